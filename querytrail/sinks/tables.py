"""Named result tables: replace / append, one or many (K1, K2, K3, K6)."""

from __future__ import annotations

import logging
import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

from querytrail.sinks.snapshots import SnapshotTable
from querytrail.sinks.store import Store

log = logging.getLogger(__name__)

FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro", "text"}


@dataclass(frozen=True)
class SinkConfig:
    """Where named results go.

    File formats write ``root/<name>``.  ``fmt="mongodb"`` (the MongoDB
    Spark connector 10.x, when on the classpath) writes collection
    ``<name>`` of ``database`` at ``uri``; any other format gets the name
    as its ``collection``/``dbtable``-style option via ``name_option``.

    ``snapshots`` makes each file table a :class:`SnapshotTable`: replaces and
    appends are atomic, also beside other writers, and readers resolve the
    newest snapshot (:func:`read_table`).  ``keep`` snapshots stay after a
    replace.  Without it a table is a plain folder, as other tools read it.
    """

    fmt: str = "parquet"
    root: str | None = None
    uri: str | None = None
    database: str | None = None
    name_option: str = "collection"
    options: dict[str, str] = field(default_factory=dict)
    snapshots: bool = False
    keep: int = 2

    def table(self, spark: SparkSession, name: str) -> SnapshotTable:
        """The snapshot table of the result ``name``."""
        if self.fmt not in FILE_FORMATS:
            raise ValueError(f"format {self.fmt!r} has no snapshots")
        return SnapshotTable(spark, self.path(name), self.fmt, self.options)

    def path(self, name: str) -> str:
        if self.root is None:
            raise ValueError(f"format {self.fmt!r} needs a root directory")
        return os.path.join(self.root, name)

    def options_for(self, name: str) -> dict[str, str]:
        """Writer options for the result ``name`` (path-based formats get
        the name as a path instead, see :meth:`path`)."""
        opts = dict(self.options)
        if self.fmt in FILE_FORMATS:
            return opts
        if self.fmt == "mongodb":
            if self.uri:
                opts["connection.uri"] = self.uri
            if self.database:
                opts["database"] = self.database
        opts[self.name_option] = name
        return opts

    def writer(self, df: DataFrame, name: str, mode: str) -> tuple[DataFrameWriter, str | None]:
        w = df.write.format(self.fmt).mode(mode).options(**self.options_for(name))
        return w, (self.path(name) if self.fmt in FILE_FORMATS else None)


def write_table(df: DataFrame, name: str, sink: SinkConfig, mode: str = "overwrite") -> None:
    """Replace (``overwrite``) or extend (``append``) the result ``name``."""
    if mode not in {"overwrite", "append", "error", "errorifexists", "ignore"}:
        raise ValueError(f"unknown save mode {mode!r}")
    if sink.snapshots and sink.fmt in FILE_FORMATS:
        _write_snapshot(df, sink.table(df.sparkSession, name), mode, sink.keep)
        return
    writer, path = sink.writer(df, name, mode)
    if path is None:
        writer.save()
    elif mode == "overwrite":
        _replace_folder(df, name, sink)
    else:
        writer.save(path)


def _write_snapshot(df: DataFrame, table: SnapshotTable, mode: str, keep: int) -> None:
    if mode == "append":
        table.append(df)
        return
    if mode != "overwrite" and table.current().folders:
        if mode == "ignore":
            return
        raise FileExistsError(f"{table.path} has rows already")
    table.replace(df)
    table.expire(keep)


def _replace_folder(df: DataFrame, name: str, sink: SinkConfig) -> None:
    """Write beside the table, then swap: a write that fails leaves the
    previous rows.  The swap itself is two renames; a process that dies
    between them leaves the previous rows in ``.old-...`` next to the table
    (``snapshots`` has no such gap)."""
    tag = uuid.uuid4().hex
    folder, _, leaf = sink.path(name).rstrip("/").rpartition("/")
    store = Store(df.sparkSession, folder or ".")
    new, old = f".new-{leaf}-{tag}", f".old-{leaf}-{tag}"
    try:
        df.write.format(sink.fmt).options(**sink.options_for(name)).save(f"{store.root}/{new}")
        there = store.exists(leaf)
        if there:
            store.rename(leaf, old)
        try:
            store.rename(new, leaf)
        except BaseException:
            if there:
                store.rename(old, leaf)
            raise
    except BaseException:
        store.delete(new)
        raise
    if there:
        store.delete(old)


def read_table(spark: SparkSession, name: str, sink: SinkConfig, schema: StructType | None = None) -> DataFrame:
    """The rows of the result ``name`` of a file sink, in either layout.
    ``schema`` is for a snapshot table that nothing was written to."""
    if sink.snapshots:
        return sink.table(spark, name).read(schema=schema)
    return spark.read.format(sink.fmt).options(**sink.options).load(sink.path(name))


class WriteFailed(RuntimeError):
    """Raised by :func:`write_all` after every output was attempted."""

    def __init__(self, failures: dict[str, BaseException]):
        self.failures = failures
        super().__init__("failed outputs: " + ", ".join(f"{k}: {v!r}" for k, v in failures.items()))


def write_all(outputs: dict[str, DataFrame], sink: SinkConfig, mode: str = "overwrite", raise_on_failure: bool = True) -> dict[str, str]:
    """Write each output independently (K6).

    One failing write does not stop the next; afterwards the failures are
    raised together (the reference only logged them, SURVEY D6) unless
    ``raise_on_failure`` is false.  Returns ``{name: "ok" | error text}``.
    """
    status: dict[str, str] = {}
    failures: dict[str, BaseException] = {}
    for name, df in outputs.items():
        try:
            write_table(df, name, sink, mode)
            status[name] = "ok"
            log.info("wrote %s", name)
        except Exception as exc:  # keep going, report at the end
            failures[name] = exc
            status[name] = f"{type(exc).__name__}: {exc}"
            log.error("writing %s failed: %s", name, exc)
    if failures and raise_on_failure:
        raise WriteFailed(failures)
    return status
