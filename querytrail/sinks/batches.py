"""Micro-batch writer for ``foreachBatch``."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from querytrail.functions.quarantine import Routed
from querytrail.sinks.snapshots import OutputOwnedElsewhere
from querytrail.sinks.store import Store
from querytrail.sinks.tables import FILE_FORMATS, SinkConfig, read_table, write_table

log = logging.getLogger(__name__)

BATCH_COLUMN = "batch_id"
STREAM_COLUMN = "stream"
OWNER_MARK = "_owner"


class BatchInDoubt(RuntimeError):
    """A batch may be written in part, and nothing can take it back."""


def claim_output(spark: SparkSession, path: str, owner: str) -> None:
    """Tie the output at ``path`` to ``owner`` (a checkpoint location).

    The first writer leaves a marker file under ``path`` (readers skip names
    starting with ``_``), which only one of several can create; a later
    writer with another owner is refused, because its batch ids restart at 0
    and would replace the earlier stream's batches.
    """
    store = Store(spark, path)
    if not store.put_new(OWNER_MARK, owner):
        entry = next(e for e in store.entries() if e.name == OWNER_MARK)
        # A folder is the form that earlier versions left.
        found = [r.value for r in spark.read.text(f"{store.root}/{OWNER_MARK}").collect()] if entry.folder else [store.read_text(OWNER_MARK)]
        if found and found != [owner]:
            raise OutputOwnedElsewhere(f"{path} belongs to the stream checkpointed at {found[0]}, not {owner}")


class BatchLedger:
    """Which micro-batches an output without transactions has, as small files
    under ``root``, by output and stream.

    A batch is noted as started before its rows are written and as done after.
    A replay of a done batch is left out; a started one was cut short, and its
    rows must be taken back before they are written again.
    """

    #: Notes of so many batches stay; replays only reach back to the last one.
    KEEP = 16

    def __init__(self, root: str) -> None:
        self.root = root

    def _folder(self, output: str, stream: str) -> str:
        return f"{output}/{stream_tag(stream)}"

    def state(self, spark: SparkSession, output: str, stream: str, batch: int) -> str | None:
        """``done``, ``started`` or none."""
        names = {e.name for e in Store(spark, self.root).entries(self._folder(output, stream))}
        if any(n.endswith(".done") and int(n[:-5]) >= batch for n in names):
            return "done"
        return "started" if f"{batch:012d}.started" in names else None

    def start(self, spark: SparkSession, output: str, stream: str, batch: int) -> None:
        Store(spark, self.root).put_new(f"{self._folder(output, stream)}/{batch:012d}.started", stream)

    def finish(self, spark: SparkSession, output: str, stream: str, batch: int) -> None:
        store, folder = Store(spark, self.root), self._folder(output, stream)
        store.put_new(f"{folder}/{batch:012d}.done", stream)
        for e in store.entries(folder):
            if int(e.name.partition(".")[0]) <= batch - self.KEEP:
                store.delete(f"{folder}/{e.name}")


def stream_tag(stream: str) -> str:
    """A short name of a stream, told from its checkpoint location."""
    return hashlib.sha256(stream.encode()).hexdigest()[:16]


#: Takes back the rows of one batch: ``undo(spark, name, stream tag, batch id)``.
Undo = Callable[[SparkSession, str, str, int], None]


def append_batches(
    name: str,
    sink: SinkConfig,
    log_count: bool = True,
    owner: str | None = None,
    ledger: BatchLedger | None = None,
    undo: Undo | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that appends each non-empty batch to ``name``.

    Exactly-once, by the kind of the sink:

    * snapshot tables: rows and batch id are committed in one step; a batch
      that is in already is left out (``owner`` names the stream there, else
      the output's name does);
    * plain file formats: batch ``N`` is written to its own partition
      directory ``batch_id=N`` with dynamic partition overwrite, so a batch
      replayed after a failure replaces its own earlier output;
    * other formats, with a ``ledger``: rows carry :data:`STREAM_COLUMN` and
      :data:`BATCH_COLUMN`; a done batch is left out, and the rows of one that
      was cut short are first taken back by ``undo`` (without it that is a
      :class:`BatchInDoubt` error).  Without a ledger they are appended again.

    Batch ids restart with a new checkpoint, so one output belongs to one
    checkpoint: pass that checkpoint as ``owner`` and a stream with another
    checkpoint is refused (checked once per writer).

    Nothing is cached, and for file formats a batch is computed once: its rows
    are counted while they are written, which also says whether it was empty
    (the reference computed a batch up to three times).  On a stream with
    state a look at the batch beforehand would run its state's tasks, Python
    and commits included, once more.  Other formats still look (``isEmpty``).
    """
    files = sink.fmt in FILE_FORMATS
    if ledger is not None and (files or owner is None):
        raise ValueError("a ledger is for formats other than files, and needs an owner")
    claimed, table = False, None

    def write(df: DataFrame, batch_id: int) -> None:
        nonlocal claimed, table
        spark = df.sparkSession
        added = [BATCH_COLUMN] if files else [STREAM_COLUMN, BATCH_COLUMN] if ledger is not None else []
        clash = [c for c in added if c in df.columns]
        if clash:
            raise ValueError(f"the stream already has a {clash[0]!r} column; rename it before appending batches")
        if files and sink.snapshots and table is None:
            table = sink.table(spark, name)
        if owner is not None and not claimed and files:
            table.claim(owner) if sink.snapshots else claim_output(spark, sink.path(name), owner)
            claimed = True
        folder = Store(spark, sink.path(name)) if files and not sink.snapshots else None
        fresh = folder is not None and not folder.exists()
        if not files and df.isEmpty():
            log.info("batch %s of %s is empty; nothing written", batch_id, name)
            return
        seen = Observation()
        if files or log_count:
            df = df.observe(seen, F.count(F.lit(1)).alias("n"))
        out = df.withColumn(BATCH_COLUMN, F.lit(int(batch_id)).cast("long")) if added else df
        if files and sink.snapshots:
            if table.append(out, owner or name, int(batch_id), rows=lambda: seen.get["n"]) is None:
                log.info("batch %s of %s is a replay or empty; nothing written", batch_id, name)
                return
        elif files:
            w = out.write.format(sink.fmt).mode("overwrite").options(**sink.options)
            w = w.option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN)
            w.save(sink.path(name))
        elif ledger is not None:
            state = ledger.state(spark, name, owner, int(batch_id))
            if state == "done":
                log.info("batch %s of %s is a replay; nothing written", batch_id, name)
                return
            if state == "started":
                if undo is None:
                    raise BatchInDoubt(f"batch {batch_id} of {name} was cut short, and there is no undo to take its rows back")
                undo(spark, name, stream_tag(owner), int(batch_id))
            ledger.start(spark, name, owner, int(batch_id))
            write_table(out.withColumn(STREAM_COLUMN, F.lit(stream_tag(owner))), name, sink, mode="append")
            ledger.finish(spark, name, owner, int(batch_id))
        else:
            write_table(df, name, sink, mode="append")
        if files and not seen.get["n"]:
            if fresh and all(e.name.startswith("_") for e in folder.entries()):  # the writer's own marks
                folder.delete("")
            log.info("batch %s of %s is empty; nothing written", batch_id, name)
            return
        log.info("batch %s: %s rows appended to %s", batch_id, seen.get["n"] if files or log_count else "some", name)

    return write


def replace_each_batch(name: str, sink: SinkConfig) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that replaces ``name`` with each batch.

    For ``complete`` output mode, where every micro-batch is the whole
    result table; replaying a batch rewrites the same table.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        write_table(df, name, sink, mode="overwrite")
        log.info("batch %s replaced %s", batch_id, name)

    return write


def read_batches(spark: SparkSession, name: str, sink: SinkConfig, keep_batch_id: bool = False) -> DataFrame:
    """Read back what :func:`append_batches` wrote to a file sink."""
    df = read_table(spark, name, sink)
    if not keep_batch_id and BATCH_COLUMN in df.columns:
        df = df.drop(BATCH_COLUMN)
    return df


def split_batches(routed: Routed, good: Callable[[DataFrame, int], None], bad: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback over ``routed.rows`` that hands each batch's
    good and bad messages to two callbacks, :func:`append_batches` of two
    outputs (P2).

    The batch is parsed once and kept for both, on disk where memory is short;
    its size is the trigger's.  Each output is exactly-once for itself, so a
    replay completes whichever was not written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good(routed.good(held), batch_id)
            bad(routed.bad(held), batch_id)
        finally:
            held.unpersist()

    return write
