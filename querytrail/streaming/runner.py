"""Starting streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# Settings of a query's state store (fixed names of Spark).  RocksDB keeps the
# state on the executors' disks, not in their heap, and with changelogs a
# checkpoint writes what a batch changed, not a whole copy.
STATE_STORES: dict[str, dict[str, str]] = {
    "rocksdb": {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    },
    "memory": {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    },
}


def state_partitions(spark: SparkSession) -> int:
    """One for each core, at most the session's shuffle partitions: each
    partition of a query's state is a task and a commit in every micro-batch,
    however few rows it gets, and a micro-batch's size is its trigger's, not
    the topic's."""
    return min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def state_store(spark: SparkSession, kind: str | None, partitions: int | None = None) -> Iterator[None]:
    """Queries that start inside keep their state in a store of this kind, in
    so many partitions: a query takes the session's settings when it starts,
    and they are put back afterwards."""
    if kind is not None and kind not in STATE_STORES:
        raise ValueError(f"unknown state store {kind!r}; known: {sorted(STATE_STORES)}")
    if partitions is not None and partitions <= 0:
        raise ValueError("the number of partitions must be positive")
    wanted = dict(STATE_STORES.get(kind, {}))
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start(
    sdf: DataFrame,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    fmt: str | None = None,
    options: dict[str, str] | None = None,
    path: str | None = None,
    query_name: str | None = None,
    state: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start ``sdf`` with a required checkpoint (T4).

    ``trigger`` is passed to ``DataStreamWriter.trigger``: ``None`` is the
    default micro-batch trigger (T3), ``{"processingTime": "10 seconds"}``
    the reference's fixed interval (T2), ``{"availableNow": True}`` drains
    what is there and stops (tests, backfills).

    ``state`` names the store of a stateful query (:data:`STATE_STORES`):
    ``rocksdb`` for state that outgrows the executors' heaps; by default the
    session's.  A checkpoint belongs to the store it was begun with.
    ``partitions`` is the number of the state's partitions
    (:func:`state_partitions`), by default the session's; a checkpoint keeps
    the number it was begun with.
    """
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    w = sdf.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif fmt is not None:
        w = w.format(fmt)
    if options:
        w = w.options(**options)
    with state_store(sdf.sparkSession, state, partitions):
        return w.start(path) if path else w.start()


def to_console(sdf: DataFrame, checkpoint: str, trigger: dict | None = None, rows: int = 20) -> StreamingQuery:
    """Print the first ``rows`` rows of each micro-batch untruncated (K4).
    It is a display: Spark's console sink, and its default of 20 rows."""
    return start(sdf, checkpoint, "append", trigger, fmt="console", options={"truncate": "false", "numRows": str(rows)})


def run_to_end(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Block until the query ends (T6); re-raise its failure if it failed."""
    finished = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"streaming query {query.id} did not finish in {timeout}s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query
