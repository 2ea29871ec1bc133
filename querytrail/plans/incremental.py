"""The batch jobs J1-J3 over a growing topic: each run reads what is new.

A run is a stream over the topic that drains what is there and stops
(``availableNow``); its checkpoint is the manifest of consumed files or of end
offsets.  Each micro-batch is reduced to partial counts by key, which are
appended to a state table (a :class:`SnapshotTable`) in one step with the
batch's id, so that a run that died and is started again counts no message
twice.  Counts add up, so the state is the sum by key over all appended rows,
and a compaction that sums them by key keeps it small.  The outputs are made
from the state and replace the earlier ones at once.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from querytrail.functions.decode import decode, with_event_time
from querytrail.functions.names import column
from querytrail.operators.counts import COUNT, count_by, grouping_counts
from querytrail.operators.pivot import DEFAULT_MAX_VALUES, pivot_pairs
from querytrail.operators.ranking import top_per_group
from querytrail.operators.sketches import TRACKED, merge_sketches, term_sketches
from querytrail.operators.windows import window_counts
from querytrail.plans.jobs import TOP_REGIONS, TOP_SEARCHES, TRENDING, USER_PIVOT, USER_TERMS, JobResult
from querytrail.schemas import EVENT, LOG
from querytrail.session import ensure_checkpoint_dir
from querytrail.sinks.snapshots import SnapshotTable
from querytrail.sinks.tables import SinkConfig, write_all
from querytrail.streaming.runner import run_to_end, start

log = logging.getLogger(__name__)

#: Appended folders from which on a run ends with a compaction.
COMPACT_AT = 16
DRAIN = {"availableNow": True}


@dataclass(frozen=True)
class Counts:
    """What one job counts: ``partial`` turns messages into ``keys..., count``."""

    name: str
    keys: tuple[str, ...]
    partial: Callable[[DataFrame], DataFrame]
    schema: StructType

    def merged(self, rows: DataFrame) -> DataFrame:
        """One row for each key of any number of partial counts."""
        return rows.groupBy(*[column(k) for k in self.keys]).agg(F.sum(COUNT).alias(COUNT))


def _schema(**fields) -> StructType:
    return StructType([StructField(k, t) for k, t in fields.items()] + [StructField(COUNT, LongType())])


def _log_values(messages: DataFrame) -> DataFrame:
    """``dimension, value, count`` of the LOG messages, from one aggregate."""
    agg, gids, _ = grouping_counts(decode(messages, LOG, fields=["region", "search"]), ["region", "search"])
    gid = F.col(agg.columns[-1])
    region = gid == gids["region"]
    return agg.select(
        F.when(region, "region").otherwise("search").alias("dimension"),
        F.when(region, F.col("region")).otherwise(F.col("search")).alias("value"),
        COUNT,
    )


def _user_terms(messages: DataFrame) -> DataFrame:
    return count_by(decode(messages, EVENT, fields=["user_id", "search"]), "user_id", "search")


LOG_VALUES = Counts("log_values_state", ("dimension", "value"), _log_values, _schema(dimension=StringType(), value=StringType()))
USER_TERM_PAIRS = Counts("user_terms_state", ("user_id", "search"), _user_terms, _schema(user_id=EVENT["user_id"].dataType, search=StringType()))


def window_terms(width: str = "30 minutes") -> Counts:
    """Counts by window and term; a state table belongs to one width."""

    def partial(messages: DataFrame) -> DataFrame:
        return window_counts(with_event_time(decode(messages, EVENT, fields=["search", "timestamp"])), width=width)

    name = "window_terms_state_" + "_".join(width.lower().split())
    return Counts(name, ("start_time", "end_time", "search"), partial, _schema(start_time=TimestampType(), end_time=TimestampType(), search=StringType()))


@dataclass(frozen=True)
class Sketches:
    """Frequent terms by window, for terms without bound: like
    :class:`Counts`, with sketches that merge instead of counts that add up."""

    width: str = "30 minutes"
    tracked: int = TRACKED

    @property
    def name(self) -> str:
        return f"term_sketches_state_{self.tracked}_" + "_".join(self.width.lower().split())

    @property
    def schema(self) -> StructType:
        sketch = "struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"
        return StructType.fromDDL(f"start_time timestamp, end_time timestamp, sketch {sketch}, rows bigint")

    def partial(self, messages: DataFrame) -> DataFrame:
        timed = with_event_time(decode(messages, EVENT, fields=["search", "timestamp"]))
        return term_sketches(timed, width=self.width, tracked=self.tracked)

    def merged(self, rows: DataFrame) -> DataFrame:
        return merge_sketches(rows, tracked=self.tracked)


def state_table(spark: SparkSession, sink: SinkConfig, counts: Counts | Sketches) -> SnapshotTable:
    return replace(sink, snapshots=True).table(spark, counts.name)


def update_counts(stream: DataFrame, counts: Counts | Sketches, state: SinkConfig, checkpoint: str, compact_at: int = COMPACT_AT, timeout: float | None = None) -> DataFrame:
    """Count the messages of ``stream`` that no earlier run has, and return
    the counts over all runs.

    ``stream`` is a streaming read of the topic from its beginning
    (:func:`stream_topic` with ``starting="earliest"``, or
    :func:`stream_topic_files`); its options bound the micro-batches.  One
    state table belongs to one checkpoint, another one is refused.
    """
    spark = stream.sparkSession
    table = state_table(spark, state, counts)
    table.claim(checkpoint)

    def append(batch: DataFrame, batch_id: int) -> None:
        inside = state_table(batch.sparkSession, state, counts)
        if inside.committed(checkpoint, batch_id):
            log.info("%s: batch %s is counted already", counts.name, batch_id)
            return
        inside.append(counts.partial(batch), checkpoint, batch_id)

    run_to_end(start(stream, checkpoint, trigger=DRAIN, foreach_batch=append), timeout)
    if len(table.current().folders) >= compact_at:
        table.compact(counts.merged)
        table.expire(state.keep)
    return counts.merged(table.read(schema=counts.schema))


def top_searches_incremental(stream: DataFrame, sink: SinkConfig, state: SinkConfig, checkpoint: str, k: int = 10, **run) -> JobResult:
    """The top-``k`` regions and terms over all messages so far."""
    if k <= 0:
        raise ValueError("k must be positive")
    totals = update_counts(stream, LOG_VALUES, state, checkpoint, **run)
    ensure_checkpoint_dir(stream.sparkSession)
    order = [F.col(COUNT).desc(), F.col("value").asc_nulls_first()]
    tops = top_per_group(totals, ["dimension"], k, order).checkpoint(eager=True)  # at most 2 k rows
    outputs = {
        name: tops.where(F.col("dimension") == dim).orderBy("rank").select(F.col("value").alias(dim), COUNT)
        for name, dim in ((TOP_REGIONS, "region"), (TOP_SEARCHES, "search"))
    }
    return JobResult(outputs, write_all(outputs, sink))


def user_terms_incremental(stream: DataFrame, sink: SinkConfig, state: SinkConfig, checkpoint: str, **run) -> JobResult:
    """J2 in long form: counts by user and term over all messages so far."""
    outputs = {USER_TERMS: update_counts(stream, USER_TERM_PAIRS, state, checkpoint, **run)}
    return JobResult(outputs, write_all(outputs, sink))


def user_pivot_incremental(
    stream: DataFrame, sink: SinkConfig, state: SinkConfig, checkpoint: str, fill_key: bool = False, max_values: int = DEFAULT_MAX_VALUES, **run
) -> JobResult:
    """The user x term matrix over all messages so far; a new term is a
    new column."""
    ensure_checkpoint_dir(stream.sparkSession)
    pairs = update_counts(stream, USER_TERM_PAIRS, state, checkpoint, **run).checkpoint(eager=True)
    outputs = {USER_PIVOT: pivot_pairs(pairs, "user_id", "search", COUNT, None, None, fill_key, max_values)}
    return JobResult(outputs, write_all(outputs, sink))


def trending_incremental(stream: DataFrame, sink: SinkConfig, state: SinkConfig, checkpoint: str, width: str = "30 minutes", **run) -> JobResult:
    """Counts by window and term over all messages so far.  No message is
    too late: windows of any time can grow."""
    outputs = {TRENDING: update_counts(stream, window_terms(width), state, checkpoint, **run)}
    return JobResult(outputs, write_all(outputs, sink))

