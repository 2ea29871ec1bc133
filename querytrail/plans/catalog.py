"""Driver-facing queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (``events``, ``part``, ``documents``)
in full and runs the library's own operators on them.  Message-level
queries first serialise the table rows to JSON messages (the wire
adapters) and decode them again, so the real decode path is measured.
Timestamps leave as ``timestamp_ntz`` (UTC wall clock) so they compare
with the oracle's zone-less ``TIMESTAMP``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from querytrail.functions.decode import decode, event_time_from_millis, with_event_time
from querytrail.functions.encode import encode_json
from querytrail.functions.quarantine import route
from querytrail.operators.counts import count_by, row_count, top_k, top_values
from querytrail.operators.filters import keyword_filter
from querytrail.operators.pivot import pivot_counts, pivot_pairs
from querytrail.operators.ranking import user_top_terms
from querytrail.operators.sketches import merge_sketches, sketched_topk
from querytrail.operators.windows import hourly_counts, trending, trending_topk
from querytrail.plans.incremental import (
    Sketches,
    state_table,
    top_searches_incremental,
    trending_incremental,
    update_counts,
    user_pivot_incremental,
    user_terms_incremental,
)
from querytrail.plans.jobs import (
    KEYWORD_HITS,
    LIVE_TRENDING,
    TOP_REGIONS,
    TOP_SEARCHES,
    TRENDING,
    USER_PIVOT,
    USER_TERMS,
    decoded_events,
    keyword_events,
    keyword_tracker_stream,
    live_trending_stream,
    top_searches_job,
    trending_job,
    user_pivot_job,
    user_terms_job,
)
from querytrail.schemas import EVENT, LOG
from querytrail.session import ensure_checkpoint_dir, shared_dir
from querytrail.sinks.batches import append_batches, read_batches
from querytrail.sinks.tables import SinkConfig, read_table, write_table
from querytrail.sources.tables import load_table
from querytrail.sources.topics import stream_topic_files, write_topic_files
from querytrail.sources.wire import event_rows, events_wire, parts_wire
from querytrail.streaming.dedupe import distinct_messages
from querytrail.streaming.live import latest_counts, latest_window_counts, live_counts, live_trending
from querytrail.streaming.ranking import latest_topk, live_topk
from querytrail.streaming.runner import run_to_end, start, state_partitions
from querytrail.streaming.supervise import Restarts, supervise

# Fixed parameters of the registered queries.
TOP_K = 10
RANK_K = 3
EVENT_KEYWORD = "SiGn"
DOCUMENT_KEYWORDS = ("Über", "été")
# Size of a stream's micro-batches: files per trigger, messages per file.
BATCH_FILES = 4
FILE_MESSAGES = 10_000
DRAIN = {"availableNow": True}
# Longer than any table's span of event time.
LONG_WATERMARK = "36500 days"

Query = Callable[[SparkSession, str], DataFrame]


def to_ntz(df: DataFrame) -> DataFrame:
    """Session-zone timestamps -> ``timestamp_ntz`` at the result edge."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_wire(load_table(spark, sf_dir, "events"))


def log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts_wire(load_table(spark, sf_dir, "part"))


def decoded(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Decoded events with their time; ``fields``: the message fields to parse
    (all, if none is named)."""
    return with_event_time(decode(event_messages(spark, sf_dir), EVENT, fields=fields or None))


# --- decoding -------------------------------------------------------------


def q_decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(decoded(spark, sf_dir))


def q_replace_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode(event_messages(spark, sf_dir), EVENT)
    return to_ntz(with_event_time(d, "timestamp", out="timestamp"))


def q_decode_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decode(log_messages(spark, sf_dir), LOG)
    return to_ntz(event_time_from_millis(d, "timestamp", out="timestamp_dt"))


def q_encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = encode_json(event_rows(load_table(spark, sf_dir, "events")))
    return msgs.select(F.col("value").cast("string").alias("message"))


# --- counts and top-k -----------------------------------------------------


def q_count_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One decoded row per message, so nothing needs to be parsed to count.
    return row_count(decode(event_messages(spark, sf_dir), EVENT, barrier=False))


def q_top_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(decode(event_messages(spark, sf_dir), EVENT, fields=["region"]), "region", TOP_K)


def q_top_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(decode(event_messages(spark, sf_dir), EVENT, fields=["search"]), "search", TOP_K)


def q_top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(decode(event_messages(spark, sf_dir), EVENT, fields=["user_id"]), "user_id", TOP_K)


def q_top_log_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(decode(log_messages(spark, sf_dir), LOG, fields=["search"]), "search", TOP_K)


def q_top_log_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(decode(log_messages(spark, sf_dir), LOG, fields=["region"]), "region", TOP_K)


def q_top_log_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top regions and top terms of the LOG messages from one scan (J1's plan)."""
    return top_values(decode(log_messages(spark, sf_dir), LOG, fields=["region", "search"]), ["region", "search"], TOP_K)


def q_user_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(decode(event_messages(spark, sf_dir), EVENT, fields=["user_id", "search"]), "user_id", "search")


def q_user_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_counts(decode(event_messages(spark, sf_dir), EVENT, fields=["user_id", "search"]), "user_id", "search")


# --- time windows ---------------------------------------------------------


def q_trending_30min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(trending(decoded(spark, sf_dir, "search", "timestamp")))


def q_trending_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(trending_topk(decoded(spark, sf_dir, "search", "timestamp"), RANK_K))


def q_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_counts(decoded(spark, sf_dir, "timestamp"))


def q_user_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_top_terms(decode(event_messages(spark, sf_dir), EVENT, fields=["user_id", "search"]), RANK_K)


# --- keyword filters ------------------------------------------------------


def q_keyword_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_ntz(keyword_events(event_messages(spark, sf_dir), EVENT_KEYWORD))


def q_keyword_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    return keyword_filter(docs, "text", *DOCUMENT_KEYWORDS).select("doc_id", "lang", "source", "n_chars", "text")


# --- whole jobs, written to a table and read back ---------------------------


def _job_sink(spark: SparkSession, name: str) -> SinkConfig:
    return SinkConfig(root=shared_dir(spark, name))


def q_job_top_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of the top-k job, tagged with their output name."""
    sink = _job_sink(spark, "job_top_searches")
    top_searches_job(log_messages(spark, sf_dir), sink, k=TOP_K)
    regions = spark.read.parquet(sink.path(TOP_REGIONS))
    terms = spark.read.parquet(sink.path(TOP_SEARCHES))
    return regions.select(F.lit(TOP_REGIONS).alias("output"), F.col("region").alias("value"), "count").unionByName(
        terms.select(F.lit(TOP_SEARCHES).alias("output"), F.col("search").alias("value"), "count")
    )


def q_job_user_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 with the original job's fill of the key (M5)."""
    sink = _job_sink(spark, "job_user_pivot")
    user_pivot_job(event_messages(spark, sf_dir), sink, fill_key=True)
    return spark.read.parquet(sink.path(USER_PIVOT))


def q_job_user_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 in long form."""
    sink = _job_sink(spark, "job_user_terms")
    user_terms_job(event_messages(spark, sf_dir), sink)
    return spark.read.parquet(sink.path(USER_TERMS))


def q_job_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _job_sink(spark, "job_trending")
    trending_job(event_messages(spark, sf_dir), sink)
    return to_ntz(spark.read.parquet(sink.path(TRENDING)))


# --- streaming ------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """The events as a file topic under ``base``, read back as a stream whose
    micro-batches hold at most :data:`BATCH_FILES` files of
    :data:`FILE_MESSAGES` messages each."""
    events = events_wire(load_table(spark, sf_dir, "events"))
    topic = write_topic_files(events, os.path.join(base, "topic"), rows_per_file=FILE_MESSAGES)
    return stream_topic_files(spark, topic, max_files_per_trigger=BATCH_FILES)


def _written(spark: SparkSession, result: DataFrame, name: str, sink: SinkConfig) -> DataFrame:
    """What a stream over ``result`` wrote to ``name``; no rows, if no batch
    had any."""
    try:
        return read_batches(spark, name, sink)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or no data in it
            raise
        return spark.createDataFrame([], result.schema)


def _drain(spark: SparkSession, result: DataFrame, base: str, name: str, mode: str = "append") -> DataFrame:
    """Run ``result`` (a stream over the file topic) to the end, appending
    each micro-batch to ``base/name``, then read the table back."""
    sink = SinkConfig(root=base)
    checkpoint = os.path.join(base, "checkpoint")
    writer = append_batches(name, sink, log_count=False, owner=checkpoint)
    run_to_end(start(result, checkpoint, mode=mode, trigger=DRAIN, foreach_batch=writer, partitions=state_partitions(spark)))
    return _written(spark, result, name, sink)


def q_stream_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream_keyword")
    hits = keyword_events(_event_stream(spark, sf_dir, base), EVENT_KEYWORD)
    return to_ntz(_drain(spark, hits, base, "hits"))


def q_job_keyword_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 as a whole job, with its own writer."""
    base = shared_dir(spark, "job_keyword_stream")
    stream, sink = _event_stream(spark, sf_dir, base), SinkConfig(root=base)
    run_to_end(keyword_tracker_stream(stream, sink, os.path.join(base, "checkpoint"), (EVENT_KEYWORD,), trigger=DRAIN))
    return to_ntz(_written(spark, keyword_events(stream, EVENT_KEYWORD), KEYWORD_HITS, sink))


def q_stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream_decode")
    rows = decoded_events(_event_stream(spark, sf_dir, base))
    return to_ntz(_drain(spark, rows, base, "decoded"))


def q_append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the keyword hits appended to a table in two writes, the events
    before and from noon; rows without a time belong to the first."""
    sink = SinkConfig(root=shared_dir(spark, "append_table"))
    hits = keyword_events(event_messages(spark, sf_dir), EVENT_KEYWORD)
    late = F.coalesce(F.hour("timestamp_dt") >= 12, F.lit(False))
    for part in (hits.where(~late), hits.where(late)):
        write_table(part, "hits", sink, mode="append")
    return to_ntz(spark.read.parquet(sink.path("hits")))


def q_live_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 in complete mode: each micro-batch carries the whole window table,
    so the last batch written is the exact answer.  The state is never freed,
    so this mode is for tables that stay small; :func:`q_live_trending_update`
    is the mode for long-running streams."""
    base = shared_dir(spark, "live_trending")
    stream, sink = _event_stream(spark, sf_dir, base), SinkConfig(root=base)
    counts = live_trending(decoded_events(stream), watermark="1 hour")
    checkpoint, partitions = os.path.join(base, "checkpoint"), state_partitions(spark)
    run_to_end(live_trending_stream(stream, sink, checkpoint, "1 hour", mode="complete", trigger=DRAIN, partitions=partitions))
    return to_ntz(_written(spark, counts, LIVE_TRENDING, sink))


def q_live_trending_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 in update mode: the newest count of each window from the appended
    changes.  The files are in no order of time, so the watermark is longer
    than the table's span and no event is late."""
    base = shared_dir(spark, "live_trending_update")
    stream, sink = _event_stream(spark, sf_dir, base), SinkConfig(root=base)
    counts = live_trending(decoded_events(stream), watermark=LONG_WATERMARK)
    checkpoint, partitions = os.path.join(base, "checkpoint"), state_partitions(spark)
    run_to_end(live_trending_stream(stream, sink, checkpoint, LONG_WATERMARK, trigger=DRAIN, partitions=partitions))
    return to_ntz(latest_window_counts(_written(spark, counts, LIVE_TRENDING, sink)))


def q_stream_user_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user x term matrix kept live on the stream: (user, term) counts in
    ``update`` mode, pivoted when they are read.  The terms come from what
    the stream has written, so a new one needs no restart."""
    base = shared_dir(spark, "stream_user_pivot")
    pairs = live_counts(decode(_event_stream(spark, sf_dir, base), EVENT, fields=["user_id", "search"]), "user_id", "search")
    newest = latest_counts(_drain(spark, pairs, base, "pairs", mode="update"), ["user_id", "search"])
    ensure_checkpoint_dir(spark)
    return pivot_pairs(newest.checkpoint(eager=True), "user_id", "search")


# --- snapshots, incremental runs, live ranking, message faults ----------------

LIVE_BUCKETS = 2


def q_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a table replaced at once: the hits before noon, then all of them;
    what is read is the newest snapshot."""
    sink = SinkConfig(root=shared_dir(spark, "replace_table"), snapshots=True)
    hits = keyword_events(event_messages(spark, sf_dir), EVENT_KEYWORD)
    write_table(hits.where(F.hour("timestamp_dt") < 12), "hits", sink)
    write_table(hits, "hits", sink)
    return to_ntz(read_table(spark, "hits", sink))


def q_append_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5, T4: keyword hits appended to a snapshot table by a supervised stream
    whose callback dies once after its rows were committed; the restart
    replays that batch, and a compaction follows."""
    base = shared_dir(spark, "append_replayed")
    hits = keyword_events(_event_stream(spark, sf_dir, base), EVENT_KEYWORD)
    sink, checkpoint = SinkConfig(root=base, snapshots=True), os.path.join(base, "checkpoint")
    append, died = append_batches("hits", sink, log_count=False, owner=checkpoint), []

    def callback(df: DataFrame, batch_id: int) -> None:
        append(df, batch_id)
        if not died:
            died.append(batch_id)
            raise RuntimeError("the callback dies once, its rows are committed")

    supervise(spark, lambda: start(hits, checkpoint, trigger=DRAIN, foreach_batch=callback), Restarts(wait_s=0.01))
    table = sink.table(spark, "hits")
    table.compact()
    table.expire(keep=1)
    return to_ntz(read_table(spark, "hits", sink, hits.schema).select(*hits.columns))


def _two_runs(spark: SparkSession, messages: DataFrame, base: str, run: Callable[[DataFrame], object]) -> None:
    """``run`` over a file topic with one part of the messages, and again when
    the other has come."""
    topic = os.path.join(base, "topic")
    part = F.pmod(F.xxhash64("value"), F.lit(2))
    for i in range(2):
        write_topic_files(messages.where(part == i), topic, rows_per_file=FILE_MESSAGES)
        run(stream_topic_files(spark, topic, max_files_per_trigger=BATCH_FILES))


def _incremental(spark: SparkSession, messages: DataFrame, name: str, job: Callable) -> SinkConfig:
    base = shared_dir(spark, name)
    sink, state = (SinkConfig(root=os.path.join(base, d), snapshots=True) for d in ("out", "state"))
    _two_runs(spark, messages, base, lambda stream: job(stream, sink, state, os.path.join(base, "checkpoint")))
    return sink


def q_job_top_searches_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 in two runs, the second over the new messages only."""
    sink = _incremental(spark, log_messages(spark, sf_dir), "job_top_searches_incremental", top_searches_incremental)
    regions, terms = read_table(spark, TOP_REGIONS, sink), read_table(spark, TOP_SEARCHES, sink)
    return regions.select(F.lit(TOP_REGIONS).alias("output"), F.col("region").alias("value"), "count").unionByName(
        terms.select(F.lit(TOP_SEARCHES).alias("output"), F.col("search").alias("value"), "count")
    )


def q_job_user_pivot_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 in two runs, from the state's counts."""
    return read_table(spark, USER_PIVOT, _incremental(spark, event_messages(spark, sf_dir), "job_user_pivot_incremental", user_pivot_incremental))


def q_job_user_terms_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 in long form, in two runs."""
    return read_table(spark, USER_TERMS, _incremental(spark, event_messages(spark, sf_dir), "job_user_terms_incremental", user_terms_incremental))


def q_job_trending_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 in two runs."""
    return to_ntz(read_table(spark, TRENDING, _incremental(spark, event_messages(spark, sf_dir), "job_trending_incremental", trending_incremental)))


def q_live_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 as a ranking: the top of every window, kept on the stream, from the
    changes it has emitted.  The files are in no order of time, so no event
    may be late and all windows stay open."""
    base = shared_dir(spark, "live_topk")
    timed = with_event_time(decode(_event_stream(spark, sf_dir, base), EVENT, fields=["search", "timestamp"]))
    sink, checkpoint = SinkConfig(root=base, snapshots=True), os.path.join(base, "checkpoint")
    top = live_topk(timed, LONG_WATERMARK, RANK_K, buckets=LIVE_BUCKETS)
    append = append_batches("top", sink, log_count=False, owner=checkpoint)
    run_to_end(start(top, checkpoint, mode="update", trigger=DRAIN, foreach_batch=append, state="rocksdb", partitions=state_partitions(spark)))
    return to_ntz(latest_topk(read_table(spark, "top", sink, top.schema).select(*top.columns), RANK_K))


def q_stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event sent twice, as by a producer that retries, with its id:
    each is taken once."""
    base = shared_dir(spark, "stream_deduplicated")
    events = load_table(spark, sf_dir, "events")
    sent = encode_json(event_rows(events, "event_id"))
    topic = os.path.join(base, "topic")
    for _ in range(2):
        write_topic_files(sent, topic, rows_per_file=FILE_MESSAGES)
    schema = StructType([*EVENT.fields, StructField("event_id", LongType())])
    stream = with_event_time(decode(stream_topic_files(spark, topic, max_files_per_trigger=BATCH_FILES), schema))
    once = distinct_messages(stream, ["event_id"], "timestamp_dt", LONG_WATERMARK)
    sink, checkpoint = SinkConfig(root=base, snapshots=True), os.path.join(base, "checkpoint")
    append = append_batches("once", sink, log_count=False, owner=checkpoint)
    run_to_end(start(once, checkpoint, trigger=DRAIN, foreach_batch=append, state="rocksdb", partitions=state_partitions(spark)))
    return to_ntz(read_table(spark, "once", sink, once.schema).select(*once.columns))


def q_trending_daily_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 over any span: 30-minute sketches, kept by two runs over the growing
    topic, merged to days; the terms fit the sketch, so counts are exact."""
    base, kind = shared_dir(spark, "trending_daily_sketch"), Sketches()
    state = SinkConfig(root=os.path.join(base, "state"))
    _two_runs(spark, event_messages(spark, sf_dir), base, lambda stream: update_counts(stream, kind, state, os.path.join(base, "checkpoint")))
    stored = state_table(spark, state, kind).read(schema=kind.schema)
    return to_ntz(sketched_topk(merge_sketches(stored, width="1 day"), RANK_K))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event messages, of which some users' are broken: cut short, in a
    list, or with an id that is no number."""
    events = load_table(spark, sf_dir, "events")
    kind = F.pmod(F.col("user_id"), F.lit(7))
    broken = (
        F.when(kind == 0, F.expr("substring(text, 1, length(text) - 1)"))
        .when(kind == 1, F.concat(F.lit("["), F.col("text"), F.lit("]")))
        .when(kind == 2, F.replace(F.col("text"), F.lit('"user_id":'), F.lit('"user_id":"no number","was":')))
        .otherwise(F.col("text"))
    )
    sent = event_rows(events).select("user_id", F.to_json(F.struct("*")).alias("text"))
    return sent.select(broken.cast("binary").alias("value"))


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by outcome, and the decoded fields of the good ones."""
    routed = route(damaged_messages(spark, sf_dir), EVENT)
    good = routed.good().groupBy("search").agg(F.count("*").alias("count")).select(F.lit("good").alias("outcome"), "search", "count")
    bad = routed.bad().groupBy("reason").agg(F.count("*").alias("count"))
    return good.unionByName(bad.select(F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("search"), "count"))


QUERIES: dict[str, Query] = {
    "decode_events": q_decode_events,
    "replace_event_time": q_replace_event_time,
    "decode_logs": q_decode_logs,
    "encode_events": q_encode_events,
    "count_events": q_count_events,
    "top_regions": q_top_regions,
    "top_searches": q_top_searches,
    "top_users": q_top_users,
    "top_log_searches": q_top_log_searches,
    "top_log_regions": q_top_log_regions,
    "top_log_overview": q_top_log_overview,
    "user_term_counts": q_user_term_counts,
    "user_pivot": q_user_pivot,
    "trending_30min": q_trending_30min,
    "trending_topk": q_trending_topk,
    "hourly_counts": q_hourly_counts,
    "user_top_terms": q_user_top_terms,
    "keyword_events": q_keyword_events,
    "keyword_documents": q_keyword_documents,
    "job_top_searches": q_job_top_searches,
    "job_user_pivot": q_job_user_pivot,
    "job_user_terms": q_job_user_terms,
    "job_trending": q_job_trending,
    "append_table": q_append_table,
    "stream_keyword": q_stream_keyword,
    "job_keyword_stream": q_job_keyword_stream,
    "stream_decode": q_stream_decode,
    "live_trending": q_live_trending,
    "live_trending_update": q_live_trending_update,
    "stream_user_pivot": q_stream_user_pivot,
    "replace_table": q_replace_table,
    "append_replayed": q_append_replayed,
    "job_top_searches_incremental": q_job_top_searches_incremental,
    "job_user_pivot_incremental": q_job_user_pivot_incremental,
    "job_user_terms_incremental": q_job_user_terms_incremental,
    "job_trending_incremental": q_job_trending_incremental,
    "live_topk": q_live_topk,
    "stream_deduplicated": q_stream_deduplicated,
    "trending_daily_sketch": q_trending_daily_sketch,
    "quarantine": q_quarantine,
}

__all__ = ["QUERIES"]
