"""Whole jobs: source and sink are arguments, never fixed."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from querytrail.functions.decode import decode, with_event_time
from querytrail.operators.counts import COUNT, GID, count_by, grouping_counts
from querytrail.operators.filters import keyword_filter
from querytrail.operators.pivot import DEFAULT_MAX_VALUES, pivot_pairs
from querytrail.operators.ranking import top_per_group
from querytrail.operators.windows import trending
from querytrail.plans.reuse import cached
from querytrail.schemas import EVENT, LOG
from querytrail.session import ensure_checkpoint_dir
from querytrail.sinks.batches import append_batches
from querytrail.sinks.tables import SinkConfig, write_all
from querytrail.sinks.topic import publish
from querytrail.streaming.runner import start, to_console

log = logging.getLogger(__name__)

# Output names of the reference's result collections (fixed values).
TOP_REGIONS = "top_10_sehirler"
TOP_SEARCHES = "top_10_aramalar"
USER_PIVOT = "search_by_userid_pivot"
TRENDING = "trending_searches_30min"
USER_TERMS = "search_by_userid_terms"
KEYWORD_HITS = "realtime_maske_searches"
KEYWORD = "maske"


@dataclass
class JobResult:
    outputs: dict[str, DataFrame]
    status: dict[str, str] = field(default_factory=dict)
    rows: int | None = None


def top_counts(decoded: DataFrame, keys: list[str], k: int) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """Top-``k`` per key for several keys, plus the row count, from ONE scan.

    One :func:`grouping_counts` aggregate, ranked per key with a map-side
    group limit, leaves at most ``k`` rows per key plus the total row (the
    overall grouping set is a group of one, always rank 1).  Returns
    ``(small, {key: top-k frame}, total-count frame)``; persist ``small``
    (at most ``k * len(keys) + 1`` rows) when several of them are used.
    """
    agg, gids, total_gid = grouping_counts(decoded, keys, total=True)
    order = [F.col(COUNT).desc()] + [F.col(c).asc_nulls_first() for c in keys]
    small = top_per_group(agg, [GID], k, order, rank_col="__rank")
    tops = {
        key: small.filter(F.col(GID) == gid).orderBy(F.col("__rank")).select(key, COUNT)
        for key, gid in gids.items()
    }
    total = small.filter(F.col(GID) == total_gid).select(COUNT)
    return small, tops, total


def top_searches_job(messages: DataFrame, sink: SinkConfig, k: int = 10, preview: bool = False, drop_malformed: bool = False) -> JobResult:
    """LOG messages -> top-``k`` regions and terms -> two outputs."""
    used = None if preview else ["region", "search"]
    decoded = decode(messages, LOG, drop_malformed=drop_malformed, fields=used)
    small, tops, total = top_counts(decoded, ["region", "search"], k)
    outputs = {TOP_REGIONS: tops["region"], TOP_SEARCHES: tops["search"]}
    with cached(small):
        rows = total.first()[COUNT]
        log.info("messages: %s", rows)
        if preview and rows:
            decoded.show(10, truncate=False)
        if preview:
            for name, df in outputs.items():
                log.info("%s", name)
                df.show(k, truncate=False)
        status = write_all(outputs, sink)
    return JobResult(outputs, status, rows)


def user_term_pairs(messages: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """EVENT messages -> ``(user_id, search, count)``, parsing no other field."""
    return count_by(decode(messages, EVENT, drop_malformed=drop_malformed, fields=["user_id", "search"]), "user_id", "search")


def user_pivot_job(
    messages: DataFrame,
    sink: SinkConfig,
    values: list | None = None,
    fill_key: bool = False,
    preview: bool = False,
    drop_malformed: bool = False,
    max_values: int = DEFAULT_MAX_VALUES,
) -> JobResult:
    """EVENT messages -> user x term matrix -> one output.

    The (user, term) counts are checkpointed once; the column list, the
    number of messages and the matrix come from them, and the matrix is
    computed once, by the write.  With ``values`` the column ``other`` holds
    the terms outside the list, so no message is lost.  More than
    ``max_values`` terms are an error; :func:`user_terms_job` has no limit.
    """
    if preview:
        with_event_time(decode(messages, EVENT), "timestamp", out="timestamp").printSchema()
    ensure_checkpoint_dir(messages.sparkSession)
    pairs = user_term_pairs(messages, drop_malformed).checkpoint(eager=True)
    rows = pairs.agg(F.coalesce(F.sum(COUNT), F.lit(0))).first()[0]
    log.info("messages: %s", rows)
    other = None if values is None else "other"
    matrix = pivot_pairs(pairs, "user_id", "search", COUNT, values, other, fill_key, max_values)
    with cached(matrix, when=preview) as m:
        if preview:
            m.show(10, truncate=False)
        status = write_all({USER_PIVOT: m}, sink)
    return JobResult({USER_PIVOT: matrix}, status, rows)


def user_terms_job(messages: DataFrame, sink: SinkConfig, preview: bool = False, drop_malformed: bool = False) -> JobResult:
    """J2 in long form: EVENT messages -> ``(user_id, search, count)`` -> one
    output.  Any number of terms, and only the combinations that occur."""
    pairs = user_term_pairs(messages, drop_malformed)
    with cached(pairs, when=preview) as p:
        if preview:
            p.show(10, truncate=False)
        status = write_all({USER_TERMS: p}, sink)
    return JobResult({USER_TERMS: pairs}, status)


def trending_job(
    messages: DataFrame,
    sink: SinkConfig,
    width: str = "30 minutes",
    preview: bool = False,
    sort_output: bool = False,
    drop_malformed: bool = False,
) -> JobResult:
    """EVENT messages -> counts per window and term -> one output.

    With a preview the aggregate is persisted so preview and write share
    one read of the topic (the reference read it twice, SURVEY D8).  The preview is sorted
    by count; the written table is sorted only with ``sort_output``, since
    neither a document store nor a multi-file table keeps row order and the
    global sort costs a range shuffle.
    """
    decoded = with_event_time(decode(messages, EVENT, drop_malformed=drop_malformed))
    counts = trending(decoded, width=width, sort=False)
    with cached(counts, when=preview) as c:
        ordered = c.orderBy(F.col(COUNT).desc(), F.col("start_time").asc(), F.col("search").asc_nulls_first())
        if preview:
            ordered.show(10, truncate=False)
        status = write_all({TRENDING: ordered if sort_output else c}, sink)
    return JobResult({TRENDING: ordered if sort_output else counts}, status)


def keyword_events(messages: DataFrame, *keywords: str) -> DataFrame:
    """Decode -> keyword filter -> event time: the J4 plan, batch or stream."""
    decoded = decode(messages, EVENT)
    return with_event_time(keyword_filter(decoded, "search", *(keywords or (KEYWORD,))))


def keyword_tracker_stream(
    stream: DataFrame,
    sink: SinkConfig,
    checkpoint: str,
    keywords: tuple[str, ...] = (KEYWORD,),
    name: str = KEYWORD_HITS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keyword hits appended per micro-batch, every 10 s by default."""
    hits = keyword_events(stream, *keywords)
    return start(
        hits,
        checkpoint,
        mode="append",
        trigger=trigger if trigger is not None else {"processingTime": "10 seconds"},
        foreach_batch=append_batches(name, sink, owner=checkpoint),
    )


LIVE_TRENDING = "live_trending_30min"


def live_trending_stream(
    stream: DataFrame,
    sink: SinkConfig,
    checkpoint: str,
    watermark: str,
    width: str = "30 minutes",
    mode: str = "update",
    name: str = LIVE_TRENDING,
    trigger: dict | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Counts per window and term kept live on the stream.

    ``update`` appends each batch's changed windows (read the newest with
    :func:`querytrail.streaming.latest_window_counts`), ``append`` only
    windows the watermark has closed, ``complete`` replaces the table with
    the whole result every batch (its state is never freed: for tables that
    stay small).  ``watermark`` has no default: rows that come later than it
    are not counted, so it must suit the topic.  ``partitions`` is that of
    :func:`querytrail.streaming.start`.
    """
    from querytrail.sinks.batches import replace_each_batch
    from querytrail.streaming.live import live_trending

    counts = live_trending(with_event_time(decode(stream, EVENT)), watermark, width=width)
    writer = replace_each_batch(name, sink) if mode == "complete" else append_batches(name, sink, owner=checkpoint)
    return start(counts, checkpoint, mode=mode, trigger=trigger, foreach_batch=writer, partitions=partitions)


def decoded_events(messages: DataFrame) -> DataFrame:
    """Decode -> event time: the J5 plan, batch or stream."""
    return with_event_time(decode(messages, EVENT))


def decode_stream(stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Decoded events printed to the console."""
    return to_console(decoded_events(stream), checkpoint, trigger)


def publish_job(df: DataFrame, topic: str, servers: str | None = None, columns: list[str] | None = None) -> None:
    """Rows -> JSON messages -> topic."""
    publish(df, topic, servers, columns)
