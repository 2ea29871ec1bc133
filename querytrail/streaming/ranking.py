"""The top terms of every open window, kept on the stream.

Each micro-batch first counts its own (window, term) pairs where the messages
are (a map-side combine, Arrow batch by Arrow batch), so a term in a third of
all messages crosses the shuffle as one row per batch.  The counts then go to
keyed state by window and a bucket of the term's hash, so the current window is
shared by as many tasks as there are buckets.  A term is in one bucket, so a
window's top ``k`` is among its buckets' top ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType, TimestampType

from querytrail.functions.names import column
from querytrail.operators.counts import COUNT
from querytrail.operators.ranking import top_per_group
from querytrail.operators.windows import has_room
from querytrail.streaming.live import latest_counts

BUCKETS = 16

_PAIRS = StructType(
    [
        StructField("start_time", TimestampType()), StructField("end_time", TimestampType()),
        StructField("bucket", LongType()), StructField("term", StringType()), StructField("n", LongType()),
    ]
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of equal rows, batch by batch."""
    keys = ["start_time", "end_time", "bucket", "term"]
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
        out = table.rename_columns([*keys, "n"]).combine_chunks()
        yield from out.to_batches()


class TopTerms(StatefulProcessor):
    """The ``k`` largest counts of one window and bucket, one state value, and
    the exact counts of all its other terms, a state entry each.

    Counts only grow, so new members of the top are among the terms that the
    batch counted: the other terms' counts are not read.  Emits the top's rows
    that are new or have changed.  A timer frees the state once the watermark
    has passed the window's end; rows of a window that late are left out, as
    a windowed aggregate does.
    """

    def __init__(self, k: int) -> None:
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        term = [StructField("missing", BooleanType()), StructField("term", StringType())]
        count = StructField("n", LongType())
        # Each call is a round trip to the state store: one for the whole top.
        self.top = handle.getValueState("top", StructType([StructField("rows", ArrayType(StructType([*term, count])))]))
        self.others = handle.getMapState("others", StructType(term), StructType([count]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start, end, _ = key
        end_ms = round(end.timestamp() * 1000)
        added: dict[tuple[bool, str], int] = {}
        for row in rows:
            t = (True, "") if row.term is None else (False, row.term)
            added[t] = added.get(t, 0) + row.n
        if end_ms <= timerValues.getCurrentWatermarkInMs() or not added:
            return
        held = self.top.get()
        if held is None:
            self.handle.registerTimer(end_ms)
        before = {(m, t): n for m, t, n in held[0]} if held is not None else {}
        top = dict(before)
        for term, n in added.items():
            if term not in before and len(before) >= self.k:  # a top that isn't full has all terms
                known = self.others.getValue(term)
                n += known[0] if known is not None else 0
            top[term] = before.get(term, 0) + n
        # Most frequent first, then by term with null first: the batch form's order.
        order = sorted(top.items(), key=lambda r: (-r[1], not r[0][0], r[0][1].encode()))
        best = dict(order[: self.k])
        for term, n in order[self.k :]:
            self.others.updateValue(term, (n,))
        self.top.update(([(*t, n) for t, n in best.items()],))
        for (missing, term), n in best.items():
            if before.get((missing, term)) != n:
                yield Row(start_time=start, end_time=end, term=None if missing else term, n=n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.others.clear()
        self.top.clear()
        return iter(())

    def close(self) -> None:
        pass


def live_topk(
    sdf: DataFrame,
    watermark: str,
    k: int = 3,
    time_col: str = "timestamp_dt",
    term: str = "search",
    width: str = "30 minutes",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``start_time, end_time, term, count`` rows: members of the top ``k`` of
    each open window's buckets, each time one is new or its count changes.

    Start it in ``update`` mode with ``state_store="rocksdb"``
    (:func:`querytrail.streaming.start`); :func:`latest_topk` of what was
    written is the ranking right now, and after the last batch equals
    :func:`querytrail.operators.trending_topk`.  Windows and null times are
    those of :func:`querytrail.operators.window_counts`; ``watermark`` says how
    late an event may come.
    """
    if not watermark:
        raise ValueError("a watermark delay is required")
    if k <= 0 or buckets <= 0:
        raise ValueError("k and buckets must be positive")
    timed = sdf.withWatermark(time_col, watermark).filter(has_room(time_col, width))
    pairs = timed.select(F.window(column(time_col), width).alias("w"), column(term).cast("string").alias("term")).select(
        F.col("w.start").alias("start_time"),
        F.col("w.end").alias("end_time"),
        F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"),
        "term",
    )
    counted = pairs.mapInArrow(_counted, _PAIRS)
    out = StructType([_PAIRS["start_time"], _PAIRS["end_time"], _PAIRS["term"], _PAIRS["n"]])
    tops = counted.groupBy("start_time", "end_time", "bucket").transformWithState(
        statefulProcessor=TopTerms(k), outputStructType=out, outputMode="Update", timeMode="EventTime"
    )
    return tops.select("start_time", "end_time", F.col("term").alias(term), F.col("n").alias(COUNT))


def latest_topk(appended: DataFrame, k: int = 3, term: str = "search") -> DataFrame:
    """The ``k`` most searched terms of each window, with ``rank``, from what
    :func:`live_topk` wrote so far.

    A term's largest count is its newest.  One that fell out of its bucket's
    top may have grown since, but not past the ``k`` terms that came before
    it, so its older count can't bring it back.
    """
    newest = latest_counts(appended, ["start_time", "end_time", term])
    return top_per_group(newest, ["start_time", "end_time"], k, order=[F.col(COUNT).desc(), column(term).asc_nulls_first()])


__all__ = ["TopTerms", "latest_topk", "live_topk"]
