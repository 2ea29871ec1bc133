"""Frequent terms in bounded memory: mergeable sketches by window.

Exact counts per window hold one entry for every term.  Where the set of terms
has no bound (free search text), a window's sketch holds at most ``tracked``
terms; sketches are built before the shuffle, stored, and merged to any longer
span without reading a message again.  Counts are exact as long as the terms
fit the sketch; beyond that each is off by at most :func:`largest_error` of the
rows, and a term with more rows than that is never missed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.functions.names import column
from querytrail.operators.counts import COUNT
from querytrail.operators.ranking import top_per_group
from querytrail.operators.windows import has_room

TRACKED = 1_000
#: Spark's limit on the terms that a sketch tracks.
MOST_TRACKED = 1_000_000
SKETCH, ROWS = "sketch", "rows"


def _checked(tracked: int) -> int:
    if not 1 <= int(tracked) <= MOST_TRACKED:
        raise ValueError(f"a sketch tracks 1 to {MOST_TRACKED} terms")
    return int(tracked)


def largest_error(tracked: int) -> float:
    """The share of the rows by which a count may be off, at most: 3.5 over
    the sketch's table size, the power of two that ``tracked`` fills to three
    quarters."""
    size = 8
    while size * 3 // 4 < _checked(tracked):
        size *= 2
    return 3.5 / size


def term_sketches(df: DataFrame, time_col: str = "timestamp_dt", term: str = "search", width: str = "30 minutes", tracked: int = TRACKED) -> DataFrame:
    """``start_time, end_time, sketch, rows`` per tumbling window; the windows
    are those of :func:`window_counts`.  A null term is a term."""
    call = F.call_function("approx_top_k_accumulate", column(term).cast("string"), F.lit(_checked(tracked)))
    windows = df.filter(has_room(time_col, width)).groupBy(F.window(column(time_col), width).alias("window"))
    agg = windows.agg(call.alias(SKETCH), F.count(F.lit(1)).alias(ROWS))
    return agg.select(F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time"), SKETCH, ROWS)


def merge_sketches(sketches: DataFrame, by: Sequence[str] | None = ("start_time", "end_time"), width: str | None = None, tracked: int = TRACKED) -> DataFrame:
    """Sketches of equal ``by`` columns as one; with ``width`` all sketches of
    each longer window (a multiple of theirs) as one; ``by=None``: of the
    whole frame."""
    merged = [F.call_function("approx_top_k_combine", F.col(SKETCH), F.lit(_checked(tracked))).alias(SKETCH), F.sum(ROWS).alias(ROWS)]
    if width is not None:
        agg = sketches.groupBy(F.window("start_time", width).alias("window")).agg(*merged)
        return agg.select(F.col("window.start").alias("start_time"), F.col("window.end").alias("end_time"), SKETCH, ROWS)
    if by is None:
        # A group of all rows: none, where there are none.
        return sketches.groupBy(F.lit(0).alias("all")).agg(*merged).select(SKETCH, ROWS)
    return sketches.groupBy(*[column(c) for c in by]).agg(*merged)


def sketched_topk(sketches: DataFrame, k: int = 3, by: Sequence[str] = ("start_time", "end_time"), term: str = "search", tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent terms of each sketch: ``by..., term, count,
    largest_error, rank``.

    ``count`` is never below the true one, and above it by ``largest_error``
    rows at most; that is 0 for sketches whose terms all fitted, which shows
    in fewer terms than ``tracked`` with counts that add up to the rows.  Ties
    are broken by the term.
    """
    found = F.call_function("approx_top_k_estimate", F.col(SKETCH), F.lit(_checked(tracked)))
    top = sketches.select(*by, ROWS, found.alias("found"))
    counted = F.aggregate("found", F.lit(0).cast("long"), lambda a, e: a + e["count"])
    exact = (F.size("found") < tracked) & (counted == F.col(ROWS))
    error = F.when(exact, F.lit(0)).otherwise(F.ceil(F.col(ROWS) * F.lit(largest_error(tracked)))).cast("long")
    rows = top.select(*by, error.alias("largest_error"), F.explode("found").alias("e"))
    rows = rows.select(*by, F.col("e.item").alias(term), F.col("e.count").alias(COUNT), "largest_error")
    return top_per_group(rows, list(by), k, order=[F.col(COUNT).desc(), column(term).asc_nulls_first()])
