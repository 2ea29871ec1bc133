"""Per-group top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querytrail.functions.names import column, free_name
from querytrail.operators.counts import COUNT, count_by

# Spark's default for spark.sql.optimizer.windowGroupLimitThreshold.
GROUP_LIMIT = 1000
SPLITS = 64


def top_per_group(df: DataFrame, group: Sequence[str], k: int, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each ``group`` under ``order``.

    ``row_number`` over a hash partition of ``group``; Spark plans a
    per-partition sort and a window-group limit that drops rows beyond
    ``k`` before the window is evaluated.  Spark does so for ``k`` up to
    :data:`GROUP_LIMIT` only; beyond it each group is first cut down to
    ``k`` rows in each of :data:`SPLITS` parts, by a hash of the row, so that
    no task ranks a whole group.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    if k > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*[column(c) for c in df.columns]), F.lit(SPLITS))
        first = Window.partitionBy(*[column(c) for c in group], part).orderBy(*order)
        cut = free_name("first", df.columns)
        df = df.withColumn(cut, F.row_number().over(first)).filter(F.col(cut) <= k).drop(cut)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def user_top_terms(df: DataFrame, k: int = 3, user: str = "user_id", term: str = "search") -> DataFrame:
    """Each user's ``k`` favourite terms with counts and ``rank``."""
    pairs = count_by(df, user, term)
    return top_per_group(pairs, [user], k, order=[F.col(COUNT).desc(), F.col(term).asc_nulls_first()])
