"""Counting operators.

Every count is a hash aggregate with a map-side partial step, so a key
that holds a third of all rows is collapsed to one row per input
partition before the shuffle; no task ever sees the hot key's raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "count"


def _n() -> Column:
    return F.count(F.lit(1)).alias(COUNT)


def row_count(df: DataFrame) -> DataFrame:
    """One row, one ``count bigint`` column: the number of rows (A1)."""
    return df.agg(_n())


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """``keys..., count`` per distinct key tuple; null keys form a group (M7)."""
    return df.groupBy(*keys).agg(_n())


def top_k(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of ``key`` with their counts (O3).

    Ties are broken by the key (nulls first) so the cut at rank ``k`` is
    repeatable (M8).  Plans to partial/final HashAggregate followed by
    ``TakeOrderedAndProject``: each partition keeps only its own top ``k``
    and the driver merges ``k x partitions`` rows, never the whole result.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    return count_by(df, key).orderBy(F.col(COUNT).desc(), F.col(key).asc_nulls_first()).limit(k)


GID = "__gid"


def grouping_counts(df: DataFrame, keys: Sequence[str], total: bool = False) -> tuple[DataFrame, dict[str, int], int]:
    """Counts per value of each key (and optionally overall) in ONE aggregate.

    A grouping-sets aggregate ((key1), (key2), ..., [()]): each row is
    expanded once per set before the partial aggregate, so the input is
    read once and the shuffle carries only partial counts.  Returns the
    aggregate (``keys..., count, __gid``), the ``__gid`` of each key's rows
    and the ``__gid`` of the overall row.
    """
    keys = list(keys)
    sets = [[c] for c in keys] + ([[]] if total else [])
    agg = df.groupingSets(sets, *keys).agg(F.count(F.lit(1)).alias(COUNT), F.grouping_id().alias(GID))
    full = (1 << len(keys)) - 1
    # grouping_id has a 0 bit for each column grouped on, first column highest.
    gids = {key: full ^ (1 << (len(keys) - 1 - i)) for i, key in enumerate(keys)}
    return agg, gids, full


def top_values(df: DataFrame, keys: Sequence[str], k: int = 10) -> DataFrame:
    """Top-``k`` values of several columns from ONE scan, in long form.

    ``dimension string, value string, count bigint, rank int`` from
    :func:`grouping_counts`, then :func:`top_per_group` keeps ``k`` rows per
    dimension, so that the single task per dimension sees a multiple of
    ``k`` rows however many distinct values there are.
    """
    from querytrail.operators.ranking import top_per_group

    if k <= 0:
        raise ValueError("k must be positive")
    agg, gids, _ = grouping_counts(df, keys)
    dim = F.lit(None).cast("string")
    val = F.lit(None).cast("string")
    for key, gid in gids.items():
        hit = F.col(GID) == F.lit(gid)
        dim = F.when(hit, F.lit(key)).otherwise(dim)
        val = F.when(hit, F.col(key).cast("string")).otherwise(val)
    long = agg.select(dim.alias("dimension"), val.alias("value"), F.col(COUNT))
    return top_per_group(long, ["dimension"], k, order=[F.col(COUNT).desc(), F.col("value").asc_nulls_first()])
