"""Keyword filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyword_match(column: str | Column, *terms: str) -> Column:
    """True when the lower-cased text contains any lower-cased term.

    Both sides are lowered by Spark itself (the needle is folded to a
    constant), so text and needle follow the same case rules, e.g. 'İ'
    lowers to two code points on both sides (M11).  Null text is no match.
    """
    if not terms:
        raise ValueError("at least one term is required")
    text = F.lower(F.col(column) if isinstance(column, str) else column)
    cond = None
    for term in terms:
        hit = text.contains(F.lower(F.lit(term)))
        cond = hit if cond is None else (cond | hit)
    return F.coalesce(cond, F.lit(False))


def keyword_filter(df: DataFrame, column: str, *terms: str) -> DataFrame:
    """Rows whose ``column`` contains any of ``terms``, case-insensitive.

    A narrow filter: no shuffle, works unchanged on streaming frames.
    """
    return df.filter(keyword_match(column, *terms))
