"""Stateful live views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.functions.names import column
from querytrail.operators.counts import count_by
from querytrail.operators.windows import window_counts


def live_trending(
    sdf: DataFrame,
    watermark: str,
    time_col: str = "timestamp_dt",
    term: str = "search",
    width: str = "30 minutes",
) -> DataFrame:
    """Window counts on a stream, with a required watermark.

    The watermark bounds the state: a window is final and its state
    dropped once event time passes its end plus ``watermark``.  Rows
    older than that are late and not counted.  Use with output mode
    ``append`` (final windows only), ``update`` (changed windows each
    batch) or ``complete`` (whole table each batch; state is then kept).
    """
    if not watermark:
        raise ValueError("a watermark delay is required")
    timed = sdf.withWatermark(time_col, watermark)
    return window_counts(timed, time_col, term, width)


def latest_counts(appended: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Final counts from the rows an ``update``-mode count stream appended
    batch by batch.

    Update mode re-emits a key's row each time one of its counts grows, and
    counts never shrink, so the largest value per key and column is the
    newest one.  A plain aggregate, with the partial step before its
    shuffle; the ``batch_id`` column, if kept, is ignored.
    """
    keys = list(keys)
    cols = [c for c in appended.columns if c not in keys and c != "batch_id"]
    return appended.groupBy(*[column(k) for k in keys]).agg(*[F.max(column(c)).alias(c) for c in cols])


def latest_window_counts(appended: DataFrame, term: str = "search") -> DataFrame:
    """:func:`latest_counts` for :func:`live_trending` output."""
    return latest_counts(appended, ["start_time", "end_time", term])


def live_counts(sdf: DataFrame, *keys: str) -> DataFrame:
    """Counts per key tuple on a stream, in long form: the live form of the
    key x term matrix (§4), with no list of terms to know beforehand.

    Run in ``update`` mode: each batch emits only the tuples it changed.
    :func:`latest_counts` over what was written is the exact count, and
    :func:`querytrail.operators.pivot.pivot_pairs` its matrix.  The state is
    one row per tuple; without a watermark no row is ever late.
    """
    return count_by(sdf, *keys)


__all__ = ["latest_counts", "latest_window_counts", "live_counts", "live_trending"]
