"""Time-bucket operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.functions.names import column
from querytrail.operators.counts import COUNT
from querytrail.operators.ranking import top_per_group


def has_room(time_col: str, width: str) -> Column:
    """True for a non-null time with room for ``width`` on both sides of it.

    Only times at the very ends of Spark's timestamp range (some 292,000
    years from the epoch) lack it; window and zone arithmetic overflows
    there, which is an error under ANSI.
    """
    ts, step = column(time_col), F.expr(f"INTERVAL '{width}'")
    return F.try_add(ts, step).isNotNull() & F.try_subtract(ts, step).isNotNull()


def window_counts(df: DataFrame, time_col: str = "timestamp_dt", term: str = "search", width: str = "30 minutes") -> DataFrame:
    """``start_time, end_time, term, count`` per tumbling window and term.

    Windows are half-open and epoch-aligned (M9); rows with a null time
    have no window and drop out (M4), and so do times at the ends of the
    timestamp range whose window would overflow (:func:`has_room`); every
    other time counts, whatever its year.  A partial aggregate runs before
    the shuffle on (window, term).  The filter keeps the time column itself,
    so a stream's watermark still applies.
    """
    df = df.filter(has_room(time_col, width))
    agg = df.groupBy(F.window(F.col(time_col), width).alias("window"), F.col(term)).agg(
        F.count(F.lit(1)).alias(COUNT)
    )
    return agg.select(
        F.col("window.start").alias("start_time"),
        F.col("window.end").alias("end_time"),
        F.col(term),
        F.col(COUNT),
    )


def trending(
    df: DataFrame,
    time_col: str = "timestamp_dt",
    term: str = "search",
    width: str = "30 minutes",
    sort: bool = True,
) -> DataFrame:
    """Window counts, most frequent first (A7 + O2).

    The global sort is for display; ``sort=False`` leaves it out where the
    consumer (a table, a document store) keeps no order anyway.  Ties are
    ordered by window start and term so the order is repeatable.
    """
    out = window_counts(df, time_col, term, width)
    if sort:
        out = out.orderBy(F.col(COUNT).desc(), F.col("start_time").asc(), F.col(term).asc_nulls_first())
    return out


def trending_topk(
    df: DataFrame,
    k: int = 3,
    time_col: str = "timestamp_dt",
    term: str = "search",
    width: str = "30 minutes",
) -> DataFrame:
    """The ``k`` most searched terms within each window (E1), with ``rank``.

    The ranking shuffle moves only aggregated (window, term) rows, so one
    busy window costs at most one row per term in the ranking task.
    """
    counts = window_counts(df, time_col, term, width)
    return top_per_group(counts, ["start_time", "end_time"], k, order=[F.col(COUNT).desc(), F.col(term).asc_nulls_first()])


def hourly_counts(df: DataFrame, time_col: str = "timestamp_dt", zone: str | None = None) -> DataFrame:
    """``hour int, count bigint``: events per hour of the day.

    Hours are read in the session zone, or in ``zone`` (e.g. the users'
    local zone) when given.  Rows without a time form the null hour, so
    counts add up to the input.
    """
    ts = F.col(time_col)
    if zone is not None:
        # session-zone wall clock -> wall clock in ``zone``; times within two
        # days of the ends of the timestamp range join the null hour
        session_zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
        local = F.convert_timezone(F.lit(session_zone), F.lit(zone), ts.cast("timestamp_ntz"))
        ts = F.when(has_room(time_col, "2 days"), local)
    return df.groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias(COUNT))
