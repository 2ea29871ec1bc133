"""Key x term count matrix."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.functions.names import column as col
from querytrail.operators.counts import COUNT, count_by
from querytrail.session import ensure_checkpoint_dir

# Spark's own ceiling for data-derived pivot columns (spark.sql.pivotMaxValues).
DEFAULT_MAX_VALUES = 10_000


def distinct_values(df: DataFrame, column: str, max_values: int = DEFAULT_MAX_VALUES) -> list:
    """Sorted (nulls first) distinct values of ``column``, at most ``max_values``.

    Runs a partial/final aggregate and brings back at most
    ``max_values + 1`` rows, so the driver only ever holds a checked,
    bounded list.  More values than that is an error, not a silent cut.
    """
    rows = df.select(col(column)).distinct().orderBy(col(column).asc_nulls_first()).limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(
            f"pivot column {column!r} has more than {max_values} distinct values; raise max_values, pass values=, "
            "or use the long form, count_by(key, column)"
        )
    return [r[0] for r in rows]


def column_names(values: Iterable, taken: Iterable[str] = ()) -> list[str]:
    """A column name for each value that no other column has, even for a
    sink that ignores case.

    A null is named ``null``, an empty text ``empty``, any other value by its
    text.  A name that is taken gets the first free of ``_2``, ``_3``, ...;
    values are named in their order, so ``Maske, maske`` become ``Maske,
    maske_2``.
    """
    used = {t.casefold() for t in taken}
    out = []
    for value in values:
        base = "null" if value is None else (str(value) or "empty")
        name, n = base, 1
        while name.casefold() in used:
            n += 1
            name = f"{base}_{n}"
        used.add(name.casefold())
        out.append(name)
    return out


def pivot_pairs(
    pairs: DataFrame,
    key: str = "user_id",
    column: str = "search",
    count: str = COUNT,
    values: Sequence | None = None,
    other: str | None = None,
    fill_key: bool = False,
    max_values: int = DEFAULT_MAX_VALUES,
) -> DataFrame:
    """The matrix of (key, value, count) rows; see :func:`pivot_counts`.

    One plan for any number of columns: Spark's two-phase pivot, its columns
    addressed by position.  ``pairs`` is read once, and once more for the
    column list where ``values`` is not given, so pass a stored frame then.
    """
    values = distinct_values(pairs, column, max_values) if values is None else list(values)
    names = column_names(values, [key] + ([other] if other else []))
    if values:
        wide = pairs.groupBy(col(key)).pivot(column, values).agg(F.sum(col(count))).toDF(key, *names)
    else:
        wide = pairs.select(col(key)).distinct()
    zero = F.lit(0).cast("bigint")
    out = wide.select(col(key), *[F.coalesce(col(n), zero).alias(n) for n in names])
    if other:
        known = [v for v in values if v is not None]
        inside = F.coalesce(col(column).isin(known), F.lit(None in values)) if known else (col(column).isNull() & F.lit(None in values))
        rest = pairs.groupBy(col(key).alias("__key")).agg(F.sum(F.when(~inside, col(count)).otherwise(zero)).alias("__other"))
        out = out.join(rest, col(key).eqNullSafe(F.col("__key"))).select(col(key), *[col(n) for n in names], F.col("__other").alias(other))
    if fill_key:
        out = out.withColumn(key, F.coalesce(col(key), F.lit(0).cast(pairs.schema[key].dataType)))
    return out


def pivot_counts(
    df: DataFrame,
    key: str = "user_id",
    column: str = "search",
    values: Sequence | None = None,
    other: str | None = None,
    fill_key: bool = False,
    max_values: int = DEFAULT_MAX_VALUES,
) -> DataFrame:
    """One row per ``key``, one ``bigint`` count column per ``column`` value.

    Column set: ``values`` if given, else the data's distinct values, sorted
    with null first (M6); names by :func:`column_names`.  Missing combinations
    are 0.  With ``values``, the column ``other`` (if named) counts all terms
    outside the list.  A null key stays null unless ``fill_key`` (the
    reference's ``na.fill(0)`` turned it into 0, M5).

    The input is read once, into (key, value) counts.  Without ``values``
    these are checkpointed to the shared checkpoint directory, and both the
    column list and the matrix come from that small result.  On a stream keep
    the long form (:func:`querytrail.streaming.live_counts`) and pivot what
    it wrote.
    """
    if df.isStreaming:
        raise ValueError("a stream has no fixed set of columns: use live_counts and pivot what it wrote")
    pairs = count_by(df, key, column)
    if values is None:
        ensure_checkpoint_dir(df.sparkSession)
        pairs = pairs.checkpoint(eager=True)
    return pivot_pairs(pairs, key, column, COUNT, values, other, fill_key, max_values)
