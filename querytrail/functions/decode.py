"""Message decoding.

All functions are narrow: no shuffle, no Python, JVM expressions only.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PARSED = "__msg"


def decode(
    df: DataFrame,
    schema: StructType,
    column: str = "value",
    keep: Iterable[str] = (),
    barrier: bool = True,
    drop_malformed: bool = False,
    fields: Iterable[str] | None = None,
) -> DataFrame:
    """Bytes -> UTF-8 text -> struct by ``schema`` -> top-level columns.

    PERMISSIVE like the reference: text that is not a JSON object becomes
    an all-null row, a field of the wrong type becomes null while the other
    fields survive, unknown fields are ignored (SURVEY M1, M2).  Columns in
    ``keep`` (e.g. a topic ``timestamp`` or ``partition``) are carried
    through in front of the decoded fields.  One output row per message.

    ``barrier=True`` (default) parses each message exactly once.  The
    struct is unpacked by a one-element ``inline`` generator, which filters
    on decoded columns cannot be pushed below.  With a plain projection
    Catalyst pushes such filters (including the ``isnotnull(time)`` that
    ``window()`` adds) beneath it by substituting the ``from_json``, so a
    filtered or windowed query parses every message twice.

    ``barrier=False`` is the plain projection.  Catalyst then narrows the
    parse to the fields used and drops it when none is (a pure row count),
    so it suits frames that are only aggregated or counted, never filtered.

    ``fields`` names the message fields that are wanted, in this order: the
    default form then parses no others.  (``drop_malformed`` has to look at
    all of them, so together they narrow only the result.)

    ``drop_malformed=True`` drops messages that yield no field at all (not
    JSON, not an object, or no known field), which otherwise surface as a
    null group in counts and a ``null`` pivot column.  A message with at
    least one usable field is kept, its bad fields null.
    """
    keep = list(keep)
    clash = sorted(set(keep) & {f.name for f in schema.fields})
    if clash:
        raise ValueError(f"kept columns {clash} collide with message fields; rename them first (e.g. withColumnRenamed)")
    wanted = [schema[f] for f in fields] if fields is not None else list(schema.fields)
    if fields is not None and not drop_malformed:
        schema = StructType(wanted)
    parsed = F.from_json(F.col(column).cast("string"), schema)
    if barrier:
        out = df.select(*keep, F.inline(F.array(parsed)))
    else:
        staged = df.select(*keep, parsed.alias(_PARSED))
        out = staged.select(*keep, *[F.col(f"{_PARSED}.{f.name}").alias(f.name) for f in schema.fields])
    if drop_malformed:
        out = out.filter(~reduce(lambda a, b: a & b, [F.col(f.name).isNull() for f in schema.fields]))
    return out.select(*keep, *[f.name for f in wanted]) if len(wanted) < len(schema.fields) else out


def parse_time(column: str | Column, fmt: str | None = None) -> Column:
    """Time text -> timestamp; unparseable text gives null, never an error.

    Spark 4 runs with ANSI on, where ``cast``/``to_timestamp`` throw on bad
    input (SURVEY M3), so only the ``try_`` forms are used.
    """
    col = F.col(column) if isinstance(column, str) else column
    if fmt is None:
        return col.try_cast("timestamp")
    return F.try_to_timestamp(col, F.lit(fmt))


def with_event_time(
    df: DataFrame,
    column: str = "timestamp",
    out: str = "timestamp_dt",
    fmt: str | None = None,
) -> DataFrame:
    """Add (or, with ``out == column``, replace) a parsed event-time column."""
    return df.withColumn(out, parse_time(column, fmt))


# Largest magnitude of epoch milliseconds whose microseconds fit in a long.
_MAX_MILLIS = (2**63 - 1) // 1000


def event_time_from_millis(df: DataFrame, column: str = "timestamp", out: str = "timestamp_dt") -> DataFrame:
    """Epoch milliseconds (the LOG message's ``timestamp``) -> timestamp.

    A value too large to be a time gives null, like unparseable time text,
    instead of failing the job with an overflow.
    """
    ms = F.col(column)
    return df.withColumn(out, F.when(ms.between(-_MAX_MILLIS, _MAX_MILLIS), F.timestamp_millis(ms)))
