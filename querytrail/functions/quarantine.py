"""Messages that don't decode, kept apart with their text and the reason."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from querytrail.functions.names import free_name

REASON, VALUE = "reason", "value"

# The reasons, in the order in which they are looked for.
MISSING, NOT_TEXT, NOT_JSON, NOT_OBJECT, BAD_FIELDS, NO_FIELD = "missing", "not utf-8", "not json", "not an object", "bad fields", "no known field"


def outcome(value: Column, fields: list[Column], corrupt: Column) -> Column:
    """Why a binary message is bad, from its parsed fields and what the parser
    noted as corrupt; null for one that decodes without loss.

    * ``missing``: no value; ``not utf-8``; ``not json`` (empty text too);
    * ``not an object``: a JSON list, number, text or null;
    * ``bad fields``: an object with a field that is not of its type, which
      :func:`decode` makes null;
    * ``no known field``.  Unknown fields are no fault, nor are missing ones as
      long as one is there.
    """
    text = value.cast("string")
    none = reduce(lambda a, b: a & b, [f.isNull() for f in fields], F.lit(True))
    is_json = F.try_parse_json(text).isNotNull()
    is_object = F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1) == "{"
    return (
        F.when(value.isNull(), MISSING)
        .when(~F.is_valid_utf8(text), NOT_TEXT)
        .when(~is_object, F.when(is_json, NOT_OBJECT).otherwise(NOT_JSON))
        .when(corrupt.isNotNull(), F.when(is_json, BAD_FIELDS).otherwise(NOT_JSON))
        .when(none, NO_FIELD)
    )


@dataclass(frozen=True)
class Routed:
    """Messages by their outcome: ``rows`` has them all, ``good`` the decoded
    fields of those that decode, ``bad`` the others as they came."""

    rows: DataFrame
    schema: StructType
    keep: tuple[str, ...]

    def good(self, rows: DataFrame | None = None) -> DataFrame:
        """``keep...``, the fields; of :attr:`rows`, or of the part of them
        that a micro-batch holds."""
        rows = self.rows if rows is None else rows
        return rows.where(F.col(REASON).isNull()).select(*self.keep, *self.schema.names)

    def bad(self, rows: DataFrame | None = None) -> DataFrame:
        """``keep..., value, reason``."""
        rows = self.rows if rows is None else rows
        return rows.where(F.col(REASON).isNotNull()).select(*self.keep, VALUE, REASON)

    def counted(self, observation: Observation | str) -> Routed:
        """The same messages, counted as they pass: ``read``, ``good`` and
        ``bad`` of ``observation`` after an action over :attr:`rows` (a name,
        on a stream: they are in its progress)."""
        bad = F.col(REASON).isNotNull()
        rows = self.rows.observe(observation, F.count(F.lit(1)).alias("read"), F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
        return replace(self, rows=rows)


def route(messages: DataFrame, schema: StructType, column: str = "value", keep: Iterable[str] = ()) -> Routed:
    """Parse each message once and note why it is bad, if it is.

    Rows without loss equal those of :func:`decode`.  A message with one bad
    field, whose other fields ``decode`` keeps, is bad here as a whole: it can
    be mended and sent again from its text.  ``keep`` names columns (offset,
    partition) that go along.  Works on a stream too.
    """
    keep = tuple(keep)
    clash = sorted({VALUE, REASON} & {*keep, *schema.names} | {*keep} & {*schema.names})
    if clash:
        raise ValueError(f"columns {clash} collide; kept columns, message fields, {VALUE!r} and {REASON!r} need names of their own")
    corrupt = free_name("corrupt", [*keep, *schema.names, VALUE, REASON])
    parsed = F.from_json(
        F.col(column).cast("string"), StructType([*schema.fields, StructField(corrupt, StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    )
    # Behind a generator, so that filters on the outcome don't parse again.
    staged = messages.select(*keep, F.col(column).alias(VALUE), F.inline(F.array(parsed)))
    reason = outcome(F.col(VALUE), [F.col(n) for n in schema.names], F.col(corrupt))
    return Routed(staged.withColumn(REASON, reason).drop(corrupt), schema, keep)

