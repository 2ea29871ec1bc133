"""Rows -> UTF-8 JSON messages (SURVEY K7, the producers' serializer)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_json(df: DataFrame, columns: Iterable[str] | None = None, key: str | None = None) -> DataFrame:
    """One ``value binary`` column holding each row as compact JSON.

    ``key`` optionally adds a ``key binary`` column (a topic message key).
    Null fields are left out of the object, as ``to_json`` does.
    """
    cols = list(columns) if columns is not None else df.columns
    value = F.to_json(F.struct(*[F.col(c) for c in cols])).cast("binary").alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").cast("binary").alias("key"), value)


def encode_events(df: DataFrame, key: str | None = None) -> DataFrame:
    """EVENT messages from a frame with the EVENT columns (others ignored),
    fields in schema order, as the event producers send them."""
    from querytrail.schemas import EVENT

    return encode_json(df, [f.name for f in EVENT.fields], key)
