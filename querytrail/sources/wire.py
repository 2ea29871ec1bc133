"""Adapters that turn the given tables into topic messages (FIXTURES §2).

They let every message-level query run on tables that grow with the
scale factor: the rows are serialised to JSON bytes exactly as a producer
would, then decoded again by the real decode path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.functions.encode import encode_json

# Fixed values of the fixture mapping (FIXTURES §2).
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
REGION_PREFIX = "NATION_"
REGION_BUCKETS = 25
LOG_EPOCH_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z


def as_topic(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows as they are or, if ``partitions`` is given, spread over so
    many partitions, like a topic that has them.

    Rows are hashed on a row id: evenly spread whatever the keys (duplicates
    and hot keys too), deterministic when a task is retried, and without the
    full sort that a round-robin repartition does first.
    """
    return df if partitions is None else df.repartition(partitions, F.monotonically_increasing_id())


def event_rows(events: DataFrame, *more: str) -> DataFrame:
    """``events`` -> EVENT fields: user_id int, search, region, ISO time text;
    and the columns ``more`` as they are."""
    return events.select(
        F.col("user_id").try_cast("int").alias("user_id"),  # out of range -> null, as the decoder does
        F.col("event_type").alias("search"),
        F.concat(F.lit(REGION_PREFIX), (F.col("user_id") % REGION_BUCKETS).cast("string")).alias("region"),
        F.date_format(F.col("ts"), ISO_SECONDS).alias("timestamp"),
        *more,
    )


def events_wire(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """``events`` as EVENT messages (``value binary``)."""
    return encode_json(as_topic(event_rows(events), partitions))


def log_rows(part: DataFrame) -> DataFrame:
    """``part`` -> LOG fields: search = name, region = brand, epoch millis."""
    return part.select(
        F.col("p_name").alias("search"),
        (F.lit(LOG_EPOCH_MS) + F.col("p_partkey") * F.lit(1000)).cast("bigint").alias("timestamp"),
        F.col("p_brand").alias("region"),
    )


def parts_wire(part: DataFrame, partitions: int | None = None) -> DataFrame:
    """``part`` as LOG messages (``value binary``)."""
    return encode_json(as_topic(log_rows(part), partitions))
