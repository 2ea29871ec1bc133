"""Messages that a producer sent more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where a message is in its topic: the key of one that a *reader* may see
#: twice.  A producer that sends again gets another offset; for that the key is
#: an id inside the message, or its bytes (:func:`message_digest`).
POSITION = ("topic", "partition", "offset")

#: From this span on nothing is late and nothing expires (:func:`endless`).
ENDLESS = "36500 days"


def message_digest(column: str = "value") -> Column:
    """A key for messages without an id: equal bytes, equal key.  Two events
    that are equal in every field are one by this key."""
    return F.sha2(F.col(column), 256)


def endless(spark: SparkSession, within: str) -> bool:
    """Is the span so long that a stream never outlives it?

    Spark's watermark starts in 1970 and frees an entry when a message's time
    is twice the span after the entry's: from a century on, two of them.
    """
    end = "timestamp_seconds(0) + CAST(:{} AS INTERVAL)"
    return spark.sql(f"SELECT {end.format('within')} >= {end.format('endless')}", args={"within": within, "endless": ENDLESS}).head()[0]


def distinct_messages(sdf: DataFrame, keys: Sequence[str], time_col: str, within: str) -> DataFrame:
    """The first of all messages that share ``keys`` and lie within ``within``
    of each other in event time; on a stream or a static frame.

    On a stream the state holds one entry per key, which expires when the
    watermark has passed the message's time by ``within``: it is bounded by
    the topic's rate times that span, not by its length.  A repeat that comes
    later than that is late, and dropped as every late row is.  Rows without a
    time can't be told old from new and are left out: give them one first (a
    topic's own ``timestamp`` is never null).  A static frame has no
    watermark: all its repeats go.

    To free entries Spark reads the whole state at the end of every
    micro-batch, which a span's worth of entries bounds.  With a span that is
    :func:`endless` there is no bound and nothing to free, and that reading
    would make a stream's time grow with the square of its length: all repeats
    go, no row is late, and a micro-batch only looks up its own keys.  A
    checkpoint belongs to the kind of span it was begun with.
    """
    if not within:
        raise ValueError("a span is required: without one the state would grow without end")
    if not keys:
        raise ValueError("a key is required")
    timed = sdf.where(F.col(time_col).isNotNull())
    if not sdf.isStreaming or endless(sdf.sparkSession, within):
        return timed.dropDuplicates(list(keys))
    return timed.withWatermark(time_col, within).dropDuplicatesWithinWatermark(list(keys))
