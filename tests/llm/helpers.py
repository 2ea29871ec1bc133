"""Fixtures shared by the operator tests."""

import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Clashing names: columns that operators use or return themselves.
CLASH = ["h", "fp", "score", "hash", "root", "start", "spans", "key", "row", "n"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def documents(spark, rows, extra=True):
    """``rows``: (doc_id, text); further columns carry clashing names."""
    names = CLASH if extra else []
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())] + [StructField(c, StringType()) for c in names])
    return spark.createDataFrame([(i, t, *["x"] * len(names)) for i, t in rows], schema)


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]
