"""Parquet tables by name under a directory (the given test tables)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``root/name.parquet`` (file or directory), scanned lazily so Catalyst
    pushes filters and column pruning into the reader."""
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))
