"""Keeping a frame for several actions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, when: bool = True) -> Iterator[DataFrame]:
    """Persist ``df`` for the block and release it afterwards.

    ``when=False`` yields ``df`` untouched, for blocks that act on it once.

    Cache aggregated results, not raw messages: a cached decode blocks
    Catalyst from pruning the JSON decode to the fields used, and at
    cluster scale raw messages do not fit in executor memory anyway.
    """
    if not when:
        yield df
        return
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
