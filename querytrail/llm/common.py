"""Helpers shared by the operators: column views, shared files, word arrays."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from querytrail.session import ensure_checkpoint_dir, shared_dir

#: Bytes of text that one numpy pass takes at a time; longer texts go alone.
CHUNK_BYTES = 1 << 21


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text string)``; a null text becomes empty.

    Only these two columns are read, so extra columns, whatever their
    names, never meet the operators' own.
    """
    return df.select(
        df[id_col].cast("long").alias("doc_id"),
        F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"),
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: cuts the lineage at a copy that survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def mounted(uri: str) -> str:
    """The path of ``uri`` on a file system that all executors mount.

    Files that workers map into memory need one; an object store is
    refused here instead of failing later in a task.
    """
    parsed = urlparse(uri)
    if parsed.scheme == "file":
        return unquote(parsed.path)
    if parsed.scheme == "":
        return uri
    raise ValueError(f"spark.checkpoint.dir must be a mounted shared folder for this operator, got {uri!r}")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, as a mounted path."""
    path = mounted(shared_dir(spark, name))
    os.makedirs(path, exist_ok=True)
    return path


def save_array(folder: str, name: str, values: np.ndarray) -> None:
    """One ``.npy`` file, put in place whole: a retried or speculative task
    replaces it by the same bytes."""
    tmp = os.path.join(folder, f".{name}-{os.getpid()}-{os.urandom(4).hex()}")
    with open(tmp, "wb") as out:
        np.save(out, values)
    os.replace(tmp, os.path.join(folder, f"{name}.npy"))


def map_array(folder: str, name: str) -> np.ndarray:
    """The array of a ``.npy`` file, mapped into memory."""
    path = os.path.join(folder, f"{name}.npy")
    with open(path, "rb") as f:
        version = np.lib.format.read_magic(f)
        shape, _, dtype = np.lib.format.read_array_header_1_0(f) if version == (1, 0) else np.lib.format.read_array_header_2_0(f)
        if 0 in shape:
            return np.empty(shape, dtype)
    return np.load(path, mmap_mode="r")


def byte_columns(batch: pa.RecordBatch, text: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the ``n + 1`` offsets into them."""
    col = pc.fill_null(batch.column(text).cast(pa.large_binary()), b"")
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (a longer row goes alone)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi
        lo = hi


#: ASCII white space (0x20, 0x09-0x0D) and A-Z to a-z, as byte tables.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = 0x9E3779B97F4A7C15
_BYTE_CODE = np.random.Generator(np.random.PCG64(20240117)).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: np.ndarray | None = None
_LOW = 1 << 16


def _powers() -> np.ndarray:
    global _POWERS
    if _POWERS is None:
        base = np.full(_LOW, _ODD, np.uint64)
        base[0] = 1
        _POWERS = np.cumprod(base, dtype=np.uint64)
    return _POWERS


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space) and how
    many words each row has.  Words never cross rows."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a row's first byte starts a word, if it is one
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, packed: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased.  ``packed``: the words
    are all of ``data``, one after the other."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lens = ends - starts
    total = int(lens.sum())
    begin = np.cumsum(lens) - lens
    place = np.arange(total, dtype=np.int64) - np.repeat(begin, lens)
    raw = data if packed else data[np.repeat(starts, lens) + place]
    power = _powers()
    if int(lens.max()) <= _LOW:
        weight = power[place]
    else:  # very long words: high and low part of the exponent
        high = np.full(int(lens.max() >> 16) + 1, power[-1:] * np.uint64(_ODD), np.uint64)
        high[0] = 1
        weight = power[place & (_LOW - 1)] * np.cumprod(high, dtype=np.uint64)[place >> 16]
    weight *= _BYTE_CODE[LOWER[raw]]
    return mix64(np.add.reduceat(weight, begin) + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal neighbours starts, with the end appended."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]


def frames(rows: Iterable[dict], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``most`` rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
