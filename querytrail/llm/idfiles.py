"""Token-id files: whole texts to ids, in ascending doc_id order, and back."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from querytrail.llm.common import byte_columns, shared_folder, texts, written
from querytrail.llm.idcoder import IdFileWriter, read_id_file
from querytrail.llm.tokens import encoder

FILES = "part int, path string, n_docs long, n_ids long"


def write_id_files(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as id files and return one row per file (:data:`FILES`).

    The rows are range-partitioned and sorted by doc_id (null first, ties and
    repeated rows by a hash of the text, then the text), one file per
    partition; ``part`` gives the order.  A file is put in place whole, so a
    retried task replaces it.  A null or empty text is the end id alone.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "id-files")
    keyed = texts(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = os.path.join(folder, f"part-{part:06d}.ids")
        tmp = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
        enc = encoder(tokenizer)
        with open(tmp, "wb") as out:
            writer = IdFileWriter(out)
            for batch in batches:
                keys = batch.column(0)
                nulls = np.asarray(keys.is_null())
                doc_ids = np.asarray(keys.fill_null(0))
                data, offsets = byte_columns(batch)
                for lo, hi, ids, at in enc.batches(data, offsets):
                    writer.add(doc_ids[lo:hi], nulls[lo:hi], np.diff(at), ids)
            n_docs, n_ids = writer.close()
        os.replace(tmp, path)
        if n_docs:
            yield pa.RecordBatch.from_pylist([{"part": part, "path": path, "n_docs": n_docs, "n_ids": n_ids}], pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return written(ordered.mapInArrow(run, FILES), "id-file-list")


def read_id_files(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, from the files;
    ``start``: ids of all documents before it.  Only the list of files, one
    row each, is put in order in one task."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("part", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = first
                with open(path, "rb") as f:
                    for doc_ids, nulls, lengths, ids in read_id_file(f):
                        ends = np.cumsum(lengths)
                        raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                        crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids, mask=nulls.astype(bool)), pa.array(at + ends - lengths), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                        at += int(ends[-1])

    spark = files.sparkSession
    tasks = max(1, min(files.count(), 100_000))
    return placed.repartition(tasks, "part").select("path", "first").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
