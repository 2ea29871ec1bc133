"""Benchmark decontamination: size-partitioned MinHash containment search.

Finds short test items inside long documents.  Items are partitioned by the
size of their shingle set.  A document that contains at least ``threshold``
of an item's ``n`` distinct shingles misses fewer than
``n - ceil(threshold * n) + 1`` of them, so it must hold at least one of that
many shingles with the smallest hashes.  This MinHash sketch, sized for the
upper end of each size partition, finds every candidate; candidates are then
verified by the exact containment of their word shingles.

Items of fewer words than a shingle are partitioned by their number of words:
such an item is one shingle of all its words, and the documents give windows
of that many words too, so it is found inside longer documents as well.

Only DataFrame functions run: no Python on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querytrail.llm.common import texts, written

SHINGLE_WORDS = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _windows(found: Column, n: int, make, least: int) -> Column:
    """``make`` of each window of ``n`` words; of all words, if they are
    fewer but ``least`` at least; else nothing."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(found) - F.lit(n - 1), F.lit(1)))
    return F.when(F.size(found) >= least, F.transform(starts, lambda i: make(F.slice(found, i, F.lit(n))))).otherwise(F.array())


def _document_windows(found: Column, n: int, short: list[int], make) -> Column:
    """``make`` of each window of ``n`` words and of each length in ``short``."""
    parts = [_windows(found, k, make, k) for k in (*short, n)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def shingle_hashes(found: Column, n: int = SHINGLE_WORDS, short: list[int] | None = None) -> Column:
    return _document_windows(found, n, short or [], lambda w: F.xxhash64(w))


def shingles(found: Column, n: int = SHINGLE_WORDS, short: list[int] | None = None) -> Column:
    return F.array_distinct(_document_windows(found, n, short or [], lambda w: F.array_join(w, " ")))


def short_sizes(rows: DataFrame, n: int = SHINGLE_WORDS) -> list[int]:
    """The numbers of words below ``n`` that occur among the items of
    :func:`item_shingles`: ``n - 1`` numbers at most."""
    length = F.size(F.split("shingle", " "))
    return sorted(r["k"] for r in rows.where(F.col("size") == 1).select(length.alias("k")).where(F.col("k") < n).distinct().collect())


def item_shingles(items: DataFrame, n: int = SHINGLE_WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, t, size, shingle, hash)``: the distinct shingles of each
    item, ``t`` the XXH64 of its text.  Rows that share an item_id, or have
    none, but not the text are items of their own."""
    text = items[text_col].cast("string")
    base = items.select(items[id_col].cast("long").alias("item_id"), F.xxhash64(text).alias("t"), words(text).alias("w"))
    own = _windows(F.col("w"), n, lambda w: F.array_join(w, " "), 1)
    rows = base.select("item_id", "t", F.explode_outer(own).alias("shingle")).where("shingle IS NOT NULL").distinct()
    sizes = rows.groupBy(F.col("item_id").alias("sized"), F.col("t").alias("sized_t")).agg(F.count("*").alias("size"))
    return rows.join(sizes, F.col("item_id").eqNullSafe(F.col("sized")) & (F.col("t") == F.col("sized_t"))).select(
        "item_id", "t", "size", "shingle", F.xxhash64(F.split("shingle", " ")).alias("hash")
    )


def sketch_size(size: Column, threshold: float) -> Column:
    """How many smallest hashes an item's sketch holds: the need of the
    largest item in its partition (sizes from a power of two to the next)."""
    upper = F.pow(F.lit(2.0), F.floor(F.log2(size.cast("double"))) + 1) - 1
    return upper - F.ceil(F.lit(threshold) * upper - 1e-9) + 1


def sketches(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(item_id, t, hash)``: the MinHash sketch of each item."""
    by_hash = Window.partitionBy("item_id", "t").orderBy("hash")
    return (
        rows.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= sketch_size(F.col("size"), threshold))
        .select("item_id", "t", "hash")
    )


def matches(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    n: int = SHINGLE_WORDS,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(doc_id, h, item_id, t, n_shingles, n_found)``, ``h`` the XXH64 of the
    document's text and ``t`` that of the item's, for every pair whose containment, the share of the item's
    distinct ``n``-word shingles that the document has, is at least
    ``threshold``.

    An item of fewer than ``n`` words is one shingle of all of them; a document
    has it if these words follow each other anywhere in it.  Null or empty texts have no shingle and
    no pair.  Null ids are kept as null.  Repeated documents and items give
    one row; rows that share a doc_id or an item_id but not the text are
    documents or items of their own (:func:`contained_items` returns the best
    containment of them).

    The item side goes to the executors whole only if Spark finds the written
    table below its broadcast limit; otherwise the joins are shuffled.
    """
    if not 0 < threshold <= 1 or math.isnan(threshold):
        raise ValueError("threshold must be above 0 and at most 1")
    rows = written(item_shingles(items, n, item_id, item_text), "decontaminate-items")
    sketch = written(sketches(rows, threshold).select("hash").distinct(), "decontaminate-sketch")
    short = short_sizes(rows, n)
    base = texts(docs, doc_id, doc_text).withColumn("h", F.xxhash64("text"))
    # The words are a column of their own, and the outer form of explode keeps them so: a filter that
    # the plain form infers would be pushed below, and split the text anew for every window.
    split = base.select("doc_id", "h", words(F.col("text")).alias("w"))
    hashed = split.select("doc_id", "h", F.explode_outer(shingle_hashes(F.col("w"), n, short)).alias("hash"))
    hits = hashed.join(sketch, "hash").select("doc_id", "h").distinct()
    found = written(hits, "decontaminate-candidates")
    found = found.select(F.col("doc_id").alias("found_id"), F.col("h").alias("found_h"))
    key = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("h") == F.col("found_h"))
    candidates = base.join(found, key, "left_semi").dropDuplicates(["doc_id", "h"]).select("doc_id", "h", words(F.col("text")).alias("w"))
    have = candidates.select("doc_id", "h", F.explode_outer(shingles(F.col("w"), n, short)).alias("shingle"))
    counted = have.join(rows, "shingle").groupBy("doc_id", "h", "item_id", "t", "size").agg(F.count("*").alias("n_found"))
    exact = counted.where(F.col("n_found") >= F.lit(threshold) * F.col("size") - 1e-9)
    return exact.select("doc_id", "h", "item_id", "t", F.col("size").alias("n_shingles"), "n_found")


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE_WORDS, **columns: str) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_found, containment)``: the
    :func:`matches`, one row for each document and item_id: the best
    containment of their texts, of equal ones that with most shingles."""
    found = matches(docs, items, threshold, n, **columns)
    best = F.max(F.struct((F.col("n_found") / F.col("n_shingles")).alias("containment"), "n_shingles", "n_found"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.n_shingles", "best.n_found", "best.containment")


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE_WORDS, doc_id: str = "doc_id", doc_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item."""
    found = matches(docs, items, threshold, n, doc_id, doc_text).select(F.col("doc_id").alias("leaked_id"), F.col("h").alias("leaked_h")).distinct()
    found = written(found, "decontaminate-leaks")
    text_hash = F.xxhash64(F.coalesce(docs[doc_text].cast("string"), F.lit("")))
    return docs.join(found, docs[doc_id].cast("long").eqNullSafe(found["leaked_id"]) & (text_hash == found["leaked_h"]), "left_anti")
