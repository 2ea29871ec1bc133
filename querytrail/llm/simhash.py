"""SimHash near-duplicates: segment-popcount embedding and a grid range-join.

A fingerprint is embedded as the bit counts of its 32 two-bit segments.
Flipping one bit changes one count by one, so the Manhattan distance of two
embeddings is a lower bound of the Hamming distance.  Fingerprints that
differ in at most four bits therefore agree, in one half of the embedding
(16 segments), up to Manhattan distance two; and two grid points at distance
two or less have a common grid point at distance one or less from both.
Each distinct fingerprint is put into the grid cells around its two
half-vectors, and fingerprints that meet in a cell are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from querytrail.functions.names import free_name
from querytrail.llm.common import checkpointed, runs, texts, written

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Rows of a cell that are compared by shifting; larger cells are searched
#: breadth first.
SHIFT_ROWS = 48

_LOWEST = -(1 << 63)
_HALF_SEGMENTS = 16
_BALL = 2 * _HALF_SEGMENTS + 1


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text: per bit the majority over the XXH64 of
    all its shingles, repeats included; zero without words."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)),
        np.uint64,
        len(found) - words + 1,
    )
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, h, fp)`` longs, one row per document: the XXH64 of its text
    and the fingerprint's 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(v, words) for v in values], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps)], ["doc_id", "h", "fp"])

    base = texts(docs, id_col, text_col)
    return base.withColumn("h", F.xxhash64("text")).mapInArrow(run, "doc_id long, h long, fp long")


def grid_cells(fps: np.ndarray) -> np.ndarray:
    """``(n, 2 * 33)`` cell keys: both half-vectors and their neighbours at
    Manhattan distance one; -1 where a neighbour would leave the grid."""
    low = np.uint64(0x5555555555555555)
    counts = fps - ((fps >> np.uint64(1)) & low)  # 32 two-bit fields, each 0 to 2
    out = np.full((len(fps), 2 * _BALL), -1, np.int64)
    three = 3 ** np.arange(_HALF_SEGMENTS, dtype=np.int64)
    for half in range(2):
        shift = (32 * half + 2 * np.arange(_HALF_SEGMENTS)).astype(np.uint64)
        vector = ((counts[:, None] >> shift) & np.uint64(3)).astype(np.int64)
        key = vector @ three + half * 3**_HALF_SEGMENTS
        at = half * _BALL
        out[:, at] = key
        out[:, at + 1 : at + 17] = np.where(vector > 0, key[:, None] - three, -1)
        out[:, at + 17 : at + 33] = np.where(vector < 2, key[:, None] + three, -1)
    return out


def _forest(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links among the fingerprints of one cell, found
    breadth first; a fingerprint leaves the search once it is reached."""
    left, queue, a, b = fps, [], [], []
    while len(left):
        if not queue:
            queue.append(left[0])
            left = left[1:]
            continue
        here = queue.pop()
        near = np.bitwise_count(left ^ here) <= most
        if near.any():
            got = left[near]
            a.append(np.full(len(got), here))
            b.append(got)
            queue.extend(got)
            left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def cell_links(cells: np.ndarray, fps: np.ndarray, most: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links within each cell.  Small cells give all
    their links, large ones a spanning forest, so never all pairs."""
    order = np.lexsort((fps, cells))
    cells, fps = cells[order], fps[order]
    at = runs(cells)
    size = np.diff(at)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for i in np.flatnonzero(size > SHIFT_ROWS):
        found.append(_forest(fps[at[i] : at[i + 1]], most))
    small = np.repeat((size <= SHIFT_ROWS) & (size > 1), size)
    cells, fps = cells[small], fps[small]
    live = np.arange(len(cells))
    step = 1
    while len(live):
        live = live[live + step < len(cells)]
        live = live[cells[live] == cells[live + step]]
        hit = live[np.bitwise_count(fps[live] ^ fps[live + step]) <= most]
        found.append((fps[hit], fps[hit + step]))
        step += 1
    if not found:
        return fps[:0], fps[:0]
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def fingerprint_links(distinct: DataFrame, rows: int, most: int = MAX_BITS) -> DataFrame:
    """``(a, b)`` edges over the distinct fingerprints ``fp`` whose connected
    components are those of all links.  ``rows``: how many there are; it sets
    the number of partitions, so that each holds a bounded part of the grid."""
    if not 0 <= most <= 5:
        raise ValueError("the two-half grid covers distances up to 5 bits")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).view(np.uint64)
            for lo in range(0, len(fps), 1 << 14):
                part = fps[lo : lo + (1 << 14)]
                cells = grid_cells(part)
                keep = cells >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[keep]), pa.array(np.broadcast_to(part[:, None], cells.shape)[keep].view(np.int64))], ["cell", "fp"]
                )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.asarray(b.column(0)), np.asarray(b.column(1)).view(np.uint64)) for b in batches]
        if not held:
            return
        a, b = cell_links(np.concatenate([c for c, _ in held]), np.concatenate([f for _, f in held]), most)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.empty((0, 2), np.uint64)
        for lo in range(0, len(pairs), 1 << 16):
            part = np.ascontiguousarray(pairs[lo : lo + (1 << 16)].T).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part[0]), pa.array(part[1])], ["a", "b"])

    spark = distinct.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows * 2 * _BALL // 1_500_000 + 1)
    cells = distinct.mapInArrow(spread, "cell long, fp long").repartition(parts, "cell")
    return cells.mapInArrow(join, "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root: the smallest
    node of its component.

    Each round hooks every node to its smallest neighbour, follows the
    pointers to their ends (doubling), and contracts the edges to the ends.
    Only joins and grouped minima run; a hub's edges are combined before the
    shuffle, and the joins are skew-splittable (one side has unique keys).
    """
    spark = edges.sparkSession
    labels = None
    edges = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        jump = checkpointed(both.groupBy("node").agg(F.min("other").alias("p")).select("node", F.least("node", "p").alias("p")))
        while True:
            ends = jump.select(F.col("node").alias("p"), F.col("p").alias("next"))
            nxt = checkpointed(jump.join(ends, "p").select("node", F.col("next").alias("p"), (F.col("next") != F.col("p")).alias("moved")))
            moved = not nxt.where("moved").isEmpty()
            jump = nxt.select("node", "p")
            if not moved:
                break
        if labels is None:
            labels = jump.select("node", F.col("p").alias("root"))
        else:
            step = jump.select(F.col("node").alias("root"), F.col("p").alias("up"))
            labels = labels.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        labels = checkpointed(labels)
        ends_a = jump.select(F.col("node").alias("a"), F.col("p").alias("x"))
        ends_b = jump.select(F.col("node").alias("b"), F.col("p").alias("y"))
        edges = checkpointed(
            edges.join(ends_a, "a").join(ends_b, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    if labels is None:
        return spark.createDataFrame([], StructType([StructField("node", LongType()), StructField("root", LongType())]))
    return labels


def _rooted(docs: DataFrame, words: int, most: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents' fingerprints, and ``(fp, first, best, root)`` of each
    distinct one: its smallest doc_id, the key of its first document, and the
    root of its component.  The documents of a fingerprint, however many, are
    combined before the shuffle."""
    fps = written(fingerprints(docs, words, id_col, text_col), "simhash-fps")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(_LOWEST)).alias("k"), F.col("h"))
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min(order).alias("best")), "simhash-classes")
    labels = connected(fingerprint_links(classes.select("fp"), classes.count(), most)).withColumnRenamed("node", "fp")
    return fps, classes.join(labels, "fp", "left").select("fp", "first", "best", F.coalesce("root", "fp").alias("root"))


def simhash_components(
    docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per document.

    ``fingerprint``: 16 lowercase hex digits; ``component_id``: the smallest
    doc_id reachable over links of at most ``most`` differing bits.  Null and
    empty texts have fingerprint zero and link like any other.  Repeated rows
    are returned as often as they occur.  A null doc_id is no candidate for
    the smallest; a component of nulls alone has a null component_id.  Exact
    copies are one fingerprint in the join, so their number does not matter.
    """
    fps, rooted = _rooted(docs, words, most, id_col, text_col)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = rooted.join(smallest, "root").select("fp", "component_id")
    return fps.join(by_class, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(
    docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component:
    that with the smallest doc_id (a null one only where there is no other),
    then the smallest hash of the text.  Of rows that repeat it, one stays.
    Columns of any name are kept."""
    _, rooted = _rooted(docs, words, most, id_col, text_col)
    first = rooted.groupBy("root").agg(F.min("best").alias("m"))
    none, k, h, *kept = (free_name(name, docs.columns) for name in ("none", "k", "h", "kept_none", "kept_k", "kept_h"))
    keep = written(first.select(*(F.col(f"m.{part}").alias(name) for part, name in zip(("none", "k", "h"), kept, strict=True))), "simhash-kept")
    key = {
        none: docs[id_col].isNull(),
        k: F.coalesce(docs[id_col].cast("long"), F.lit(_LOWEST)),
        h: F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))),
    }
    once = docs.withColumns(key).dropDuplicates(list(key))
    on = [F.col(own) == F.col(other) for own, other in zip(key, kept, strict=True)]
    return once.join(keep, on, "left_semi").drop(*key)
