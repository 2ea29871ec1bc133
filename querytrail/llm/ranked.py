"""Ranked lexical search: sparse inner products by ball trees, exact.

A document's vector has, for each term, a whole number that grows with the
term's occurrences and shrinks with the document's length; an item's vector
has the weights of its terms.  The score is their inner product.

1. The items' terms (in blocks of bounded size, broadcast) are looked up in
   every whole document text: term counts by document, and over all documents
   the numbers that the weights need.
2. The documents are dealt evenly into shards.  A task builds a ball tree over
   a shard, in a space where term ``t`` is stretched by the root of its weight,
   and visits the nodes best-first.  A node is left out for the items whose
   k-th score is above its bound, the smaller of ``q . centre + |q| * radius``
   and, for the items' own terms, ``q . centre`` plus the largest distance from
   the centre upwards in each term.  Bounds are rounded up, so that no document
   is lost; at the leaves the scores are whole numbers and exact.
3. A first wave searches a part of the shards, about the root of their number;
   its k-th scores are the start for all others.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from querytrail.llm.common import byte_columns, runs, texts, word_hashes, word_spans, written

K = 10
#: Item terms that are broadcast at a time, and entries of a task's dense
#: matrix of item weights.
BLOCK_TERMS = 1 << 17
MATRIX = 1 << 22
#: Documents, and entries of their vectors, in a tree; documents in a leaf.
SHARD_DOCS, SHARD_ENTRIES, LEAF_DOCS = 4_096, 1 << 20, 64
#: Bytes of text that are split into terms at a time.
SLICE_BYTES = 1 << 20
#: Safe rounding of bounds: far above the error of a double sum.
SLACK = 1e-9

#: Bytes between terms: ASCII but for digits and letters.
GAP = np.zeros(256, bool)
GAP[:128] = True
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    GAP[_lo:_hi] = False


def term_pieces(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row, hash)`` of all terms, some rows, or a slice of a long one, at a
    time; a slice ends at a gap, and a longer term is in one slice."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        start, end = int(offsets[lo]), int(offsets[hi])
        if end - start <= most:
            a, b, counts = word_spans(data[start:end], offsets[lo : hi + 1] - start, GAP)
            yield np.repeat(np.arange(lo, hi), counts), word_hashes(data[start:end], a, b)
        else:
            while start < end:
                stop = min(start + most, end)
                while stop < end and not GAP[data[stop]]:
                    stop += 1
                a, b, _ = word_spans(data[start:stop], np.array([0, stop - start]), GAP)
                yield np.full(len(a), lo), word_hashes(data[start:stop], a, b)
                start = stop
        lo = hi


# --- items ------------------------------------------------------------------


@dataclass
class Items:
    """A block of items: sorted term hashes, and each item's terms as places
    in them (``terms[first[i]:first[i + 1]]``)."""

    ids: np.ndarray  # item_id; null as None
    vocabulary: np.ndarray
    first: np.ndarray
    terms: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int | None, bytes]]) -> Items:
        hashes = [np.frombuffer(h, np.uint64) for _, h in rows]
        vocabulary, terms = np.unique(np.concatenate(hashes), return_inverse=True)
        ids = np.empty(len(rows), object)
        ids[:] = [i for i, _ in rows]
        return Items(ids, vocabulary, np.r_[0, np.cumsum([len(h) for h in hashes])], terms)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item_id, terms, n)``: the distinct term hashes of every distinct
    item that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_columns(batch)
            got: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for row, h in term_pieces(data, offsets):
                at = runs(row)
                for lo, hi in zip(at[:-1], at[1:], strict=True):
                    got[int(row[lo])].append(np.unique(h[lo:hi]))
            terms = [np.unique(np.concatenate(g)) if g else np.empty(0, np.uint64) for g in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.tobytes() for t in terms], pa.binary()), pa.array([len(t) for t in terms], pa.int64())],
                ["item_id", "terms", "n"],
            )

    rows = texts(items, id_col, text_col).distinct()
    return rows.mapInArrow(run, "item_id long, terms binary, n long").where("n > 0")


def blocks_of(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of at most :data:`BLOCK_TERMS` terms, or of one
    item, where a single one has more."""
    total = items.agg(F.sum("n")).first()[0]
    if total is None:
        return
    number = -(-total // BLOCK_TERMS)
    while True:
        block = F.pmod(F.xxhash64("item_id", "terms"), F.lit(number))
        sizes = items.groupBy(block.alias("block")).agg(F.sum("n").alias("n"), F.count("*").alias("items")).orderBy("block").collect()
        if all(r.n <= BLOCK_TERMS or r["items"] == 1 for r in sizes):
            break
        number *= 2
    for r in sizes:
        rows = items.where(block == r.block).select("item_id", "terms").collect()
        yield Items.of([(i, bytes(t)) for i, t in rows])


# --- vectors ----------------------------------------------------------------


def term_counts(docs: DataFrame, items: Items) -> DataFrame:
    """``(doc_id, n, terms, counts)`` of the documents that have a term: ``n``
    terms with repeats, and the occurrences of the items' terms as arrays."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            data, offsets = byte_columns(batch)
            n = np.zeros(batch.num_rows, np.int64)
            keys, counts = [], []
            for row, h in term_pieces(data, offsets):
                n += np.bincount(row, minlength=batch.num_rows)
                place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                hit = vocabulary[place] == h
                key, count = np.unique(row[hit] * len(vocabulary) + place[hit], return_counts=True)
                keys.append(key)
                counts.append(count)
            key = np.concatenate([np.empty(0, np.int64), *keys])
            count = np.concatenate([np.empty(0, np.int64), *counts])
            order = np.argsort(key, kind="stable")  # slices of a long text meet here
            key, count = key[order], count[order]
            at = runs(key)
            key, count = key[at[:-1]], np.add.reduceat(count, at[:-1]) if len(key) else count
            row, term = key // len(vocabulary), key % len(vocabulary)
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            some = np.flatnonzero(n)
            term, count = term.astype(np.int32), count.astype(np.int32)
            binary = [pa.array([x[edges[i] : edges[i + 1]].tobytes() for i in some], pa.binary()) for x in (term, count)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.array(n[some]), *binary], ["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms binary, counts binary")


def statistics(vectors: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, their terms with repeats, and documents by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n += batch.num_rows
            total += int(np.sum(batch.column(0).to_numpy()))
            df += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, some]), pa.array(np.r_[n, total, df[some]])], ["term", "n"])

    # At most a block's terms and two more rows.
    rows = vectors.select("n", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    got = dict(map(tuple, rows))
    df = np.zeros(size, np.int64)
    for t, c in got.items():
        if t >= 0:
            df[t] = c
    return got.get(-2, 0), got.get(-1, 0), df


def term_weights(docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def length_norms(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """``100 - 90 + (90 * n * docs) div total`` for each length."""
    if 90 * int(n.max(initial=0)) * docs < 1 << 63:
        return 10 + (90 * n * docs) // total
    return np.array([10 + (90 * x * docs) // total for x in n.tolist()], np.int64)


def term_values(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# --- ball tree --------------------------------------------------------------


class Sparse:
    """Rows of ``(column, whole value)`` pairs, columns ascending in a row."""

    def __init__(self, first: np.ndarray, column: np.ndarray, value: np.ndarray, width: int) -> None:
        self.first, self.column, self.value, self.width = first, column, value, width

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and for each the number of its row in ``rows``."""
        lens = self.first[rows + 1] - self.first[rows]
        begin = np.cumsum(lens) - lens
        return np.arange(int(lens.sum())) - np.repeat(begin - self.first[rows], lens), np.repeat(np.arange(len(rows)), lens)


class BallTree:
    """Balls over the rows of ``x``; a split halves a node along the line
    between two far rows.  ``scale`` stretches each column."""

    def __init__(self, x: Sparse, scale: np.ndarray, leaf: int = LEAF_DOCS) -> None:
        self.order = np.arange(len(x.first) - 1)
        self.lo, self.hi, self.left, self.right, self.radius = [], [], [], [], []
        centres, highs = [], []
        todo = [(0, len(self.order), -1, False)]
        while todo:
            lo, hi, parent, is_right = todo.pop()
            rows = self.order[lo:hi]
            at, row = x.entries(rows)
            column, value = x.column[at], x.value[at] * scale[x.column[at]]
            centre = np.bincount(column, value, x.width) / len(rows)
            by = np.argsort(column, kind="stable")
            high = np.zeros(x.width)
            edges = runs(column[by])
            if len(by):
                high[column[by][edges[:-1]]] = np.maximum.reduceat(value[by], edges[:-1])
            square = np.bincount(row, value**2, len(rows))
            core = float(centre @ centre)
            dist = square - 2 * np.bincount(row, value * centre[column], len(rows)) + core
            dist = np.sqrt(np.maximum(dist, 0) + SLACK * (square + core))
            me = len(self.lo)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = me
            for held, v in zip((self.lo, self.hi, self.left, self.right, self.radius), (lo, hi, -1, -1, dist.max(initial=0) * (1 + SLACK)), strict=True):
                held.append(v)
            centres.append(centre)
            highs.append(high)
            if hi - lo <= leaf or (dist.max() <= 1e-3 * math.sqrt(core) and hi - lo <= 4 * leaf):
                continue
            far, other = np.zeros(x.width), np.zeros(x.width)
            mine = row == dist.argmax()
            far[column[mine]] = value[mine]
            gap = square - 2 * np.bincount(row, value * far[column], len(rows))
            mine = row == gap.argmax()
            other[column[mine]] = value[mine]
            along = np.bincount(row, value * (other - far)[column], len(rows))
            mid = (lo + hi) // 2
            self.order[lo:hi] = rows[np.argpartition(along, mid - lo)]
            todo.append((mid, hi, me, True))
            todo.append((lo, mid, me, False))
        self.centres, self.highs = np.array(centres), np.array(highs)

    def bounds(self, q: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner product, nodes by columns of ``q``
        (stretched, not negative), rounded up."""
        ball = self.centres @ q + np.outer(self.radius, norms)
        return np.minimum(ball, self.highs @ q) * (1 + SLACK) + 1


class Best:
    """The best ``k`` documents of each of ``n`` items so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray) -> None:
        self.k, self.kth = k, floor.copy()
        self.item = self.doc = self.score = np.empty(0, np.int64)

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        item, doc, score = np.r_[self.item, item], np.r_[self.doc, doc], np.r_[self.score, score]
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        at = runs(item)
        rank = np.arange(len(item)) - np.repeat(at[:-1], np.diff(at))
        full = rank == self.k - 1
        self.kth[item[full]] = np.maximum(self.kth[item[full]], score[full])
        keep = (rank < self.k) & (score >= self.kth[item])
        self.item, self.doc, self.score = item[keep], doc[keep], score[keep]


def search(x: Sparse, ids: np.ndarray, items: Items, weights: np.ndarray, floor: np.ndarray, k: int, leaf: int = LEAF_DOCS) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(item, doc, score)`` of the best ``k`` documents of a shard for each
    item, without those that score below ``floor`` (at least 1), and how many
    documents were scored, summed over the items."""
    root = np.sqrt(weights.astype(np.float64))
    tree = BallTree(x, root, leaf)
    out, scored = [], 0
    step = max(1, MATRIX // max(1, x.width))
    for lo in range(0, len(items.ids), step):
        hi = min(lo + step, len(items.ids))
        a, b = items.first[lo], items.first[hi]
        who = np.repeat(np.arange(hi - lo), np.diff(items.first[lo : hi + 1]))
        q = np.zeros((x.width, hi - lo))
        q[items.terms[a:b], who] = weights[items.terms[a:b]]
        exact = q.sum(0).max(initial=0) * max(1, int(x.value.max(initial=0))) < 2**53
        stretched = np.divide(q, root[:, None], out=np.zeros_like(q), where=root[:, None] > 0)
        bounds = tree.bounds(stretched, np.sqrt((stretched**2).sum(0)) * (1 + SLACK))
        best = Best(hi - lo, k, np.maximum(floor[lo:hi], 1))
        heap = [(-float(bounds[0].max(initial=0)), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            active = np.flatnonzero(bounds[node] >= best.kth)
            if not len(active):
                continue
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.right[node]):
                    gain = bounds[child] - best.kth
                    if (gain >= 0).any():
                        heapq.heappush(heap, (-float(gain.max()), child))
                continue
            rows = tree.order[tree.lo[node] : tree.hi[node]]
            at, row = x.entries(rows)
            columns, column = np.unique(x.column[at], return_inverse=True)
            if not len(columns):
                continue
            part = q[np.ix_(columns, active)]
            if exact:  # every partial sum is a whole number below 2**53
                dense = np.zeros((len(rows), len(columns)))
                dense[row, column] = x.value[at]
                scores = (dense @ part).astype(np.int64)
            else:
                dense = np.zeros((len(rows), len(columns)), np.int64)
                dense[row, column] = x.value[at]
                scores = dense @ part.astype(np.int64)
            scored += scores.size
            r, c = np.nonzero(scores >= best.kth[active])
            if len(r):
                best.add(active[c], ids[rows[r]], scores[r, c])
        out.append((best.item + lo, best.doc, best.score))
    item, doc, score = (np.concatenate(v) for v in zip(*out, strict=True))
    return item, doc, score, scored


# --- the operator -----------------------------------------------------------

#: A null doc_id inside a task; it counts as the smallest.
_NULL = -(1 << 63)
_FOUND = "item int, item_id long, doc_id long, score long, scored long"


def _search_shards(vectors: DataFrame, items: Items, weights: np.ndarray, docs: int, total: int, floor: np.ndarray, k: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast((items, weights, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, w, low = shared.value
        held: list[pa.RecordBatch] = []
        n_docs = n_entries = 0

        def found() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            doc = table.column("doc_id").fill_null(_NULL).to_numpy()
            raw = table.column("terms").to_pylist()
            first = np.r_[0, np.cumsum([len(t) // 4 for t in raw])]
            column = np.frombuffer(b"".join(raw), np.int32).astype(np.int64)
            tf = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int32).astype(np.int64)
            m = np.repeat(length_norms(table.column("n").to_numpy(), docs, total), np.diff(first))
            x = Sparse(first, column, term_values(tf, m), len(w))
            item, ids, score, scored = search(x, doc, block, w, low, k)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(item, pa.int32()), pa.array(block.ids[item].tolist(), pa.int64()),
                    pa.array(ids, pa.int64(), mask=ids == _NULL), pa.array(score, pa.int64()),
                    pa.array(np.r_[scored, np.zeros(len(item) - 1, np.int64)] if len(item) else np.empty(0, np.int64)),
                ],
                ["item", "item_id", "doc_id", "score", "scored"],
            )

        for batch in batches:
            step = max(1, SHARD_DOCS // 16)
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                entries = sum(map(len, part.column(2).to_pylist())) // 4
                if held and (n_docs + part.num_rows > SHARD_DOCS or n_entries + entries > SHARD_ENTRIES):
                    yield found()
                    held, n_docs, n_entries = [], 0, 0
                held.append(part)
                n_docs += part.num_rows
                n_entries += entries
        if held:
            yield found()

    return vectors.select("doc_id", "n", "terms", "counts").mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` highest-scoring documents
    of each item with a score above 0, equal scores by ascending doc_id.

    Terms are runs of ASCII letters and digits and all other characters from
    U+0080 on, A-Z lower-cased, told apart by 64-bit hashes.  Null and empty
    texts have none, and such documents are not counted.  Every row of
    ``docs`` is a document, repeats too; a null doc_id counts as the smallest.
    Items that are equal altogether are one; different texts of one item_id,
    null included, are ranked apart.  Items without a match, and empty inputs,
    give no rows.
    """
    spark = docs.sparkSession
    base = texts(docs, id_col, text_col)
    wanted = written(item_terms(items, item_id_col, item_text_col), "ranked-items")
    results = []
    for block in blocks_of(wanted):
        vectors = written(term_counts(base, block), "ranked-vectors")
        n, total, df = statistics(vectors, len(block.vocabulary))
        if n == 0:
            continue
        weights = term_weights(n, df)
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_DOCS))
        waves = max(1, math.isqrt(-(-n // SHARD_DOCS)))
        number = F.monotonically_increasing_id()  # of the written rows: the same on a retry
        vectors = vectors.withColumn("number", F.xxhash64(number))
        start = np.zeros(len(block.ids), np.int64)
        first = F.pmod("number", F.lit(waves)) == 0
        if waves > 1:
            part = vectors.where(first).repartition(max(1, shards // waves), "number")
            wave = written(_ranked(_search_shards(part, block, weights, n, total, start, k), k).drop("rank"), "ranked-wave")
            # One row for each item of a block.
            for r in wave.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("low")).where(F.col("n") >= k).collect():
                start[r["item"]] = r.low
            results.append((wave, _search_shards(vectors.where(~first).repartition(shards, "number"), block, weights, n, total, start, k)))
        else:
            results.append((_search_shards(vectors.repartition(shards, "number"), block, weights, n, total, start, k),))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    ranked = []
    for parts in results:
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        ranked.append(_ranked(found, k).select("item_id", "rank", "doc_id", "score"))
    out = ranked[0]
    for p in ranked[1:]:
        out = out.unionByName(p)
    return out
