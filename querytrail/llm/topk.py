"""Exact maximum-inner-product top-k: ball trees, branch and bound per shard.

The vectors are hash-partitioned into shards of bounded size.  A task builds
a ball tree over its shard and visits the nodes by their upper bound of the
inner product, ``q . centre + |q| * radius``; queries whose bound is below
their current k-th score leave a node unvisited.  Every query first searches
its home shard; the k-th score found there is shared with all other shards,
which start pruning from it.
"""

from __future__ import annotations

import heapq
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from querytrail.llm.common import written

K = 10
#: Vectors in a shard, and queries in a block, of one task (bounds of memory).
SHARD_ROWS = 16_384
BLOCK_QUERIES = 4_096
LEAF_ROWS = 256
SCALE = 1024
LARGEST = float(np.finfo(np.float64).max)
#: Scores are longs; an inner product beyond them counts as the end of their range.
LOW, HIGH = 1 - 2**63, 2**63 - 1


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, dim, v array<double>)`` with ``floor(scale * x)`` of every
    component as double; rows with a null id, a null vector, or a null or
    non-finite component are left out.  A product beyond the range of a
    double counts as the end of that range."""
    x = F.col("v")

    def whole(c: Column) -> Column:
        product = F.greatest(F.least(c * F.lit(float(scale)), F.lit(LARGEST)), F.lit(-LARGEST))
        # From 2**53 on a double is whole, and floor() would go through a long.
        return F.when(F.abs(product) < F.lit(2.0**53), F.floor(product).cast("double")).otherwise(product)

    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ok)
        .select("vec_id", F.size(x).alias("dim"), F.transform(x, whole).alias("v"))
    )


class BallTree:
    """Balls over the rows of ``x``: each split halves a node along the line
    between two far points.  Leaves are contiguous row ranges of ``order``."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF_ROWS) -> None:
        self.order = np.arange(len(x))
        self.nodes: list[tuple[int, int, int, int]] = []
        centres, radii = [], []
        todo = [(0, len(x), -1, False)]
        while todo:
            lo, hi, parent, right = todo.pop()
            rows = x[self.order[lo:hi]]
            centre = rows.mean(0)
            dist = np.sqrt(((rows - centre) ** 2).sum(1))
            me = len(self.nodes)
            self.nodes.append((lo, hi, -1, -1))
            centres.append(centre)
            radii.append(dist.max() * (1 + 1e-9) + 1e-6)
            if parent >= 0:
                a, b, left, _ = self.nodes[parent]
                self.nodes[parent] = (a, b, left, me) if right else (a, b, me, -1)
            if hi - lo > leaf and dist.max() > 0:
                far = rows[dist.argmax()]
                other = rows[((rows - far) ** 2).sum(1).argmax()]
                mid = (lo + hi) // 2
                part = np.argpartition(rows @ (other - far), mid - lo)
                self.order[lo:hi] = self.order[lo:hi][part]
                todo.append((mid, hi, me, True))
                todo.append((lo, mid, me, False))
        self.centres, self.radii = np.array(centres), np.array(radii)


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of whole numbers held as double, cut to the
    range of a long.  Products of small numbers are exact as double, of larger
    ones as long.  Beyond that, a sum of longs is right modulo 2**64, so it is
    right wherever the product is known to fit; what an estimate with its
    error bound can't tell to fit or to be cut, Python integers decide."""
    with np.errstate(all="ignore"):
        big = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if big < 2**53:
        return np.rint(q @ x.T).astype(np.int64)
    if big < 2**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    with np.errstate(all="ignore"):
        guess = q @ x.T
        error = (np.abs(q) @ np.abs(x).T) * (1e-15 * (q.shape[1] + 1))
        high, low = guess - error > 2.0**63, guess + error < -(2.0**63)
        small_q, small_x = (np.abs(q) < 2.0**62).all(1), (np.abs(x) < 2.0**62).all(1)
        fits = (np.abs(guess) + error < 2.0**62) & small_q[:, None] & small_x[None, :]
    out = np.where(small_q[:, None], q, 0).astype(np.int64) @ np.where(small_x[:, None], x, 0).astype(np.int64).T
    out[high], out[low] = HIGH, LOW
    for i, j in zip(*np.nonzero(~(fits | high | low)), strict=True):
        out[i, j] = min(max(sum(int(a) * int(b) for a, b in zip(q[i], x[j], strict=True)), LOW), HIGH)
    return out


def search(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` of this shard for each query, as (query row, vec_id,
    score); nothing that scores below ``floor`` is needed."""
    with np.errstate(all="ignore"):  # squares of components beyond 1e150 overflow: no bound, no pruning
        tree = BallTree(x)
        norms = np.sqrt((q**2).sum(1))
        slack = 1e-7 * (1 + norms * np.sqrt((x**2).sum(1).max(initial=0)))
    best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(q)
    kth = floor.astype(np.float64).copy()

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            b = q[rows] @ tree.centres[node] + norms[rows] * tree.radii[node] + slack[rows]
        return np.clip(np.where(np.isnan(b), np.inf, b), float(LOW), 1e300)

    rows = np.arange(len(q))
    heap = [(0.0, 0, rows, bound(0, rows))]
    while heap:
        _, node, rows, bounds = heapq.heappop(heap)
        rows = rows[bounds >= kth[rows]]
        if not len(rows):
            continue
        lo, hi, left, right = tree.nodes[node]
        if left < 0:
            members = tree.order[lo:hi]
            scores, own = exact_products(q[rows], x[members]), ids[members]
            for i, r in enumerate(rows):
                take = (scores[i] >= kth[r]) & (own != qids[r])
                if not take.any():
                    continue
                score, vec = np.concatenate([best[r][0], scores[i][take]]), np.concatenate([best[r][1], own[take]])
                top = np.lexsort((vec, -score))[:k]
                best[r] = score[top], vec[top]
                if len(top) == k:
                    kth[r] = max(kth[r], score[top[-1]])
            continue
        for child in (left, right):
            b = bound(child, rows)
            heapq.heappush(heap, (-float((b - np.maximum(kth[rows], -1e300)).max()), child, rows, b))
    counts = [len(s) for s, _ in best]
    return np.repeat(np.arange(len(q)), counts), np.concatenate([v for _, v in best]), np.concatenate([s for s, _ in best])


_RESULT = "query_id long, vec_id long, score long"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, 0))


def _found(ids, x, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    q = _matrix(queries["v"])
    rows, vec, score = search(ids, x, queries["query_id"].to_numpy(), q, queries["kth"].fillna(-np.inf).to_numpy(np.float64), k)
    return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[rows], "vec_id": vec, "score": score})


def top_k_inner_product(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest integer inner
    products of each query over all vectors but its own.

    ``vectors``: ``(vec_id, dim, v)`` from :func:`quantised`; ``queries``: rows
    of the same form.  Ties go to the smaller vec_id; fewer candidates give
    fewer rows.  Vectors of another length are no candidates.  Every row that
    has the query's vec_id counts as its own; a query row that repeats is
    answered once.  Empty inputs give no rows.  An inner product beyond the
    range of a long counts as the end of that range, and ties there as anywhere.
    """
    base = written(vectors.select("vec_id", "dim", "v"), "topk-vectors")
    n = base.count()
    shards = max(1, -(-n // SHARD_ROWS))
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    base = base.select(hashed.alias("shard"), "vec_id", "dim", "v")
    asked = queries.select(F.col("vec_id").alias("query_id"), "dim", "v").dropDuplicates(["query_id", "dim", "v"])
    asked = written(
        asked.select(
            F.pmod(F.xxhash64("query_id"), F.lit(shards)).cast("int").alias("home"), "query_id", "dim", "v",
        ),
        "topk-queries",
    )
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("query_id", F.lit(7)), F.lit(blocks)).cast("int")

    def run(key: tuple[Any, ...], left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return _found(left["vec_id"].to_numpy(), _matrix(left["v"]), right, k)

    def joined(shards_df: DataFrame, queries_df: DataFrame) -> DataFrame:
        keys = ["shard", "block", "dim"]
        return shards_df.groupBy(*keys).cogroup(queries_df.groupBy(*keys)).applyInPandas(run, _RESULT)

    # Round 1: each query in its home shard.
    home = asked.select(F.col("home").alias("shard"), F.lit(0).alias("block"), "query_id", "dim", "v", F.lit(None).cast("double").alias("kth"))
    first = written(joined(base.select("shard", F.lit(0).alias("block"), "vec_id", "dim", "v"), home), "topk-home")
    if shards == 1:
        found = first
    else:
        # Round 2: the k-th score of round 1 goes to every other shard.
        kth = first.groupBy("query_id", ).agg(F.count("*").alias("n"), F.min("score").alias("low"))
        known = asked.join(kth, "query_id", "left").select(
            "home", "query_id", "dim", "v", F.when(F.col("n") >= k, F.col("low")).cast("double").alias("kth")
        )
        rest = (
            known.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .where("shard <> home")
            .select("shard", block.alias("block"), "query_id", "dim", "v", "kth")
        )
        copies = base.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        found = first.unionByName(joined(copies, rest))
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(ranked).cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
