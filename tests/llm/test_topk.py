import math

import numpy as np
import pytest

from querytrail.llm import topk as T


def brute(rows, queries, k):
    usable = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in sorted({(i, tuple(v)) for i, v in usable if queries(i)}):
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in usable if i != q and len(v) == len(qv))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def rows():
    rng = np.random.default_rng(9)
    out = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(700)]
    out += [(1000 + i, out[3][1]) for i in range(30)]  # ties
    out += [(2000, None), (2100, [1.0, None] + [0.0] * 6), (2200, [float("nan")] * 8), (2300, [float("inf")] * 8), (2400, []), (2500, [0.5, 0.25]), (None, out[0][1]), (2600, [0.0] * 8), (2700, [0.1, 0.2])]
    return out


@pytest.mark.parametrize("shard,leaf", [(16384, 256), (100, 8)])
def test_matches_brute_force(spark, monkeypatch, shard, leaf):
    monkeypatch.setattr(T, "SHARD_ROWS", shard)
    monkeypatch.setattr(T, "BLOCK_QUERIES", 3 if shard == 100 else 4096)
    monkeypatch.setattr(T, "LEAF_ROWS", leaf)
    data = rows()
    vectors = T.quantised(spark.createDataFrame([(i, v, "x", "y") for i, v in data], "vec_id long, embedding array<float>, v string, dim string").repartition(4))
    got = T.top_k_inner_product(vectors, vectors.where("vec_id % 100 = 0"))
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(data, lambda i: i % 100 == 0, 10)


def test_fewer_candidates_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    some = T.quantised(spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [-0.5])], schema))
    assert [tuple(r) for r in T.top_k_inner_product(some, some.where("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 1, 524288), (0, 2, 2, -524288)]
    none = T.quantised(spark.createDataFrame([], schema))
    assert T.top_k_inner_product(none, none).count() == 0


def test_large_numbers_stay_exact():
    q, x = np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0], [2.0**30, 2.0]])
    assert T.exact_products(q, x).tolist() == [[2**60 + 1, 2**60 + 2]]
    assert T.exact_products(q * 2.0**20, x).tolist() == [[2**63 - 1, 2**63 - 1]]


def test_products_beyond_longs_are_cut_and_others_exact():
    rng = np.random.default_rng(4)
    q = np.rint(rng.normal(size=(40, 5)) * 10.0 ** rng.integers(0, 30, (40, 1)))
    x = np.rint(rng.normal(size=(60, 5)) * 10.0 ** rng.integers(0, 30, (60, 1)))
    x[:20] = np.rint(rng.normal(size=(20, 5)) * 2.0**31)
    x[20] = [1e300, -1e300, 0, 0, 0]
    q[0], q[1], q[2] = [1.0] * 5, [2.0**32 + 1] * 5, [T.LARGEST, T.LARGEST, 3, 0, 0]
    want = [[min(max(sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), T.LOW), T.HIGH) for w in x] for v in q]
    assert T.exact_products(q, x).tolist() == want
    assert len({s for row in want for s in row}) > 300


def test_very_large_components_end_no_query(spark, monkeypatch):
    monkeypatch.setattr(T, "SHARD_ROWS", 40)
    monkeypatch.setattr(T, "LEAF_ROWS", 8)
    rng = np.random.default_rng(5)
    data = [(i, (rng.normal(size=3) * 10.0 ** int(rng.integers(0, 22))).tolist()) for i in range(150)]
    data += [(200, [1e18, 0.5, -1e18]), (201, [1.7e308, -1.7e308, 0.0]), (300, [1e308, 1.0, 1.0]), (202, [2.0**43, 1.0, 0.0])]
    whole = lambda c: int(math.floor(min(max(1024 * c, -T.LARGEST), T.LARGEST)))
    vectors = {i: [whole(c) for c in v] for i, v in data}
    want = []
    for q in sorted(vectors):
        if q % 100 == 0:
            scored = sorted((-min(max(sum(a * b for a, b in zip(vectors[q], v, strict=True)), T.LOW), T.HIGH), i) for i, v in vectors.items() if i != q)
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:10])]
    base = T.quantised(spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3))
    got = T.top_k_inner_product(base, base.where("vec_id % 100 = 0"))
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == want


def test_bounds_prune_but_keep_the_best():
    rng = np.random.default_rng(0)
    x = np.rint(rng.normal(size=(3000, 4)) * 100 + rng.integers(-3, 4, (3000, 1)) * 500)
    q = x[:20]
    rows_, vec, score = T.search(np.arange(3000), x, np.arange(20), q, np.full(20, -np.inf), 5)
    for r in range(20):
        s = x @ q[r]
        s[r] = -np.inf
        best = np.lexsort((np.arange(3000), -s))[:5]
        assert sorted(vec[rows_ == r].tolist()) == sorted(best.tolist())
