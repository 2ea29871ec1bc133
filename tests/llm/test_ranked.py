"""Ranked search against scoring every document for every item."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, documents
from pyspark.sql.types import LongType, StringType, StructField, StructType

from querytrail.llm import ranked as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    counted = [(d, terms(t)) for d, t in docs]
    counted = [(d, t) for d, t in counted if t]
    total, length = len(counted), sum(len(t) for _, t in counted)
    df = {}
    for _, t in counted:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for d, t in counted:
            m = 10 + (90 * len(t) * total) // length
            s = 0
            for x in set(terms(text)):
                tf = t.count(x)
                if tf:
                    s += math.floor(1000 * math.log((2 * total + 2) / (2 * df[x] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scores.append((-s, -(1 << 63) if d is None else d, d))
        for rank, (s, _, d) in enumerate(sorted(scores, key=lambda r: r[:2])[:k], 1):
            out.append((item, rank, d, -s))
    return sorted(out, key=str)


def benchmark(spark, rows):
    schema = StructType([StructField("item_id", LongType()), StructField("text", StringType()), StructField("score", StringType()), StructField("n", LongType())])
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], schema)


def found(spark, docs, items, k=10):
    df = R.rank(documents(spark, docs), benchmark(spark, items), k)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = ["the", "The", "été", "ÉTÉ", "x1", "a", "İ"] + [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(size):
        return rnd.choice([" ", "_", "-"]).join(rnd.choices(vocabulary, weights, k=size))

    docs = [(i, text(rnd.randint(0, 80))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(15)]  # ties
    docs += [(None, docs[5][1]), (None, None), (8, ""), (9, " .,;"), (7, docs[7][1]), (7, docs[7][1])]
    items = [(i, text(rnd.randint(1, 30))) for i in range(25)] + [(100, docs[5][1]), (101, docs[20][1])]
    items += [(102, None), (103, "..."), (104, "nowhere"), (3, "w1 w2"), (None, "w3"), (None, "w4"), (105, "w5"), (105, "w5")]
    return docs, items


def test_as_scoring_everything(spark):
    docs, items = corpus(1, 400)
    assert found(spark, docs, items) == brute(docs, items)


def test_waves_blocks_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_DOCS", 24)
    monkeypatch.setattr(R, "BLOCK_TERMS", 200)
    docs, items = corpus(2, 300)
    assert found(spark, docs, items, 3) == brute(docs, items, 3)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "")], [(1, "a")]) == []


def test_one_document_and_large_counts(spark):
    docs = [(1, "a " * 5000 + "b"), (2, "a")]
    items = [(1, "A b"), (2, "b b b")]
    assert found(spark, docs, items) == brute(docs, items)


def _shard(seed, n, width, leaf):
    rnd = np.random.default_rng(seed)
    centres = [rnd.choice(width, 12, replace=False) for _ in range(8)]
    rows = [np.sort(rnd.choice(centres[i % 8], 9, replace=False)) for i in range(n)]
    first = np.arange(n + 1) * 9
    value = rnd.integers(1, 10**6, n * 9)
    x = R.Sparse(first, np.concatenate(rows), value, width)
    queries = [np.sort(rnd.choice(centres[i % 8], 6, replace=False)) for i in range(16)]
    ids = np.empty(16, object)
    ids[:] = list(range(16))
    items = R.Items(ids, np.arange(width, dtype=np.uint64), np.arange(17) * 6, np.concatenate(queries))
    return x, items, rnd.integers(0, 9000, width)


def test_bounds_hold_and_subtrees_are_left_out():
    x, items, weights = _shard(4, 1000, 200, 16)
    dense = np.zeros((1000, 200), np.int64)
    dense[np.repeat(np.arange(1000), 9), x.column] = x.value
    q = np.zeros((200, 16), np.int64)
    q[items.terms, np.repeat(np.arange(16), 6)] = weights[items.terms]
    scores = dense @ q
    root = np.sqrt(weights)
    tree = R.BallTree(x, root, 16)
    stretched = np.divide(q, root[:, None], out=np.zeros(q.shape), where=root[:, None] > 0)
    bounds = tree.bounds(stretched, np.sqrt((stretched**2).sum(0)))
    for node in range(len(tree.lo)):
        assert (bounds[node] >= scores[tree.order[tree.lo[node] : tree.hi[node]]].max(0)).all()
    item, doc, score, scored = R.search(x, np.arange(1000), items, weights, np.zeros(16, np.int64), 10, 16)
    for i in range(16):
        want = sorted((-s, d) for d, s in enumerate(scores[:, i].tolist()) if s > 0)[:10]
        assert sorted((-s, d) for d, s in zip(doc[item == i].tolist(), score[item == i].tolist(), strict=True)) == want
    assert scored < 0.5 * scores.size


def test_integers_beyond_a_double():
    ids = np.empty(1, object)
    ids[:] = [1]
    items = R.Items(ids, np.arange(2, dtype=np.uint64), np.array([0, 2]), np.array([0, 1]))
    x = R.Sparse(np.array([0, 2, 4]), np.array([0, 1, 0, 1]), np.array([10**6, 10**6 - 1, 10**6, 10**6 - 2]), 2)
    weights = np.array([2**40 + 1, 2**40 + 1])
    _, doc, score, _ = R.search(x, np.array([5, 6]), items, weights, np.zeros(1, np.int64), 1)
    assert doc.tolist() == [5] and score.tolist() == [(2**40 + 1) * (2 * 10**6 - 1)]


def test_slices_of_a_long_text():
    text = "Ab cd-été " * 300 + "x" * 2000 + " cd"
    batch = np.frombuffer(text.encode(), np.uint8)
    offsets = np.array([0, len(batch)])
    whole = np.concatenate([h for _, h in R.term_pieces(batch, offsets)])
    for most in (1, 7, 64):
        assert np.concatenate([h for _, h in R.term_pieces(batch, offsets, most)]).tolist() == whole.tolist()
    assert len(whole) == 902 and pa.array(whole).unique().__len__() == 4


def test_length_norms_beyond_64_bits():
    n = np.array([10, 1 << 40])
    assert R.length_norms(n, 1 << 30, 1 << 50).tolist() == [10 + (90 * x * (1 << 30)) // (1 << 50) for x in n.tolist()]


@pytest.mark.parametrize("df,want", [(0, math.floor(1000 * math.log(22 / 1))), (10, math.floor(1000 * math.log(22 / 21)))])
def test_weights(df, want):
    assert R.term_weights(10, np.array([df])).tolist() == [want]
