import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents, words
from pyspark.sql import functions as F

from querytrail.llm import ngram
from querytrail.llm.queries import fold


def texts():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60), p=np.arange(60, 0, -1) / 1830).tolist()).title()) for i in range(150)]
    return rows + [(1000, None), (1001, ""), (1002, "  \t\n"), (1003, "w1 " * 4000 + "é" * 70_000), (1004, "unseen words only"), (5, rows[5][1])]


def brute(rows, held):
    """The model written plainly with dictionaries."""
    docs = [(i, words(t) + ["</s>\0"]) for i, t in rows]
    c, b = Counter(), Counter()
    for i, w in docs:
        if not held(i):
            c.update(w)
            b.update(zip(["<s>", *w], w, strict=False))

    def discounts(values):
        n = Counter(min(v, 5) for v in values)
        return [0, *ngram.discounts(np.array([n[k] for k in (1, 2, 3, 4)])).tolist()]

    total, types, left = Counter(), defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (a, w), n in b.items():
        total[a] += n
        types[a][min(n, 3)] += 1
        left[w] += 1
    d, u, v, n_all, pairs = discounts(b.values()), discounts(left.values()), len(c), sum(c.values()), len(b)
    kinds = Counter(min(x, 3) for x in left.values())
    rest = sum(u[k] * kinds[k] for k in (1, 2, 3)) / pairs / (v + 1)

    def p(a, w):
        low = (left[w] - u[min(left[w], 3)] if w in left else 0) / pairs + rest
        if not total[a]:
            return low
        n = b[(a, w)]
        return max(n - d[min(n, 3)], 0) / total[a] + sum(d[k] * types[a][k] for k in (1, 2, 3)) / total[a] * low

    assert abs(sum(p("w1", w) for w in c) + p("w1", "?") - 1) < 1e-9
    return {
        i: (len(w), sum(x in c for x in w), n_all, sum(math.log10((c[x] + 0.1) / (n_all + 0.1 * (v + 1))) for x in w), sum(math.log10(p(a, x)) for a, x in zip(["<s>", *w], w, strict=False)))
        for i, w in docs
    }


@pytest.mark.parametrize("small", [False, True])
def test_scores_match_plain_model(spark, monkeypatch, small):
    if small:  # many shards, ranges and blocks
        for name, value in (("VOCABULARY_SHARD", 8), ("PAIR_SHARD", 512), ("BUFFER", 300), ("ID_RANGE", 16)):
            monkeypatch.setattr(ngram, name, value)
    rows = texts()
    docs = documents(spark, rows).repartition(3)
    got = ngram.score(docs, ngram.fit(docs, fold(10) != 0)).collect()
    want = brute(rows, lambda i: zlib.crc32(str(i).encode()) % 10 == 0)
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert r["base_score"] == pytest.approx(w[3], rel=1e-9) and r["score"] == pytest.approx(w[4], rel=1e-5)


def test_empty_training_and_empty_table(spark):
    docs = documents(spark, [(1, "a b"), (None, "a"), (2, None)])
    got = {r["doc_id"]: r for r in ngram.score(docs, ngram.fit(docs, F.lit(False))).collect()}
    assert got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0 and got[1]["score"] == pytest.approx(0.0)
    assert set(got) == {1, 2, None}
    empty = documents(spark, [])
    assert ngram.score(empty, ngram.fit(empty, fold(10) != 0)).count() == 0


def test_copies_score_better_than_the_base(spark):
    docs = documents(spark, [(i, "the quick brown fox jumps over the lazy dog " * 3) for i in range(40)])
    got = ngram.score(docs, ngram.fit(docs, fold(10) != 0)).collect()
    assert all(r["score"] > r["base_score"] for r in got)


def test_counts_beyond_32_bits_stay():
    for counts in ([1, (1 << 32) - 1], [1, 1 << 32], [5, 1 << 40]):
        assert ngram._narrow(np.array(counts)).tolist() == counts
    assert ngram._narrow(np.array([1])).dtype == np.uint32 and ngram._narrow(np.empty(0, np.int64)).tolist() == []


def test_a_missing_shard_is_an_error(spark):
    import os

    docs = documents(spark, texts())
    model = ngram.fit(docs, F.lit(True))
    stored = sorted(f for f in os.listdir(model.folder) if f.startswith(("pairs-", "totals-")))
    assert stored
    for name in stored:
        os.rename(os.path.join(model.folder, name), os.path.join(model.folder, f"gone-{name}"))
        with pytest.raises(Exception, match="(?i)no such file|FileNotFound"):
            ngram.score(docs, model).collect()
        os.rename(os.path.join(model.folder, f"gone-{name}"), os.path.join(model.folder, name))
    assert ngram.score(docs, model).count() == docs.count()
