"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the unlabelled set is a sample
of all documents outside the held-out fold.  A linear classifier over hashed
words and word beginnings minimises the non-negative risk

    prior * R(positive, +) + max(0, R(unlabelled, -) - prior * R(positive, -))

with the logistic loss, where ``prior`` is the class prior.  Several
classifiers are trained in parallel Spark tasks, each on its own bounded
sample, and their scores are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.llm.common import byte_columns, chunks, mix64, texts, word_hashes, word_spans

#: Hashed features, classifiers, and the bounds of each classifier's sample.
FEATURES = 1 << 20
MODELS = 4
POSITIVES = 3_000
UNLABELLED = 9_000
#: A feature is used if its rates among the sampled positives and unlabelled
#: documents differ by so many standard errors; chance alone rarely gives it.
LEAST_Z = 5.0
STEPS = 250
RATE = 0.05
#: By how much the estimated limit of the class prior may be exceeded.
SLACK = 1.4
L2 = 1e-4

#: Bytes of a word's beginning (0: the whole word), and which least shares of
#: the document's words are features (0: once is enough).
FEATURE_KINDS = ((0, (0.0,)), (4, (1 / 256, 1 / 64)), (6, (1 / 256, 1 / 64)))
_ROW_SHIFT, _ROW_SHIFT24, _LOW40 = np.uint64(40), np.uint64(24), np.uint64((1 << 40) - 1)

#: What separates words: ASCII that is no letter, digit or apostrophe.
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x27, *range(0x80, 0x100)]] = False


def presence(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each row: ``(features, offsets)``.  A feature
    says that the row has a word, or that two or more of its words, and at
    least a certain share of them, begin with the same few bytes."""
    starts, ends, counts = word_spans(data, offsets, _SEPARATOR)
    rows = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    found = []
    for size, shares in FEATURE_KINDS:
        long = np.flatnonzero(ends - starts >= size)
        stop = np.minimum(ends[long], starts[long] + size) if size else ends
        begin = starts[long] if size else starts
        key = rows[long] if size else rows
        key = (key << _ROW_SHIFT) | (word_hashes(data, begin, stop) >> _ROW_SHIFT24)
        key, times = np.unique(key, return_counts=True)
        for level, share in enumerate(shares):
            part = key[(times >= share * counts[(key >> _ROW_SHIFT).astype(np.int64)]) & (times >= (2 if share else 1))]
            feature = mix64((part & _LOW40) + np.uint64((size * 8 + level) << 40)) & np.uint64(FEATURES - 1)
            found.append(((part >> _ROW_SHIFT) * np.uint64(FEATURES) + feature).astype(np.int64))
    keys = np.unique(np.concatenate(found))
    return (keys % FEATURES).astype(np.int32), np.searchsorted(keys, np.arange(len(counts) + 1) * FEATURES)


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float


def _scores(weights: np.ndarray, bias: float, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.r_[0.0, np.cumsum(weights[features], dtype=np.float64)]
    return total[offsets[1:]] - total[offsets[:-1]] + bias


def telling(features: np.ndarray, of_positive: np.ndarray, n_pos: int, n_unl: int) -> np.ndarray:
    """Which features separate positives from unlabelled documents."""
    pos = np.bincount(features[of_positive], minlength=FEATURES)
    unl = np.bincount(features[~of_positive], minlength=FEATURES)
    rate = (pos + unl + 1) / (n_pos + n_unl + 2)
    z = (pos / max(1, n_pos) - unl / max(1, n_unl)) / np.sqrt(rate * (1 - rate) * (1 / max(1, n_pos) + 1 / max(1, n_unl)))
    return np.abs(z) >= LEAST_Z


def bounded_prior(prior: float, row: np.ndarray, local: np.ndarray, positive: np.ndarray) -> float:
    """``prior``, or less if the sample shows that it can't be as large: the
    unlabelled set holds the share ``prior`` of positives, so above any score
    it has at least ``prior`` times the positives' rate.  The score is a naive
    sum of log ratios."""
    n = int(local.max(initial=-1)) + 1
    pos = (np.bincount(local[positive[row]], minlength=n) + 0.5) / (positive.sum() + 1)
    unl = (np.bincount(local[~positive[row]], minlength=n) + 0.5) / ((~positive).sum() + 1)
    score = np.bincount(row, np.log(pos / unl)[local], len(positive)) if n else np.zeros(len(positive))
    for above in (0.8, 0.6, 0.4):
        t = np.quantile(score[positive], 1 - above)
        rate = (score[positive] >= t).mean()
        prior = min(prior, SLACK * ((score[~positive] >= t).sum() + 1) / ((~positive).sum() + 1) / rate)
    return max(prior, 0.001)


def train(features: np.ndarray, offsets: np.ndarray, positive: np.ndarray, prior: float, steps: int = STEPS) -> Classifier:
    """One classifier by full-batch Adam on the non-negative risk; where its
    second part falls below zero, only that part's gradient is undone."""
    row = np.repeat(np.arange(len(positive)), np.diff(offsets))
    keep = telling(features, positive[row], int(positive.sum()), int((~positive).sum()))[features]
    row = row[keep]
    features = features[keep]
    used, local = np.unique(features, return_inverse=True)
    prior = bounded_prior(prior, row, local, positive)
    w = np.zeros(len(used) + 1)
    w[-1] = np.log(prior / (1 - prior))
    n_pos, n_unl = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    mean, var = np.zeros_like(w), np.zeros_like(w)
    at_pos = np.flatnonzero(positive)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[local], len(positive)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        minus = -np.log1p(-np.minimum(p, 1 - 1e-12))  # loss of a row as a negative
        second = minus[~positive].sum() / n_unl - prior * minus[at_pos].sum() / n_pos
        slope = np.zeros(len(positive))
        if second >= 0:
            slope[~positive] = p[~positive] / n_unl
            slope[at_pos] = (prior * (p[at_pos] - 1) - prior * p[at_pos]) / n_pos
        else:
            slope[~positive] = -p[~positive] / n_unl
            slope[at_pos] = prior * p[at_pos] / n_pos
        grad = np.append(np.bincount(local, slope[row], len(used)), slope.sum()) + L2 * np.append(w[:-1], 0)
        mean = 0.9 * mean + 0.1 * grad
        var = 0.999 * var + 0.001 * grad**2
        w -= RATE * (mean / (1 - 0.9**t)) / (np.sqrt(var / (1 - 0.999**t)) + 1e-8)
    full = np.zeros(FEATURES, np.float32)
    full[used] = w[:-1]
    return Classifier(full, float(w[-1]))


def unit_hash(*cols: Column | str) -> Column:
    """A number in [0, 1) from a hash: a repeatable sampling key."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, models: int = MODELS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> list[Classifier]:
    """Train on the documents and labels for which ``usable`` (of doc_id)
    holds.  Each classifier sees about :data:`POSITIVES` positives and
    :data:`UNLABELLED` unlabelled documents, chosen by a hash of doc_id.

    The labels give the positives and, by their share among labelled
    documents, an upper limit of the class prior.  A document with several labels counts as
    toxic if one says so; null labels and ids are ignored.  No positive, or
    no unlabelled document: no classifier.
    """
    marked = (
        labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    count = marked.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    if not count["p"]:
        return []
    prior = min(max(count["p"] / count["n"], 0.001), 0.5)
    share = min(1.0, models * POSITIVES / count["p"])
    positives = marked.where((F.col("toxic") == 1) & (unit_hash("doc_id", F.lit("p")) < share)).select("doc_id", F.lit(True).alias("positive"))
    base = texts(docs, id_col, text_col).where(F.col("doc_id").isNotNull() & usable)
    total = base.select("doc_id").count()
    chosen = min(1.0, models * UNLABELLED / max(1, total))
    # The positives are a sample of bounded size, so they may go to all tasks.
    sample = (
        base.join(F.broadcast(positives), "doc_id", "left").where(F.col("positive") | (unit_hash("doc_id", F.lit("u")) < chosen))
        .select("doc_id", "text", F.coalesce("positive", F.lit(False)).alias("positive"))
    )

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_columns(batch)
            for lo, hi in chunks(offsets):
                found, at = presence(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                rows = [found[at[i] : at[i + 1]].tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(rows, pa.binary()), batch.column(2).slice(lo, hi - lo)], ["doc_id", "features", "positive"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        positive = pdf["positive"].to_numpy(bool)
        if positive.all() or not positive.any():
            return pd.DataFrame({"weights": [], "bias": []})
        order = np.argsort(pdf["doc_id"].to_numpy(), kind="stable")
        rows = [np.frombuffer(pdf["features"].iat[i], np.int32) for i in order]
        model = train(np.concatenate(rows), np.r_[0, np.cumsum([len(r) for r in rows])], positive[order], prior)
        return pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    features = sample.mapInArrow(featurise, "doc_id long, features binary, positive boolean")
    groups = min(models, max(1, int(min(count["p"] / 200, total / 600))))
    trained = features.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(groups)).alias("model")).applyInPandas(learn, "weights binary, bias double")
    return [Classifier(np.frombuffer(r["weights"], np.float32), r["bias"]) for r in trained.collect()]


def _mean_scores(models: list[tuple[np.ndarray, float]], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The mean probability of each row; 0 without classifiers."""
    out = [np.empty(0)]
    for lo, hi in chunks(offsets):
        found, at = presence(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        total = np.zeros(hi - lo)
        for weights, bias in models:
            total += 1 / (1 + np.exp(-np.clip(_scores(weights, bias, found, at), -35, 35)))
        out.append(total / max(1, len(models)))
    return np.concatenate(out)


def score(docs: DataFrame, classifiers: list[Classifier], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` per row: the mean probability of being toxic, 0
    without classifiers.  Null and empty texts get the score of a document
    without words.  Only the text enters the score."""
    shared = docs.sparkSession.sparkContext.broadcast([(c.weights, c.bias) for c in classifiers])  # MODELS vectors of FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _mean_scores(shared.value, *byte_columns(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, classifiers: list[Classifier], below: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``below``."""
    shared = docs.sparkSession.sparkContext.broadcast([(c.weights, c.bias) for c in classifiers])
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_mean_scores(shared.value, *byte_columns(batch, place)) < below))

    return docs.mapInArrow(run, docs.schema)
