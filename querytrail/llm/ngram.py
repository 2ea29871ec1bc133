"""Interpolated modified Kneser-Ney bigram model over sorted hash arrays.

Counting runs in Spark in three shuffles of pre-aggregated blocks:

1. word hashes and counts; the sorted hashes are the vocabulary, and a word's
   rank in them is its id;
2. word pairs, packed as ``context id * 2**32 + word id``, spread over shards
   by a mixing hash, so that no frequent word makes a shard large; each shard
   is merged and stored as a sorted hash array with its counts;
3. per shard and id range, partial sums of what each context and each word
   needs (totals, types by count, distinct contexts), merged into dense
   arrays over the ids.

All arrays lie in the shared folder.  The scoring tasks map them into memory
and look up the distinct pairs of a batch in hash order, so a task holds a
batch, never the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from querytrail.llm.common import byte_columns, chunks, map_array, mix64, runs, save_array, shared_folder, texts, word_hashes, word_spans, written

#: Words of a vocabulary file, training tokens of a pair shard, and ids of a
#: range: the sizes of what one task merges.
VOCABULARY_SHARD = 1 << 20
PAIR_SHARD = 1 << 20
ID_RANGE = 1 << 20
#: Pairs (or hashes) that a task gathers before it emits a block.
BUFFER = 1 << 20
#: Text that is scored at a time: its distinct pairs are looked up together.
SCORE_BYTES = 1 << 21

END_HASH = np.uint64(0x51ED270B9F1A3C77)
_32 = np.uint64(32)


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of rows, the end token after each row's words, and the
    number of tokens per row."""
    starts, ends, counts = word_spans(data, offsets)
    out_at = np.r_[0, np.cumsum(counts + 1)]
    out = np.full(out_at[-1], END_HASH, np.uint64)
    body = np.ones(len(out), bool)
    body[out_at[1:] - 1] = False
    out[body] = word_hashes(data, starts, ends)
    return out, counts + 1


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with their summed counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    at = runs(key)
    return key[at[:-1]], np.add.reduceat(count, at[:-1]) if len(key) else count


def _packed(*columns: np.ndarray) -> bytes:
    """Integer columns of one length as a compressed block, byte by byte of
    their significance; the first is sorted and stored as differences."""
    first = columns[0].astype(np.uint64)
    planes = [np.uint64(len(first)).tobytes()]
    for c in (np.diff(first, prepend=np.uint64(0)), *columns[1:]):
        planes.append(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(block: bytes, columns: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, np.uint64, 1)[0])
    out = [np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8 + 8 * n * i).reshape(8, n).T).view("<u8").reshape(-1) for i in range(columns)]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


class Vocabulary:
    """Sorted word hashes and counts in files by the hash's top bits."""

    def __init__(self, folder: str, bits: int, sizes: list[int]) -> None:
        self.folder, self.bits, self.first = folder, bits, np.r_[0, np.cumsum(sizes)]
        self.arrays: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"arrays": {}}

    def __len__(self) -> int:
        return int(self.first[-1])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        at = runs(shard)
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            s = int(shard[lo])
            if s not in self.arrays:
                self.arrays[s] = map_array(self.folder, f"words-{s}"), map_array(self.folder, f"word-counts-{s}")
            keys, n = self.arrays[s]
            if not len(keys):
                continue
            place = np.minimum(np.searchsorted(keys, hashes[lo:hi]), len(keys) - 1)
            hit = keys[place] == hashes[lo:hi]
            ids[lo:hi] = np.where(hit, place + self.first[s], -1)
            counts[lo:hi] = np.where(hit, n[place], 0)
        return ids, counts


def _bits_for(rows: int, most: int) -> int:
    """Bits of a shard number so that a shard has about ``most`` rows."""
    return max(0, (max(1, rows) - 1) // most).bit_length()


def _shard(column: str, bits: int) -> Column:
    return F.shiftrightunsigned(column, 64 - bits).cast("int") if bits else F.lit(0)


def build_vocabulary(train: DataFrame, folder: str) -> tuple[Vocabulary, int]:
    """The vocabulary of ``(doc_id, text)`` rows and the number of tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def block() -> pa.RecordBatch:
            k, n = _merge(keys, counts)
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], ["hash", "n"])

        for batch in batches:
            data, offsets = byte_columns(batch)
            for lo, hi in chunks(offsets):
                found, _ = _hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                k, n = np.unique(found, return_counts=True)
                keys.append(k)
                counts.append(n.astype(np.int64))
                held += len(k)
                if held > BUFFER:
                    k, n = _merge(keys, counts)
                    keys, counts, held = [k], [n], len(k)
                    if held > BUFFER // 2:
                        yield block()
                        keys, counts, held = [], [], 0
        if keys:
            yield block()

    words = written(train.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")), "ngram-words")
    size = words.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    if size["v"] >= 1 << 31:
        raise OverflowError("more than 2**31 distinct words")
    bits = _bits_for(size["v"], VOCABULARY_SHARD)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.asarray(b.column(0)), np.asarray(b.column(1)).view(np.uint64), np.asarray(b.column(2))) for b in batches]
        if not held:
            return
        shard, key, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((key, shard))
        shard, key, n = shard[order], key[order], n[order]
        at = runs(shard)
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            save_array(folder, f"words-{shard[lo]}", key[lo:hi])
            save_array(folder, f"word-counts-{shard[lo]}", n[lo:hi])
        yield pa.RecordBatch.from_arrays([pa.array(shard[at[:-1]]), pa.array(np.diff(at))], ["shard", "size"])

    sharded = words.select(_shard("hash", bits).alias("shard"), "hash", "n").repartition(1 << bits, "shard")
    sizes = dict(sharded.mapInArrow(store, "shard int, size long").collect())  # one row per vocabulary file
    for s in range(1 << bits):
        if s not in sizes:
            save_array(folder, f"words-{s}", np.empty(0, np.uint64))
            save_array(folder, f"word-counts-{s}", np.empty(0, np.int64))
    return Vocabulary(folder, bits, [sizes.get(s, 0) for s in range(1 << bits)]), int(size["n"])


def _pairs(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token: the context's id (the vocabulary's size at a start, -1
    unknown), the token's id and count; and the tokens per row."""
    found, per_row = _hashes(data, offsets)
    distinct, inverse = np.unique(found, return_inverse=True)
    ids, counts = vocabulary.find(distinct)
    token = ids[inverse]
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[np.r_[0, np.cumsum(per_row)[:-1]].astype(np.int64)] = len(vocabulary)
    return context, token, counts[inverse], per_row


def discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from the
    numbers of types with counts 1 to 4; where these are too few, the values
    for an even decline."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    out = np.array([0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        out[0] = 1 - 2 * y * n2 / n1
        out[1] = 2 - 3 * y * n3 / n2
        if n3:
            out[2] = 3 - 4 * y * n4 / n3
    return np.clip(out, [0.05, 0.05, 0.05], [0.95, 1.95, 2.95])


@dataclass
class BigramModel:
    folder: str
    vocabulary: Vocabulary
    tokens: int
    pair_bits: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    word_types: np.ndarray  # words with one, two, and more distinct contexts
    distinct_pairs: int
    id_range: int = ID_RANGE

    def __post_init__(self) -> None:
        self.maps: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"maps": {}}

    def _map(self, name: str) -> np.ndarray:
        if name not in self.maps:
            self.maps[name] = map_array(self.folder, name)
        return self.maps[name]

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Training counts of distinct pair keys."""
        hashed = mix64(keys)
        order = np.argsort(hashed)
        hashed = hashed[order]
        out = np.zeros(len(keys), np.int64)
        shard = (hashed >> np.uint64(64 - self.pair_bits)).astype(np.int64) if self.pair_bits else np.zeros(len(keys), np.int64)
        at = runs(shard)
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            stored = self._map(f"pairs-{shard[lo]}")
            if not len(stored):
                continue
            place = np.minimum(np.searchsorted(stored, hashed[lo:hi]), len(stored) - 1)
            n = self._map(f"pair-counts-{shard[lo]}")[place]
            out[order[lo:hi]] = np.where(stored[place] == hashed[lo:hi], n, 0)
        return out

    def by_id(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of a dense array at sorted distinct ids."""
        part = ids // self.id_range
        at = runs(part)
        return np.concatenate([self._map(f"{name}-{part[lo]}")[ids[lo:hi] - part[lo] * self.id_range] for lo, hi in zip(at[:-1], at[1:], strict=True)]) if len(ids) else np.empty(0)

    def word_probabilities(self, ids: np.ndarray) -> np.ndarray:
        """The lower order: by the number of distinct contexts of each known
        word (sorted distinct ids), interpolated with the uniform share."""
        rest = self.unknown()
        if not self.distinct_pairs:
            return np.full(len(ids), rest)
        contexts = self.by_id("contexts", ids).astype(np.int64)
        return np.maximum(contexts - np.r_[0, self.word_discounts][np.minimum(contexts, 3)], 0) / self.distinct_pairs + rest

    def unknown(self) -> float:
        types = len(self.vocabulary) + 1
        return float(self.word_discounts @ self.word_types / self.distinct_pairs / types) if self.distinct_pairs else 1.0 / types

    def log10_probabilities(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        known = np.unique(token[token >= 0])
        lower = np.full(len(token), self.unknown())
        seen = token >= 0
        lower[seen] = self.word_probabilities(known)[np.searchsorted(known, token[seen])]
        left = np.unique(context[context >= 0])
        totals, weight = self.by_id("totals", left), self.by_id("weights", left)
        place = np.searchsorted(left, np.maximum(context, left[0] if len(left) else 0))
        place = np.minimum(place, max(0, len(left) - 1))
        total = np.where(context >= 0, totals[place], 0) if len(left) else np.zeros(len(token))
        both = np.flatnonzero(seen & (context >= 0))
        keys, inverse = np.unique((context[both].astype(np.uint64) << _32) | token[both].astype(np.uint64), return_inverse=True)
        count = np.zeros(len(token))
        count[both] = self.pair_counts(keys)[inverse]
        upper = np.maximum(count - np.r_[0, self.pair_discounts][np.minimum(count, 3).astype(np.int64)], 0)
        has = total > 0
        p = np.where(has, upper / np.where(has, total, 1) + np.where(has, weight[place] if len(left) else 1.0, 1.0) * lower, lower)
        return np.log10(p)


def fit(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text") -> BigramModel:
    """Count and store a model of the rows for which ``usable`` (of doc_id)
    holds.  Null texts are empty: an end token alone; a row with a null doc_id
    is used only if the condition is true for it.  Without rows every
    probability is uniform."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "ngram")
    train = texts(docs, id_col, text_col).where(usable)
    vocabulary, tokens = build_vocabulary(train, folder)
    bits = _bits_for(tokens, PAIR_SHARD)
    id_range = ID_RANGE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held = [], 0

        def blocks() -> Iterator[pa.RecordBatch]:
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            shard = (mix64(key) >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(key), np.int32)
            order = np.argsort(shard, kind="stable")
            key, n, shard = key[order], n[order], shard[order]
            at = runs(shard)
            rows = [_packed(key[lo:hi], n[lo:hi]) for lo, hi in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard[at[:-1]]), pa.array(rows, pa.binary())], ["shard", "block"])

        for batch in batches:
            data, offsets = byte_columns(batch)
            for lo, hi in chunks(offsets):
                context, token, _, _ = _pairs(vocabulary, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                keys.append((context.astype(np.uint64) << _32) | token.astype(np.uint64))
                held += len(token)
                if held > BUFFER:
                    yield from blocks()
                    keys, held = [], 0
        if held:
            yield from blocks()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for shard, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(shard, []).append(block)
        for shard, raw in sorted(held.items()):
            held[shard] = []
            key, n = _merge(*zip(*(_unpacked(raw.pop(), 2) for _ in range(len(raw))), strict=True))
            hashed = mix64(key)
            order = np.argsort(hashed)
            save_array(folder, f"pairs-{shard}", hashed[order])
            save_array(folder, f"pair-counts-{shard}", _narrow(n[order]))
            del hashed, order
            rows = [(0, shard, _packed(np.arange(4), np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6)[1:5]))]
            context, word = (key >> _32).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
            at = runs(context)
            sums = [np.add.reduceat(x, at[:-1]) for x in (n.astype(np.int64), *((n == 1).astype(np.int64), (n == 2).astype(np.int64), (n >= 3).astype(np.int64)))]
            rows += _by_range(id_range, 1, context[at[:-1]], sums)
            rows += _by_range(id_range, 2, *_contexts(word))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["kind", "range", "block"])

    blocks = train.mapInArrow(count, "shard int, block binary").repartition(1 << bits, "shard")
    partial = written(blocks.mapInArrow(merge, "kind int, range int, block binary"), "ngram-partials")
    of_pairs = _sum_blocks(partial.where("kind = 0").select("block"))
    d = discounts(of_pairs)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for kind, part, block in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if part not in held:
                    held[part] = np.zeros((5, id_range), np.int64)
                columns = _unpacked(block, 5 if kind == 1 else 2)
                at = columns[0].astype(np.int64)
                for row, values in zip(range(4) if kind == 1 else (4,), columns[1:], strict=True):
                    held[part][row, at] += values.astype(np.int64)
        for part, sums in held.items():
            total = sums[0]
            weight = (d[0] * sums[1] + d[1] * sums[2] + d[2] * sums[3]) / np.maximum(total, 1)
            save_array(folder, f"totals-{part}", total)
            save_array(folder, f"weights-{part}", weight.astype(np.float32))
            save_array(folder, f"contexts-{part}", sums[4].astype(np.uint32))
            types = np.bincount(np.minimum(sums[4], 5), minlength=6)
            row = _packed(np.arange(6), np.r_[types[1:5], types[5], sums[4].sum()])
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([row], pa.binary())], ["range", "block"])

    ranges = len(vocabulary) // id_range + 1
    stored = written(partial.where("kind > 0").repartition(ranges, "range").mapInArrow(dense, "range int, block binary"), "ngram-ranges")
    of_words = _sum_blocks(stored.select("block"), 6)
    # A shard or range that no task reported had no pairs: its arrays are empty.
    # One that was reported and is not there when it is read is an error.
    for part in set(range(ranges)) - {r[0] for r in stored.select("range").collect()}:
        for name, kind in (("totals", np.int64), ("weights", np.float32), ("contexts", np.uint32)):
            save_array(folder, f"{name}-{part}", np.zeros(id_range, kind))
    for s in set(range(1 << bits)) - {r[0] for r in partial.where("kind = 0").select("range").collect()}:
        save_array(folder, f"pairs-{s}", np.empty(0, np.uint64))
        save_array(folder, f"pair-counts-{s}", np.empty(0, np.uint32))
    types = np.array([of_words[0], of_words[1], of_words[2] + of_words[3] + of_words[4]])
    return BigramModel(folder, vocabulary, tokens, bits, d, discounts(of_words[:4]), types, int(of_words[5]), id_range)


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits where all of them fit, else in 64."""
    return counts.astype(np.uint32 if int(counts.max(initial=0)) < 1 << 32 else np.uint64)


def _contexts(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    word, n = np.unique(words, return_counts=True)
    return word, [n]


def _by_range(size: int, kind: int, ids: np.ndarray, columns: list[np.ndarray]) -> list[tuple[int, int, bytes]]:
    """Blocks of sorted ids with their values, one per range of ``size`` ids."""
    part = ids // size
    at = runs(part)
    return [(kind, int(part[lo]), _packed(ids[lo:hi] - part[lo] * size, *(c[lo:hi] for c in columns))) for lo, hi in zip(at[:-1], at[1:], strict=True)]


def _sum_blocks(blocks: DataFrame, size: int = 4) -> np.ndarray:
    """The sum of small vectors, one row per shard, added up in the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for block in batch.column(0).to_pylist():
                total += _unpacked(block, 2)[1].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["i", "n"])

    summed = blocks.mapInArrow(add, "i int, n long").groupBy("i").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in summed.collect():
        out[row["i"]] = row["n"]
    return out


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: BigramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:data:`SCORES` per row: numbers of tokens and of known tokens, the
    smoothed unigram score and the model's log10 probability of the text with
    its end.  Null and empty texts have the end token alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.float64(model.tokens) + 0.1 * (len(model.vocabulary) + 1)
        for batch in batches:
            data, offsets = byte_columns(batch)
            for lo, hi in chunks(offsets, SCORE_BYTES):
                context, token, count, per_row = _pairs(model.vocabulary, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = np.cumsum(per_row) - per_row
                columns = [
                    per_row,
                    np.add.reduceat((count > 0).astype(np.int64), at),
                    np.full(hi - lo, model.tokens),
                    np.add.reduceat(np.log10((count + 0.1) / base), at),
                    np.add.reduceat(model.log10_probabilities(context, token), at),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *map(pa.array, columns)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return texts(docs, id_col, text_col).mapInArrow(run, SCORES)
