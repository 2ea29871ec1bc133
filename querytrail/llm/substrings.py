"""Exact removal of repeated substrings by sorting suffixes at anchors.

A byte goes if a string of ``length`` (100) bytes covers it that also starts
earlier: in a document with a smaller id, or earlier in the same one.

Every string of 100 bytes has an anchor, the leftmost of its 32-byte grams
with the smallest hash, which equal strings share.  So equal strings meet
among the occurrences of one anchor:

1. the hashes of all anchors are counted; those that occur twice or more are
   kept as sorted hash arrays in the shared folder;
2. a second scan sends each occurrence of a kept anchor, with the bytes
   around it, to the anchor's shard;
3. a shard sorts the suffixes that start at its anchors, and the reversed
   prefixes that end there, by deep-shallow sorting: a library sort per symbol
   of 8 bytes, in the place of a multikey quicksort, to a shallow depth, then
   blind tries for the groups whose common prefix is longer.  From the orders and their common-prefix lengths
   it follows, for every distance between a string's start and its anchor,
   which strings are equal and which of them is first;
4. the repeated strings are joined to the documents as byte ranges.

Strings at an anchor with very many occurrences (:data:`HOT`) go by a hash of
the whole string instead, the first of each in a buffer: a passage in a third
of all documents makes no group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.llm.common import byte_columns, map_array, mix64, runs, save_array, shared_folder, texts
from querytrail.llm.ngram import _bits_for, _merge, _packed, _unpacked

LENGTH = 100
GRAM = 32
#: Occurrences from which on an anchor's strings are hashed one by one.
HOT = 512
#: Bytes that are searched for anchors at a time (positions fit 20 bits), and
#: occurrences that a shard sorts.
SEARCH_BYTES = 1 << 18
SHARD_RECORDS = 150_000
#: Bytes of text per anchor, about, and anchors that a counting shard merges.
ANCHOR_BYTES = 32
SHARD_ANCHORS = 1 << 20
BUFFER = 1 << 21
#: Depths to which the sort by symbols goes.
SHALLOW_RIGHT, SHALLOW_LEFT = 64, 32

_POSITION = np.uint64((1 << 20) - 1)
_CODES = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.array([0x9E3779B97F4A7C15], np.uint64)


def _rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every substring of ``size`` bytes."""
    parts, have = [(1, _CODES[data])], 1
    power = {1: _BASE}
    while have * 2 <= size:
        h = parts[-1][1]
        parts.append((have * 2, h[:-have] * power[have] + h[have:]))
        power[have * 2] = power[have] * power[have]
        have *= 2
    out, done = parts[-1][1], have
    for part, h in reversed(parts[:-1]):
        if done + part <= size:
            out = out[: len(h) - done] * power[part] + h[done:]
            done += part
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM, search: int = SEARCH_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``length`` bytes of one text: positions, gram
    hashes, and the first and last string start that each serves."""
    found: list[tuple[np.ndarray, ...]] = []
    span = length - gram + 1
    for lo in range(0, max(0, len(data) - length + 1), search):
        part = data[lo : lo + search + length - 1]
        h = _rolling(part, gram)
        least = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
        have = 1
        while have * 2 <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < span:
            least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
        at = (least & _POSITION).astype(np.int64)
        r = runs(at)
        p = at[r[:-1]]
        # The smallest hashes have few leading bits: mixed, they spread evenly over the shards.
        found.append((p + lo, mix64(h[p]), r[:-1] + lo, r[1:] - 1 + lo))
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty.astype(np.uint64), empty, empty
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _many(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, search: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors of rows, some rows at a time: ``(rows, row starts, positions,
    hashes, firsts, lasts)``, places within ``data``.  Short rows are searched
    together, and the strings that cross rows left out."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + search, side="right")) - 1)
        start, end = int(offsets[lo]), int(offsets[hi])
        p, h, first, last = anchors(data[start:end], length, gram, search)
        p, first, last = p + start, first + start, last + start
        if hi > lo + 1 and len(p):
            row = np.searchsorted(offsets, first, side="right") - 1
            stop = offsets[row + 1] - length  # the last string that fits the row of the first one
            after = np.searchsorted(offsets, last, side="right") - 1
            again = (after > row) & (offsets[after + 1] - length >= offsets[after])
            # A run over a row's end serves strings of both rows: it is split.
            p2, h2, f2, l2 = p[again], h[again], offsets[after[again]], last[again]
            last = np.minimum(last, stop)
            keep = first <= last
            l2 = np.minimum(l2, offsets[after[again] + 1] - length)
            keep2 = f2 <= l2
            p, h = np.r_[p[keep], p2[keep2]], np.r_[h[keep], h2[keep2]]
            first, last = np.r_[first[keep], f2[keep2]], np.r_[last[keep], l2[keep2]]
        row = np.searchsorted(offsets, first, side="right") - 1
        yield row, offsets[row], p, h, first, last
        lo = hi


# --- deep-shallow sorting ---------------------------------------------------


class _Node:
    """A blind-trie node: strings below it agree on the first ``depth`` bytes."""

    __slots__ = ("depth", "below", "items")

    def __init__(self, depth: int, item: int = -1) -> None:
        self.depth = depth
        self.below: dict[int, _Node] = {}
        self.items = [item] if item >= 0 else []


def blind_trie_order(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """The sorted order of strings of one length, and the common-prefix length
    of each with the one before it (0 for the first).

    A blind trie keeps branching bytes only.  A new string descends by them
    without a look at what lies between, is compared once with the leaf it
    reaches, and then splits the path where the two differ.
    """
    size = len(strings[0])
    root = _Node(size, 0)
    for i in range(1, len(strings)):
        s = strings[i]
        node = root
        while node.depth < size:
            node = node.below.get(s[node.depth]) or next(iter(node.below.values()))
        other = strings[node.items[0]]
        if s == other:
            node.items.append(i)
            continue
        lo, hi = 0, size
        while lo < hi:  # the first byte where they differ
            mid = (lo + hi + 1) // 2
            if s[:mid] == other[:mid]:
                lo = mid
            else:
                hi = mid - 1
        parent, node = None, root
        while node.depth < lo:
            parent, node = node, node.below[s[node.depth]]
        if node.depth == lo and node.depth < size:
            node.below[s[lo]] = _Node(size, i)
            continue
        split = _Node(lo)
        split.below = {other[lo]: node, s[lo]: _Node(size, i)}
        if parent is None:
            root = split
        else:
            parent.below[s[parent.depth]] = split
    order: list[int] = []
    common: list[int] = []
    todo = [(root, 0)]
    while todo:
        node, shared = todo.pop()
        if node.items:
            for k, item in enumerate(node.items):
                order.append(item)
                common.append(size if k else shared)
        else:
            bytes_ = sorted(node.below, reverse=True)
            todo.extend((node.below[b], node.depth if b != bytes_[-1] else shared) for b in bytes_)
    return order, common


def deep_shallow_sort(rows: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of byte rows and the common-prefix length of each with
    the one before it.  Rows are ordered symbol by symbol (8 bytes) while
    ties remain, to ``shallow`` bytes; groups that still agree go to a blind
    trie, unless their rests are all equal."""
    n, size = rows.shape
    order = np.arange(n)
    common = np.zeros(n, np.int64)  # of each place in the order with the one before
    group = np.zeros(n, np.int64)  # equal so far
    live = np.arange(n)  # places whose group has more than one row
    for depth in range(0, shallow, 8):
        if len(live) < 2:
            break
        word = np.ascontiguousarray(rows[order[live], depth : depth + 8]).view(">u8").reshape(-1).astype(np.uint64)
        by = np.lexsort((word, group[live]))
        order[live] = order[live][by]
        word, g = word[by], group[live]
        same_group = np.r_[False, g[1:] == g[:-1]]
        equal = same_group & np.r_[False, word[1:] == word[:-1]]
        differ = np.flatnonzero(same_group & ~equal)
        x = word[differ] ^ word[differ - 1]
        lead = np.zeros(len(x), np.int64)
        for b in range(1, 8):
            lead += x < (np.uint64(1) << np.uint64(64 - 8 * b))
        common[live[differ]] = depth + lead
        common[live[equal]] = depth + 8
        starts = np.flatnonzero(~equal)
        group[live] = live[starts[np.searchsorted(starts, np.arange(len(live)), side="right") - 1]]
        live = live[equal | np.r_[equal[1:], False]]
    if len(live) >= 2 and shallow < size:
        at = runs(group[live])
        rest = np.ascontiguousarray(rows[order[live], shallow:])
        like_first = (rest == rest[np.repeat(at[:-1], np.diff(at))]).all(1)
        alike = np.logical_and.reduceat(like_first, at[:-1])
        for i, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)):
            places = live[lo:hi]
            if alike[i]:
                common[places[1:]] = size
                continue
            by, lengths = blind_trie_order([r.tobytes() for r in rest[lo:hi]])
            order[places] = order[places][by]
            common[places[1:]] = shallow + np.array(lengths[1:])
    return order, common


def repeated_starts(
    group: np.ndarray, rank: np.ndarray, left: np.ndarray, right: np.ndarray, near: np.ndarray, far: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray]:
    """Which strings also start earlier: ``(record, distance)``, the distance
    from the string's start to the anchor.

    Records of one ``group`` share the gram.  ``rank``: the order of their
    anchors' places (equal: the same place).  ``left``: the bytes before the
    anchor, reversed; ``right``: those from it on; the record serves strings
    at distances ``near`` to ``far``.
    """
    by_rank = np.argsort(rank, kind="stable")
    group, rank, left, right, near, far = (x[by_rank] for x in (group, rank, left, right, near, far))
    n = len(rank)
    order_r, common_r = deep_shallow_sort(right, SHALLOW_RIGHT)
    order_l, common_l = deep_shallow_sort(left, SHALLOW_LEFT)
    # Records of different groups must differ, even if a hash collides.
    other_r = np.r_[True, group[order_r][1:] != group[order_r][:-1]]
    out_record, out_distance = [], []
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int(near.min(initial=0)), int(far.max(initial=-1)) + 1):
        use = np.flatnonzero((near <= d) & (far >= d))
        if len(use) < 2:
            continue
        class_r[order_r] = np.cumsum((common_r < length - d) | other_r)
        class_l[order_l] = np.cumsum(np.r_[True, common_l[1:] < d]) if d else 0
        key = class_r[use] * (n + 1) + class_l[use]
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        later = rank[use] > rank[use][first][inverse]
        out_record.append(by_rank[use[later]])
        out_distance.append(np.full(int(later.sum()), d))
    if not out_record:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_record), np.concatenate(out_distance)


# --- the Spark jobs ---------------------------------------------------------


def _count_anchors(docs: DataFrame, folder: str, length: int, gram: int) -> tuple[int, int]:
    """Store the hashes of anchors that occur more than once, by their top
    bits; the number of these bits, and of such occurrences."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = _bits_for(size // ANCHOR_BYTES, SHARD_ANCHORS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def blocks() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            shard = (key >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(key), np.int32)
            at = runs(shard)
            rows = [_packed(key[lo:hi], n[lo:hi]) for lo, hi in zip(at[:-1], at[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(shard[at[:-1]]), pa.array(rows, pa.binary())], ["shard", "block"])

        for batch in batches:
            data, offsets = byte_columns(batch, 2)
            for _, _, _, h, _, _ in _many(data, offsets, length, gram, SEARCH_BYTES):
                held.append(h)
                n_held += len(h)
                if n_held > BUFFER:
                    yield blocks()
                    held, n_held = [], 0
        if n_held:
            yield blocks()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[bytes]] = {}
        for batch in batches:
            for shard, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got.setdefault(shard, []).append(block)
        for shard, raw in sorted(got.items()):
            parts_ = [_unpacked(b, 2) for b in raw]
            key, n = _merge([p[0] for p in parts_], [p[1] for p in parts_])
            twice = n > 1
            save_array(folder, f"anchors-{shard}", key[twice])
            save_array(folder, f"anchor-hot-{shard}", n[twice] >= HOT)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([int(n[twice].sum())], pa.int64())], ["shard", "n"])

    counted = docs.mapInArrow(count, "shard int, block binary").repartition(1 << bits, "shard").mapInArrow(merge, "shard int, n long")
    sizes = dict(counted.collect())  # one row per file
    for s in range(1 << bits):
        if s not in sizes:
            save_array(folder, f"anchors-{s}", np.empty(0, np.uint64))
            save_array(folder, f"anchor-hot-{s}", np.empty(0, bool))
    return bits, sum(sizes.values())


class _Kept:
    """The stored anchors, mapped into memory."""

    def __init__(self, folder: str, bits: int) -> None:
        self.folder, self.bits = folder, bits
        self.arrays: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are kept, and which of them are hot."""
        kept, hot = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
        order = np.argsort(hashes)
        hashes = hashes[order]
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        at = runs(shard)
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            s = int(shard[lo])
            if s not in self.arrays:
                self.arrays[s] = map_array(self.folder, f"anchors-{s}"), map_array(self.folder, f"anchor-hot-{s}")
            keys, often = self.arrays[s]
            if len(keys):
                place = np.minimum(np.searchsorted(keys, hashes[lo:hi]), len(keys) - 1)
                hit = keys[place] == hashes[lo:hi]
                kept[order[lo:hi]] = hit
                hot[order[lo:hi]] = hit & often[place]
        return kept, hot


_RECORD, _WINDOW, _RANGE = 0, 1, 2
#: ``place``: the position in the text, then a byte each of the farthest and
#: nearest distance and the kind.  ``around``: of a record the text from its
#: first string's start to its last string's end; of a window the second half
#: of its hash; of a range its length.
_ROWS = "key long, doc long, h long, place long, around binary"
_SCHEMA = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("h", pa.int64()), ("place", pa.int64()), ("around", pa.binary())])


def _batch(kind: int, key: np.ndarray, doc: np.ndarray, h: np.ndarray, pos: np.ndarray, far: np.ndarray | int, near: np.ndarray | int, around: pa.Array) -> pa.RecordBatch:
    place = (pos.astype(np.int64) << 24) | (np.asarray(far, np.int64) << 16) | (np.asarray(near, np.int64) << 8) | kind
    return pa.RecordBatch.from_arrays([pa.array(key.astype(np.uint64).view(np.int64)), pa.array(doc), pa.array(h), pa.array(place), around], schema=_SCHEMA)


def _binary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ranges of ``data`` as a binary column."""
    lens = ends - starts
    offsets = np.r_[0, np.cumsum(lens)]
    at = np.repeat(starts - offsets[:-1], lens)
    at += np.arange(len(at))
    return pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at]))])


def _longs(values: np.ndarray) -> pa.Array:
    """64-bit numbers as a binary column."""
    raw = np.ascontiguousarray(values.astype(np.int64) if values.dtype != np.uint64 else values).view(np.uint8)
    at = np.arange(len(values)) * 8
    return _binary(raw, at, at + 8)


def _occurrences(docs: DataFrame, folder: str, bits: int, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Kept(folder, bits)
        hot_rows: list[tuple[np.ndarray, ...]] = []
        n_hot = 0

        def windows() -> Iterator[pa.RecordBatch]:
            """The first of each hot string in the buffer; the others repeat."""
            w, w2, doc, h, pos = (np.concatenate(x) for x in zip(*hot_rows, strict=True))
            order = np.lexsort((pos, h.view(np.uint64), doc, w2, w))
            w, w2, doc, h, pos = (x[order] for x in (w, w2, doc, h, pos))
            new = np.r_[True, (w[1:] != w[:-1]) | (w2[1:] != w2[:-1])]
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = (doc != doc[lead]) | (h != h[lead]) | (pos != pos[lead])
            i = np.flatnonzero(new)
            yield _batch(_WINDOW, w[i], doc[i], h[i], pos[i], 0, 0, _longs(w2[i]))
            i = np.flatnonzero(later)
            by = np.lexsort((pos[i], h[i], doc[i]))
            i = i[by]
            doc, h, pos = doc[i], h[i], pos[i]
            gap = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]) | (pos[1:] > pos[:-1] + 1)] if len(i) else np.empty(0, bool)
            a = np.flatnonzero(gap)
            b = np.r_[a[1:], len(i)] - 1 if len(a) else a
            if len(a):  # neighbouring strings join to one range
                yield _batch(_RANGE, mix64(h[a].view(np.uint64)), doc[a], h[a], pos[a], 0, 0, _longs(pos[b] - pos[a] + length))

        for batch in batches:
            data, offsets = byte_columns(batch, 2)
            doc_of, h_of = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for row, base, p, gram_hash, first, last in _many(data, offsets, length, gram, SEARCH_BYTES):
                is_kept, is_hot = kept.find(gram_hash)
                i = np.flatnonzero(is_kept & ~is_hot)
                if len(i):
                    around = _binary(data, first[i], last[i] + length)
                    yield _batch(_RECORD, gram_hash[i], doc_of[row[i]], h_of[row[i]], p[i] - base[i], p[i] - first[i], p[i] - last[i], around)
                i = np.flatnonzero(is_hot)
                if len(i):
                    count = last[i] - first[i] + 1
                    at = np.repeat(first[i] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                    lo, hi = int(at.min()), int(at.max()) + length
                    w = _rolling(data[lo:hi], length)[at - lo]
                    w2 = _rolling(data[lo:hi] ^ np.uint8(0x5A), length)[at - lo]
                    r = np.repeat(row[i], count)
                    hot_rows.append((mix64(w), w2, doc_of[r], h_of[r], at - offsets[r]))
                    n_hot += len(at)
                    if n_hot > BUFFER:
                        yield from windows()
                        hot_rows, n_hot = [], 0
        if n_hot:
            yield from windows()

    return docs.mapInArrow(run, _ROWS)


def _surroundings(data: np.ndarray, at: np.ndarray, back: np.ndarray, ahead: np.ndarray, before: int, length: int) -> np.ndarray:
    """Per record the ``before`` bytes before its anchor, the nearest first,
    and the ``length`` bytes from it on; zero beyond ``back`` and ``ahead``."""
    out = np.zeros((before + length, len(at)), np.uint8)
    for j in range(before):
        use = np.flatnonzero(back > j)
        out[j, use] = data[at[use] - 1 - j]
    for j in range(length):
        use = np.flatnonzero(ahead > j)
        out[before + j, use] = data[at[use] + j]
    return np.ascontiguousarray(out.T)


def _ranges(rows: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """Byte ranges ``(doc, h, start, stop)`` of repeated strings."""
    before = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        key, doc, h, place = (table.column(i).to_numpy() for i in range(4))
        around = table.column(4).chunk(0)
        h = h.view(np.uint64)
        kind, near, far, pos = place & 255, place >> 8 & 255, place >> 16 & 255, place >> 24
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        i = np.flatnonzero(kind == _RANGE)
        out.append((doc[i], h[i], pos[i], pos[i] + np.frombuffer(b"".join(around.take(pa.array(i)).to_pylist()), np.int64)))

        i = np.flatnonzero(kind == _WINDOW)
        if len(i):
            w2 = np.frombuffer(b"".join(around.take(pa.array(i)).to_pylist()), np.uint64)
            order = np.lexsort((pos[i], h[i], doc[i], w2, key[i]))
            i, w2 = i[order], w2[order]
            new = np.r_[True, (key[i][1:] != key[i][:-1]) | (w2[1:] != w2[:-1])]
            lead = i[np.flatnonzero(new)[np.cumsum(new) - 1]]
            i = i[(doc[i] != doc[lead]) | (h[i] != h[lead]) | (pos[i] != pos[lead])]
            out.append((doc[i], h[i], pos[i], pos[i] + length))

        i = np.flatnonzero(kind == _RECORD)
        if len(i):
            data, starts = byte_columns(pa.RecordBatch.from_arrays([around.take(pa.array(i))], ["a"]), 0)
            key, doc, h, pos, near, far = (x[i] for x in (key, doc, h, pos, near, far))
            around_ = _surroundings(data, starts[:-1] + far, far, length - near, before, length)
            order = np.lexsort((pos, h, doc))
            moved = np.r_[False, (doc[order][1:] != doc[order][:-1]) | (h[order][1:] != h[order][:-1]) | (pos[order][1:] != pos[order][:-1])]
            rank = np.empty(len(i), np.int64)
            rank[order] = np.cumsum(moved)
            # Occurrences with the same bytes around them: all strings of the later ones repeat.
            words = around_.view(np.uint64) if (before + length) % 8 == 0 else np.pad(around_, ((0, 0), (0, -(before + length) % 8))).view(np.uint64)
            mixed = mix64(key.view(np.uint64) ^ (near.astype(np.uint64) << np.uint64(8)) ^ far.astype(np.uint64))
            for c in range(words.shape[1]):
                mixed = mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + words[:, c])
            by = np.lexsort((rank, mixed))
            new = np.r_[True, mixed[by][1:] != mixed[by][:-1]]
            lead = np.empty(len(i), np.int64)
            lead[by] = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
            same = (words == words[lead]).all(1) & (key == key[lead]) & (near == near[lead]) & (far == far[lead])
            later = same & (rank > rank[lead])
            out.append((doc[later], h[later], pos[later] - far[later], pos[later] - near[later] + length))
            # The others, where a gram has several kinds of surroundings.
            rest = np.flatnonzero(~later)
            _, group, size = np.unique(key[rest], return_inverse=True, return_counts=True)
            several = size[group] > 1
            rest, group = rest[several], group[several]
            if len(rest):
                left, right = np.ascontiguousarray(around_[rest, :before]), np.ascontiguousarray(around_[rest, before:])
                # What lies beyond a record's own strings is zero, and no part of a string that is compared.
                record, distance = repeated_starts(group, rank[rest], left, right, near[rest], far[rest], length)
                by = np.lexsort((distance, record))
                record, distance = record[by], distance[by]
                first = np.flatnonzero(np.r_[True, (record[1:] != record[:-1]) | (distance[1:] != distance[:-1] + 1)]) if len(record) else record
                stop = np.r_[first[1:], len(record)] - 1 if len(first) else first
                r = rest[record[first]]
                out.append((doc[r], h[r], pos[r] - distance[stop], pos[r] - distance[first] + length))
        doc, h, a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        for lo in range(0, len(doc), 1 << 16):
            cut = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(doc[cut]), pa.array(h[cut].view(np.int64)), pa.array(a[cut]), pa.array(b[cut])], ["doc", "h", "start", "stop"])

    return rows.repartition(parts, "key").mapInArrow(run, "doc long, h long, start long, stop long")


def deduplicate(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` per document: the maximal removed
    byte ranges and the bytes that are left (removal may cut a character).

    Null texts are empty; texts below ``length`` bytes lose nothing.  A null
    doc_id counts as the smallest.  Rows that share a doc_id come in the order
    of a hash of their text; rows that are equal altogether are one document
    to each other, and no repeat.  Empty input gives no rows.
    """
    gram = GRAM
    if length < gram + 1 or (length - gram + 1) >= 1 << 7:
        raise ValueError("the string length must be between 33 and 158")
    spark = docs.sparkSession
    folder = shared_folder(spark, "substrings")
    lowest = -(1 << 63)
    base = texts(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(lowest)).alias("doc"), F.xxhash64("text").alias("h"), "text", F.col("doc_id").isNull().alias("no_id"))
    scan = base.select("doc", "h", "text")
    bits, repeated = _count_anchors(scan, folder, length, gram)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-repeated // SHARD_RECORDS))
    ranges = _ranges(_occurrences(scan, folder, bits, length, gram), parts, length, gram)
    by_doc = ranges.groupBy("doc", "h").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    joined = base.join(by_doc, ["doc", "h"], "left").select("doc", "no_id", "text", "ranges.start", "ranges.stop")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            sizes, spans, kept = [], [], []
            texts_ = batch.column(2).cast(pa.binary())
            starts, stops = batch.column(3), batch.column(4)
            for i in range(batch.num_rows):
                raw = texts_[i].as_py()
                sizes.append(len(raw))
                if not starts[i].is_valid:
                    spans.append([])
                    kept.append(raw)
                    continue
                a, b = starts[i].values.to_numpy(), stops[i].values.to_numpy()
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
                a, b = a[new], b[np.r_[new[1:], len(a)] - 1]
                spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(a, b, strict=True)])
                edges = np.r_[0, np.stack([a, b], 1).reshape(-1), len(raw)].tolist()
                kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if n else d for d, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
