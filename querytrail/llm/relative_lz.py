"""Removal of repeated word windows by relative Lempel-Ziv parsing.

A word goes if a window of ``window`` (35) consecutive words of one document
covers it whose word sequence also starts anywhere else, in the same document
or another one.

The text of the corpus is indexed in reference blocks, and a document is
factored against every block that can hold a window of it:

1. every window has an anchor, the leftmost of its 12-word grams with the
   smallest hash, which equal windows share.  The anchors are counted; those
   that occur twice or more are kept as sorted hash arrays in the shared
   folder.  A window at any other anchor occurs once;
2. a second scan cuts the documents into segments, the words of consecutive
   windows with one anchor, and sends those at kept anchors to the anchor's
   block.  No other block can hold their windows, and a window belongs to one
   segment.  Segments that repeat within a task are marked there, and one of
   them goes on;
3. a block sorts the suffixes of its words (ranks of 3, 9, 27 and 81 words),
   which answers for any position how long the longest match elsewhere in the
   block is.  Each segment is parsed greedily into such factors.  A factor of
   ``window`` words or more is repeated text.  A repeated window that is in no
   factor crosses exactly one factor boundary, since the factor that starts
   inside it reaches its end at least: so the windows within two neighbouring
   factors are checked at their boundary;
4. the repeated word ranges are joined to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.llm.common import SPACE, byte_columns, map_array, mix64, runs, save_array, shared_folder, texts, word_spans
from querytrail.llm.ngram import _bits_for, _merge, _packed, _unpacked

WINDOW = 35
GRAM = 12
#: Bytes of text that are split into words at a time, here and in the output.
SLICE_BYTES = 1 << 20
#: Words a window's anchor search takes at a time (positions fit 20 bits).
_POSITION = np.uint64((1 << 20) - 1)
#: Bytes of text per anchor, about, and anchors that a counting shard merges.
ANCHOR_BYTES = 64
SHARD_ANCHORS = 1 << 20
#: Anchors, and segments, that a task holds before it sends them off.
BUFFER_ANCHORS = 1 << 20
BUFFER_SEGMENTS = 1 << 15
#: Segments in a task of the parsing stage, and blocks among which they are dealt.
PART_SEGMENTS = 40_000
BLOCKS = 4

_CODES = np.random.Generator(np.random.PCG64(1201)).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of ``codes`` (any order, overlaps too)."""
    up, down = _POWERS.upto(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:-1], dtype=np.uint64, out=total[1:])
    lens = (ends - starts).astype(np.uint64)
    return mix64((total[ends] - total[starts]) * down[starts] + lens * np.uint64(0xD6E8FEB86659FD93))


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word, unchanged, and the words per row."""
    starts, ends, counts = word_spans(data, offsets)
    return range_hashes(_CODES[data], starts, ends), counts


def _cuts(raw: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Slices of a text of about ``most`` bytes that end behind white space
    or at the text's end; a longer word is in one slice."""
    lo = 0
    while lo < len(raw):
        hi = min(lo + most, len(raw))
        if hi < len(raw):
            gaps = np.flatnonzero(SPACE[raw[lo:hi]])
            if len(gaps):
                hi = lo + int(gaps[-1]) + 1
            else:
                while hi < len(raw):
                    gap = np.flatnonzero(SPACE[raw[hi : hi + most]])
                    if len(gap):
                        hi += int(gap[0]) + 1
                        break
                    hi = min(hi + most, len(raw))
        yield lo, hi
        lo = hi


def word_pieces(batch: pa.RecordBatch, text: int, window: int, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The words of a batch in pieces: ``(codes, offsets, rows, first)``, where
    piece ``i`` has the codes ``offsets[i]:offsets[i + 1]``, row ``rows[i]``
    and begins at the row's word ``first[i]``.  A long text gives several
    pieces, each with the last ``window - 1`` words of the one before, so that
    every window is in exactly one piece."""
    data, offsets = byte_columns(batch, text)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        if hi > lo + 1 or offsets[hi] - offsets[lo] <= most:
            codes, counts = word_codes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            yield codes, np.r_[0, np.cumsum(counts)], np.arange(lo, hi), np.zeros(hi - lo, np.int64)
        else:
            raw, held, first = data[offsets[lo] : offsets[hi]], np.empty(0, np.uint64), 0
            for a, b in _cuts(raw, most):
                codes = np.r_[held, word_codes(raw[a:b], np.array([0, b - a]))[0]]
                yield codes, np.array([0, len(codes)]), np.array([lo]), np.array([first])
                keep = min(len(codes), window - 1)
                first += len(codes) - keep
                held = codes[len(codes) - keep :]
        lo = hi


def segments(codes: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(piece, anchor hash, first, last)`` of each segment: the first and
    the last start, within ``codes``, of its windows."""
    empty = np.empty(0, np.int64)
    found = []
    span = window - gram + 1
    step = int(_POSITION) + 1 - window
    for lo in range(0, max(0, len(codes) - window + 1), step):
        part = codes[lo : lo + step + window - 1]
        starts = np.arange(len(part) - gram + 1)
        h = range_hashes(part, starts, starts + gram)
        least = (h & ~_POSITION) | starts.astype(np.uint64)
        have = 1
        while have * 2 <= span:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < span:
            least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
        at = (least & _POSITION).astype(np.int64)
        start = np.arange(lo, lo + len(at))
        piece = np.searchsorted(offsets, start, side="right") - 1
        inside = start + window <= offsets[piece + 1]
        start, piece, at = start[inside], piece[inside], at[inside]
        if not len(start):
            continue
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])])
        last = np.r_[new[1:], len(start)] - 1
        # The smallest hashes have few leading bits: mixed, they spread evenly over the shards.
        found.append((piece[new], mix64(h[at[new]]), start[new], start[last]))
    if not found:
        return empty, empty.astype(np.uint64), empty, empty
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# --- repeated anchors -------------------------------------------------------


def _shards(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def count_anchors(docs: DataFrame, folder: str, window: int, gram: int) -> tuple[int, int]:
    """Store the hashes of the anchors that occur more than once, by their top
    bits; the number of these bits, and of their occurrences."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = _bits_for(size // ANCHOR_BYTES, SHARD_ANCHORS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def blocks() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            shard = _shards(key, bits)
            at = runs(shard)
            rows = [_packed(key[lo:hi], n[lo:hi]) for lo, hi in zip(at[:-1], at[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(shard[at[:-1]], pa.int32()), pa.array(rows, pa.binary())], ["shard", "block"])

        for batch in batches:
            for codes, offsets, _, _ in word_pieces(batch, 2, window):
                h = segments(codes, offsets, window, gram)[1]
                held.append(h)
                n_held += len(h)
                if n_held > BUFFER_ANCHORS:
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
            parts = [_unpacked(b, 2) for b in raw]
            key, n = _merge([p[0] for p in parts], [p[1] for p in parts])
            twice = n > 1
            save_array(folder, f"anchors-{shard}", key[twice])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([int(n[twice].sum())], pa.int64())], ["shard", "n"])

    counted = docs.mapInArrow(count, "shard int, block binary").repartition(1 << bits, "shard").mapInArrow(merge, "shard int, n long")
    sizes = dict(counted.collect())  # a row per shard of about a million anchors
    for s in range(1 << bits):
        if s not in sizes:
            save_array(folder, f"anchors-{s}", np.empty(0, np.uint64))
    return bits, sum(sizes.values())


class KeptAnchors:
    """The stored anchors, mapped into memory; a missing file is an error."""

    def __init__(self, folder: str, bits: int) -> None:
        self.folder, self.bits = folder, bits
        self.arrays: dict[int, np.ndarray] = {}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes are kept."""
        kept = np.zeros(len(hashes), bool)
        order = np.argsort(hashes)
        hashes = hashes[order]
        shard = _shards(hashes, self.bits)
        at = runs(shard)
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            s = int(shard[lo])
            if s not in self.arrays:
                self.arrays[s] = map_array(self.folder, f"anchors-{s}")
            keys = self.arrays[s]
            if len(keys):
                place = np.minimum(np.searchsorted(keys, hashes[lo:hi]), len(keys) - 1)
                kept[order[lo:hi]] = keys[place] == hashes[lo:hi]
        return kept


# --- segments on their way to a block ---------------------------------------


def _ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + lens[i] - 1``, one after another."""
    begin = np.cumsum(lens) - lens
    return np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(begin - starts, lens)


def _first_of_equal(words: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """For each range of ``words`` the first range with the same words."""
    h = range_hashes(words, starts, starts + lens)
    by = np.lexsort((lens, h))
    new = np.r_[True, (h[by][1:] != h[by][:-1]) | (lens[by][1:] != lens[by][:-1])]
    lead = np.empty(len(h), np.int64)
    lead[by] = np.minimum.reduceat(by, np.flatnonzero(new))[np.cumsum(new) - 1]
    other = np.flatnonzero(lead != np.arange(len(h)))
    if len(other):  # the words themselves decide
        same = words[_ragged(starts[other], lens[other])] == words[_ragged(starts[lead[other]], lens[other])]
        wrong = other[~np.logical_and.reduceat(same, np.cumsum(lens[other]) - lens[other])]
        lead[wrong] = wrong
    return lead


def _pack(doc: np.ndarray, h: np.ndarray, first: np.ndarray, lens: np.ndarray, words: np.ndarray) -> bytes:
    """Segments of a block; their words as places in a sorted list of codes."""
    codes, place = np.unique(words, return_inverse=True)
    kind = np.uint16 if len(codes) < 1 << 16 else np.uint32
    head = np.array([len(doc), len(words), len(codes), np.dtype(kind).itemsize], np.int64)
    raw = b"".join(x.tobytes() for x in (head, doc, h, first, lens.astype(np.int64), codes, place.astype(kind)))
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n, n_words, n_codes, width = np.frombuffer(raw, np.int64, 4).tolist()
    doc, h, first, lens = (np.frombuffer(raw, np.int64, n, 32 + 8 * n * i) for i in range(4))
    codes = np.frombuffer(raw, np.uint64, n_codes, 32 + 32 * n)
    place = np.frombuffer(raw, np.uint16 if width == 2 else np.uint32, n_words, 32 + 32 * n + 8 * n_codes)
    return doc, h, first, lens, codes[place]


_PART = "key long, doc long, h long, start long, stop long, block binary"
_FIELDS = ["key", "doc", "h", "start", "stop", "block"]


def _span_rows(doc: np.ndarray, h: np.ndarray, a: np.ndarray, b: np.ndarray, most: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Word ranges as rows, spread by a key of their own; ranges that follow
    and touch each other in one row become one."""
    if not len(doc):
        return
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]) | (a[1:] < a[:-1]) | (a[1:] > b[:-1])])
    doc, h, a, b = doc[new], h[new], a[new], b[np.r_[new[1:], len(b)] - 1]
    for lo in range(0, len(doc), most):
        cut = slice(lo, lo + most)
        n = len(doc[cut])
        spread = (mix64(mix64(doc[cut].view(np.uint64) ^ h[cut].view(np.uint64)) + a[cut].astype(np.uint64)) >> np.uint64(1)).view(np.int64)
        columns = [spread, doc[cut], h[cut], a[cut], b[cut]]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.nulls(n, pa.binary())], _FIELDS)


def to_blocks(docs: DataFrame, folder: str, bits: int, blocks: int, window: int, gram: int) -> DataFrame:
    """Packed segments by block, and the ranges already known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = KeptAnchors(folder, bits)
        held: list[tuple[np.ndarray, ...]] = []
        n_held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            anchor, doc, h, first, lens, words = (np.concatenate(x) for x in zip(*held, strict=True))
            starts = np.cumsum(lens) - lens
            lead = _first_of_equal(words, starts, lens)
            several = np.zeros(len(lead), bool)
            again = lead != np.arange(len(lead))
            several[again] = several[lead[again]] = True
            yield from _span_rows(doc[several], h[several], first[several], first[several] + lens[several])
            one = np.flatnonzero(~again)
            key = (anchor[one] % np.uint64(blocks)).astype(np.int64)
            one = one[np.argsort(key, kind="stable")]
            key = np.sort(key, kind="stable")
            at = runs(key)
            packed = []
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                i = one[lo:hi]
                packed.append(_pack(doc[i], h[i], first[i], lens[i], words[_ragged(starts[i], lens[i])]))
            none = pa.nulls(len(packed), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(key[at[:-1]]), none, none, none, none, pa.array(packed, pa.binary())], _FIELDS)

        for batch in batches:
            ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1)]
            for codes, offsets, rows, base in word_pieces(batch, 2, window):
                piece, anchor, first, last = segments(codes, offsets, window, gram)
                i = np.flatnonzero(kept.find(anchor))
                if not len(i):
                    continue
                piece, first, lens = piece[i], first[i], last[i] - first[i] + window
                row = rows[piece]
                held.append((anchor[i], ids[0][row], ids[1][row], first - offsets[piece] + base[piece], lens, codes[_ragged(first, lens)]))
                n_held += len(i)
                if n_held >= BUFFER_SEGMENTS:
                    yield from sent()
                    held, n_held = [], 0
        if n_held:
            yield from sent()

    return docs.mapInArrow(run, _PART)


# --- parsing ----------------------------------------------------------------


def longest_matches(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each word of the ranges ``offsets[i]:offsets[i + 1]``, the length of
    the longest match, within its range, that starts at another word: by the
    sorted suffixes and their neighbours.  Exact up to 80 words."""
    n, size = len(words), len(offsets) - 1
    # A symbol of its own ends each range, so that no match crosses it.
    at = np.arange(n) + np.repeat(np.arange(size), np.diff(offsets))
    total = n + size
    _, ids = np.unique(words, return_inverse=True)
    text = np.zeros(total, np.int64)
    text[at] = ids
    ends = offsets[1:] + np.arange(size)
    text[ends] = int(ids.max(initial=-1)) + 1 + np.arange(size)
    ranks = [text]
    width, order = 1, None
    while width <= 27:
        r = ranks[-1]
        top = int(r.max()) + 2
        later = [np.r_[r[width * k :], np.full(min(width * k, total), -1, np.int64)][:total] + 1 for k in (1, 2)]
        if top ** 3 < 1 << 63:
            key = ((r + 1) * top + later[0]) * top + later[1]
        else:  # too many ranks for one number: two sorts
            pair = np.unique((r + 1) * top + later[0], return_inverse=True)[1].astype(np.int64)
            key = pair * top + later[1]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(total, np.int64)
        rank[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
        width *= 3
        ranks.append(rank)
    common = np.zeros(max(total - 1, 0), np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 2, -1, -1):
        r, step = ranks[level], 3**level
        for _ in range(2):
            same = (a < total) & (b < total)
            same[same] = r[a[same]] == r[b[same]]
            common += same * step
            a += same * step
            b += same * step
    best = np.zeros(total, np.int64)
    best[order[:-1]] = common
    best[order[1:]] = np.maximum(best[order[1:]], common)
    return best[at]


def repeated_windows(words: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """Which words start a window that occurs elsewhere in the block: greedy
    factors of each range, and the windows across their boundaries."""
    match = longest_matches(words, offsets)
    found = np.zeros(len(words) + 1, np.int64)  # steps of the number of covering factors
    checked = []
    place, end = offsets[:-1].copy(), offsets[1:]
    lane = np.flatnonzero(place < end)
    before = place.copy()  # where the factor before started
    while len(lane):
        p = place[lane]
        size = np.maximum(match[p], 1)
        long = size >= window
        np.add.at(found, p[long], 1)
        np.add.at(found, p[long] + size[long] - window + 1, -1)
        low = np.maximum(before[lane], p - window + 1)
        high = np.minimum(p - 1, p + size - window)
        some = high >= low
        if some.any():
            s = _ragged(low[some], high[some] - low[some] + 1)
            checked.append(s[match[s] >= window])
        before[lane] = p
        place[lane] = p + size
        lane = lane[place[lane] < end[lane]]
    out = np.cumsum(found[:-1]) > 0
    if checked:
        out[np.concatenate(checked)] = True
    return out


def repeated_ranges(rows: DataFrame, parts: int, window: int) -> DataFrame:
    """``(doc, h, start, stop)``: ranges of words that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[bytes]] = {}
        for batch in batches:
            known = batch.filter(batch.column(5).is_null())
            if known.num_rows:
                yield known.select(["doc", "h", "start", "stop"])
            rest = batch.filter(batch.column(5).is_valid())
            for key, block in zip(rest.column(0).to_pylist(), rest.column(5).to_pylist(), strict=True):
                got.setdefault(key, []).append(block)
        for blocks in got.values():
            doc, h, first, lens, words = (np.concatenate(x) for x in zip(*map(_unpack, blocks), strict=True))
            offsets = np.r_[0, np.cumsum(lens)]
            start = np.flatnonzero(repeated_windows(words, offsets, window))
            if not len(start):
                continue
            segment = np.searchsorted(offsets, start, side="right") - 1
            new = np.flatnonzero(np.r_[True, (start[1:] != start[:-1] + 1) | (segment[1:] != segment[:-1])])
            last = np.r_[new[1:], len(start)] - 1
            s = segment[new]
            a, b = start[new] - offsets[s] + first[s], start[last] - offsets[s] + first[s] + window
            for out in _span_rows(doc[s], h[s], a, b):
                yield out.select(["doc", "h", "start", "stop"])

    return rows.repartition(parts, "key").mapInArrow(run, "doc long, h long, start long, stop long")


# --- the operator -----------------------------------------------------------


def _kept_words(raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[int, int, bytes]:
    """``(words, removed words, kept words joined by one space)``; a long
    text is split a slice at a time."""
    out, seen, removed, i = [], 0, 0, 0
    data = np.frombuffer(raw, np.uint8)
    for lo, hi in _cuts(data, SLICE_BYTES):
        words = raw[lo:hi].split()  # bytes split at ASCII white space
        end, at = seen + len(words), seen
        while i < len(starts) and starts[i] < end:
            if starts[i] > at:
                out.extend(words[at - seen : starts[i] - seen])
            stop = min(int(stops[i]), end)
            removed += stop - max(at, int(starts[i]))
            at = stop
            if stops[i] > end:
                break
            i += 1
        out.extend(words[at - seen :])
        if len(out) > 1 << 16:
            out = [b" ".join(out)]
        seen = end
    return seen, removed, b" ".join(out)


def deduplicate(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept)`` per row: the maximal
    removed ranges of words (end exclusive), and the words that are left,
    joined by one space.

    Words are runs without ASCII white space, unchanged.  Every copy of a
    repeated window goes, the first one too.  Null texts have no words; a text
    of fewer than ``window`` words loses none.  Rows that are equal
    altogether, or share a doc_id, null included, are documents to each other.
    Words are told apart by 64-bit hashes.  Empty input gives no rows.
    """
    gram = min(GRAM, window)
    if not 2 <= window <= 80:  # to where matches are measured
        raise ValueError("the window must have 2 to 80 words")
    spark = docs.sparkSession
    folder = shared_folder(spark, "relative-lz")
    lowest = -(1 << 63)
    base = texts(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(lowest)).alias("doc"), F.xxhash64("text").alias("h"), "text", F.col("doc_id").isNull().alias("no_id"))
    scan = base.select("doc", "h", "text")
    bits, occurrences = count_anchors(scan, folder, window, gram)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-occurrences // PART_SEGMENTS))
    ranges = repeated_ranges(to_blocks(scan, folder, bits, parts * BLOCKS, window, gram), parts, window)
    # A set: rows that are equal altogether have the same ranges.
    by_doc = ranges.groupBy("doc", "h").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    joined = base.join(by_doc, ["doc", "h"], "left").select("doc", "no_id", "text", "ranges.start", "ranges.stop")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        none = np.empty(0, np.int64)
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            raws, starts, stops = batch.column(2).cast(pa.binary()), batch.column(3), batch.column(4)
            for i in range(batch.num_rows):
                a, b = (starts[i].values.to_numpy(), stops[i].values.to_numpy()) if starts[i].is_valid else (none, none)
                if len(a):
                    order = np.argsort(a, kind="stable")
                    a, b = a[order], np.maximum.accumulate(b[order])
                    new = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
                    a, b = a[new], b[np.r_[new[1:], len(a)] - 1]
                n, gone, left = _kept_words(raws[i].as_py(), a, b)
                sizes.append(n)
                removed.append(gone)
                spans.append([{"start": int(x), "stop": int(y)} for x, y in zip(a, b, strict=True)])
                kept.append(left)
            ids = pa.array([None if n else d for d, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept string")
