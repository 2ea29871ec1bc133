"""Sequence packing: best fit decreasing, then a swap-based local search.

Groups of a bounded number of pieces are packed apart from each other.  In a
group the search takes the emptiest bin as a donor and moves documents to
other underfull bins, exchanges one for one, or two for one, so that the sum
of squared fills grows until the donor is empty.  A group settles its full
bins; the emptiest one and further ones, a bounded share, go on to the next
round, where fewer groups pack them together, until one group is left.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.llm.common import byte_columns, texts, written
from querytrail.llm.tokens import encoder

SEQUENCE_TOKENS = 4096
#: Pieces in a group (bound of a task's memory), and which part of them may
#: go on to the next round, besides those of the emptiest bin.
GROUP_PIECES = 16_384
PASS_ON = 8
#: Donors in a row that may fail to empty before the search ends.
PATIENCE = 48

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, most: int = SEQUENCE_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of whole texts, see :data:`PIECES`: one per document, or
    for documents of over ``most`` ids consecutive pieces of ``most``.  A null
    or empty text is one piece with the end id alone.  Each row of ``docs``
    counts, repeated or not; a null doc_id stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            data, offsets = byte_columns(batch)
            for lo, hi, ids, at in enc.batches(data, offsets):
                lens = np.diff(at)
                n = -(-lens // most)
                row = np.repeat(np.arange(hi - lo), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * most
                length = np.minimum(most, lens[row] - start)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                first = (at[row] + start) * 4
                crc = [zlib.crc32(raw[a : a + b]) for a, b in zip(first.tolist(), (length * 4).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return texts(docs, id_col, text_col).mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, cap: int) -> list[list[int]]:
    """Best fit decreasing: bins as lists of item numbers."""
    bins: list[list[int]] = []
    open_by_room: list[list[int]] = [[] for _ in range(cap + 1)]
    rooms = 0  # bit r: some bin has r tokens of room
    sizes = lengths.tolist()
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[item]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            where = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
        else:
            where, room = len(bins), cap
            bins.append([])
        bins[where].append(item)
        if room > size:
            open_by_room[room - size].append(where)
            rooms |= 1 << (room - size)
    return bins


def _exchange(donor: list[tuple[int, int]], taker: list[tuple[int, int]], room: int) -> tuple[int, list[int], int]:
    """The exchange that fills ``room`` of the taker best: ``(gain, donor
    places, taker place or -1)``.  Both lists are sorted ``(length, item)``."""
    sizes = [s for s, _ in donor]
    best: tuple[int, list[int], int] = (0, [], -1)
    at = bisect_right(sizes, room) - 1
    if at >= 0:  # move one
        best = (sizes[at], [at], -1)
    for j, (back, _) in enumerate(taker):
        if best[0] == room:
            break
        if j and taker[j - 1][0] == back:
            continue
        at = bisect_right(sizes, room + back) - 1  # one for one
        if at >= 0 and sizes[at] - back > best[0]:
            best = (sizes[at] - back, [at], j)
        lo, hi = 0, len(sizes) - 1  # two for one
        while lo < hi:
            gain = sizes[lo] + sizes[hi] - back
            if gain > room:
                hi -= 1
            else:
                if gain > best[0]:
                    best = (gain, [lo, hi], j)
                lo += 1
    return best


def improve(bins: list[list[int]], lengths: np.ndarray, cap: int, patience: int = PATIENCE) -> list[list[int]]:
    """Local search: empty bins, the emptiest first, by exchanges that raise
    the sum of squared fills; stops at the lower bound of bins."""
    sizes = lengths.tolist()
    full = [b for b in bins if sum(sizes[i] for i in b) == cap]
    under = sorted(([sum(sizes[i] for i in b), sorted((sizes[i], i) for i in b)] for b in bins if sum(sizes[i] for i in b) < cap), key=lambda b: b[0])
    least = -(-sum(sizes) // cap)
    failed = 0
    while len(full) + len(under) > least and failed < patience and failed < len(under):
        donor = under.pop(failed)
        for taker in reversed(under):
            while taker[0] < cap and donor[1]:
                gain, out, back = _exchange(donor[1], taker[1], cap - taker[0])
                if gain <= 0 or taker[0] + gain <= donor[0]:
                    break  # the sum of squares would not grow
                moved = [donor[1][i] for i in out]
                for i in reversed(out):
                    del donor[1][i]
                if back >= 0:
                    donor[1].append(taker[1].pop(back))
                    donor[1].sort()
                taker[1].extend(moved)
                taker[1].sort()
                taker[0] += gain
                donor[0] -= gain
            if not donor[1]:
                break
        if donor[1]:
            under.append(donor)
            failed += 1
        else:
            failed = 0
        full += [[i for _, i in b[1]] for b in under if b[0] == cap]
        under = sorted((b for b in under if b[0] < cap), key=lambda b: b[0])
    return full + [[i for _, i in b[1]] for b in under]


_PACKED = PIECES + ", sequence_id long, offset long, settled boolean"


def _pack_round(rows: DataFrame, groups: int, level: int, cap: int, last: bool, group_pieces: int) -> DataFrame:
    """One round over ``rows`` (with a stable ``rid``): each group packed."""

    def run(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        bins = improve(best_fit(lengths, cap), lengths, cap)
        fills = np.array([lengths[b].sum() for b in bins])
        sequence, offset, settled = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64), np.ones(len(pdf), bool)
        going, emptiest = 0, True
        for at in np.argsort(fills, kind="stable").tolist():
            b = np.array(bins[at])
            sequence[b] = (level << 56) + (int(key[0]) << 24) + at
            offset[b] = np.cumsum(lengths[b]) - lengths[b]
            if last or fills[at] == cap:
                continue
            # A bin has at most cap - 1 pieces, so the emptiest one can always go on.
            if emptiest or going + len(b) <= group_pieces // PASS_ON:
                settled[b] = False
                going += 0 if emptiest else len(b)
            emptiest = False
        return pdf.drop(columns=["grp"]).assign(sequence_id=sequence, offset=offset, settled=settled)

    grouped = rows.withColumn("grp", F.pmod(F.xxhash64("rid", F.lit(level)), F.lit(groups)))
    return grouped.groupBy("grp").applyInPandas(run, "rid long, " + _PACKED)


def pack(rows: DataFrame, cap: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``rows`` (:data:`PIECES`, lengths from 1 to ``cap``) with the sequence
    and the place in it of every piece.

    Pieces of ``cap`` tokens are sequences of their own and take no part in
    the search.  Empty input gives no rows; a length outside the range is an
    error.  sequence_id holds the round, the group and the bin.
    """
    checked = rows.withColumn("length", F.when(F.col("length").between(1, cap), F.col("length")).otherwise(F.raise_error(F.lit("piece length out of range")).cast("long")))
    todo = written(checked.withColumn("rid", F.monotonically_increasing_id()), "pack-pieces")
    out = [
        todo.where(F.col("length") == cap).select("doc_id", "piece", "start", "length", "ids_crc32", (F.lit(127 << 56) + F.col("rid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    ]
    todo = todo.where(F.col("length") < cap)
    level, groups = 0, 0
    while True:
        n = todo.count()
        # Fewer each round, even if all pieces of a small group went on.
        groups = max(1, min(-(-n // group_pieces), groups // 2 if level else n))
        last = groups == 1
        packed = written(_pack_round(todo, groups, level, cap, last, group_pieces), f"pack-round{level}")
        out.append(packed.where("settled").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
        if last:
            break
        todo = packed.where("NOT settled").drop("sequence_id", "offset", "settled")
        level += 1
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


def pack_documents(docs: DataFrame, tokenizer: str, cap: int = SEQUENCE_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack whole documents; one row per piece."""
    return pack(pieces(docs, tokenizer, cap, id_col, text_col), cap)
