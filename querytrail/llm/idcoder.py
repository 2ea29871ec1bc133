"""Adaptive context-mixing range coder for token ids.

Every block of ids starts from a fresh state and can be decoded alone, with
the table of its group of blocks.  An id is coded as one of eight symbols: it
equals the id last seen after the same two ids (order 2), after the same id
(order 1), or neither; then the symbol is its class.  The classes are runs of
ids by falling count in the group, of about equal mass; the id's place within
its class follows with the order-0 prediction that the group's :class:`Table`
holds.  Symbol and place narrow the coder's range in one step, and no bit is
stored plain.

The symbol's distribution mixes three adaptive cumulative tables: one without
context (order 0), one per hash of the last id (order 1) and one per hash of
the last two (order 2).  The mixing weights move towards the table that
predicted best.  All arithmetic is on integers, so decoding repeats it
exactly.

The blocks of a group run in step, one numpy lane each.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

#: Ids in a block, and blocks that run in step (bound of memory).
BLOCK_IDS = 4096
LANES = 2048
MAGIC = b"IDMIX3\n\0"

_SYMBOLS = 8
_TOTAL = 1 << 15
_CTX1, _CTX2 = 32, 64
_SLOT1, _SLOT2 = 256, 512
_RATE0, _RATE = 6, 5
_W_LOW, _W_HIGH = 1024, 31744
#: Steps whose contexts the encoder hashes at once.
_AHEAD = 64
#: A step divides the range by the symbol's and the place's totals, 2**31.
_16, _31, _32 = np.uint64(16), np.uint64(31), np.uint64(32)
_SETTLED, _TIGHT = np.uint64(1 << 32), np.uint64(1 << 31)
_BELOW = np.uint64((1 << 31) - 1)
_LAST, _FRACTION = np.uint64((1 << 31) - 1), np.uint64((1 << 16) - 1)
_IDS = _GUESSED = 1 << 16

#: Where each table moves when a symbol occurred; every symbol keeps a share
#: of at least 16 of 32768 in the tables, 15 in any mixture of them.
_TARGET = np.array([[i * 16 if i <= s else _TOTAL - (_SYMBOLS - i) * 16 for i in range(_SYMBOLS)] for s in range(_SYMBOLS)], np.int16).view("V16").reshape(-1)
_UNIFORM = np.arange(_SYMBOLS, dtype=np.int16) * np.int16(_TOTAL // _SYMBOLS)
_ROW = np.dtype("V16")  # a table row of eight 16-bit numbers, moved whole


_FACTOR, _BEFORE, _SHIFT = np.array([[40503], [25717]], np.uint32), np.uint32(31337), np.array([[7], [9]], np.uint32)
_SLOT_MASK, _ROW_MASK = np.array([[_SLOT1 - 1], [_SLOT2 - 1]], np.uint32), np.array([[_CTX1 - 1], [_CTX2 - 1]])


class Table:
    """Class and order-0 prediction of each id of a group of blocks: the place
    of an id in its class starts at ``start`` and is ``width`` wide, of 65536.
    An id that a context predicted stands at :data:`_GUESSED`, and has all.
    """

    def __init__(self, ids: np.ndarray, kind: np.ndarray, width: np.ndarray) -> None:
        self.ids, self.widths = ids, width
        self.kind = np.full(_IDS, 2, np.uint8)
        self.start, self.width = np.zeros(_IDS + 1, np.uint64), np.full(_IDS + 1, _IDS, np.uint64)
        self.found = np.zeros(_SYMBOLS * _IDS, np.int32)
        self.found[: 2 * _IDS] = _GUESSED
        self.kind[ids] = kind
        for k in range(2, _SYMBOLS):
            of = np.flatnonzero(kind == k)
            ends = np.cumsum(width[of])
            if len(of) and ends[-1] != _IDS:
                raise ValueError("a damaged table of ids")
            self.start[ids[of]] = ends - width[of]
            self.width[ids[of]] = width[of]
            self.found[k * _IDS : (k + 1) * _IDS] = np.repeat(ids[of], width[of]) if len(of) else 0

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids, minlength=1)
        present = np.flatnonzero(counts)
        present = present[np.argsort(-counts[present], kind="stable")]
        counts = counts[present]
        before = np.cumsum(counts) - counts
        kind = (2 + before * (_SYMBOLS - 2) // max(1, len(ids))).astype(np.uint8)
        width = np.ones(len(present), np.int64)
        for k in range(2, _SYMBOLS):
            of = np.flatnonzero(kind == k)
            if len(of):
                width[of] += counts[of] * (_IDS - len(of)) // counts[of].sum()
                width[of[0]] += _IDS - width[of].sum()
        order = np.argsort(present)
        return cls(present[order], kind[order], width[order])

    def to_bytes(self) -> bytes:
        """The number of ids, the ids, their classes and their widths less one;
        packed, behind the packed size and crc32 as ``<II``."""
        raw = b"".join([struct.pack("<I", len(self.ids)), self.ids.astype("<u2").tobytes(), self.kind[self.ids].tobytes(), (self.widths - 1).astype("<u2").tobytes()])
        packed = zlib.compress(raw)
        return struct.pack("<II", len(packed), zlib.crc32(raw)) + packed

    @classmethod
    def read(cls, f) -> Table:
        size, check = struct.unpack("<II", f.read(8))
        try:
            raw = zlib.decompress(f.read(size))
        except zlib.error as e:
            raise ValueError("a damaged table of ids") from e
        if zlib.crc32(raw) != check:
            raise ValueError("a table of ids fails its checksum")
        (n,) = struct.unpack_from("<I", raw)
        ids, kind = np.frombuffer(raw, "<u2", n, 4), np.frombuffer(raw, "u1", n, 4 + 2 * n)
        return cls(ids.astype(np.int64), kind, np.frombuffer(raw, "<u2", n, 4 + 3 * n).astype(np.int64) + 1)


class _Model:
    """The adaptive state of ``n`` lanes.  A step is :meth:`predict`, then
    :meth:`span` (for a decoder :meth:`find` and :meth:`found_span`) and
    :meth:`update`; the first ``a`` lanes are still running.
    Rows start with 0, so the entry after a lane's last one is 0 as well.

    A mixture weighs each order's table; every 8th step the weights move
    towards the share that each order had in giving the symbol.
    """

    def __init__(self, n: int) -> None:
        lane = np.arange(n)
        self.slot_base = np.stack([lane * (_SLOT1 + _SLOT2), lane * (_SLOT1 + _SLOT2) + _SLOT1])
        self.row_base = np.stack([lane * (_CTX1 + _CTX2), lane * (_CTX1 + _CTX2) + _CTX1])
        self.slots = np.zeros(n * (_SLOT1 + _SLOT2), np.uint16)
        self.rows = np.tile(_UNIFORM, n * (_CTX1 + _CTX2)).view(_ROW)
        self.w = np.full((3, n), 16384, np.int32)
        self.w[2] = 32768
        self.t = np.tile(_UNIFORM, n).reshape(1, -1)
        self._resize(n)

    def _resize(self, a: int) -> None:
        """Work space for ``a`` lanes; the order-0 tables stay in theirs."""
        k = a * _SYMBOLS
        self.a, self.flat = a, np.zeros(3 * k + 1, np.int16)
        t = self.flat[:-1].reshape(3, k)
        t[0] = self.t[0, :k]
        self.t, self.near = t, t[1:].view(_ROW)
        self.move, self.part = np.empty((3, k), np.int16), np.empty((3, k), np.int32)
        self.mixed = np.zeros(k + 1, np.int32)
        self.entry = np.arange(2)[:, None, None] + np.arange(3)[None, :, None] * k + np.arange(a) * _SYMBOLS
        self.wide = None

    def contexts(self, last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the hashes of the last id and of the last two point, along a
        new axis before the lanes: to the slots of the ids seen after them, and
        to the rows of the tables."""
        hashed = last[..., None, :] * _FACTOR
        hashed[..., 1, :] += before * _BEFORE
        hashed >>= _SHIFT
        hashed &= _SLOT_MASK
        slots, a = hashed.astype(np.int64), last.shape[-1]
        rows = slots & _ROW_MASK
        slots += self.slot_base[:, :a]
        rows += self.row_base[:, :a]
        return slots, rows

    def predict(self, slots: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The ids that order 1 and order 2 expect, from :meth:`contexts`."""
        if slots.shape[-1] != self.a:
            self._resize(slots.shape[-1])
        self.slot_at, self.row_at = slots, rows
        self.rows.take(rows, out=self.near, mode="clip")
        return self.slots.take(slots)

    def find(self, value: np.ndarray) -> np.ndarray:
        """The symbol of each lane whose span, in 65536ths, holds ``value``."""
        if self.wide is None:
            self.wide = np.repeat(self.w[:, : self.a], _SYMBOLS, axis=1)
        part, mixed = self.part, self.mixed[:-1]
        part[:] = self.t
        part *= self.wide
        np.add(part[0], part[1], out=mixed)
        mixed += part[2]
        below = mixed <= np.repeat((value | _FRACTION).astype(np.int32), _SYMBOLS)
        return np.bitwise_count(below.view(np.uint64)).astype(np.int64) - 1

    @staticmethod
    def _widths(start: np.ndarray, end: np.ndarray) -> None:
        """Ends to widths; an end of 0 is the total."""
        end -= 1
        end &= _TOTAL - 1
        end -= start
        end += 1

    def span(self, symbol: np.ndarray) -> np.ndarray:
        """Start and width of each lane's symbol in the mixture."""
        parts = self.flat.take(self.entry + symbol) * self.w[:, : self.a]
        both = parts[:, 0] + parts[:, 1]
        both += parts[:, 2]
        both >>= 16
        self._widths(*both)
        return both.astype(np.uint64)

    def found_span(self, symbol: np.ndarray) -> np.ndarray:
        """The same, after :meth:`find`."""
        both = self.mixed.take(self.entry[:, 0] + symbol) >> 16
        self._widths(*both)
        return both.astype(np.uint64)

    def _weigh(self, symbol: np.ndarray) -> None:
        w = self.w[:, : self.a]
        start, end = self.flat.take(self.entry + symbol).astype(np.int64)
        self._widths(start, end)
        end *= w
        total = end[0] + end[1]
        total += end[2]
        part = end[:2]
        part <<= 16
        part //= total
        part -= w[:2]
        part >>= 4
        part += w[:2]
        np.maximum(part, _W_LOW, out=part)
        np.minimum(part, _W_HIGH, out=part)
        w[:2] = part
        w[2] = 65536 - w[0] - w[1]
        self.wide = None

    def update(self, symbol: np.ndarray, ids: np.ndarray, step: int) -> None:
        if step & 7 == 0:
            self._weigh(symbol)
        t, move = self.t, self.move
        np.subtract(_TARGET.take(symbol).view(np.int16), t, out=move)
        move[0] >>= _RATE0
        move[1:] >>= _RATE
        t += move
        self.rows[self.row_at] = self.near
        ids = ids.astype(np.uint16)
        self.slots[self.slot_at[0]] = ids
        self.slots[self.slot_at[1]] = ids


def _shift_out(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The lanes whose top 32 bits leave the coder now.  A step narrows a range
    by at most 2**31, and a range is above that after it: one that is short
    but straddles a boundary is cut at it."""
    top = low + size
    top ^= low
    settled, tight = top < _SETTLED, size < _TIGHT
    tail = tight > settled
    if tail.any():
        size[tail] = (~low[tail] + np.uint64(1)) & _BELOW
    settled |= tight
    return settled.nonzero()[0]


def _narrow(start: np.ndarray, width: np.ndarray, table: Table, at: np.ndarray, r: np.ndarray) -> None:
    """From a symbol's span to how far the step moves a range of unit ``r``,
    and its new size; ``at``: the id, or :data:`_GUESSED`."""
    place = table.start.take(at)
    place *= width
    start <<= _16
    start += place
    start *= r
    width *= table.width.take(at)
    width *= r


def _active(lens: np.ndarray, steps: int) -> list[int]:
    """For each step the number of blocks that have more ids."""
    return np.searchsorted(-lens, -np.arange(steps), side="left").tolist()


def encode_blocks(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """The payload of each block of ids below 65536 (longest block first), all
    of them in ``table``: the coder's words as ``<u4``."""
    n = len(blocks)
    lens = np.array([len(b) for b in blocks])
    steps = int(lens[0]) if n else 0
    if not steps:
        return [b""] * n
    whole = np.zeros((n, steps), np.uint16)
    for i, b in enumerate(blocks):
        whole[i, : len(b)] = b
    ids = np.ascontiguousarray(whole.T)
    del whole
    model = _Model(n)
    low, size = np.zeros(n, np.uint64), np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64)
    room = steps + 2
    out, pos = np.zeros(n * room, np.uint32), np.arange(n) * room
    past = np.zeros((_AHEAD + 2, n), np.uint32)  # the ids before a run of steps, and those of it
    for t, a in enumerate(_active(lens, steps)):
        if t % _AHEAD == 0:
            past[:2] = past[-2:]
            past[2 : 2 + min(_AHEAD, steps - t)] = ids[t : t + _AHEAD]
            slots, rows = model.contexts(past[1:-1], past[:-2])
            kinds = table.kind.take(past[2:]).astype(np.int64)
        here, symbol = ids[t, :a], kinds[t % _AHEAD, :a]
        hit = model.predict(slots[t % _AHEAD, :, :a], rows[t % _AHEAD, :, :a]) == here
        np.copyto(symbol, 1, where=hit[0])
        np.copyto(symbol, 0, where=hit[1])
        at = here.astype(np.int64)
        np.copyto(at, _GUESSED, where=symbol < 2)
        lo, r = low[:a], size[:a] >> _31
        start, width = model.span(symbol)
        _narrow(start, width, table, at, r)
        lo += start
        size[:a] = width
        m = _shift_out(lo, size[:a])
        v, at = lo[m], pos[m]
        out[at] = v >> _32
        pos[m] = at + 1
        lo[m] = v << _32
        size[m] <<= _32
        model.update(symbol, here, t)
    for _ in range(2):
        out[pos] = low >> _32
        pos += 1
        low <<= _32
    return [out[i * room : pos[i]].astype("<u4").tobytes() for i in range(n)]


def decode_blocks(payloads: list[bytes], lens: np.ndarray, table: Table) -> list[np.ndarray]:
    """The ids of each block (longest block first)."""
    n = len(payloads)
    steps = int(lens[0]) if n else 0
    if not steps:
        return [np.empty(0, np.uint32)] * n
    sizes = np.array([len(p) // 4 + 2 for p in payloads])
    pos = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()) + 2, np.uint32)
    for p, i in zip(payloads, pos.tolist(), strict=True):
        words = np.frombuffer(p, "<u4", len(p) // 4)
        data[i : i + len(words)] = words
    top = len(data) - 1
    code = np.zeros(n, np.uint64)
    for _ in range(2):
        code = (code << _32) | data[pos]
        pos += 1
    model = _Model(n)
    low, size = np.zeros(n, np.uint64), np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64)
    ids = np.zeros((steps, n), np.uint16)
    last, before = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    for t, a in enumerate(_active(lens, steps)):
        guess1, guess2 = model.predict(*model.contexts(last[:a], before[:a]))
        lo, r = low[:a], size[:a] >> _31
        value = np.minimum((code[:a] - lo) // r, _LAST)
        symbol = model.find(value)
        start, width = model.found_span(symbol)
        value -= start << _16
        value //= width
        value &= _FRACTION
        here = table.found.take((symbol << 16) + value.view(np.int64))
        _narrow(start, width, table, here, r)
        lo += start
        size[:a] = width
        np.copyto(here, guess1, where=symbol == 1)
        np.copyto(here, guess2, where=symbol == 0)
        m = _shift_out(lo, size[:a])
        at = pos[m]
        code[m] = (code[m] << _32) | data[np.minimum(at, top)]
        pos[m] = at + 1
        lo[m] <<= _32
        size[m] <<= _32
        model.update(symbol, here, t)
        before[:a] = last[:a]
        last[:a] = here
        ids[t, :a] = here
    whole = np.ascontiguousarray(ids.T)
    return [whole[i, : lens[i]].astype(np.uint32) for i in range(n)]


class IdFileWriter:
    """A file of documents' ids.

    ``MAGIC``; per group of :data:`LANES` blocks its :class:`Table`; per block
    ``n_ids, payload bytes, crc32`` (of the ids as little-endian unsigned
    32-bit integers) as ``<III`` and the payload; the index:
    doc_id ``<i8`` each, null flags ``u1`` each, lengths ``<i8`` each; and at
    the end ``index offset, documents, blocks`` as ``<QQQ``, the index's crc32
    as ``<I`` and ``MAGIC`` again.
    """

    def __init__(self, out) -> None:
        self.out, self.at, self.blocks = out, 0, 0
        self.doc_ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self._put(MAGIC)

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents in their order, ``ids`` concatenated."""
        if len(ids) and int(ids.max()) >= 1 << 16:
            raise ValueError("ids of 16 bits only")
        self.doc_ids.append(doc_ids.astype("<i8"))
        self.nulls.append(nulls.astype("u1"))
        self.lengths.append(lengths.astype("<i8"))
        self.held.append(ids.astype(np.uint16))
        self.n_held += len(ids)
        if self.n_held >= LANES * BLOCK_IDS:
            self._flush(False)

    def _flush(self, all_: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, np.uint16)
        step = LANES * BLOCK_IDS
        end = len(ids) if all_ else len(ids) // step * step
        for lo in range(0, end, step):
            part = ids[lo : min(lo + step, end)]
            blocks = [part[i : i + BLOCK_IDS] for i in range(0, len(part), BLOCK_IDS)]
            table = Table.of(part)
            self._put(table.to_bytes())
            for block, payload in zip(blocks, encode_blocks(blocks, table), strict=True):
                self._put(struct.pack("<III", len(block), len(payload), zlib.crc32(block.astype("<u4").tobytes())))
                self._put(payload)
                self.blocks += 1
        self.held = [ids[end:]]
        self.n_held = len(ids) - end

    def close(self) -> tuple[int, int]:
        """Write the rest; the numbers of documents and ids."""
        self._flush(True)
        index = b"".join(x.tobytes() for part in (self.doc_ids, self.nulls, self.lengths) for x in part)
        offset, docs = self.at, sum(map(len, self.doc_ids))
        self._put(index)
        self._put(struct.pack("<QQQI", offset, docs, self.blocks, zlib.crc32(index)) + MAGIC)
        return docs, int(sum(int(x.sum()) for x in self.lengths))


def read_id_file(f) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of a file, a bounded number of blocks at a time: doc_ids, null
    flags, lengths and concatenated ids.  A wrong checksum is an error."""
    tail = struct.calcsize("<QQQI") + len(MAGIC)
    f.seek(-tail, 2)
    offset, docs, blocks, crc = struct.unpack("<QQQI", f.read(tail)[: -len(MAGIC)])
    f.seek(offset)
    index = f.read(docs * 17)
    f.seek(0)
    if f.read(len(MAGIC)) != MAGIC or zlib.crc32(index) != crc:
        raise ValueError("not an id file, or a damaged index")
    doc_ids, nulls, lengths = np.frombuffer(index, "<i8", docs), np.frombuffer(index, "u1", docs, docs * 8), np.frombuffer(index, "<i8", docs, docs * 9)
    ends = np.cumsum(lengths)
    have, base, doc = np.empty(0, np.uint32), 0, 0
    for lo in range(0, blocks, LANES):
        table, heads, payloads = Table.read(f), [], []
        for _ in range(min(LANES, blocks - lo)):
            n, size, check = struct.unpack("<III", f.read(12))
            heads.append((n, check))
            payloads.append(f.read(size))
        parts = decode_blocks(payloads, np.array([n for n, _ in heads]), table)
        for part, (_, check) in zip(parts, heads, strict=True):
            if zlib.crc32(part.astype("<u4").tobytes()) != check:
                raise ValueError("a block fails its checksum")
        have = np.concatenate([have, *parts])
        upto = int(np.searchsorted(ends, base + len(have), side="right"))
        if upto > doc:
            used = int(ends[upto - 1]) - base
            yield doc_ids[doc:upto], nulls[doc:upto], lengths[doc:upto], have[:used]
            have, base, doc = have[used:], base + used, upto
    if doc < docs or len(have):
        raise ValueError("blocks and index disagree")
