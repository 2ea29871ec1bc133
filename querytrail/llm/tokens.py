"""Token ids of whole texts through the tokenizers library, in batches.

The word-level BPE file lower-cases, drops white space and splits texts into
letter runs, single digits, runs of other characters and English
contractions before it merges.  Texts within Latin-1 are split here with
byte tables, and each distinct piece of a task goes through the library's
model once; all other texts, and those with a special token's marks, go
through the library whole.  So does every text of a file whose own rules
(:data:`RULES`) are others.  ``tests/llm`` compares both ways.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from querytrail.llm.common import LOWER, chunks, word_hashes

END_ID = 1
#: Distinct pieces that a worker remembers before it starts anew, and the
#: least size of the table that finds them.  For a text of more distinct
#: pieces than half its slots the table grows.
MEMORY = 1 << 20
TABLE_BITS = 22

# The normaliser and splitter, in the file's own words, that the
# byte tables below follow, and how its special tokens begin.
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
MARK = "<|"

SPACE_, LETTER, NUMBER, OTHER = range(4)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = SPACE_
_CLASS[[*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = NUMBER
_CLASS[[*range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = LETTER
_LOWER1 = LOWER.copy()  # Latin-1 lower case
_LOWER1[[*range(0xC0, 0xD7), *range(0xD8, 0xDF)]] += 32


def _byte_letters() -> dict[int, str]:
    """The printable letter that the byte-level step gives each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def latin1(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 rows within Latin-1 as one byte per character."""
    lead = data >= 0xC0
    if not lead.any():
        return data, offsets
    out = data.copy()
    at = np.flatnonzero(lead)
    out[at + 1] += (data[at] == 0xC3).astype(np.uint8) * np.uint8(64)
    kept = np.r_[0, np.cumsum(~lead)]
    return out[~lead], kept[offsets]


class Encoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        file = json.loads(self.tokenizer.to_str())
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split_here = {key: file[key] for key in RULES} == RULES and all(t.startswith(MARK) for t in added)
        self.forget()

    def forget(self, room: int = 0) -> None:
        """Start anew, with a table for at least ``room`` pieces."""
        self.known = 0
        bits = max(TABLE_BITS, (2 * room).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)  # 0: free
        self.values = np.zeros(1 << bits, np.int32)
        self.flat = np.empty(1 << 16, np.uint32)
        self.begin = np.zeros((1 << 16) + 1, np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 where it is new."""
        at = (hashes >> self.shift).astype(np.int64)
        keys = self.keys.take(at)
        slots = np.where(keys == hashes, self.values.take(at), -1)
        open_ = np.flatnonzero((keys != hashes) & (keys != 0))
        while len(open_):  # the next place, while another hash is there
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            keys = self.keys[at[open_]]
            hit = keys == hashes[open_]
            slots[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (keys != 0)]
        return slots

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Add the ids of new distinct pieces (Latin-1 bytes) to the memory."""
        tokenize, n = self.tokenizer.model.tokenize, self.known
        spelled = [w.decode() if w.isalpha() and w.isascii() else w.decode("latin1").encode().decode("latin1").translate(self.letters) for w in words]
        ids = [[t.id for t in tokenize(w)] for w in spelled]
        while n + len(ids) >= len(self.begin):
            self.begin = np.r_[self.begin, np.zeros(len(self.begin), np.int64)]
        self.begin[n + 1 : n + len(ids) + 1] = self.begin[n] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        new = np.fromiter(chain.from_iterable(ids), np.uint32)
        while self.begin[n] + len(new) > len(self.flat):
            self.flat = np.r_[self.flat, np.empty(len(self.flat), np.uint32)]
        self.flat[self.begin[n] : self.begin[n] + len(new)] = new
        slots = np.arange(n, n + len(ids), dtype=np.int32)
        at = (hashes >> self.shift).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]] = hashes[put]
            self.values[at[put]] = slots[put]
            left = left[self.keys[at[left]] != hashes[left]]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
        self.known += len(ids)

    def _fast(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of rows within Latin-1 and free of marks."""
        data, offsets = latin1(data, offsets)
        data = _LOWER1[data]
        kind = _CLASS[data]
        start = np.ones(len(data), bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        start[edge] = True
        quote = np.flatnonzero((data == 0x27) & start)
        if len(quote):
            row_end = offsets[np.searchsorted(offsets, quote, side="right")]
            padded = np.r_[data, np.zeros(3, np.uint8)]
            one, two = padded[quote + 1], padded[quote + 2]
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (quote + 1 < row_end)
            long = (((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)) & (quote + 2 < row_end)
            for at, length in ((quote[short], 2), (quote[long & ~short], 3)):
                start[at + 1] = False
                after = at + length
                after = after[after < len(data)]
                start[after] = True
        starts = np.flatnonzero(start)
        ends = np.r_[starts[1:], len(data)]
        piece = kind[starts] != SPACE_
        starts, ends = starts[piece], ends[piece]
        per_row = np.diff(np.searchsorted(starts, offsets))
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        gathered, begin = _gather(data, starts, ends)
        hashes = np.maximum(_piece_hashes(gathered, begin), np.uint64(1))
        slots = self._find(hashes)
        new = np.flatnonzero(slots < 0)
        if len(new):
            distinct, first = np.unique(hashes[new], return_index=True)
            if self.known + len(distinct) > min(MEMORY, len(self.keys) // 2):
                new = np.arange(len(hashes))
                distinct, first = np.unique(hashes, return_index=True)
                self.forget(len(distinct))
            raw, first = data.tobytes(), new[first]
            self._learn(distinct, [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            slots[new] = self._find(hashes[new])
        lo, hi = self.begin[slots], self.begin[slots + 1]
        ids, begin = _gather(self.flat, lo, hi)
        counts = np.diff(np.r_[0, np.cumsum(hi - lo)][np.r_[0, np.cumsum(per_row)]])
        return ids, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of UTF-8 rows, each with :data:`END_ID` after it."""
        n = len(offsets) - 1
        slow = np.full(n, not self.split_here)
        odd = np.flatnonzero(data >= 0xC4)
        if len(odd):
            slow[np.unique(np.searchsorted(offsets, odd, side="right") - 1)] = True
        mark = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if len(data) > 1 else odd[:0]
        if len(mark):
            slow[np.unique(np.searchsorted(offsets, mark, side="right") - 1)] = True
        parts: list[np.ndarray] = [np.empty(0, np.uint32)] * n if slow.any() else []
        if not slow.any():
            ids, counts = self._fast(data, offsets)
        else:
            counts = np.zeros(n, np.int64)
            for at in np.flatnonzero(slow):
                text = data[offsets[at] : offsets[at + 1]].tobytes().decode()
                parts[at] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                counts[at] = len(parts[at])
            fast = np.flatnonzero(~slow)
            if len(fast):
                some, begin = _gather(data, offsets[fast], offsets[fast + 1])
                got, counts[fast] = self._fast(some, np.r_[begin, len(some)])
                at = np.r_[0, np.cumsum(counts[fast])]
                for i, r in enumerate(fast):
                    parts[r] = got[at[i] : at[i + 1]]
            ids = np.concatenate(parts) if n else np.empty(0, np.uint32)
        out_at = np.r_[0, np.cumsum(counts + 1)]
        out = np.full(out_at[-1], END_ID, np.uint32)
        body = np.ones(len(out), bool)
        body[out_at[1:] - 1] = False
        out[body] = ids
        return out, out_at

    def batches(self, data: np.ndarray, offsets: np.ndarray):
        """Row ranges of bounded size with their ids: ``(lo, hi, ids, offsets)``."""
        for lo, hi in chunks(offsets):
            part = data[offsets[lo] : offsets[hi]]
            yield lo, hi, *self.encode(part, offsets[lo : hi + 1] - offsets[lo])


def _gather(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges ``[start, end)`` of ``values`` one after the other, and where
    each begins."""
    lens = ends - starts
    begin = np.cumsum(lens) - lens
    shift = np.repeat(starts - begin, lens)
    shift += np.arange(len(shift))
    return values[shift], begin


def _piece_hashes(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return word_hashes(data, begin, np.r_[begin[1:], len(data)], packed=True)
