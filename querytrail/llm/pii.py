"""Personal data by weak supervision.

Four base kinds have fixed patterns and are always reported.  Further
candidates (numbers, secrets, names, IBANs) come from loose patterns.  Regex,
gazetteer and context labelers vote on every candidate and base span: +1
personal, -1 not, 0 abstains.  Expectation-maximisation over the counts of
all vote patterns in the corpus estimates each labeler's reliability and the
probability that a span with given votes is personal data; a logistic
classifier over shape features, trained on these soft labels, decides which
candidates are added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.llm.common import texts

BASE = ("email", "ip", "card", "phone")
ADDED = ("number", "secret", "name", "iban")
KINDS = BASE + ADDED
LABELERS = ("shape", "cue words", "other words", "delimiter", "structure", "variety", "edges")
THRESHOLD = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start within a run of digits fails wherever its beginning fails, so only run starts are tried.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_NUMBER = re.compile(r"(?<![0-9A-Za-z+(])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,}(?![0-9])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
# Fixed word lists of the gazetteer labelers.
_TITLES = "Mr Mrs Ms Dr Prof Herr Frau Mme Monsieur Madame Señor Señora Sra"
_NAMES = frozenset(
    "James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth "
    "Barbara Susan Jessica Sarah Karen Anna Maria Hans Peter Klaus Sabine Petra Jean Pierre Marie Claire José Carlos".split()
)
_CUES = re.compile(
    r"(?:phone|tel|call|mobile|fax|contact|e-?mail|mail|card|visa|account|iban|ssn|social|passport|id|ip|address|"
    r"token|secret|key|password|pwd|api|bearer|credential|name|signed|dear)\W{0,4}\Z", re.I
)
_OTHER = re.compile(r"(?:version|licen[sc]e|page|pages|chapter|section|isbn|rfc|figure|table|no|vol|eur|usd)\W{0,3}\Z", re.I)
_NAME = re.compile(rf"\b(?:{_TITLES.replace(' ', '|')})\.? (?=[^\W\d_a-z])[^\W\d_]+(?: (?=[^\W\d_a-z])[^\W\d_]+)?")
# A capitalised word before another, the first of which the gazetteer may hold; a name after a phrase that announces it.
_FIRST = re.compile(r"(?<!\w)[^\W\d_a-z][^\W\d_]*(?= [^\W\d_a-z])")
_WORD = re.compile(r"[^\W\d_a-z][^\W\d_]*")
_NAMED = re.compile(r"(?:\b[Mm]y name is|\b[Nn]ame:|\b[Ss]igned by|\b[Mm]ein Name ist|\b[Ii]ch heiße|\b[Jj]e m'appelle|\b[Mm]e llamo) \Z")
_AFTER = re.compile(rf"{_NAMED.pattern[:-2]}({_WORD.pattern}(?: {_WORD.pattern})?)")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}\Z")
_LOCAL_PHONE = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\Z")
_HEX = re.compile(r"(?:[0-9a-f]{32,}|[0-9A-F]{32,})\Z")
_KEY = re.compile(r"(?:AKIA|ASIA|ghp_|sk-|xox[bp]-|eyJ)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def iban_checks(span: str) -> bool:
    """Whether the number's remainder modulo 97 is that of a valid IBAN."""
    packed = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1


def _iban_end(span: str) -> int:
    """The length of the longest valid beginning in whole groups (a word in
    capitals may follow the last one); of ``span``, if none is valid."""
    cut = span
    while len(cut.replace(" ", "")) >= 15:
        if iban_checks(cut):
            return len(cut)
        cut = cut[: max(cut.rfind(" "), 0)]
    return len(span)


def _listed_names(text: str, names: frozenset[str]) -> Iterator[tuple[int, int]]:
    """A name of the gazetteer and the capitalised word after it; one more, if
    that word is a name of the gazetteer or an initial too."""
    for m in _FIRST.finditer(text):
        if m[0] in names:
            last = _WORD.match(text, m.end() + 1)
            if last[0] in names or len(last[0]) == 1:
                at = last.end() + (1 if len(last[0]) > 1 or text[last.end() : last.end() + 1] != "." else 2)
                more = _WORD.match(text, at) if text[at - 1 : at] == " " else None
                last = more or last
            yield m.start(), last.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base kinds in code points: per kind
    the leftmost non-overlapping matches, those that fail a check dropped."""
    out = []
    at = text.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (p.lstrip("0") or "0" for p in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _digits(m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def candidates(text: str, base: list[tuple[int, int, int]], names: frozenset[str] = _NAMES) -> list[tuple[int, int, int]]:
    """Further spans that may be personal data, free of base spans and of
    each other (leftmost first, then longest)."""
    found = []
    if _DIGIT.search(text):
        found += [(m.start(), 7, m.start() + _iban_end(m[0])) for m in _IBAN.finditer(text)]
        found += [(m.start(), 4, m.end()) for m in _NUMBER.finditer(text)]
        for m in _SECRET.finditer(text):
            digits = sum("0" <= c <= "9" for c in m[0])
            if digits >= 4 and m.end() - m.start() - digits >= 4:
                found.append((m.start(), 5, m.end()))
    found += [(m.start(), 6, m.end()) for m in _NAME.finditer(text)]
    found += [(m.start(1), 6, m.end()) for m in _AFTER.finditer(text)]
    found += [(start, 6, end) for start, end in _listed_names(text, names)]
    found.sort(key=lambda s: (s[0], -s[2]))
    out, done, i = [], 0, 0
    for start, kind, end in found:
        while i < len(base) and base[i][2] <= start:
            i += 1
        if start >= done and not any(b[0] < end and b[2] > start for b in base[i : i + 8]):
            out.append((start, kind, end))
            done = end
    return out


def votes(text: str, start: int, kind: int, end: int, names: frozenset[str] = _NAMES) -> tuple[int, int]:
    """The vote pattern (base 3, one digit per labeler) and eight shape bits."""
    span, before = text[start:end], text[max(0, start - 24) : start]
    prev, nxt = text[start - 1 : start], text[end : end + 1]
    n = end - start
    digits = sum("0" <= c <= "9" for c in span)
    varied = len(set(span))
    cue, other = _CUES.search(before.rstrip(" \"'=:(")) or (kind == 6 and _NAMED.search(before)), _OTHER.search(before)
    if kind < len(BASE):
        shape = 1
    elif kind == 4:
        shape = 1 if _SSN.match(span) or _LOCAL_PHONE.match(span) else -1
    elif kind == 5:
        shape = 1 if _HEX.match(span) or _KEY.match(span) else 0
    elif kind == 6:
        shape = 1 if span.count(" ") == 2 else 0
    else:
        shape = 1 if iban_checks(span) else -1
    if kind == 4:
        only = _digits(span)
        structure = 1 if 12 <= len(only) <= 19 and luhn(only) else (-1 if len(only) >= 12 else 0)
    elif kind == 5:
        structure = 1 if 0.1 < digits / n < 0.9 else -1
    elif kind == 6:
        structure = 1 if any(w in names for w in span.split()) else 0
    else:
        structure = 1 if shape > 0 else -1
    apart = (not prev or not prev.isalnum()) and (not nxt or not nxt.isalnum())
    row = (
        shape,
        1 if cue else 0,
        -1 if other else 0,
        1 if prev in ("=", ":", '"', "'") and prev else 0,
        structure,
        0 if varied >= min(n, 10) * 0.6 else -1,
        0 if apart else -1,
    )
    pattern = 0
    for v in row:
        pattern = pattern * 3 + v + 1
    letters = any(c.isalpha() for c in span)
    flags = (n >= 12, n >= 24, digits * 5 >= n * 2, letters, any(c in " ().-" for c in span), apart, bool(cue), shape > 0)
    return pattern, sum(1 << i for i, f in enumerate(flags) if f)


@dataclass
class PiiModel:
    """Per kind: the classifier's weights over the shape bits and a bias;
    ``reliability``: how often each labeler is right when it votes;
    ``names``: the gazetteer of first names."""

    weights: dict[int, np.ndarray] = field(default_factory=dict)
    reliability: dict[int, np.ndarray] = field(default_factory=dict)
    names: frozenset[str] = _NAMES

    def probability(self, kind: int, shape: int) -> float:
        w = self.weights.get(kind)
        if w is None:
            return 0.0
        return float(1 / (1 + np.exp(-(w[:-1] @ _bits(shape) + w[-1]))))


def _bits(shape: int) -> np.ndarray:
    return np.array([shape >> i & 1 for i in range(8)], float)


def _vote_matrix(patterns: np.ndarray) -> np.ndarray:
    out = np.empty((len(patterns), len(LABELERS)), np.int64)
    rest = patterns.copy()
    for i in range(len(LABELERS) - 1, -1, -1):
        out[:, i] = rest % 3 - 1
        rest //= 3
    return out


def expectation_maximisation(v: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of "personal" per vote pattern, and reliabilities.  Each
    labeler has a rate of +1 and of -1 votes under either class, smoothed
    towards being right four times in five."""
    yes = 1 / (1 + np.exp(-v.sum(1).astype(float)))
    prior = 0.5
    for _ in range(rounds):
        odds = np.full(len(v), np.log(prior / (1 - prior)))
        reliability = np.empty(v.shape[1])
        for j in range(v.shape[1]):
            up, down = v[:, j] > 0, v[:, j] < 0
            right = (counts[up] @ yes[up]) + (counts[down] @ (1 - yes[down])) + 8
            total = counts[up | down].sum() + 10
            reliability[j] = np.clip(right / total, 0.55, 0.98)
            odds += v[:, j] * np.log(reliability[j] / (1 - reliability[j]))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        prior = float(np.clip((counts @ new + 1) / (counts.sum() + 2), 0.05, 0.95))
        if np.abs(new - yes).max() < 1e-6:
            yes = new
            break
        yes = new
    return yes, reliability


def logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Weights and bias for soft labels, by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (p - y)) + l2 * w
        step = np.linalg.solve((x * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + l2 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


#: First names that a gazetteer may hold, since every task gets it whole.
MOST_NAMES = 200_000


def gazetteer(names: DataFrame, column: str = "name") -> frozenset[str]:
    """The distinct first names in a table, besides the built-in ones; more
    than :data:`MOST_NAMES` are an error.  Null and blank ones are left out."""
    name = F.trim(names[column].cast("string"))
    rows = names.select(name.alias("name")).where("name <> ''").distinct().limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names")
    return _NAMES | {r["name"] for r in rows}


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", names: frozenset[str] = _NAMES) -> PiiModel:
    """Count all votes in ``docs`` and train.  ``names``: the first names that
    the name labelers know, see :func:`gazetteer`.  The counts that reach the
    driver are one row for each kind, vote pattern and shape that occur: at
    most 8 * 3**7 * 2**8, whatever the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, int, int], int] = {}
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                for start, kind, end in base + candidates(text, base, names):
                    key = (kind, *votes(text, start, kind, end, names))
                    seen[key] = seen.get(key, 0) + 1
            rows = np.array([(*k, n) for k, n in seen.items()], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(4)], ["kind", "pattern", "shape", "n"])

    counted = texts(docs, id_col, text_col).mapInArrow(run, "kind long, pattern long, shape long, n long")
    table = counted.groupBy("kind", "pattern", "shape").agg(F.sum("n").alias("n")).orderBy("kind", "pattern", "shape").collect()
    model = PiiModel(names=names)
    for kind in sorted({r["kind"] for r in table}):
        rows = [r for r in table if r["kind"] == kind]
        patterns, at = np.unique([r["pattern"] for r in rows], return_inverse=True)
        counts = np.array([r["n"] for r in rows], float)
        yes, model.reliability[kind] = expectation_maximisation(_vote_matrix(patterns), np.bincount(at, counts))
        model.weights[kind] = logistic(np.array([_bits(r["shape"]) for r in rows]), yes[at], counts)
    return model


def detect(text: str, model: PiiModel) -> list[tuple[int, int, int, float]]:
    """All spans ``(start, kind number, end, probability)``: base ones with
    probability 1, candidates from :data:`THRESHOLD` on."""
    base = base_spans(text)
    out = [(*s, 1.0) for s in base]
    for start, kind, end in candidates(text, base, model.names):
        p = model.probability(kind, votes(text, start, kind, end, model.names)[1])
        if p >= THRESHOLD:
            out.append((start, kind, end, p))
    out.sort()
    return out


SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>"


def find(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:data:`SPANS`, one row per document, spans in the order of start, then
    kind.  Offsets are code points, end exclusive.  Null and empty texts have
    no spans; repeated rows and null ids are kept."""
    schema = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in detect(t, model)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, schema)], ["doc_id", "spans"])

    return texts(docs, id_col, text_col).mapInArrow(run, SPANS)


def masked(docs: DataFrame, model: PiiModel, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by ``[KIND]`` and, if
    named, ``length_col`` set to the new length.  Other columns stay; a null
    text stays null."""
    schema = docs.schema
    place = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col else None

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, done = [], 0
        for start, kind, end, _ in detect(text, model):
            if end > done:
                out += [text[done : max(start, done)], f"[{KINDS[kind].upper()}]" if start >= done else ""]
                done = end
        return "".join([*out, text[done:]]) if done else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            new = [clean(t) for t in batch.column(place).to_pylist()]
            columns[place] = pa.array(new, batch.schema.field(place).type)
            if length_at is not None:
                old = batch.column(length_at).to_pylist()
                was = batch.column(place).to_pylist()
                columns[length_at] = pa.array([o if a == b else len(b) for o, a, b in zip(old, was, new, strict=True)], batch.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)


def digests(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of the base spans and all spans
    as text, ``kind:start:end`` joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [[] for _ in BASE]
            hashes, every = [], []
            for row in batch.column(1).to_pylist():
                parts = [(s["kind"], f"{s['kind']}:{s['start']}:{s['end']}") for s in row]
                for kind, to in zip(BASE, counts, strict=True):
                    to.append(sum(k == kind for k, _ in parts))
                hashes.append(hashlib.sha256(",".join(p for k, p in parts if k in BASE).encode()).hexdigest())
                every.append(",".join(p for _, p in parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes), pa.array(every)],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return spans.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
