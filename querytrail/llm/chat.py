"""Chat formatting by schema fingerprints.

A record's fingerprint is the hash of its sorted nested field paths (lists
add ``[]``).  It selects one of the declarative :data:`MAPPINGS`, which turn
prompt, instruction and message layouts into canonical turns
``(conv_id, turn, part, role, text)``.  Formatting walks the turns in order
and writes the template; the reader undoes it exactly.

Template: each turn is ``### <role>: <text></turn>`` and a newline.  Inside
roles and texts a backslash is doubled and control strings become
two-character escapes (:data:`ESCAPES`), so neither can be mistaken for a
mark.  The loss mask covers the text of each assistant turn.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.llm.common import frames

OPEN, MID, CLOSE = "### ", ": ", "</turn>"
END = CLOSE + "\n"
#: Escape letter after a backslash -> what it stands for (the colon is a
#: control string in roles only).
ESCAPES = {"\\": "\\", "h": OPEN, "t": CLOSE, "c": ":"}
ASSISTANT = "assistant"
#: Code points of formatted text in one output row; a longer conversation
#: continues in further rows.
PART_CHARS = 1 << 20


#: Fields that describe a record or turn and are no part of its text.
IGNORED = ("id", "conv_id", "source", "dataset", "lang", "language", "model", "category", "license", "url", "split", "timestamp")


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.  ``needs``: field paths that a record of
    the layout has.  Either ``each`` names a list of turns (empty: the record
    is one turn itself) with ``role`` and ``text`` fields, or ``parts`` lists
    ``(role, fields)``, whose non-empty texts are joined by a blank line.
    ``system``: a field whose text, if any, is a turn ahead of a list's.
    ``history``: a field of earlier turns, ``[user, assistant]`` pairs or
    objects of role and content, ahead of the first user part.  ``ignored``:
    fields of a record or turn that are no part of the conversation."""

    name: str
    needs: tuple[str, ...]
    each: str = ""
    role: str = "role"
    text: str = "text"
    turn: str = ""
    ids: tuple[str, ...] = ("conv_id", "id")
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)
    system: str = ""
    history: str = ""
    ignored: tuple[str, ...] = IGNORED

    def reads(self, path: str) -> bool:
        """Whether the value at ``path`` is read or ignored."""
        if self.each and path.startswith(f"{self.each}[]."):
            path, names = path[len(self.each) + 3 :], (self.role, self.text)
        elif self.parts:
            names = (self.history, *(f for _, fields in self.parts for f in fields), *self.ids)
        else:
            names = (self.system, *self.ids) if self.each else (self.role, self.text, self.turn, *self.ids)
        return any(path == n or path.startswith((f"{n}.", f"{n}[]")) for n in (*names, *self.ignored) if n)


#: Tried in this order; the first whose paths a record has is taken.
MAPPINGS = (
    Mapping("messages", ("messages[].role", "messages[].content"), each="messages", text="content", system="system"),
    Mapping(
        "from-value", ("conversations[].from", "conversations[].value"), each="conversations", role="from", text="value",
        aliases={"human": "user", "gpt": "assistant"}, system="system",
    ),
    Mapping("turn-rows", ("turn", "role", "text"), turn="turn"),
    Mapping("instruction", ("instruction", "output"), parts=(("system", ("system",)), ("user", ("context", "instruction", "input")), ("assistant", ("output",))), history="history"),
    Mapping("prompt-response", ("prompt", "response"), parts=(("system", ("system",)), ("user", ("context", "prompt")), ("assistant", ("response",))), history="history"),
    Mapping("prompt-completion", ("prompt", "completion"), parts=(("system", ("system",)), ("user", ("context", "prompt")), ("assistant", ("completion",))), history="history"),
    Mapping("question-answer", ("question", "answer"), parts=(("system", ("system",)), ("user", ("context", "question")), ("assistant", ("answer",))), history="history"),
)

TURNS = "conv_id long, turn long, part int, role string, text string, layout string, fingerprint long"
PARTS = "conv_id long, task int, seq long, formatted string, loss array<struct<start:long,length:long>>"


def field_paths(value: object, prefix: str = "") -> set[str]:
    """All field paths of a decoded JSON value."""
    todo, out = [(value, prefix)], set()
    while todo:
        here, path = todo.pop()
        if isinstance(here, dict):
            for key, below in here.items():
                child = f"{path}.{key}" if path else str(key)
                out.add(child)
                todo.append((below, child))
        elif isinstance(here, list):
            todo.extend((below, f"{path}[]") for below in here)
    return out


def fingerprint(paths: set[str]) -> int:
    """The signed 64-bit hash of the sorted paths."""
    h = xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode())
    return h - (1 << 64) if h >= 1 << 63 else h


def choose(paths: set[str], mappings: tuple[Mapping, ...] = MAPPINGS) -> Mapping:
    for m in mappings:
        if all(p in paths or ("[]" in p and p.split("[]")[0] in paths and not any(x.startswith(p.split("[]")[0] + "[]") for x in paths)) for p in m.needs):
            return m
    raise ValueError(f"no mapping fits a record with the fields {sorted(paths)[:20]}")


def _text(value: object) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def unread(record: dict, m: Mapping) -> list[str]:
    """The fields with text that ``m`` neither reads nor ignores."""
    todo, out = [(record, "")], []
    while todo:
        here, path = todo.pop()
        if path and m.reads(path):
            continue
        if isinstance(here, dict):
            todo.extend((below, f"{path}.{key}" if path else str(key)) for key, below in here.items())
        elif isinstance(here, list):
            todo.extend((below, f"{path}[]") for below in here)
        elif isinstance(here, str) and here:
            out.append(path)
    return sorted(set(out))


def _history(value: object) -> Iterator[tuple[str, str]]:
    if value is not None and not isinstance(value, list):
        raise ValueError("no mapping fits a history that is not a list of turns")
    for item in value or []:
        if isinstance(item, list) and len(item) == 2:
            yield from zip(("user", ASSISTANT), map(_text, item), strict=True)
        elif isinstance(item, dict) and set(item) == {"role", "content"}:
            yield _text(item["role"]), _text(item["content"])
        else:
            raise ValueError("no mapping fits a history that is not a list of turns")


def turns_of(record: dict, m: Mapping) -> Iterator[tuple[int | None, int, str, str]]:
    """``(turn, part, role, text)`` of one record under its mapping."""
    if m.parts:
        kept = [(role, "\n\n".join(x for x in (_text(record.get(f)) for f in fields) if x)) for role, fields in m.parts]
        rows = [(role, text) for role, text in kept if text or role != "system"]
        first = next((i for i, (role, _) in enumerate(rows) if role != "system"), 0)
        rows[first:first] = _history(record.get(m.history)) if m.history else ()
        for i, (role, text) in enumerate(rows):
            yield i, 0, role, text
        return
    system = _text(record.get(m.system)) if m.system else ""
    if system:
        yield 0, 0, "system", system
    for i, item in enumerate((record.get(m.each) or []) if m.each else [record], 1 if system else 0):
        item = item or {}
        role = _text(item.get(m.role))
        turn = item.get(m.turn) if m.turn else i
        yield turn, 0, m.aliases.get(role, role), _text(item.get(m.text))


def conversation_id(record: dict, m: Mapping, raw: str, number: int) -> int | None:
    """The ``conv_id`` of a record: its id, where that is a whole number of 64
    bits.  Any other id (a text, say) gives the hash of its JSON.  A record
    that holds a conversation and has no id is one of its own: it gives a hash
    of itself and its number among the rows.  A turn without an id has none."""
    found = next((record[i] for i in m.ids if record.get(i) is not None), None)
    if type(found) is int and -(1 << 63) <= found < 1 << 63:
        return found
    if found is not None:
        name = f"id {json.dumps(found, sort_keys=True)}"
    elif m.turn:
        return None
    else:
        name = f"record {number} {raw}"
    h = xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"), seed=7)
    return h - (1 << 64) if h >= 1 << 63 else h


def canonical_turns(records: DataFrame, record_col: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Canonical turns of JSON records; see :data:`TURNS` for the columns.

    Null texts and roles are empty.  Rows of single turns belong together by
    their id, null included; a record that holds a conversation and has no id
    is a conversation of its own, repeats too (:func:`conversation_id`).  A
    record that is null or not a JSON object, or whose fields fit no mapping, is an error that names the
    fields, as is one with a text that its mapping neither reads nor ignores.
    A record without turns gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[Mapping, bool]] = {}
        schema = pa.schema(
            [("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("layout", pa.string()), ("fingerprint", pa.int64())]
        )

        def rows() -> Iterator[dict]:
            for batch in batches:
                for raw, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    record = json.loads(raw) if raw is not None else None
                    if not isinstance(record, dict):
                        raise ValueError("a chat record must be a JSON object")
                    paths = field_paths(record)
                    key = fingerprint(paths)
                    if key not in known:
                        fit = choose(paths, mappings)
                        known[key] = fit, all(map(fit.reads, paths))
                    m, whole = known[key]
                    left = [] if whole else unread(record, m)
                    if left:
                        raise ValueError(f"no mapping fits a record with texts beside the layout {m.name}: {left[:20]}")
                    conv = conversation_id(record, m, raw, number)
                    for turn, part, role, text in turns_of(record, m):
                        yield {"conv_id": conv, "turn": turn, "part": part, "role": role, "text": text, "layout": m.name, "fingerprint": key}

        yield from frames(rows(), schema)

    numbered = records.select(F.col(record_col).cast("string"), F.monotonically_increasing_id())
    return numbered.mapInArrow(run, TURNS)


def escape(text: str, role: bool = False) -> str:
    out = text.replace("\\", "\\\\").replace(OPEN, "\\h").replace(CLOSE, "\\t")
    return out.replace(":", "\\c") if role else out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: ESCAPES[m[1]], text)


def format_conversations(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Formatted conversations, :data:`PARTS`: normally one row each.

    Turns are ordered by turn (null first), then role, then a hash of the
    text and the text itself, which settles ties and repeated rows.  The rows
    are range-partitioned by conversation and turn, so a conversation of any
    size is split over tasks; it then has several rows, in the order of
    ``(task, seq)``.  ``loss``: spans of code points within ``formatted``.
    """
    keys = ["conv_id", "turn", "part", "role", "h"]
    ordered = (
        turns.select("conv_id", "turn", "part", "role", "text", F.xxhash64("text").alias("h"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys, "text")
        .select("conv_id", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("task", pa.int32()), ("seq", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))]
        )
        task = TaskContext.get().partitionId()

        def rows() -> Iterator[dict]:
            seq, conv, blocks, spans, chars = 0, None, [], [], 0
            for batch in batches:
                for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if blocks and (c != conv or chars >= part_chars):
                        yield {"conv_id": conv, "task": task, "seq": seq, "formatted": "".join(blocks), "loss": spans}
                        seq, blocks, spans, chars = seq + 1, [], [], 0
                    conv = c
                    head, body = OPEN + escape(role or "", role=True) + MID, escape(text or "")
                    if role == ASSISTANT:
                        spans.append({"start": chars + len(head), "length": len(body)})
                    blocks += [head, body, END]
                    chars += len(head) + len(body) + len(END)
            if blocks:
                yield {"conv_id": conv, "task": task, "seq": seq, "formatted": "".join(blocks), "loss": spans}

        yield from frames(rows(), schema, 64)

    return ordered.mapInArrow(run, PARTS)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The ``(role, text)`` turns of formatted text."""
    out = []
    for block in formatted.split(END)[:-1]:
        role, body = block.removeprefix(OPEN).split(MID, 1)
        out.append((unescape(role), unescape(body)))
    return out


def conversation_digests(parts: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted text: the number of
    turns, digests of all turns and of all text under the loss mask, and
    lengths in code points.  A conversation's rows pass one task in order, a
    part at a time; only the running digests are held."""
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "task", "seq").select("conv_id", "formatted", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
        )

        def rows() -> Iterator[dict]:
            state: dict | None = None

            def done() -> dict:
                return {k: v.hexdigest() if k.endswith("sha256") else v for k, v in state.items()}

            for batch in batches:
                for conv, formatted, loss in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if state is None or state["conv_id"] != conv:
                        if state is not None:
                            yield done()
                        state = {"conv_id": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0, "loss_sha256": hashlib.sha256(), "formatted_chars": 0}
                    for role, text in parse(formatted):
                        state["n_turns"] += 1
                        state["turns_sha256"].update(f"{role}\n{text}\n".encode())
                    for span in loss:
                        text = unescape(formatted[span["start"] : span["start"] + span["length"]])
                        state["loss_chars"] += len(text)
                        state["loss_sha256"].update(text.encode())
                    state["formatted_chars"] += len(formatted)
            if state is not None:
                yield done()

        yield from frames(rows(), schema)

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
