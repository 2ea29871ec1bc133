import hashlib
import json

import pytest

from querytrail.llm import chat

NASTY = ["", "plain", "\\", "\\\\t", "</turn>", "\\</turn>", "### user: x</turn>\n", "a</tur", "</turn></turn>", "### ", "\\h\\t\\c", "é\U0001f600\n\n### ", "x" * 300_000]


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


@pytest.mark.parametrize("text", NASTY)
def test_escape_round_trip(text):
    for role in ("user", "a: b", "### </turn>\\"):
        block = chat.OPEN + chat.escape(role, True) + chat.MID + chat.escape(text) + chat.END
        assert chat.CLOSE not in chat.escape(text)
        assert chat.parse(block * 2) == [(role, text)] * 2


def test_fingerprints_depend_on_paths_only():
    a = {"messages": [{"role": "user", "content": None}], "id": 1}
    b = {"id": "x", "messages": [{"content": "c", "role": "r"}, {"role": "q", "content": "d"}]}
    assert chat.fingerprint(chat.field_paths(a)) == chat.fingerprint(chat.field_paths(b))
    assert chat.fingerprint(chat.field_paths({"prompt": 1})) != chat.fingerprint(chat.field_paths({"prompt": {"a": 1}}))


def records(spark, rows):
    return spark.createDataFrame([(json.dumps(r) if r is not None else None,) for r in rows], "record string")


def test_layouts_become_the_same_turns(spark):
    rows = [
        {"id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"id": 3, "prompt": "q", "response": "a"},
        {"id": 4, "instruction": "q", "input": "", "output": "a"},
        {"id": 5, "question": "q", "answer": "a"},
        {"conv_id": 6, "turn": 1, "role": "assistant", "text": "a"},
        {"conv_id": 6, "turn": 0, "role": "user", "text": "q"},
        {"id": 7, "messages": []},
    ]
    turns = chat.canonical_turns(records(spark, rows))
    assert turns.select("layout").distinct().count() == 6
    got = chat.conversation_digests(chat.format_conversations(turns)).collect()
    assert sorted(r["conv_id"] for r in got) == [1, 2, 3, 4, 5, 6]
    assert {r["turns_sha256"] for r in got} == {digest([("user", "q"), ("assistant", "a")])}
    assert {(r["n_turns"], r["loss_chars"], r["loss_sha256"]) for r in got} == {(2, 1, hashlib.sha256(b"a").hexdigest())}


def test_system_context_and_history_are_turns(spark):
    pair, listed = [["a", "b"]], [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]
    both = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]}
    rows = [
        {"id": 1, "system": "s", **both, "source": "web"},
        {"id": 2, "system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]},
        {"id": 3, "context": "c", "question": "q", "answer": "r"},
        {"id": 4, "system": "s", "instruction": "q", "output": "r", "history": pair},
        {"id": 5, "prompt": "q", "completion": "r", "history": listed},
        {"id": 6, "system": None, **both, "history": [], "weight": 2},
    ]
    got = {}
    for r in chat.canonical_turns(records(spark, rows)).orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    system, end, before = [("system", "s")], [("user", "q"), ("assistant", "r")], [("user", "a"), ("assistant", "b")]
    assert got == {1: system + end, 2: system + end, 3: [("user", "c\n\nq"), end[1]], 4: system + before + end, 5: before + end, 6: end}


def test_records_without_an_id_are_apart(spark):
    pair = lambda q, a: {"instruction": q, "output": a}
    rows = [pair("q1", "a1"), pair("q2", "a2"), pair("q1", "a1"), {"messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": "y"}]}]
    got = chat.conversation_digests(chat.format_conversations(chat.canonical_turns(records(spark, rows)))).collect()
    want = [[("user", "q1"), ("assistant", "a1")]] * 2 + [[("user", "q2"), ("assistant", "a2")], [("user", "x"), ("assistant", "y")]]
    assert sorted(r["turns_sha256"] for r in got) == sorted(map(digest, want))
    assert len({r["conv_id"] for r in got}) == 4 and all(r["n_turns"] == 2 for r in got)


def test_ids_of_other_kinds(spark):
    both = {"prompt": "q", "response": "a"}
    rows = [{"id": i, **both} for i in ("identity_0", "identity_1", 1 << 63, 1.5, True, ["a"], 12)]
    rows += [{"conv_id": "c", "turn": i, "role": r, "text": t} for i, r, t in ((1, "assistant", "a"), (0, "user", "q"))]
    rows += [{"conv_id": None, "turn": 0, "role": "user", "text": "n"}]
    got = chat.conversation_digests(chat.format_conversations(chat.canonical_turns(records(spark, rows)))).collect()
    ids = [r["conv_id"] for r in got]
    assert len(ids) == len(set(ids)) == 9 and 12 in ids and None in ids
    assert sum(r["turns_sha256"] == digest([("user", "q"), ("assistant", "a")]) for r in got) == 8


@pytest.mark.parametrize(
    "extra",
    [{"notes": "x"}, {"prompt": "x"}, {"meta": {"say": ["x"]}}, {"messages": [{"role": "user", "content": "q", "name": "x"}]}],
)
def test_texts_beside_the_layout_fail(spark, extra):
    with pytest.raises(Exception, match="no mapping fits"):
        chat.canonical_turns(records(spark, [{"id": 1, "messages": [{"role": "user", "content": "q"}], **extra}])).collect()


@pytest.mark.parametrize("bad", [None, [1], {"nothing": 1}])
def test_records_without_a_layout_fail(spark, bad):
    with pytest.raises(Exception, match="no mapping fits|JSON object"):
        chat.canonical_turns(records(spark, [bad])).collect()


def test_nulls_ties_repeats_and_split_conversations(spark):
    schema = "conv_id long, turn long, part int, role string, text string"
    rows = [(1, 2, 0, "assistant", "b"), (1, 2, 0, "assistant", "b"), (1, None, 0, "user", None), (1, 1, 0, None, "x"), (None, 0, 0, "user", "n")]
    rows += [(9, i, 0, "assistant" if i % 2 else "user", NASTY[i % len(NASTY)][:50] + str(i)) for i in range(500)]
    df = spark.createDataFrame(rows, schema).repartition(5)
    parts = chat.format_conversations(df, part_chars=200)
    assert parts.where("conv_id = 9").count() > 10
    got = {r["conv_id"]: r for r in chat.conversation_digests(parts).collect()}
    assert got[1]["turns_sha256"] == digest([("user", ""), ("", "x"), ("assistant", "b"), ("assistant", "b")])
    assert got[1]["loss_chars"] == 2 and got[None]["n_turns"] == 1
    nine = [(r, t) for c, _, _, r, t in rows if c == 9]
    assert got[9]["turns_sha256"] == digest(nine) and got[9]["n_turns"] == 500
    loss = "".join(t for r, t in nine if r == "assistant")
    assert got[9]["loss_chars"] == len(loss) and got[9]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert got[9]["formatted_chars"] == sum(len(r["formatted"]) for r in parts.where("conv_id = 9").collect())


def test_empty(spark):
    turns = chat.canonical_turns(records(spark, []))
    assert chat.conversation_digests(chat.format_conversations(turns)).count() == 0
