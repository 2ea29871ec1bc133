import hashlib
import random
import re

import numpy as np
from helpers import documents

from querytrail.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(t):
    only = lambda s: "".join(c for c in s if c in "0123456789")
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(only(m[0])) <= 19 and P.luhn(only(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(only(m[0])) <= 15]
    return sorted(out)


def texts():
    rng = random.Random(4)
    parts = ["a@b.com", "_x@c-d.e.f", "a@b@c.de", "@", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999",
             "+12", "+49.30.123456", " ", ".", "é", "\n", "9", "0-0", "_", "%", "+", "x", "12", "😀", "4111111111111111"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]


def test_base_spans_equal_plain_patterns():
    for t in texts():
        assert P.base_spans(t) == plain(t), t


def test_long_runs_are_quick():
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + " " * 100_000, "@" * 50_000, "a." * 50_000 + "@x.y", "1 " * 100_000, "Mr " * 30_000, "John " * 40_000, "DE89 " * 40_000, "DE12" + " A1B2" * 40_000, "My name is " * 20_000):
        P.candidates(t, P.base_spans(t))


def test_em_finds_reliable_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(3000) < 0.4
    votes = np.zeros((3000, 3), int)
    for j, right in enumerate((0.95, 0.9, 0.6)):
        ok = rng.random(3000) < right
        votes[:, j] = np.where(truth == ok, 1, -1)
    yes, reliability = P.expectation_maximisation(votes, np.ones(3000))
    assert reliability[0] > 0.9 and reliability[1] > 0.85 and reliability[2] < 0.75
    assert ((yes > 0.5) == truth).mean() > 0.93


def corpus():
    rng = random.Random(1)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(40)]
    rows = [(i, f'text with token = "{h}" and more words') for i, h in enumerate(hexes)]
    rows += [(100 + i, f"order 70866383198462{i:02d} of the list, version 10.2.{i}") for i in range(40)]
    rows += [(200 + i, f"write to user{i}@mail.example.com or call +1 (555) 010-{1000 + i}; Mr. John Smith") for i in range(40)]
    return rows + [(300, None), (301, ""), (None, "a@b.cd"), (302, "plain words only " * 20_000), (200, rows[80][1])]


def test_find_adds_secrets_and_leaves_plain_numbers(spark):
    rows = corpus()
    docs = documents(spark, rows).repartition(3)
    found = P.find(docs, P.fit(docs))
    got = found.collect()
    assert len(got) == len(rows)
    kinds = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in got}
    assert all(kinds[i] == ["secret"] for i in range(40))
    assert all(kinds[100 + i] == (["card"] if P.luhn(f"70866383198462{i:02d}") else []) for i in range(40))
    assert all(kinds[200 + i][:2] == ["email", "phone"] for i in range(40))
    assert kinds[300] == kinds[301] == kinds[302] == [] and kinds[None] == ["email"]
    text = dict(rows)
    for r in P.digests(found).collect():
        base = plain(text[r["doc_id"]] or "")
        joined = ",".join(f"{P.BASE[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == j for _, k, _ in base) for j in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_long_keys_are_found_and_masked(spark):
    rng = random.Random(7)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))
    keys = {1000 + n: key(n) for n in (510, 512, 513, 600, 2000)}
    rows = corpus() + [(i, f'private key = "{k}" and more words') for i, k in keys.items()]
    docs = documents(spark, rows)
    model = P.fit(docs)
    spans = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in P.find(docs, model).collect()}
    assert all(spans[i] == [("secret", 15, 15 + len(k))] for i, k in keys.items())
    clean = {r["doc_id"]: r["text"] for r in P.masked(docs, model).collect()}
    assert all(clean[i] == 'private key = "[SECRET]" and more words' for i in keys)
    for t in ("a1" * 500_000, "a1b2c3d4-" * 100_000 + " ", "A1+/" * 200_000 + "é"):
        assert P.candidates(t, P.base_spans(t)) == [(0, 5, len(t.rstrip(" é")))]


def test_masked_keeps_other_columns(spark):
    docs = documents(spark, corpus()).selectExpr("*", "cast(length(text) as bigint) as n_chars")
    out = P.masked(docs, P.fit(docs), "text", "n_chars")
    assert out.schema == docs.schema
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["text"] == 'text with token = "[SECRET]" and more words' and rows[0]["n_chars"] == len(rows[0]["text"])
    assert rows[300]["text"] is None and rows[100]["text"] == dict(corpus())[100]
    assert "[EMAIL]" in rows[205]["text"] and "@" not in rows[205]["text"]


def test_empty(spark):
    docs = documents(spark, [])
    assert P.digests(P.find(docs, P.fit(docs))).count() == 0


def test_ibans_end_where_they_check():
    good = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "FR1420041010050500013M02606", "NO9386011117947"]
    for g in good:
        assert P.iban_checks(g) and P.candidates(f"pay to {g} AND more", []) == [(7, 7, 7 + len(g))], g
    assert not P.iban_checks("DE88370400440532013000")


def test_planted_kinds_are_found_and_decoys_left(spark):
    rng = random.Random(11)
    first, last = ["Patricia", "John", "Maria", "Klaus", "José"], ["Smith", "Meyer", "Okafor", "Dupont", "Ng"]
    key = lambda n: "".join(rng.choice("abcdef0123456789") for _ in range(n))

    def iban():
        account = "".join(rng.choice("0123456789") for _ in range(18))
        return f"DE{98 - int(account + '131400') % 97:02d}{account}"

    rows, want = [], {}
    forms = {
        "name": lambda: (rng.choice(["Contact {} today", "my name is {}.", "we met {} there", "Signed by {}"]), f"{rng.choice(first)} {rng.choice(last)}"),
        "secret": lambda: (rng.choice(["token = \"{}\" end", "api key: {} end"]), key(rng.choice([32, 40, 64]))),
        "iban": lambda: (rng.choice(["IBAN {} please", "account {} of"]), iban()),
        "number": lambda: ("my ssn is: {} yes", f"{rng.randint(100, 999)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"),
    }
    for kind, make in forms.items():
        for _ in range(60):
            form, value = make()
            want[len(rows)] = (kind, value)
            rows.append((len(rows), form.format(value)))
    decoys = ["The Old River and New Bridge", "version 1.20.300.4000", "page 1234567 of 7654321", "isbn 9783161484100", "1 " * 60, "Contact Customer Service now", "DE00 1111 2222 3333 4444 55 is none", "12345678901234567890123456789"]
    rows += [(1000 + i * len(decoys) + j, d) for i in range(10) for j, d in enumerate(decoys)]
    docs = documents(spark, rows).repartition(3)
    text = {}
    for i, t in rows:
        text.setdefault(i, []).append(t)
    got = P.find(docs, P.fit(docs)).collect()
    hit = {k: 0 for k in forms}
    wrong = []
    for r in got:
        if r["doc_id"] >= 1000:
            wrong += [(text[r["doc_id"]], s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in P.ADDED]
            continue
        kind, value = want[r["doc_id"]]
        hit[kind] += any(text[r["doc_id"]][0][s["start"] : s["end"]] == value for s in r["spans"])
    assert all(n >= 54 for n in hit.values()), hit
    assert not wrong


def test_names_of_a_table(spark):
    table = spark.createDataFrame([("Wanjiru",), (" Wanjiru ",), (None,), ("",), ("Siobhán",)], "name string")
    names = P.gazetteer(table)
    assert {"Wanjiru", "Siobhán", "John"} <= names and "" not in names
    docs = documents(spark, [(i, f"then {n} Kamau left {i}") for i in range(20) for n in ("Wanjiru", "Siobhán")])
    assert all([s["kind"] for s in r["spans"]] == ["name"] for r in P.find(docs, P.fit(docs, names=names)).collect())
    assert not any(r["spans"] for r in P.find(docs, P.fit(docs)).collect())
    assert P.candidates("John F. Kennedy, Anna Maria Schmidt, John A", []) == [(0, 6, 15), (17, 6, 35), (37, 6, 43)]
