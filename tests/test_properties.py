"""Operators against plain-Python brute force on random small inputs."""

import datetime as dt
import os
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from querytrail.operators import count_by, keyword_filter, pivot_counts, top_k, trending, user_top_terms

TERMS = st.sampled_from(["a", "b", "Maske", "cerrahi maske", "İz", None])
USERS = st.one_of(st.none(), st.integers(1, 6))
MINUTES = st.one_of(st.none(), st.integers(0, 240))
ROWS = st.lists(st.tuples(USERS, TERMS, MINUTES), min_size=0, max_size=40)
# QT_EXAMPLES raises the example count for a deeper local run.
SETTINGS = settings(max_examples=int(os.environ.get("QT_EXAMPLES", "12")), deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.datetime(2024, 1, 1)


def _frame(spark, rows):
    data = [(u, t, None if m is None else BASE + dt.timedelta(minutes=m)) for u, t, m in rows]
    return spark.createDataFrame(data, "user_id int, search string, timestamp_dt timestamp")


def _sort_key(v):
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(rows=ROWS, k=st.integers(1, 4))
def test_top_k_brute_force(spark, rows, k):
    counts = Counter(t for _, t, _ in rows)
    expect = sorted(counts.items(), key=lambda kv: (-kv[1], _sort_key(kv[0])))[:k]
    got = [tuple(r) for r in top_k(_frame(spark, rows), "search", k).collect()]
    assert got == expect


@SETTINGS
@given(rows=ROWS)
def test_count_by_brute_force(spark, rows):
    expect = Counter((u, t) for u, t, _ in rows)
    got = {(r.user_id, r.search): r["count"] for r in count_by(_frame(spark, rows), "user_id", "search").collect()}
    assert got == dict(expect)


@SETTINGS
@given(rows=ROWS)
def test_pivot_brute_force(spark, rows):
    out = pivot_counts(_frame(spark, rows))
    terms = sorted({t for _, t, _ in rows}, key=_sort_key)
    assert out.columns == ["user_id"] + ["null" if t is None else t for t in terms]
    expect = {u: [sum(1 for uu, tt, _ in rows if uu == u and tt == t) for t in terms] for u in {u for u, _, _ in rows}}
    got = {r[0]: list(r[1:]) for r in out.collect()}
    assert got == expect


@SETTINGS
@given(rows=ROWS)
def test_window_counts_brute_force(spark, rows):
    expect = Counter((m // 30, t) for _, t, m in rows if m is not None)
    got = {}
    for r in trending(_frame(spark, rows)).collect():
        start = r.start_time.replace(tzinfo=None)
        assert r.end_time.replace(tzinfo=None) - start == dt.timedelta(minutes=30)
        got[(int((start - BASE).total_seconds() // 1800), r.search)] = r["count"]
    assert got == dict(expect)


@SETTINGS
@given(rows=ROWS, needle=st.sampled_from(["maske", "MASKE", "a", "iz", "İz"]))
def test_keyword_brute_force(spark, rows, needle):
    expect = sorted((t for _, t, _ in rows if t is not None and needle.lower() in t.lower()))
    got = sorted(r.search for r in keyword_filter(_frame(spark, rows), "search", needle).collect())
    assert got == expect


@SETTINGS
@given(rows=ROWS, k=st.integers(1, 3))
def test_user_top_terms_brute_force(spark, rows, k):
    pairs = Counter((u, t) for u, t, _ in rows)
    expect = []
    for u in {u for u, _, _ in rows}:
        ranked = sorted(((t, n) for (uu, t), n in pairs.items() if uu == u), key=lambda tn: (-tn[1], _sort_key(tn[0])))[:k]
        expect += [(u, t, n, i + 1) for i, (t, n) in enumerate(ranked)]
    got = [tuple(r) for r in user_top_terms(_frame(spark, rows), k).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)


JSONISH = st.one_of(
    st.binary(max_size=40),
    st.text(max_size=40),
    st.builds(
        lambda u, s, t: __import__("json").dumps({"user_id": u, "search": s, "timestamp": t, "region": s}),
        st.one_of(st.none(), st.integers(), st.floats(allow_nan=False), st.text(max_size=5)),
        st.one_of(st.none(), st.text(max_size=8), st.integers()),
        st.one_of(st.none(), st.text(max_size=25), st.integers(), st.floats(allow_nan=False)),
    ),
)


@SETTINGS
@given(texts=st.lists(st.one_of(st.none(), JSONISH), max_size=12), barrier=st.booleans())
def test_decoding_never_fails_and_keeps_every_message(spark, texts, barrier):
    from conftest import messages

    from querytrail.functions import decode, event_time_from_millis, with_event_time
    from querytrail.schemas import EVENT, LOG

    spark.conf.set("spark.sql.ansi.enabled", "true")
    msgs = messages(spark, texts)
    events = with_event_time(decode(msgs, EVENT, barrier=barrier))
    logs = event_time_from_millis(decode(msgs, LOG, barrier=barrier))
    # evaluate every expression on every row without converting to Python
    # (Spark timestamps reach years Python's datetime cannot hold)
    events.write.format("noop").mode("overwrite").save()
    logs.write.format("noop").mode("overwrite").save()
    assert events.count() == len(texts) and logs.count() == len(texts)
    from querytrail.operators import hourly_counts, trending_topk

    for out in (trending(events, sort=False), trending_topk(events, 2), hourly_counts(events), top_k(events, "search", 3)):
        out.write.format("noop").mode("overwrite").save()
