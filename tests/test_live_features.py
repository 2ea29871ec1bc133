"""Live top-k, repeated messages, quarantine, supervision and state stores."""

import datetime as dt
import json
import os
import threading

import pytest
from conftest import SF_SMALL, messages
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from querytrail.functions import decode, route, with_event_time
from querytrail.operators import trending_topk
from querytrail.schemas import EVENT
from querytrail.sinks import SinkConfig, append_batches, read_batches, read_table, split_batches
from querytrail.sources import events_wire, load_table, read_topic_files, stream_topic_files, write_topic_files
from querytrail.streaming import (
    GaveUp,
    ProgressListener,
    Restarts,
    distinct_messages,
    latest_topk,
    live_topk,
    live_trending,
    message_digest,
    run_to_end,
    start,
    state_store,
    supervise,
)

DRAIN = {"availableNow": True}
BASE = dt.datetime(2024, 1, 1)


def _event(minute, search, user=1, **more):
    time = (BASE + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ") if minute is not None else None
    return json.dumps({"user_id": user, "search": search, "timestamp": time, **more})


def _files(spark, topic, batches):
    """One file for each list of messages, in this order."""
    for texts in batches:
        messages(spark, texts).coalesce(1).write.mode("append").parquet(topic)
    return topic


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- live top-k ---------------------------------------------------------------

BATCHES = [
    [_event(1, "a"), _event(2, "a"), _event(3, "b"), _event(40, None), _event(None, "a"), "junk"],
    [_event(4, "c"), _event(5, "c"), _event(6, "c"), _event(7, "b"), _event(41, "z"), _event(42, "é")],
    [_event(8, "d"), _event(9, "b"), _event(10, "b"), _event(43, None), _event(44, "é"), _event(45, "zz")],
]


@pytest.mark.parametrize("k,buckets", [(1, 1), (2, 1), (3, 4)])
def test_live_topk_equals_the_batch_ranking(spark, scratch, k, buckets):
    topic = _files(spark, os.path.join(scratch, "topic"), BATCHES)
    stream = with_event_time(decode(stream_topic_files(spark, topic, 1), EVENT))
    sink, checkpoint = SinkConfig(root=scratch, snapshots=True), os.path.join(scratch, "ck")
    top = live_topk(stream, "1000 days", k, buckets=buckets)
    run_to_end(start(top, checkpoint, mode="update", trigger=DRAIN, foreach_batch=append_batches("top", sink, owner=checkpoint), state="rocksdb"), 300)
    want = trending_topk(with_event_time(decode(read_topic_files(spark, topic), EVENT)), k)
    got = latest_topk(read_batches(spark, "top", sink), k)
    assert got.columns == want.columns == ["start_time", "end_time", "search", "count", "rank"]
    assert _rows(got) == _rows(want)


def test_live_topk_now_restart_and_late_rows(spark, scratch):
    topic = _files(spark, os.path.join(scratch, "topic"), BATCHES[:2])
    sink, checkpoint = SinkConfig(root=scratch, snapshots=True), os.path.join(scratch, "ck")

    def run():
        top = live_topk(with_event_time(decode(stream_topic_files(spark, topic, 1), EVENT)), "5 minutes", 2, buckets=1)
        run_to_end(start(top, checkpoint, mode="update", trigger=DRAIN, foreach_batch=append_batches("top", sink, owner=checkpoint), state="rocksdb"), 300)
        found = latest_topk(read_batches(spark, "top", sink), 2)
        return [(r.start_time.replace(tzinfo=None), r.search, r["count"]) for r in found.orderBy("start_time", "rank").collect()]

    half = BASE + dt.timedelta(minutes=30)
    # Batch 1 raised the watermark to 35 minutes, so the first window is closed when batch 2 comes.
    assert run() == [(BASE, "a", 2), (BASE, "b", 1), (half, None, 1), (half, "z", 1)]
    _files(spark, topic, BATCHES[2:])
    assert run() == [(BASE, "a", 2), (BASE, "b", 1), (half, None, 2), (half, "é", 2)]


def test_live_topk_arguments(spark, scratch):
    stream = with_event_time(decode(stream_topic_files(spark, _files(spark, os.path.join(scratch, "t"), BATCHES)), EVENT))
    for bad in ({"watermark": ""}, {"watermark": "1 hour", "k": 0}, {"watermark": "1 hour", "buckets": 0}):
        with pytest.raises(ValueError):
            live_topk(stream, **bad)


# --- repeated messages --------------------------------------------------------


def test_repeats_in_one_and_in_two_batches_count_once(spark, scratch):
    schema = EVENT.add("id", "long") if "id" not in EVENT.names else EVENT
    sent = [_event(i, "a", id=i) for i in range(6)]
    topic = _files(spark, os.path.join(scratch, "topic"), [sent[:3] + sent[:2], sent[2:] + sent[:1], sent])
    stream = with_event_time(decode(stream_topic_files(spark, topic, 1), schema))
    sink = SinkConfig(root=scratch, snapshots=True)
    once = distinct_messages(stream, ["id"], "timestamp_dt", "1 day")
    run_to_end(start(once, os.path.join(scratch, "ck"), trigger=DRAIN, foreach_batch=append_batches("once", sink)), 300)
    assert sorted(r.id for r in read_batches(spark, "once", sink).collect()) == list(range(6))
    static = distinct_messages(with_event_time(decode(read_topic_files(spark, topic), schema)), ["id"], "timestamp_dt", "1 day")
    assert sorted(r.id for r in static.collect()) == list(range(6))


def test_the_state_of_repeats_is_bounded_by_the_span(spark, scratch):
    batches = [[_event(60 * hour + m, "a", user=m) for m in range(20)] for hour in range(12)]
    topic = _files(spark, os.path.join(scratch, "topic"), batches)
    stream = with_event_time(decode(stream_topic_files(spark, topic, 1).withColumn("key", message_digest()), EVENT, keep=["key"]))
    query = start(distinct_messages(stream, ["key"], "timestamp_dt", "2 hours"), os.path.join(scratch, "ck"), trigger=DRAIN, fmt="noop")
    run_to_end(query, 300)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 20 * 5 and sum(p["numInputRows"] for p in query.recentProgress) == 240


def test_an_endless_span_never_reads_the_whole_state(spark, scratch):
    years = [(1, 1969), (2, 2024), (3, 9999), (4, 1971), (5, 2200)]
    sent = [json.dumps({"user_id": 1, "search": "a", "timestamp": f"{y}-01-01T00:00:00Z", "id": i}) for i, y in years]
    topic = _files(spark, os.path.join(scratch, "topic"), [sent[:3], sent[2:], sent, sent[::-1]])
    schema = StructType([*(f for f in EVENT.fields if f.name != "id"), StructField("id", LongType())])
    stream = with_event_time(decode(stream_topic_files(spark, topic, 1), schema))
    sink = SinkConfig(root=scratch, snapshots=True)
    read, rows = {}, {}
    for span in ("36500 days", "100 years", "2 hours"):
        once = distinct_messages(stream, ["id"], "timestamp_dt", span)
        checkpoint = os.path.join(scratch, f"ck {span}")
        query = run_to_end(start(once, checkpoint, trigger=DRAIN, foreach_batch=append_batches(span, sink), state="rocksdb"), 300)
        states = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
        read[span] = sum(m["rocksdbTotalBytesReadThroughIterator"] for m in states)
        rows[span] = sorted(r.id for r in read_batches(spark, span, sink).collect())
    # a short span's state is read to free what has expired; no message is late for an endless one
    assert read["2 hours"] > 0 == read["36500 days"] == read["100 years"]
    assert rows["36500 days"] == rows["100 years"] == [1, 2, 3, 4, 5]


def test_digests_rows_without_time_and_arguments(spark):
    df = messages(spark, [_event(1, "a"), _event(1, "a"), _event(2, "a"), _event(None, "a"), "junk"]).withColumn("key", message_digest())
    timed = with_event_time(decode(df, EVENT, keep=["key"]))
    assert distinct_messages(timed, ["key"], "timestamp_dt", "1 day").count() == 2
    for keys, within in (([], "1 day"), (["key"], "")):
        with pytest.raises(ValueError):
            distinct_messages(timed, keys, "timestamp_dt", within)


# --- quarantine ---------------------------------------------------------------

ODD = {
    None: "missing", b"\xff\xfe{": "not utf-8", "junk": "not json", "": "not json", "  ": "not json", '{"user_id":1,': "not json", "{a}": "not json",
    "[1]": "not an object", "3": "not an object", "null": "not an object", '"text"': "not an object",
    '{"user_id":"x","search":"a"}': "bad fields", '{"user_id":99999999999}': "bad fields", "{}": "no known field", '{"x":1}': "no known field",
    ' \n{"search":null}': "no known field", '{"user_id":1}': None, '\t{"user_id":1,"search":"a","extra":{"b":[1]}}': None, '{"search":5}': None,
}


def test_reasons(spark):
    routed = route(messages(spark, list(ODD)), EVENT)
    key = lambda v: v if v is None else bytes(v)
    want = {k.encode() if isinstance(k, str) else k: v for k, v in ODD.items()}
    assert {key(r.value): r.reason for r in routed.rows.collect()} == want
    assert {key(r.value): r.reason for r in routed.bad().collect()} == {k: v for k, v in want.items() if v}
    good = [k for k, v in ODD.items() if v is None]
    assert _rows(routed.good()) == _rows(decode(messages(spark, good), EVENT))


def test_good_and_bad_make_up_what_was_read(spark, scratch):
    texts = [t for t in ODD] + [_event(i, "a") for i in range(50)]
    seen = Observation()
    routed = route(messages(spark, texts).withColumn("offset", F.monotonically_increasing_id()), EVENT, keep=["offset"]).counted(seen)
    routed.rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"read": len(texts), "good": 53, "bad": len(ODD) - 3}
    plan = routed.good().where("search = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    with pytest.raises(ValueError):
        route(messages(spark, texts).withColumn("search", F.lit(1)), EVENT, keep=["search"])


def test_a_stream_with_two_outputs(spark, scratch):
    odd = list(ODD)
    topic = _files(spark, os.path.join(scratch, "topic"), [odd[:9] + [_event(1, "a")], odd[9:], [_event(2, "b")]])
    sink, checkpoint = SinkConfig(root=scratch, snapshots=True), os.path.join(scratch, "ck")
    routed = route(stream_topic_files(spark, topic, 1), EVENT)
    good, bad = (append_batches(n, sink, owner=checkpoint) for n in ("good", "bad"))
    failed = []

    def once_cut(df, batch):
        if batch == 1 and not failed:
            failed.append(batch)
            raise RuntimeError("between the outputs")
        bad(df, batch)

    begin = lambda: start(routed.rows, checkpoint, trigger=DRAIN, foreach_batch=split_batches(routed, good, once_cut))
    supervise(spark, begin, Restarts(wait_s=0.01))
    assert failed and read_table(spark, "good", sink).count() == 5 and read_table(spark, "bad", sink).count() == len(ODD) - 3


# --- supervision --------------------------------------------------------------


def test_a_failing_query_restarts_and_reports_late_rows(spark, scratch):
    times = [[0, 1], [100], [101], [2], [102], [3], [300], [301]]
    topic = _files(spark, os.path.join(scratch, "topic"), [[_event(m, "a") for m in ts] for ts in times])
    stream = with_event_time(decode(stream_topic_files(spark, topic, 1), EVENT))
    sink, checkpoint = SinkConfig(root=scratch, snapshots=True), os.path.join(scratch, "ck")
    write = append_batches("w", sink, owner=checkpoint)
    failed, reports = [], []

    def failing(df, batch):
        write(df, batch)
        if batch in (1, 4) and batch not in failed:
            failed.append(batch)
            raise RuntimeError("worker is gone")

    listener = ProgressListener(lambda query, progress: reports.append(progress.last_batch))
    spark.streams.addListener(listener)
    try:
        done = supervise(spark, lambda: start(live_trending(stream, "10 minutes"), checkpoint, trigger=DRAIN, foreach_batch=failing), Restarts(wait_s=0.01), listener)
    finally:
        spark.streams.removeListener(listener)
    assert failed == [1, 4] and len(done.failures) == 2 and "worker is gone" in done.failures[0]
    assert done.late_rows == 2  # minutes 2 and 3: the first window was closed
    assert reports and done.watermark is not None
    # Closed windows, each once, though two batches were replayed.
    got = {(r.start_time.replace(tzinfo=None) - BASE).seconds // 60: r["count"] for r in read_batches(spark, "w", sink).collect()}
    assert got == {0: 2, 90: 3} and read_batches(spark, "w", sink).count() == 2


def test_restarts_are_bounded(spark, scratch):
    topic = _files(spark, os.path.join(scratch, "topic"), BATCHES)
    starts = []

    def begin():
        starts.append(1)

        def fail(df, batch):
            raise RuntimeError("always")

        return start(decode(stream_topic_files(spark, topic, 1), EVENT), os.path.join(scratch, "ck"), trigger=DRAIN, foreach_batch=fail)

    with pytest.raises(GaveUp):
        supervise(spark, begin, Restarts(most=2, wait_s=0.01))
    assert len(starts) == 3
    assert [Restarts(wait_s=1, longest_s=5).wait(n) for n in (1, 2, 3, 4, 9)] == [1, 2, 4, 5, 5]


def test_a_running_query_is_stopped(spark, scratch):
    topic = _files(spark, os.path.join(scratch, "topic"), BATCHES)
    stop, rows = threading.Event(), []

    def seen(df, batch):
        rows.append(df.count())
        if sum(rows) >= 18:
            stop.set()

    stream = decode(stream_topic_files(spark, topic, 1), EVENT)
    done = supervise(spark, lambda: start(stream, os.path.join(scratch, "ck"), foreach_batch=seen), stop=stop)
    assert sum(rows) == 18 and done.failures == []


# --- state stores -------------------------------------------------------------


def test_state_store_settings_are_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with state_store(spark, "rocksdb"):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before
    with pytest.raises(ValueError):
        with state_store(spark, "tape"):
            pass


def test_many_keys_in_rocksdb_and_a_restart(spark, scratch):
    """The same rows as in the default store, over a restart, for more keys
    than the test's micro-batches hold."""
    rows = spark.range(60_000).select(F.to_json(F.struct((F.col("id") % 30_000).cast("int").alias("user_id"), F.lit("a").alias("search"))).cast("binary").alias("value"))
    topic = write_topic_files(rows, os.path.join(scratch, "topic"), rows_per_file=10_000)
    counts = decode(stream_topic_files(spark, topic, 2), EVENT).groupBy("user_id").count()
    sink, checkpoint = SinkConfig(root=scratch, snapshots=True), os.path.join(scratch, "ck")

    def run():
        query = start(counts, checkpoint, mode="update", trigger=DRAIN, foreach_batch=append_batches("n", sink, owner=checkpoint), state="rocksdb")
        run_to_end(query, 300)
        return query

    first = run()
    state = [s for p in first.recentProgress for s in p["stateOperators"]]
    assert any("rocksdb" in name.lower() for name in state[-1]["customMetrics"]) and state[-1]["numRowsTotal"] >= 30_000
    write_topic_files(rows.limit(100), topic)
    run()
    newest = read_batches(spark, "n", sink).groupBy("user_id").agg(F.max("count").alias("n"))
    assert newest.count() == 30_000 and newest.agg(F.sum("n")).first()[0] == 60_100


def test_events_of_the_small_table(spark, scratch):
    """All events, sent twice, some broken: the ranking is that of the table."""
    events = events_wire(load_table(spark, SF_SMALL, "events"))
    routed = route(events.unionAll(messages(spark, ["junk", None])), EVENT)
    assert routed.good().count() == events.count() and routed.bad().count() == 2
