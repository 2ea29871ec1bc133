import datetime as dt
import json
import os

import pytest
from conftest import SF_SMALL

from querytrail.functions import decode, with_event_time
from querytrail.operators import keyword_filter, trending
from querytrail.schemas import EVENT
from querytrail.sinks import SinkConfig, append_batches, read_batches, replace_each_batch
from querytrail.sources import events_wire, load_table, stream_topic_files, write_topic_files
from querytrail.streaming import latest_window_counts, live_counts, live_trending, run_to_end, start, to_console

DRAIN = {"availableNow": True}


def _topic(spark, scratch, n_files=3):
    msgs = events_wire(load_table(spark, SF_SMALL, "events"))
    return write_topic_files(msgs, os.path.join(scratch, "topic"), files=n_files)


def _hits(stream_or_batch):
    return with_event_time(keyword_filter(decode(stream_or_batch, EVENT), "search", "sign"))


def _run(df, scratch, name, ckpt="ckpt", mode="append", sink_fn=append_batches):
    sink = SinkConfig(root=scratch)
    q = start(df, os.path.join(scratch, ckpt), mode=mode, trigger=DRAIN, foreach_batch=sink_fn(name, sink))
    run_to_end(q, 300)
    return sink, q


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stream_equals_batch(spark, scratch):
    topic = _topic(spark, scratch)
    stream = _hits(stream_topic_files(spark, topic, max_files_per_trigger=1))
    sink, q = _run(stream, scratch, "hits")
    assert q.lastProgress is not None
    batch_ids = {r.batch_id for r in read_batches(spark, "hits", sink, keep_batch_id=True).select("batch_id").distinct().collect()}
    assert len(batch_ids) >= 3  # one file per trigger -> several micro-batches
    batch = _hits(spark.read.parquet(topic))
    assert _rows(read_batches(spark, "hits", sink)) == _rows(batch)


def test_restart_same_checkpoint_adds_nothing(spark, scratch):
    topic = _topic(spark, scratch)
    stream = _hits(stream_topic_files(spark, topic, max_files_per_trigger=1))
    sink, _ = _run(stream, scratch, "hits")
    n = read_batches(spark, "hits", sink).count()
    _run(stream, scratch, "hits")  # same checkpoint: nothing new
    assert read_batches(spark, "hits", sink).count() == n


def test_new_checkpoint_cannot_take_over_an_output(spark, scratch):
    topic = _topic(spark, scratch)
    stream = _hits(stream_topic_files(spark, topic, max_files_per_trigger=1))
    sink = SinkConfig(root=scratch)
    first = os.path.join(scratch, "ck-a")
    run_to_end(start(stream, first, trigger=DRAIN, foreach_batch=append_batches("hits", sink, owner=first)), 300)
    n = read_batches(spark, "hits", sink).count()
    # the same checkpoint may come back ...
    run_to_end(start(stream, first, trigger=DRAIN, foreach_batch=append_batches("hits", sink, owner=first)), 300)
    # ... another one may not: its batch ids restart at 0
    other = os.path.join(scratch, "ck-b")
    with pytest.raises(Exception, match="belongs to the stream"):
        run_to_end(start(stream, other, trigger=DRAIN, foreach_batch=append_batches("hits", sink, owner=other)), 300)
    assert read_batches(spark, "hits", sink).count() == n


def test_live_trending_complete_equals_batch(spark, scratch):
    topic = _topic(spark, scratch)
    stream = with_event_time(decode(stream_topic_files(spark, topic, max_files_per_trigger=1), EVENT))
    sink, _ = _run(live_trending(stream, "1 hour"), scratch, "w", mode="complete", sink_fn=replace_each_batch)
    batch = trending(with_event_time(decode(spark.read.parquet(topic), EVENT)), sort=False)
    assert _rows(read_batches(spark, "w", sink)) == _rows(batch)


def test_live_trending_append_emits_closed_windows_only(spark, scratch):
    base = dt.datetime(2024, 1, 1)
    topic = os.path.join(scratch, "ordered")
    # three files in event-time order, one per micro-batch
    for i, minute in enumerate([0, 40, 200]):
        msg = json.dumps({"user_id": 1, "search": "a", "timestamp": (base + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ")})
        spark.createDataFrame([(bytearray(msg.encode()),)], "value binary").coalesce(1).write.mode("append").parquet(topic)
    stream = with_event_time(decode(stream_topic_files(spark, topic, 1), EVENT))
    sink, _ = _run(live_trending(stream, "10 minutes"), scratch, "w", mode="append")
    got = sorted(r.start_time.replace(tzinfo=None) for r in read_batches(spark, "w", sink).collect())
    # the window holding the last event is still open when the stream ends
    assert got == [base, base + dt.timedelta(minutes=30)]


def test_live_trending_update_mode_latest_counts(spark, scratch):
    base = dt.datetime(2024, 1, 1)
    topic = os.path.join(scratch, "ordered")
    for minute in [0, 5, 40]:
        msg = json.dumps({"user_id": 1, "search": "a", "timestamp": (base + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ")})
        spark.createDataFrame([(bytearray(msg.encode()),)], "value binary").coalesce(1).write.mode("append").parquet(topic)
    stream = with_event_time(decode(stream_topic_files(spark, topic, 1), EVENT))
    sink, _ = _run(live_trending(stream, "1 hour"), scratch, "w", mode="update")
    out = read_batches(spark, "w", sink, keep_batch_id=True).collect()
    latest = {}
    for r in sorted(out, key=lambda r: r.batch_id):
        latest[r.start_time.replace(tzinfo=None)] = r["count"]
    # every batch re-emits the windows it changed; the newest version is exact
    assert latest == {base: 2, base + dt.timedelta(minutes=30): 1}
    assert len(out) == 3
    final = latest_window_counts(read_batches(spark, "w", sink))
    assert sorted((r.start_time.replace(tzinfo=None), r["count"]) for r in final.collect()) == sorted(latest.items())


def test_watermark_required(spark, scratch):
    stream = stream_topic_files(spark, _topic(spark, scratch))
    with pytest.raises(ValueError):
        live_trending(with_event_time(decode(stream, EVENT)), "")


def test_live_matrix_takes_new_terms(spark, scratch):
    from querytrail.operators import pivot_counts, pivot_pairs
    from querytrail.streaming import latest_counts

    topic = os.path.join(scratch, "t")
    batches = [[(1, "a"), (1, "a"), (2, "b")], [(1, "new"), (2, "b")], [(3, None), (1, "a"), (1, "A")]]
    for rows in batches:
        msgs = [(bytearray(json.dumps({"user_id": u, "search": t}).encode()),) for u, t in rows]
        spark.createDataFrame(msgs, "value binary").coalesce(1).write.mode("append").parquet(topic)
    stream = decode(stream_topic_files(spark, topic, 1), EVENT)
    sink, _ = _run(live_counts(stream, "user_id", "search"), scratch, "m", mode="update")
    appended = read_batches(spark, "m", sink, keep_batch_id=True)
    assert appended.select("batch_id").distinct().count() == 3
    live = pivot_pairs(latest_counts(appended, ["user_id", "search"]))
    batch = pivot_counts(decode(spark.read.parquet(topic), EVENT))
    assert live.columns == batch.columns == ["user_id", "null", "A", "a_2", "b", "new"]
    assert _rows(live) == _rows(batch)


def test_empty_streams_give_no_rows(spark, scratch):
    from querytrail.plans import catalog as C

    os.makedirs(os.path.join(scratch, "in"))
    load_table(spark, SF_SMALL, "events").limit(0).write.parquet(os.path.join(scratch, "in", "events.parquet"))
    for name in ("stream_keyword", "stream_decode", "live_trending", "live_trending_update", "stream_user_pivot", "job_keyword_stream", "append_table"):
        assert C.QUERIES[name](spark, os.path.join(scratch, "in")).count() == 0, name


@pytest.mark.parametrize("name", ["live_trending", "live_trending_update", "stream_user_pivot", "live_topk", "stream_deduplicated"])
def test_state_has_no_more_partitions_than_cores(spark, name, monkeypatch):
    from querytrail.plans import catalog as C

    ran = []
    monkeypatch.setattr(C, "run_to_end", lambda q, *a: ran.append(run_to_end(q, *a)))
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "23")
        assert C.QUERIES[name](spark, SF_SMALL).count() > 0
        assert spark.conf.get(key) == "23"
    finally:
        spark.conf.set(key, before)
    states = [s for p in ran[0].recentProgress for s in p.stateOperators]
    assert states and {s.numShufflePartitions for s in states} == {spark.sparkContext.defaultParallelism}


def test_batches_grow_in_number_not_in_size(spark, scratch):
    msgs = events_wire(load_table(spark, SF_SMALL, "events"))
    n = msgs.count()
    for times in (1, 4):
        wide = msgs
        for _ in range(times - 1):
            wide = wide.unionAll(msgs)
        topic = write_topic_files(wide.coalesce(1), os.path.join(scratch, f"t{times}"), rows_per_file=100)
        sink, q = _run(decode(stream_topic_files(spark, topic, 2), EVENT), scratch, f"o{times}", ckpt=f"c{times}")
        sizes = [r["count"] for r in read_batches(spark, f"o{times}", sink, keep_batch_id=True).groupBy("batch_id").count().collect()]
        assert max(sizes) <= 200 and sum(sizes) == n * times and len(sizes) == -(-n * times // 200)


def test_streaming_pivot_needs_values(spark, scratch):
    from querytrail.operators import pivot_counts

    stream = decode(stream_topic_files(spark, _topic(spark, scratch)), EVENT)
    with pytest.raises(ValueError):
        pivot_counts(stream)


def test_console_sink_runs(spark, scratch, capsys):
    stream = with_event_time(decode(stream_topic_files(spark, _topic(spark, scratch, 1)), EVENT))
    q = to_console(stream, os.path.join(scratch, "c"), trigger=DRAIN, rows=2)
    run_to_end(q, 300)
    assert q.exception() is None


def test_checkpoint_required(spark, scratch):
    stream = stream_topic_files(spark, _topic(spark, scratch))
    with pytest.raises(ValueError):
        start(stream, "")


def test_file_sink_stream(spark, scratch):
    topic = _topic(spark, scratch)
    stream = _hits(stream_topic_files(spark, topic, 1))
    out = os.path.join(scratch, "files_out")
    q = start(stream, os.path.join(scratch, "fck"), trigger=DRAIN, fmt="parquet", path=out, query_name="qt_file_sink")
    run_to_end(q, 300)
    assert q.name == "qt_file_sink"
    assert _rows(spark.read.parquet(out)) == _rows(_hits(spark.read.parquet(topic)))
