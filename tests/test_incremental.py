"""Runs over a growing topic against one run over all of it."""

import json
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from querytrail.plans import incremental as I
from querytrail.plans.jobs import TOP_REGIONS, TOP_SEARCHES, TRENDING, USER_PIVOT, USER_TERMS, top_searches_job, trending_job, user_pivot_job, user_terms_job
from querytrail.sinks import OutputOwnedElsewhere, SinkConfig, SnapshotTable, Store, read_table
from querytrail.sources import events_wire, load_table, parts_wire, read_topic_files, stream_topic_files, write_topic_files


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _halves(spark, table, wire):
    rows = wire(load_table(spark, SF_SMALL, table)).withColumn("h", F.xxhash64("value") % 2)
    return rows.where("h = 0"), rows.where("h <> 0")


JOBS = {
    "top": ("part", parts_wire, I.top_searches_incremental, top_searches_job, [TOP_REGIONS, TOP_SEARCHES], I.LOG_VALUES),
    "terms": ("events", events_wire, I.user_terms_incremental, user_terms_job, [USER_TERMS], I.USER_TERM_PAIRS),
    "pivot": ("events", events_wire, I.user_pivot_incremental, user_pivot_job, [USER_PIVOT], I.USER_TERM_PAIRS),
    "trending": ("events", events_wire, I.trending_incremental, trending_job, [TRENDING], I.window_terms()),
}


@pytest.mark.parametrize("job", sorted(JOBS))
def test_two_runs_equal_one_and_read_new_files_only(spark, scratch, job, monkeypatch):
    table, wire, incremental, whole, names, counts = JOBS[job]
    topic, checkpoint = os.path.join(scratch, "topic"), os.path.join(scratch, "ck")
    sink, state = SinkConfig(root=os.path.join(scratch, "out"), snapshots=True), SinkConfig(root=os.path.join(scratch, "state"))
    read = []
    append = SnapshotTable.append

    def noted(self, df, stream=None, batch=None):
        read.append(batch)
        return append(self, df, stream, batch)

    monkeypatch.setattr(SnapshotTable, "append", noted)
    first, second = _halves(spark, table, wire)
    write_topic_files(first, topic, files=3)
    incremental(stream_topic_files(spark, topic, 2), sink, state, checkpoint)
    assert len(read) == 2  # three files, two at a time
    n = sum(r["count"] for r in counts.merged(I.state_table(spark, state, counts).read()).collect())
    assert n == first.count() * (2 if job == "top" else 1)
    write_topic_files(second, topic, files=1)
    incremental(stream_topic_files(spark, topic, 2), sink, state, checkpoint)
    assert len(read) == 3  # the one new file
    incremental(stream_topic_files(spark, topic, 2), sink, state, checkpoint)
    assert len(read) == 3  # nothing new: nothing read
    plain = SinkConfig(root=os.path.join(scratch, "whole"))
    whole(read_topic_files(spark, topic), plain)
    for name in names:
        assert _rows(read_table(spark, name, sink)) == _rows(read_table(spark, name, plain)), name


def test_the_second_run_scans_the_new_files(spark, scratch):
    """The files themselves, as the scan of each micro-batch names them."""
    topic = os.path.join(scratch, "topic")
    first, second = _halves(spark, "events", events_wire)
    seen = []

    def partial(messages):
        seen.append({r[0] for r in messages.select(F.input_file_name()).distinct().collect()})
        return I.USER_TERM_PAIRS.partial(messages)

    counts = I.replace(I.USER_TERM_PAIRS, partial=partial)
    state = SinkConfig(root=os.path.join(scratch, "state"))
    for half in (first, second):
        write_topic_files(half, topic, files=2)
        I.update_counts(stream_topic_files(spark, topic, 10), counts, state, os.path.join(scratch, "ck"))
    assert len(seen) == 2 and all(len(s) == 2 for s in seen) and not seen[0] & seen[1]


def test_a_run_that_died_counts_nothing_twice(spark, scratch, monkeypatch):
    topic, checkpoint = os.path.join(scratch, "topic"), os.path.join(scratch, "ck")
    events = events_wire(load_table(spark, SF_SMALL, "events"))
    write_topic_files(events, topic, files=3)
    state = SinkConfig(root=os.path.join(scratch, "state"))
    append, calls = SnapshotTable.append, []

    def dying(self, df, stream=None, batch=None):
        calls.append(batch)
        out = append(self, df, stream, batch)
        if len(calls) == 2:
            raise RuntimeError("executor and driver are gone")
        return out

    monkeypatch.setattr(SnapshotTable, "append", dying)
    with pytest.raises(Exception, match="gone"):
        I.update_counts(stream_topic_files(spark, topic, 1), I.USER_TERM_PAIRS, state, checkpoint)
    got = I.update_counts(stream_topic_files(spark, topic, 1), I.USER_TERM_PAIRS, state, checkpoint)
    assert calls == [0, 1, 2]  # batch 1 was committed: its replay is not counted
    assert _rows(got) == _rows(I.USER_TERM_PAIRS.partial(events))


def test_the_state_is_compacted_by_key(spark, scratch):
    topic, checkpoint = os.path.join(scratch, "topic"), os.path.join(scratch, "ck")
    state = SinkConfig(root=os.path.join(scratch, "state"))
    events = events_wire(load_table(spark, SF_SMALL, "events"))
    for _ in range(2):
        write_topic_files(events, topic, files=4)
        got = I.update_counts(stream_topic_files(spark, topic, 1), I.USER_TERM_PAIRS, state, checkpoint, compact_at=4)
    table = I.state_table(spark, state, I.USER_TERM_PAIRS)
    assert len(table.current().folders) == 1 and table.read().count() == got.count()
    assert len(Store(spark, table.path).entries("_data")) <= 1 + 5
    twice = events.unionAll(events)
    assert _rows(got) == _rows(I.USER_TERM_PAIRS.partial(twice))


def test_bad_messages_nulls_and_an_empty_topic(spark, scratch):
    topic = os.path.join(scratch, "topic")
    os.makedirs(topic)
    sink, state = SinkConfig(root=os.path.join(scratch, "out")), SinkConfig(root=os.path.join(scratch, "state"))
    res = I.top_searches_incremental(stream_topic_files(spark, topic), sink, state, os.path.join(scratch, "ck"))
    assert res.outputs[TOP_REGIONS].count() == 0 and read_table(spark, TOP_REGIONS, sink).count() == 0
    texts = ['{"search":"a","region":null}', "junk", '{"region":"r"}', '{"search":"a","region":"r"}']
    spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "value binary").write.mode("append").parquet(topic)
    I.top_searches_incremental(stream_topic_files(spark, topic), sink, state, os.path.join(scratch, "ck"))
    assert _rows(read_table(spark, TOP_REGIONS, sink)) == sorted([(None, 2), ("r", 2)], key=str)
    assert _rows(read_table(spark, TOP_SEARCHES, sink)) == sorted([(None, 2), ("a", 2)], key=str)


def test_late_windows_grow_and_widths_are_apart(spark, scratch):
    topic = os.path.join(scratch, "topic")
    state, sink = SinkConfig(root=os.path.join(scratch, "state")), SinkConfig(root=os.path.join(scratch, "out"), snapshots=True)
    for minute in (5, 500, 6):
        text = json.dumps({"user_id": 1, "search": "a", "timestamp": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z"})
        spark.createDataFrame([(bytearray(text.encode()),)], "value binary").write.mode("append").parquet(topic)
        for width in ("30 minutes", "1 hour"):
            I.trending_incremental(stream_topic_files(spark, topic), sink, state, os.path.join(scratch, f"ck {width}"), width=width)
    counts = [I.state_table(spark, state, I.window_terms(w)).read() for w in ("30 minutes", "1 hour")]
    assert [sorted(r["count"] for r in I.window_terms().merged(c).collect()) for c in counts] == [[1, 2], [1, 2]]


def test_one_state_belongs_to_one_checkpoint(spark, scratch):
    topic = write_topic_files(events_wire(load_table(spark, SF_SMALL, "events")), os.path.join(scratch, "topic"))
    state = SinkConfig(root=os.path.join(scratch, "state"))
    I.update_counts(stream_topic_files(spark, topic), I.USER_TERM_PAIRS, state, os.path.join(scratch, "a"))
    with pytest.raises(OutputOwnedElsewhere):
        I.update_counts(stream_topic_files(spark, topic), I.USER_TERM_PAIRS, state, os.path.join(scratch, "b"))
