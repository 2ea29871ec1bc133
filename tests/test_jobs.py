import json
import os

import pytest
from pyspark.errors import AnalysisException
from conftest import SF_SMALL, messages

from querytrail.functions import decode
from querytrail.operators import top_k
from querytrail.plans import decode_stream, keyword_tracker_stream, publish_job, top_searches_job, trending_job, user_pivot_job, user_terms_job
from querytrail.plans.jobs import KEYWORD_HITS, TOP_REGIONS, TOP_SEARCHES, TRENDING, USER_PIVOT, USER_TERMS, top_counts
from querytrail.schemas import LOG
from querytrail.sinks import SinkConfig, read_batches
from querytrail.sources import events_wire, load_table, parts_wire, stream_topic_files, write_topic_files
from querytrail.streaming import run_to_end


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_top_counts_single_scan_matches_separate_top_k(spark):
    msgs = parts_wire(load_table(spark, SF_SMALL, "part"))
    d = decode(msgs, LOG)
    agg, tops, total = top_counts(d, ["region", "search"], 10)
    assert _rows(tops["region"]) == _rows(top_k(d, "region", 10))
    assert _rows(tops["search"]) == _rows(top_k(d, "search", 10))
    assert total.collect()[0]["count"] == d.count()
    assert agg.count() <= 2 * 10 + 1
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan


def test_top_counts_null_keys(spark):
    msgs = messages(spark, ['{"search":"a","region":null}', '{"search":null,"region":"r"}', "junk"])
    _, tops, total = top_counts(decode(msgs, LOG), ["region", "search"], 10)
    assert _rows(tops["region"]) == sorted([(None, 2), ("r", 1)], key=str)
    assert _rows(tops["search"]) == sorted([(None, 2), ("a", 1)], key=str)
    assert total.collect()[0]["count"] == 3


def test_top_searches_job(spark, scratch):
    sink = SinkConfig(root=scratch)
    res = top_searches_job(parts_wire(load_table(spark, SF_SMALL, "part")), sink)
    assert res.status == {TOP_REGIONS: "ok", TOP_SEARCHES: "ok"}
    assert res.rows == load_table(spark, SF_SMALL, "part").count()
    assert spark.read.parquet(os.path.join(scratch, TOP_SEARCHES)).count() == 10


def test_user_pivot_job(spark, scratch):
    sink = SinkConfig(root=scratch)
    res = user_pivot_job(events_wire(load_table(spark, SF_SMALL, "events")), sink, fill_key=True)
    out = spark.read.parquet(os.path.join(scratch, USER_PIVOT))
    assert out.columns[0] == "user_id" and len(out.columns) == 6
    assert res.status[USER_PIVOT] == "ok"
    assert res.rows == load_table(spark, SF_SMALL, "events").count()


TERMS = ["Maske", "maske", None, "null", "user_id", "", "x.y"]


def _term_messages(spark, n=1):
    return messages(spark, [json.dumps({"user_id": u, "search": t}) for u in (1, 2, None) for t in TERMS[:7] + [f"t{i}" for i in range(n)]])


@pytest.mark.parametrize("n", [1, 58, 63])
def test_user_pivot_job_on_real_terms(spark, scratch, n):
    sink = SinkConfig(root=scratch)
    res = user_pivot_job(_term_messages(spark, n), sink)
    out = spark.read.parquet(os.path.join(scratch, USER_PIVOT))
    assert len(out.columns) == 8 + n and res.rows == 3 * (7 + n)
    assert sorted(str(r["user_id"]) for r in out.collect()) == ["1", "2", "None"]
    assert all(list(r)[1:] == [1] * (7 + n) for r in out.collect())


def test_user_pivot_job_with_values_loses_no_message(spark, scratch):
    res = user_pivot_job(_term_messages(spark), SinkConfig(root=scratch), values=["Maske"])
    out = spark.read.parquet(os.path.join(scratch, USER_PIVOT))
    assert out.columns == ["user_id", "Maske", "other"] and res.rows == 24
    assert sum(r["Maske"] + r["other"] for r in out.collect()) == 24


def test_user_pivot_job_limit_and_long_form(spark, scratch):
    sink = SinkConfig(root=scratch)
    with pytest.raises(ValueError, match="max_values"):
        user_pivot_job(_term_messages(spark), sink, max_values=5)
    user_terms_job(_term_messages(spark), sink)
    out = spark.read.parquet(os.path.join(scratch, USER_TERMS))
    assert out.columns == ["user_id", "search", "count"] and out.count() == 24


def test_top_counts_beyond_the_group_limit(spark):
    msgs = messages(spark, [json.dumps({"search": f"s{i % 1500}", "region": f"r{i % 1200}"}) for i in range(4000)])
    d = decode(msgs, LOG)
    small, tops, _ = top_counts(d, ["region", "search"], 1001)
    assert _rows(tops["search"]) == _rows(top_k(d, "search", 1001)) and tops["region"].count() == 1001
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") + plan.count("Window[") >= 2 and "xxhash64" in plan


def test_trending_job(spark, scratch):
    sink = SinkConfig(root=scratch)
    res = trending_job(events_wire(load_table(spark, SF_SMALL, "events")), sink, preview=True)
    out = spark.read.parquet(os.path.join(scratch, TRENDING))
    assert out.columns == ["start_time", "end_time", "search", "count"]
    assert out.agg({"count": "sum"}).collect()[0][0] == load_table(spark, SF_SMALL, "events").count()
    assert "RangePartitioning" not in res.outputs[TRENDING]._jdf.queryExecution().executedPlan().toString()
    res = trending_job(events_wire(load_table(spark, SF_SMALL, "events")), sink, sort_output=True)
    counts = [r["count"] for r in res.outputs[TRENDING].collect()]
    assert counts == sorted(counts, reverse=True)


def test_keyword_tracker_and_decode_streams(spark, scratch):
    msgs = events_wire(load_table(spark, SF_SMALL, "events"))
    topic = write_topic_files(msgs, os.path.join(scratch, "topic"), files=3)
    sink = SinkConfig(root=scratch)
    q = keyword_tracker_stream(stream_topic_files(spark, topic, 1), sink, os.path.join(scratch, "ck"), keywords=("SIGN",), trigger={"availableNow": True})
    run_to_end(q, 300)
    hits = read_batches(spark, KEYWORD_HITS, sink)
    assert hits.count() > 0 and {r.search for r in hits.select("search").distinct().collect()} == {"signup"}
    q2 = decode_stream(stream_topic_files(spark, topic, 1), os.path.join(scratch, "ck2"), trigger={"availableNow": True})
    run_to_end(q2, 300)
    assert sum(p["numInputRows"] for p in q2.recentProgress) == load_table(spark, SF_SMALL, "events").count()


def test_default_triggers_of_the_stream_jobs(spark, scratch):
    """T2 (10 s, the tracker's default) and T3 (no trigger, the decoder's)."""
    topic = write_topic_files(events_wire(load_table(spark, SF_SMALL, "events")), os.path.join(scratch, "topic"), files=3)
    sink = SinkConfig(root=scratch)
    q = keyword_tracker_stream(stream_topic_files(spark, topic, 3), sink, os.path.join(scratch, "ck"), keywords=("sign",))
    q2 = decode_stream(stream_topic_files(spark, topic, 3), os.path.join(scratch, "ck2"))
    try:
        q.processAllAvailable()
        q2.processAllAvailable()
    finally:
        q.stop()
        q2.stop()
    assert read_batches(spark, KEYWORD_HITS, sink).count() == load_table(spark, SF_SMALL, "events").filter("event_type like '%sign%'").count()
    assert sum(p["numInputRows"] for p in q2.recentProgress) == load_table(spark, SF_SMALL, "events").count()


def test_publish_without_kafka_jar_fails(spark):
    df = spark.createDataFrame([(1, "a")], "user_id int, search string")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        publish_job(df, "t", "localhost:1")


def test_cached_only_when_asked(spark):
    from querytrail.plans import cached

    df = spark.range(3)
    with cached(df, when=False) as d:
        assert not d.is_cached
    with cached(df) as d:
        assert d.is_cached
    assert not df.is_cached


def test_top_searches_job_drop_malformed(spark, scratch):
    sink = SinkConfig(root=scratch)
    msgs = messages(spark, ['{"search":"a","region":"r"}', "junk", "junk", "junk"])
    kept = top_searches_job(msgs, sink, drop_malformed=True)
    assert kept.rows == 1
    assert top_searches_job(msgs, sink).rows == 4


def test_previews_show_rows_and_schema(spark, scratch, capsys):
    """K8 and K9: what the jobs print with ``preview``."""
    sink = SinkConfig(root=scratch)
    logs = messages(spark, ['{"search":"a","region":"Bursa"}', '{"search":"a","region":"Ankara"}'])
    top_searches_job(logs, sink, preview=True)
    out = capsys.readouterr().out
    assert "|Bursa " in out and "|a     |2    |" in out
    events = messages(spark, ['{"user_id":7,"search":"telefon","timestamp":"2024-01-01T10:05:00Z"}'])
    user_pivot_job(events, sink, preview=True)
    out = capsys.readouterr().out
    assert " |-- user_id: integer (nullable = true)" in out and " |-- timestamp: timestamp (nullable = true)" in out
    assert "|user_id|telefon|" in out and "|7      |1      |" in out
    trending_job(events, sink, preview=True)
    assert "|2024-01-01 10:00:00|2024-01-01 10:30:00|telefon|1    |" in capsys.readouterr().out
