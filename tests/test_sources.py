import os

import pytest
from pyspark.errors import AnalysisException
from conftest import SF_SMALL, messages

from querytrail.sources import (
    bootstrap_servers,
    events_wire,
    load_table,
    parts_wire,
    read_topic,
    read_topic_files,
    stream_topic_files,
    write_topic_files,
)
from querytrail.sources.topics import kafka_options


def test_servers_fallback(monkeypatch):
    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    assert bootstrap_servers() == "localhost:9092"
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "k:1")
    assert bootstrap_servers() == "k:1"
    assert bootstrap_servers("x:2") == "x:2"


def test_publish_options(monkeypatch):
    from querytrail.sinks.topic import publish_options

    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    assert publish_options("t") == {"kafka.bootstrap.servers": "localhost:9092", "topic": "t"}
    assert publish_options("t", "k:1")["kafka.bootstrap.servers"] == "k:1"


def test_kafka_options():
    opts = kafka_options("t", "s:1", "earliest", maxOffsetsPerTrigger=100)
    assert opts == {"kafka.bootstrap.servers": "s:1", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "100"}
    assert "startingOffsets" not in kafka_options("t", "s:1")


def test_kafka_reads_split_hot_partitions(spark):
    from querytrail.sources.topics import _split_hot_partitions

    assert _split_hot_partitions(spark, {})["minPartitions"] == str(spark.sparkContext.defaultParallelism)
    assert _split_hot_partitions(spark, {"minPartitions": "7"}) == {"minPartitions": "7"}


def test_kafka_source_without_jar_fails_loudly(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_topic(spark, "t", "localhost:1").schema


def test_file_topic_roundtrip(spark, scratch):
    msgs = messages(spark, ['{"a":1}', '{"a":2}', "junk"])
    path = write_topic_files(msgs, os.path.join(scratch, "topic"), files=3)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) >= 3
    back = read_topic_files(spark, path)
    assert back.dtypes == [("value", "binary")]
    assert back.count() == 3
    assert stream_topic_files(spark, path, 1).isStreaming


def test_wire_adapters(spark):
    ev = load_table(spark, SF_SMALL, "events")
    wire = events_wire(ev)
    assert wire.dtypes == [("value", "binary")]
    assert wire.count() == ev.count()
    first = bytes(wire.limit(1).collect()[0].value).decode()
    assert first.startswith('{"user_id":') and '"region":"NATION_' in first and first.endswith('Z"}')
    part = load_table(spark, SF_SMALL, "part")
    assert parts_wire(part).count() == part.count()


def test_wire_spreads_only_when_asked(spark):
    ev = load_table(spark, SF_SMALL, "events")
    assert events_wire(ev, partitions=4).rdd.getNumPartitions() == 4
    plan = events_wire(ev)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no shuffle unless asked for


def test_checkpoint_dir_is_required_on_a_cluster(spark, monkeypatch):
    from querytrail import session

    class Context:
        def __init__(self, master):
            self.master, self.dir = master, None

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, path):
            self.dir = path

    class Session:
        def __init__(self, master):
            self.sparkContext, values = Context(master), {}
            self.conf = type("Conf", (), {"get": staticmethod(values.get), "set": staticmethod(values.__setitem__)})

    for master in ("yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Session(master))
    assert "querytrail-" in session.ensure_checkpoint_dir(Session("local[4]"))


def test_build_session_and_shared_dir(spark):
    from querytrail.session import build_session, shared_dir

    s = build_session("t", {"spark.sql.shuffle.partitions": "4"})
    assert s is spark  # reuses the running session
    assert s.conf.get("spark.sql.session.timeZone") == "UTC"
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"
    a, b = shared_dir(s, "x"), shared_dir(s, "x")
    assert a != b and "querytrail" in a
