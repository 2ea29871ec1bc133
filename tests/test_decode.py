import datetime as dt

import pytest
from conftest import messages

from querytrail.functions import decode, encode_json, event_time_from_millis, with_event_time
from querytrail.schemas import EVENT, LOG


def _decode_one(spark, text):
    df = with_event_time(decode(messages(spark, [text]), EVENT))
    return df.collect()[0]


GOOD = '{"user_id":1000,"search":"telefon","region":"Ankara","timestamp":"2024-01-01T10:05:00Z"}'


def test_valid_message(spark):
    r = _decode_one(spark, GOOD)
    assert (r.user_id, r.search, r.region, r.timestamp) == (1000, "telefon", "Ankara", "2024-01-01T10:05:00Z")
    assert r.timestamp_dt.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 10, 5)


@pytest.mark.parametrize(
    "text,user_id,search,ts",
    [
        ('{"user_id":1001,"search":"tablet","region":"Izmir","timestamp":"not a time"}', 1001, "tablet", None),
        ('{"user_id":"1002","search":"tablet","timestamp":"2024-01-01T11:00:00+03:00"}', None, "tablet", dt.datetime(2024, 1, 1, 8, 0)),
        ('{"user_id":1.5,"search":"tablet","timestamp":"2024-01-01T11:00:00Z"}', None, "tablet", dt.datetime(2024, 1, 1, 11, 0)),
        ('{"user_id":99999999999,"search":"tablet","timestamp":"2024-01-01T11:00:00Z"}', None, "tablet", dt.datetime(2024, 1, 1, 11, 0)),
        ('{"user_id":1003,"search":null,"extra":1,"timestamp":"2024-01-01T11:00:00Z"}', 1003, None, dt.datetime(2024, 1, 1, 11, 0)),
        ('{"user_id":1003,"search":5,"timestamp":1704106800000}', 1003, "5", None),
        ('{"user_id":1,"search":"a"} trailing', 1, "a", None),
        ('{"User_ID":4,"SEARCH":"b"}', None, None, None),
    ],
)
def test_messy_fields(spark, text, user_id, search, ts):
    r = _decode_one(spark, text)
    assert r.user_id == user_id
    assert r.search == search
    got = None if r.timestamp_dt is None else r.timestamp_dt.replace(tzinfo=None)
    assert got == ts


@pytest.mark.parametrize("text", ["garbage", "", None, "[]", "{}", '[{"user_id":1}]', b"\xff\xfe{"])
def test_bad_messages_are_all_null_rows(spark, text):
    df = with_event_time(decode(messages(spark, [text]), EVENT))
    rows = df.collect()
    assert len(rows) == 1  # kept, not dropped (M1)
    assert all(v is None for v in rows[0])


@pytest.mark.parametrize("barrier", [True, False])
def test_drop_malformed(spark, barrier):
    texts = ["garbage", "", None, "[]", "{}", '{"User_ID":4}', b"\xff\xfe{", GOOD, '{"user_id":"1002","search":"tablet"}']
    df = decode(messages(spark, texts), EVENT, barrier=barrier, drop_malformed=True)
    got = sorted(((r.user_id, r.search) for r in df.collect()), key=str)
    assert got == sorted([(None, "tablet"), (1000, "telefon")], key=str)
    assert decode(messages(spark, texts), EVENT, barrier=barrier).count() == len(texts)


def test_ansi_mode_does_not_throw(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    df = with_event_time(decode(messages(spark, ['{"timestamp":"nope"}', GOOD]), EVENT))
    assert [r.timestamp_dt is None for r in df.collect()] == [True, False]


def test_replace_time_column(spark):
    df = with_event_time(decode(messages(spark, [GOOD]), EVENT), "timestamp", out="timestamp")
    assert df.columns == ["user_id", "search", "region", "timestamp"]
    assert dict(df.dtypes)["timestamp"] == "timestamp"


def test_time_format_option(spark):
    df = with_event_time(decode(messages(spark, ['{"timestamp":"01/02/2024 10:00"}']), EVENT), fmt="MM/dd/yyyy HH:mm")
    assert df.collect()[0].timestamp_dt.replace(tzinfo=None) == dt.datetime(2024, 1, 2, 10, 0)


def test_log_schema_and_millis(spark):
    msgs = messages(
        spark,
        [
            '{"search":"kamera","timestamp":1704067200000,"region":"Bursa"}',
            '{"search":"kamera","timestamp":"2024-01-01T00:00:00Z","region":"Bursa"}',
        ],
    )
    df = event_time_from_millis(decode(msgs, LOG))
    a, b = df.collect()
    assert a.timestamp == 1704067200000 and a.timestamp_dt.replace(tzinfo=None) == dt.datetime(2024, 1, 1)
    assert b.timestamp is None and b.search == "kamera" and b.region == "Bursa"


def test_millis_out_of_range_is_null(spark):
    msgs = messages(spark, ['{"search":"a","timestamp":9223372036854775807}', '{"search":"a","timestamp":-9223372036854775807}'])
    rows = event_time_from_millis(decode(msgs, LOG)).collect()
    assert [r.timestamp_dt for r in rows] == [None, None]


def test_keep_columns(spark):
    from pyspark.sql import functions as F

    msgs = messages(spark, [GOOD]).withColumn("partition", F.lit(7))
    df = decode(msgs, EVENT, keep=["partition"])
    assert df.columns == ["partition", "user_id", "search", "region", "timestamp"]


def test_keep_column_clash_is_an_error(spark):
    from pyspark.sql import functions as F

    msgs = messages(spark, [GOOD]).withColumn("timestamp", F.current_timestamp())
    with pytest.raises(ValueError):
        decode(msgs, EVENT, keep=["timestamp"])
    renamed = decode(msgs.withColumnRenamed("timestamp", "topic_ts"), EVENT, keep=["topic_ts"])
    assert renamed.columns[0] == "topic_ts"


def test_encode_decode_roundtrip(spark):
    rows = [(1000, "akıllı saat", "İzmir", "2024-01-01T10:05:00Z"), (None, "x", None, None)]
    df = spark.createDataFrame(rows, EVENT)
    enc = encode_json(df)
    assert enc.dtypes == [("value", "binary")]
    back = decode(enc, EVENT)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_encode_events_keeps_schema_fields_only(spark):
    from querytrail.functions import encode_events

    df = spark.createDataFrame(
        [("x", 5, 1000, "r", "t", None)], "extra string, n int, user_id int, region string, search string, timestamp string"
    )
    msg = bytes(encode_events(df).collect()[0].value).decode()
    assert msg == '{"user_id":1000,"search":"t","region":"r"}'  # null timestamp left out


def test_encode_with_key(spark):
    df = spark.createDataFrame([(1000, "a", "b", "c")], EVENT)
    enc = encode_json(df, ["search"], key="user_id")
    r = enc.collect()[0]
    assert bytes(r.key) == b"1000" and bytes(r.value) == b'{"search":"a"}'


def test_projection_decode_prunes_json_fields(spark):
    df = decode(messages(spark, [GOOD]), EVENT, barrier=False).groupBy("region").count()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(region" in plan and "StructField(user_id" not in plan


def test_projection_decode_is_skipped_for_a_count(spark):
    df = decode(messages(spark, [GOOD, "junk"]), EVENT, barrier=False)
    assert "from_json" not in df.groupBy().count()._jdf.queryExecution().optimizedPlan().toString()


def test_barrier_decode_parses_once_under_filters(spark):
    from querytrail.operators import keyword_filter, trending

    msgs = messages(spark, [GOOD])
    for df in (
        trending(with_event_time(decode(msgs, EVENT))),
        with_event_time(keyword_filter(decode(msgs, EVENT), "search", "tel")),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1, plan
    # the projection form parses more than once here: every pushed filter
    # copies the from_json below the projection
    plan = trending(with_event_time(decode(msgs, EVENT, barrier=False)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") > 1


@pytest.mark.parametrize("barrier", [True, False])
def test_both_forms_agree(spark, barrier):
    texts = [GOOD, "garbage", None, '{"user_id":"x","search":5}', b"\xff"]
    df = with_event_time(decode(messages(spark, texts), EVENT, barrier=barrier))
    assert df.columns == ["user_id", "search", "region", "timestamp", "timestamp_dt"]
    other = with_event_time(decode(messages(spark, texts), EVENT, barrier=not barrier))
    assert sorted(map(str, df.collect())) == sorted(map(str, other.collect()))


def test_zoneless_time_text_is_read_in_session_zone(spark):
    """Text without an offset is read in the session zone (UTC here)."""
    msgs = messages(spark, ['{"timestamp":"2024-01-01T10:00:00"}', '{"timestamp":"2024-01-01T10:00:00Z"}'])
    rows = with_event_time(decode(msgs, EVENT)).select("timestamp_dt").collect()
    assert rows[0].timestamp_dt == rows[1].timestamp_dt
    epoch = with_event_time(decode(msgs, EVENT)).selectExpr("unix_seconds(timestamp_dt) AS s").collect()
    assert {r.s for r in epoch} == {1704103200}


def test_same_results_with_and_without_ansi(spark):
    from querytrail.operators import pivot_counts, top_k, trending

    texts = [GOOD, '{"user_id":"x","search":"a","timestamp":"bad"}', "junk", '{"user_id":7,"search":"b","timestamp":"2024-01-01T10:31:00Z"}']

    def run():
        d = with_event_time(decode(messages(spark, texts), EVENT))
        return (
            sorted(map(str, trending(d).collect())),
            sorted(map(str, top_k(d, "search", 5).collect())),
            sorted(map(str, pivot_counts(d, values=["a", "b", "telefon"]).collect())),
        )

    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        on = run()
        spark.conf.set("spark.sql.ansi.enabled", "false")
        off = run()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert on == off


@pytest.mark.parametrize("fields", [["region"], ["search", "user_id"]])
def test_only_wanted_fields_are_parsed(spark, fields):
    texts = [GOOD, "junk", '{"user_id":"x","region":"r"}']
    df = decode(messages(spark, texts), EVENT, fields=fields)
    assert df.columns == fields
    plan = df._jdf.queryExecution().executedPlan().toString()
    parsed = plan[plan.index("from_json(") :]
    assert all(f"StructField({f}," in parsed for f in fields)
    assert parsed.split("from_json(")[1].split("))")[0].count("StructField(") == len(fields)
    whole = decode(messages(spark, texts), EVENT).select(*fields)
    assert sorted(map(str, df.collect())) == sorted(map(str, whole.collect()))
    kept = decode(messages(spark, texts), EVENT, fields=fields, drop_malformed=True)
    assert kept.columns == fields and kept.count() == 2
