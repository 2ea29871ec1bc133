import datetime as dt

from querytrail.operators import hourly_counts, trending, trending_topk

SCHEMA = "search string, timestamp_dt timestamp"


def T(h, m, s=0):
    return dt.datetime(2024, 1, 1, h, m, s)


def test_half_open_epoch_aligned_windows(spark):
    df = spark.createDataFrame([("a", T(10, 5)), ("a", T(10, 29, 59)), ("a", T(10, 30))], SCHEMA)
    got = [(r.start_time.replace(tzinfo=None), r.end_time.replace(tzinfo=None), r.search, r["count"]) for r in trending(df).collect()]
    assert got == [(T(10, 0), T(10, 30), "a", 2), (T(10, 30), T(11, 0), "a", 1)]


def test_null_times_drop_out(spark):
    df = spark.createDataFrame([("a", None), ("a", T(1, 0))], SCHEMA)
    assert [r["count"] for r in trending(df).collect()] == [1]


def test_sort_order_and_columns(spark):
    rows = [("b", T(1, 0))] * 3 + [("a", T(2, 0))] * 3 + [("c", T(1, 0))]
    out = trending(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["start_time", "end_time", "search", "count"]
    assert [(r.search, r["count"]) for r in out.collect()] == [("b", 3), ("a", 3), ("c", 1)]


def test_unsorted_has_no_global_sort(spark):
    out = trending(spark.createDataFrame([("a", T(1, 0))], SCHEMA), sort=False)
    assert "Sort " not in out._jdf.queryExecution().executedPlan().toString()


def test_width_parameter(spark):
    df = spark.createDataFrame([("a", T(10, 5)), ("a", T(10, 55))], SCHEMA)
    assert trending(df, width="1 hour").count() == 1


def test_topk_per_window(spark):
    rows = [("a", T(1, 0))] * 3 + [("b", T(1, 1))] * 2 + [("c", T(1, 2))] + [("z", T(5, 0))]
    out = trending_topk(spark.createDataFrame(rows, SCHEMA), k=2)
    got = sorted((r.start_time.replace(tzinfo=None), r.search, r["count"], r["rank"]) for r in out.collect())
    assert got == [(T(1, 0), "a", 3, 1), (T(1, 0), "b", 2, 2), (T(5, 0), "z", 1, 1)]


def test_topk_ties_by_term(spark):
    rows = [("b", T(1, 0)), ("a", T(1, 0))]
    out = trending_topk(spark.createDataFrame(rows, SCHEMA), k=1)
    assert [r.search for r in out.collect()] == ["a"]


def test_hourly_counts(spark):
    rows = [("a", T(1, 0)), ("a", T(1, 59)), ("a", T(23, 0)), ("a", None)]
    got = {r.hour: r["count"] for r in hourly_counts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 2, 23: 1, None: 1}


def test_hourly_counts_in_a_zone(spark):
    rows = [("a", T(22, 0)), ("a", T(23, 30)), ("a", None)]
    got = {r.hour: r["count"] for r in hourly_counts(spark.createDataFrame(rows, SCHEMA), zone="Europe/Istanbul").collect()}
    assert got == {1: 1, 2: 1, None: 1}  # UTC+3


def test_extreme_times_do_not_fail_window_operators(spark):
    import json

    from conftest import messages

    from querytrail.functions import decode, with_event_time
    from querytrail.schemas import EVENT

    spark.conf.set("spark.sql.ansi.enabled", "true")
    stamps = [
        "0001-01-01T00:00:00Z",
        "9999-12-31T23:59:59Z",
        "-1000-01-01T00:00:00Z",
        "294247-01-10T04:00:54Z",
        "-290308-12-21T19:59:06Z",
        "+10000-01-01T00:00:00Z",
    ]
    msgs = messages(spark, [json.dumps({"user_id": 1, "search": "a", "timestamp": t}) for t in stamps])
    events = with_event_time(decode(msgs, EVENT))
    for out in (trending(events, sort=False), trending_topk(events, 1), hourly_counts(events), hourly_counts(events, zone="Asia/Tokyo")):
        out.write.format("noop").mode("overwrite").save()
    # only the two times at the very ends of the timestamp range have no room for their window
    assert trending(events, sort=False).agg({"count": "sum"}).collect()[0][0] == len(stamps) - 2
    assert hourly_counts(events, zone="Asia/Tokyo").filter("hour IS NULL").collect()[0]["count"] == 2


def test_every_year_counts(spark):
    import json

    from conftest import messages

    from querytrail.functions import decode, with_event_time
    from querytrail.schemas import EVENT

    stamps = ["+12024-01-01T10:00:00Z", "-1000-01-01T10:00:00Z", "2024-01-01T10:00:00Z", "2024-01-01T10:29:59Z", None]
    msgs = messages(spark, [json.dumps({"user_id": 1, "search": "a", "timestamp": t}) for t in stamps])
    counts = trending(with_event_time(decode(msgs, EVENT)), sort=False).selectExpr("cast(start_time as string) as s", "count").collect()
    assert sorted((r.s, r["count"]) for r in counts) == [("+12024-01-01 10:00:00", 1), ("-1000-01-01 10:00:00", 1), ("2024-01-01 10:00:00", 2)]
