from pyspark.sql import functions as F

from querytrail.operators import count_by, row_count, top_k


def _df(spark, rows, schema="region string, search string"):
    return spark.createDataFrame(rows, schema)


def test_row_count(spark):
    df = _df(spark, [("a", "x"), ("b", None), (None, None)])
    assert row_count(df).collect()[0]["count"] == 3
    assert row_count(df.limit(0)).collect()[0]["count"] == 0


def test_count_by_keeps_null_group(spark):
    df = _df(spark, [("a", "x"), (None, "y"), (None, "z")])
    got = {r.region: r["count"] for r in count_by(df, "region").collect()}
    assert got == {"a": 1, None: 2}


def test_count_by_pairs(spark):
    df = _df(spark, [("a", "x"), ("a", "x"), ("a", "y")])
    got = sorted(tuple(r) for r in count_by(df, "region", "search").collect())
    assert got == [("a", "x", 2), ("a", "y", 1)]


def test_top_k_order_and_ties(spark):
    rows = [(r, "s") for r in ["b", "a", "c", "c", "d", "d", "e"]]
    out = [tuple(r) for r in top_k(_df(spark, rows), "region", 3).collect()]
    # c and d tie at 2 -> key order; then a/b/e tie at 1 -> 'a' wins rank 3
    assert out == [("c", 2), ("d", 2), ("a", 1)]


def test_top_k_null_key_first_among_ties(spark):
    rows = [(None, "s"), ("a", "s")]
    assert [tuple(r) for r in top_k(_df(spark, rows), "region", 1).collect()] == [(None, 1)]


def test_top_k_schema_and_small_input(spark):
    out = top_k(_df(spark, [("a", "x")]), "search", 10)
    assert out.dtypes == [("search", "string"), ("count", "bigint")]
    assert out.count() == 1


def test_top_k_plan_is_take_ordered(spark):
    out = top_k(_df(spark, [("a", "x")]), "search", 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_top_k_rejects_bad_k(spark):
    import pytest

    with pytest.raises(ValueError):
        top_k(_df(spark, [("a", "x")]), "search", 0)


def test_top_values_long_form(spark):
    from querytrail.operators import top_values

    rows = [("a", "x"), ("a", "y"), ("b", "y"), (None, "y")]
    out = top_values(_df(spark, rows), ["region", "search"], 2)
    assert out.columns == ["dimension", "value", "count", "rank"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([("region", "a", 2, 1), ("region", None, 1, 2), ("search", "y", 3, 1), ("search", "x", 1, 2)], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "WindowGroupLimit" in plan


def test_top_per_group_keeps_columns_of_any_name(spark):
    from querytrail.operators import top_per_group

    df = spark.createDataFrame([(1, i, "kept", "too") for i in range(1500)], "g int, first int, __first string, _first string")
    out = top_per_group(df, ["g"], 1200, [F.col("first").desc()])
    assert out.columns == ["g", "first", "__first", "_first", "rank"] and out.count() == 1200
    assert out.where("__first = 'kept' AND _first = 'too'").count() == 1200
