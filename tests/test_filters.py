import pytest

from querytrail.operators import keyword_filter, user_top_terms


def test_case_insensitive_substring(spark):
    df = spark.createDataFrame([("Cerrahi MASKE",), ("maske",), ("tablet",), (None,)], "search string")
    assert [r.search for r in keyword_filter(df, "search", "maske").collect()] == ["Cerrahi MASKE", "maske"]
    assert keyword_filter(df, "search", "MaSkE").count() == 2


def test_non_ascii_needle(spark):
    df = spark.createDataFrame([("İSTANBUL",), ("istanbul",), ("Über",)], "search string")
    # 'İ' lowers to 'i' + U+0307 on both sides, so it matches itself only
    assert [r.search for r in keyword_filter(df, "search", "İstanbul").collect()] == ["İSTANBUL"]
    assert [r.search for r in keyword_filter(df, "search", "über").collect()] == ["Über"]


def test_any_of_several_terms(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "search string")
    assert keyword_filter(df, "search", "a", "c").count() == 2


def test_needs_a_term(spark):
    df = spark.createDataFrame([("a",)], "search string")
    with pytest.raises(ValueError):
        keyword_filter(df, "search")


def test_filter_is_narrow(spark):
    df = spark.createDataFrame([("a",)], "search string")
    assert "Exchange" not in keyword_filter(df, "search", "a")._jdf.queryExecution().executedPlan().toString()


def test_user_top_terms(spark):
    rows = [(1, "a")] * 3 + [(1, "b")] * 2 + [(1, "c")] + [(2, "c")]
    out = user_top_terms(spark.createDataFrame(rows, "user_id int, search string"), k=2)
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "a", 3, 1), (1, "b", 2, 2), (2, "c", 1, 1)]
