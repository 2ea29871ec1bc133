"""A key holding a third of all rows: results stay whole, and every shuffle
is preceded by a map-side partial aggregate or group limit."""

import datetime as dt
import re

import pytest

from querytrail.operators import count_by, pivot_counts, top_k, trending, trending_topk, user_top_terms

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(N):
        if i % 3 == 0:  # hot user, hot term, hot window
            rows.append((1, "hot", base))
        else:
            rows.append((100 + i, f"t{i % 50}", base + dt.timedelta(minutes=i)))
    return spark.createDataFrame(rows, "user_id int, search string, timestamp_dt timestamp").repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_each_hash_exchange(plan):
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning", line):
            below = lines[i + 1] if i + 1 < len(lines) else ""
            if "partial_" not in below and "Partial" not in below and "WindowGroupLimit" not in "".join(lines[i + 1 : i + 3]):
                return False
    return True


def test_counts_whole_under_skew(spark, skewed):
    got = {r.search: r["count"] for r in count_by(skewed, "search").collect()}
    assert got["hot"] == N // 3
    assert sum(got.values()) == N
    assert _partial_before_each_hash_exchange(_plan(count_by(skewed, "search")))


def test_top_k_under_skew(spark, skewed):
    out = top_k(skewed, "user_id", 1).collect()
    assert (out[0].user_id, out[0]["count"]) == (1, N // 3)


def test_pivot_under_skew(spark, skewed):
    out = pivot_counts(skewed, values=["hot", "t1"])
    hot = out.filter("user_id = 1").collect()[0]
    assert hot.hot == N // 3
    assert out.agg({"hot": "sum"}).collect()[0][0] == N // 3
    assert _partial_before_each_hash_exchange(_plan(out))


def test_windows_under_skew(spark, skewed):
    out = trending(skewed, sort=False)
    assert out.agg({"count": "sum"}).collect()[0][0] == N
    top = trending_topk(skewed, k=1).filter("search = 'hot'").collect()
    assert top[0]["count"] == N // 3
    plan = _plan(trending_topk(skewed, k=1))
    assert "WindowGroupLimit" in plan and _partial_before_each_hash_exchange(plan)


def test_user_top_terms_under_skew(spark, skewed):
    out = user_top_terms(skewed, k=1).filter("user_id = 1").collect()
    assert (out[0].search, out[0]["count"]) == ("hot", N // 3)
