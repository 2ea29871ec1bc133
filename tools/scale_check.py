"""Time key operators over 1x, 4x and 16x copies of the events table.

    python tools/scale_check.py [sf_dir]

The copies are unioned scans of the same Parquet file, so the input has at
least as many splits as copies and grows linearly; each operator runs on the
full message path (encode -> decode) and is executed with a ``noop`` write.
A last "skew" input adds repeats of one user's rows to 10 copies until that
user holds a third of all messages.  Prints one line per (input, operator)
with seconds and messages/second.
"""

from __future__ import annotations

import functools
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from querytrail.functions import decode, with_event_time  # noqa: E402
from querytrail.operators import keyword_filter, pivot_counts, top_k, trending, user_top_terms  # noqa: E402
from querytrail.schemas import EVENT  # noqa: E402
from querytrail.sources import events_wire, load_table  # noqa: E402

OPERATORS = {
    "top_k(region)": lambda d: top_k(d, "region", 10),
    "trending": lambda d: trending(with_event_time(d)),
    "keyword": lambda d: with_event_time(keyword_filter(d, "search", "sign")),
    "pivot(values from data)": lambda d: pivot_counts(d),
    "user_top_terms": lambda d: user_top_terms(d, 3),
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = load_table(spark, sf_dir, "events")
    n = base.count()
    inputs = [(f"{c}x", functools.reduce(lambda a, b: a.unionAll(b), [base] * c)) for c in (1, 4, 16)]
    # skew: 10 copies, each with its share of one user's rows repeated, so that
    # user holds a third of all rows while the input splits stay balanced
    hot_user = base.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first()["user_id"]
    hot = base.filter(F.col("user_id") == hot_user)
    repeat = max(1, (n // 2) // max(hot.count(), 1))
    hot_rows = hot.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(repeat)))).drop("_r")
    inputs.append(("skew", functools.reduce(lambda a, b: a.unionAll(b), [base.unionAll(hot_rows)] * 10)))
    for label, events in inputs:
        total = events.count()
        for name, op in OPERATORS.items():
            runs = []
            for _ in range(2):
                t0 = time.perf_counter()
                op(decode(events_wire(events), EVENT)).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            secs = min(runs)
            print(f"{label:>4s} {total:9d} msgs  {name:24s} {secs:6.2f}s  {total / secs:10.0f} msgs/s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
