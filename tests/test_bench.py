"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR=SF_SMALL,
        BENCH_CPUS="2",
        BENCH_REPEAT="1",
        BENCH_QUERIES="count_events,top_regions",
        BENCH_DRIVER_MEMORY="2g",
    )
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=600, check=True
    )
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"count_events", "top_regions"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
