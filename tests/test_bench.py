"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SMALL_SF


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL_SF, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="group_avg_count_df,top_n_per_group_df")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"group_avg_count_df", "top_n_per_group_df"}
    assert result["value"] == round(sum(result["queries"].values()), 4)
    assert "failures" not in result
