"""bench.py keeps its contract: exactly one JSON line on stdout."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "silver_account", "scd1_current"],
                         capture_output=True, text=True, timeout=600, env=env, cwd=ROOT)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and set(res["queries"]) == {"silver_account", "scd1_current"}
    assert res["value"] == round(sum(res["queries"].values()), 3)
