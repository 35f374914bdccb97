"""Task retries (as after a lost executor) neither lose nor double-count rows or observed metrics."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_observed_metrics_survive_task_retries():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tests", "retry_probe.py"), ROOT],
                         capture_output=True, text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")]
    assert line, out.stderr[-2000:]
    res = json.loads(line[-1])
    assert res["injected_failures"] >= 2  # both jobs (valid with observation, quarantine) had a task retried
    assert res["valid"] == 20000 and res["quarantine"] == 20000
    m = res["metrics"]
    assert m["input_row_count"] == "40000"
    assert m["error_row_count"] == "20000"
    assert m["warning_row_count"] == "10000"
    assert m["valid_row_count"] == "15000"  # even and < 30000
