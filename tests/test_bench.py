"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_QUERIES="risk_kpi,top_k",
               BENCH_REPEAT="1", BENCH_EXTRA="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"risk_kpi", "top_k"} and rec["value"] > 0
