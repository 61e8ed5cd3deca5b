"""bench.py prints one JSON line with a time for every query of the core library."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_WARMUP_DIR="/nonexistent")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1, out.stdout[-2000:] + out.stderr[-2000:]
    d = json.loads(lines[0])
    sys.path.insert(0, ROOT)
    from tidemark.plans.queries import QUERIES

    assert d["unit"] == "sec" and d["sf"] == "0.001" and "errors" not in d
    assert set(d["queries"]) == set(QUERIES)
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
