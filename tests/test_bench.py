"""bench.py prints exactly one JSON line in the agreed format."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "group_count"],
        capture_output=True, text=True, env=env, timeout=600, check=True,
    ).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    data = json.loads(lines[0])
    assert data["unit"] == "sec" and data["sf"] == 0.001
    assert set(data["queries"]) == {"group_count"}
    assert data["value"] == data["queries"]["group_count"] > 0
