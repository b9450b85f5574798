"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf):
    env = {**os.environ, "BENCH_SF_DIR": sf, "BENCH_CPUS": "2", "BENCH_WARMUP_DIR": "/nonexistent"}
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, cwd=REPO,
                         capture_output=True, text=True, timeout=900, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["value"] > 0
    assert all(v > 0 for v in result["queries"].values())
