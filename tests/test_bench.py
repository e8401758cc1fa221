"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL


def test_bench_output_contract():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_CPUS": "2",
           "BENCH_QUERIES": "yearly_extrema,list_all"}
    done = subprocess.run([sys.executable, "bench.py"], cwd=root, env=env, capture_output=True,
                          text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [line for line in done.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"yearly_extrema", "list_all"}
    assert abs(out["value"] - sum(out["queries"].values())) < 1e-3
