"""bench.py must keep producing its one JSON line (the harness records it each round)."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    done = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py")], cwd=REPO, env=env, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-3000:]
    lines = [line for line in done.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["value"] > 0 and result["sf"] == 0.001
    assert set(result["queries"]) >= {"pipe_end_to_end", "key_uuid5_native", "flatten_complex"}
    assert all(isinstance(v, (int, float)) for v in result["queries"].values())
