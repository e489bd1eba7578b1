"""bench.py prints exactly one JSON line with every headline query timed."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEAT="1", BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    result = json.loads(lines[0])
    sys.path.insert(0, ROOT)
    from bench import HEADLINE
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == set(HEADLINE)
    assert all(v is not None and v > 0 for v in result["queries"].values())
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-3
