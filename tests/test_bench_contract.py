import json
import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="url_class,audit_rule_summary")
    out = subprocess.run([sys.executable, str(REPO / "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"url_class", "audit_rule_summary"}
    assert rec["sf"] == 0.001
