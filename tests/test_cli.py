import glob
import os
import subprocess
import sys
import tempfile
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

CSV = """URL,Status,Title,Lung. Title,Meta Desc,H1,Img senza ALT,Robots
u1,200,A,1,d,h,0,"NOINDEX, follow"
u2,404,A,40,d,,0,index
"""


def test_report_subcommand():
    d = tempfile.mkdtemp(prefix="sitelens-cli-")
    with open(os.path.join(d, "audit.csv"), "w", encoding="utf-8") as f:
        f.write(CSV)
    env = dict(os.environ, SITELENS_MASTER="local[2]", PYTHONPATH=str(REPO))
    subprocess.run([sys.executable, "-m", "sitelens", "report", "--audit", f"{d}/audit.csv",
                    "--out", f"{d}/out"], check=True, cwd=d, env=env, timeout=600,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    rows = []
    for p in sorted(glob.glob(f"{d}/out/rules/part-*.csv")):
        with open(p, encoding="utf-8") as f:
            rows += [line.strip() for line in f if not line.startswith("rule,")]
    got = {r.split(",")[0]: r.split(",")[1:] for r in rows}
    assert got["broken_status"] == ["error", "1", "2"] and got["priority"] == ["error", "1", "2"]
    assert got["duplicate_title"] == ["notice", "1", "2"] and got["noindex"] == ["notice", "1", "2"]
    duplicates = [line for p in sorted(glob.glob(f"{d}/out/duplicate_titles/part-*.csv")) for line in open(p, encoding="utf-8") if line.startswith("u")]
    assert [line.split(",")[0] for line in duplicates] == ["u2"]
    assert glob.glob(f"{d}/out/priority/part-*.csv")
