"""Every query where Python workers have no copy of the package on their path."""

import subprocess
import sys
import textwrap
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]


def test_queries_run_from_another_folder(tmp_path):
    """__spark_entry__.py is loaded by its path; workers start in a folder of their own."""
    code = f"""
        import importlib.util, os, sys
        os.environ.pop("PYTHONPATH", None)
        spec = importlib.util.spec_from_file_location("entry", "{REPO}/__spark_entry__.py")
        entry = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
                 .config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate())
        seen = spark.range(1).rdd.map(lambda x: [p for p in sys.path if os.path.isdir(os.path.join(p, "sitelens"))]).first()
        assert not seen, seen
        for name in sorted(q for q in entry.queries() if q.startswith("op")) + ["page_audit"]:
            rows = entry.queries()[name](spark, "/root/testdata/sf0.001").count()
            print(name, rows)
            assert rows > 0
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, capture_output=True, text=True, timeout=900,
                          env={"PATH": "/usr/bin:/bin:/usr/local/bin", "HOME": str(tmp_path), **{k: v for k, v in __import__("os").environ.items() if k in ("JAVA_HOME", "SPARK_HOME", "PYSPARK_PYTHON", "LD_LIBRARY_PATH", "VIRTUAL_ENV", "PATH")}})
    assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-4000:]
    assert done.stdout.count("op") >= 13
