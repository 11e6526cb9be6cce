"""Session helpers.

Library code never creates its own session; callers pass one in.  These
helpers exist for tests, ``bench.py`` and small scripts.  Cluster settings
(checkpoint folder, shuffle partitions) are read from the session and only
filled in when they are unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "sitelens",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session: AQE on, UI off, Arrow on, UTC clock."""
    master = master or os.environ.get("SITELENS_MASTER", "local[8]")
    cores = _cores(master)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Pages vary from 1 KB to 150 KB: bound Arrow batches in rows and bytes.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        .config("spark.driver.memory", os.environ.get("SITELENS_DRIVER_MEM", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3...)
    and is used as is.  Only when nothing is configured (tests, local runs)
    do we create a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="sitelens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder (for streaming state/sinks)."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def written(df, name: str = "table"):
    """``df`` written to the shared folder and read back: its lineage ends here, and
    a lost executor costs no more than reading it again.  The folder's owner clears it."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cores(master: str) -> int:
    inner = master[master.find("[") + 1: master.find("]")] if "[" in master else "1"
    if inner == "*":
        return os.cpu_count() or 8
    try:
        return int(inner)
    except ValueError:
        return 8
