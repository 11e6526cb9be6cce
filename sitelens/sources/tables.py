"""Scans of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan; selecting ``cols`` here keeps the ReadSchema pruned."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


POSITION = "_position"


def with_input_position(scan: DataFrame, name: str = POSITION) -> DataFrame:
    """``scan``, straight from a file source, with each row's place in the input.

    The place is (file, byte where the row's split begins, row number): files in
    path order, rows in file order.  Carry it along (``keep=``) to report in
    input order later on, whatever was shuffled in between.
    """
    return scan.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                                     F.monotonically_increasing_id().alias("row")).alias(name))


def on_all_cores(scan: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt over the cores row by row.

    For a caller whose next step is costly per row (a page parse) and whose
    input may be one small file; an input with enough splits is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream scan of one table, be it a file or a folder of files, in ``sf_dir``.

    A stream takes no single file as its path, so the table is named by a
    pattern that only it matches; folders below it name partition columns as in a batch scan.
    """
    reader = spark.readStream.schema(schema).option("basePath", sf_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}[.]parquet")
