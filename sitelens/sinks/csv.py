"""Report sinks: headered CSV (optionally with a byte-order mark), parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame

BOM = "﻿"


def write_csv(df: DataFrame, path: str, bom: bool = False, mode: str = "overwrite",
              partition_by: tuple[str, ...] = ()) -> None:
    """Headered UTF-8 CSV folder.  ``bom`` puts a byte-order mark before the
    header (spreadsheet-friendly); Spark has no writer option for it, so it is
    carried by the first column name.  ``partition_by`` writes one folder per
    value (e.g. one keyword list per seed)."""
    out = df
    if bom and df.columns:
        first = next(c for c in df.columns if c not in partition_by)
        out = df.withColumnRenamed(first, BOM + first)
    # RFC 4180 quoting (a quote inside a field is doubled), as spreadsheets expect
    writer = (out.write.mode(mode).option("header", True).option("encoding", "UTF-8")
              .option("escape", "\""))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_if_not_empty(df: DataFrame, path: str, fmt: str = "csv", **kw) -> bool:
    """Write only when there is at least one row; returns whether it wrote."""
    if df.isEmpty():
        return False
    if fmt == "csv":
        write_csv(df, path, **kw)
    else:
        df.write.mode(kw.get("mode", "overwrite")).format(fmt).save(path)
    return True


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
