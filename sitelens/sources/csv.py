"""Headered CSV input (audit exports, backlink exports, keyword lists).

Read as strings (no type inference pass over the data), then the usual
spreadsheet NA tokens become null, as a pandas reader would do.  Rules that
need numbers apply ``try_cast`` themselves, so a bad cell is null, not an
error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import null_if_na_token
from .tables import with_input_position


def read_csv(spark: SparkSession, path: str, na_tokens: bool = True, position: str | None = None,
             multiLine: bool = False, **options) -> DataFrame:
    """Headered CSV folder/file as all-string columns.

    ``multiLine``: fields hold line breaks inside quotes; each file is then one
    task, where otherwise a large file is read in splits.  ``position``: name
    of a column for each row's place in the input (``tables.with_input_position``).
    Any ``options`` override the defaults.
    """
    reader = (spark.read.option("header", True).option("multiLine", multiLine)
              .option("escape", '"').option("encoding", "UTF-8"))
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.csv(path)
    # a byte-order mark, if any, ends up in the first header name
    first = df.columns[0] if df.columns else None
    if first is not None and first.startswith("﻿"):
        df = df.withColumnRenamed(first, first[1:])
    names = df.columns
    if position:
        df = with_input_position(df, position)
    if na_tokens:
        df = df.select(*[null_if_na_token(F.col(f"`{c}`")).alias(c) for c in names], *([position] if position else []))
    return df
