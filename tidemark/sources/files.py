"""Text files (S1) and in-memory elements (S4) as DataFrames of lines."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """A bounded text file (or directory, or glob) as rows of lines in ``value``.
    Large files are split across tasks by Spark's file splitting."""
    return spark.read.option("wholetext", str(whole_files).lower()).text(path)


def elements(spark: SparkSession, rows: Iterable, schema: T.StructType | str = "value string") -> DataFrame:
    """Literal elements as a DataFrame (small, fixed inputs for tests and demos)."""
    rows = [r if isinstance(r, (tuple, list, dict)) else (r,) for r in rows]
    return spark.createDataFrame(rows, schema)
