"""The driver's parquet tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table. Projection and filters applied later are pushed into the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
