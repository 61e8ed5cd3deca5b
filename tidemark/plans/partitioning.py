"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Make sure a row-expanding step (exploding whole texts into words) runs on at
    least ``min_partitions`` tasks (default: the cluster's parallelism).

    A large table read from many files already has that many scan partitions and is left
    alone (no shuffle); a small one stored as a single row group would otherwise be
    processed by one task, so its rows are dealt round-robin first.
    """
    if df.isStreaming:  # a stream's parallelism comes from its source
        return df
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)

