"""Per-record running aggregates in arrival order (A3, ST1, ST2), batch form.

The reference emits one updated result per input record from keyed state. On a bounded
table that is a running window aggregate; here it is computed with the skew-safe
:func:`tidemark.plans.prefix.prefix_scan`, so a key holding a large share of the rows is
spread over many tasks. The streaming forms live in :mod:`tidemark.streaming.state`.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.prefix import Scan, prefix_scan


def running_sum(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str,
                name: str = "running_sum", ranges: int | None = None,
                bucket: Column | None = None) -> DataFrame:
    """A3: keyed running sum, one output row per input row."""
    return prefix_scan(df, order_by, {name: Scan("sum", F.col(value))}, keys, ranges=ranges,
                       bucket=bucket)


def running_count(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                  name: str = "running_n", ranges: int | None = None,
                  bucket: Column | None = None) -> DataFrame:
    """ST1: per key (e.g. sensor id and level) the number of rows so far, including the
    current one -- the reference's map state ``level -> count``, read per record."""
    return prefix_scan(df, order_by, {name: Scan("count", F.lit(1))}, keys, ranges=ranges,
                       bucket=bucket)


def running_avg(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str,
                name: str = "running_avg", ranges: int | None = None,
                bucket: Column | None = None) -> DataFrame:
    """ST2: per key the average of all rows so far, as a double (sum / count, the
    reference's aggregating state)."""
    s = prefix_scan(df, order_by, {"_tm_s": Scan("sum", F.col(value)),
                                   "_tm_c": Scan("count", F.col(value))}, keys, ranges=ranges,
                       bucket=bucket)
    return s.withColumn(name, F.col("_tm_s").cast("double") / F.col("_tm_c")).drop("_tm_s", "_tm_c")
