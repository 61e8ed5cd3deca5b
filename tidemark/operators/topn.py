"""Top-N per group (ST4): the reference keys window counts by window end and keeps the N
largest.

A plain ``row_number().over(partitionBy(window))`` sorts every key of a window in one
task; a window with millions of keys is then one straggler. Here the ranking is done
twice: first inside ``salt_buckets`` hash slices of each group, keeping N per slice, then
over the at most ``N * salt_buckets`` survivors. The top N of a union is the top N of the
per-slice top Ns, so the result is exact. The order must be total (end it with the key)
so ties are broken the same way every time.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group_by: Sequence[str], order_by: Sequence[Column], n: int,
          salt_cols: Sequence[str], salt_buckets: int = 32, rank: str = "rank") -> DataFrame:
    groups = list(group_by)
    salted = df.withColumn("_tm_salt", F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets)))
    first = (salted
             .withColumn("_tm_r", F.row_number().over(
                 Window.partitionBy(*groups, "_tm_salt").orderBy(*order_by)))
             .where(F.col("_tm_r") <= n).drop("_tm_r", "_tm_salt"))
    ranked = first.withColumn(rank, F.row_number().over(
        Window.partitionBy(*groups).orderBy(*order_by)).cast("bigint"))
    return ranked.where(F.col(rank) <= n)
