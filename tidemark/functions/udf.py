"""General user-function hooks for logic that column expressions cannot express
(U1 map, U2 flat-map). Both run Arrow-batched in pandas, never row at a time, and keep
Spark's partitioning: each task transforms its own batches."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_values(fn: Callable[[pd.Series], pd.Series], return_type: T.DataType | str) -> Callable[..., Column]:
    """A vectorized scalar function usable in ``select``: ``map_values(f, "int")(col)``."""
    return F.pandas_udf(fn, return_type)


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
             schema: T.StructType | str) -> DataFrame:
    """Each input batch -> any number of output rows (the collector form of a
    flat-map), applied per Arrow batch with ``mapInPandas``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    return df.mapInPandas(run, schema)


def aggregate_values(fn: Callable[[pd.Series], object], return_type: T.DataType | str) -> Callable[..., Column]:
    """U6 general form: a user aggregate over all values of a group, as a grouped-aggregate
    pandas UDF usable in ``agg`` (also per window). Spark sends each group's values to one
    Python worker (no partial aggregation), so use it for groups of bounded size; built-in
    aggregates cover sums, counts and extremes with map-side combining."""

    def agg(values: pd.Series) -> object:
        return fn(values)

    return F.pandas_udf(agg, return_type)
