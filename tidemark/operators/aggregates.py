"""Keyed and windowed aggregation (A1, A4-A8) and the user-function hooks around them.

The default is built-in aggregate columns: partial aggregation runs in every map task
(so hot keys are pre-combined before the shuffle) and the whole stage is code-generated.
Python is used only by :func:`process_window`, the general full-window hook.
"""

from __future__ import annotations

from typing import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.formats import aggregate_result_text
from tidemark.functions.parse import lines_of, words
from tidemark.operators.windows import window_agg
from tidemark.plans.partitioning import spread


def word_count(df: DataFrame, text: str = "value", whole_texts: bool = False) -> DataFrame:
    """A1 over T4: ``(word, n)`` for every space-separated word.

    With ``whole_texts`` each value is a whole multi-line text (for example a document),
    split into lines first. Every line and every word is counted; nothing is truncated.
    """
    src = spread(df.select(text))
    lines = src.select(F.explode(lines_of(text)).alias("_tm_line")) if whole_texts \
        else src.select(F.col(text).alias("_tm_line"))
    return words(lines, "_tm_line").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def keyed_sum(df: DataFrame, keys: Sequence[str], value: str, name: str = "n") -> DataFrame:
    """A1: group by key, sum a field (sums of int are bigint, no 32-bit wrap)."""
    return df.groupBy(*keys).agg(F.sum(F.col(value).cast("bigint")).alias(name))


def window_reduce(df: DataFrame, keys: Sequence[str], window: Column, seq: str,
                  first_cols: Sequence[str], sum_col: str, blank_cols: Sequence[str],
                  stamp_time: bool = False) -> DataFrame:
    """A4: the reference's pairwise reduce, as one aggregate.

    The reduce keeps ``first_cols`` of the first record (in ``seq`` order), sums
    ``sum_col``, sets ``blank_cols`` to ``''`` and (optionally) stamps the current time.
    A window with a single record is passed through unchanged, so blanking and the stamp
    apply only when the window holds more than one record.
    """
    aggs = [F.min_by(F.col(c), F.col(seq)).alias(c) for c in first_cols]
    aggs.append(F.sum(sum_col).alias(sum_col))
    aggs += [F.min_by(F.col(c), F.col(seq)).alias(f"_tm_first_{c}") for c in blank_cols]
    aggs.append(F.count(F.lit(1)).alias("_tm_n"))
    out = window_agg(df, keys, window, aggs)
    many = F.col("_tm_n") > 1
    out = out.withColumns({c: F.when(many, F.lit("")).otherwise(F.col(f"_tm_first_{c}"))
                           for c in blank_cols})
    if stamp_time:
        out = out.withColumn("create_time", F.when(many, F.current_timestamp()))
    return out.drop("_tm_n", *[f"_tm_first_{c}" for c in blank_cols])


def window_aggregate(df: DataFrame, keys: Sequence[str], window: Column,
                     aggregate: Column, as_text: bool = False, name: str = "result") -> DataFrame:
    """A5: an incremental (mergeable) aggregate per key and window; with ``as_text`` the
    result is rendered like the reference's ``getResult``."""
    agg = aggregate_result_text(aggregate) if as_text else aggregate
    return window_agg(df, keys, window, [agg.alias(name)])


def window_agg_with_context(df: DataFrame, keys: Sequence[str], window: Column,
                            aggs: Sequence[Column], count_name: str = "n") -> DataFrame:
    """The incremental aggregate *and* the window's context (bounds, true row count)
    in one row -- what the reference's aggregate-then-process pair intends."""
    return window_agg(df, keys, window, [*aggs, F.count(F.lit(1)).alias(count_name)])


def process_window(df: DataFrame, keys: Sequence[str], window: Column,
                   fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """A full-window function over all rows of one (key, window), in pandas.

    ``fn`` receives the rows of one group with ``window_start`` and ``window_end``
    columns added and returns rows of ``schema``. Spark loads each group into one Python
    worker, so use this only for groups of bounded size and logic that aggregate columns
    cannot express; for counts and sums use :func:`window_agg_with_context`.
    """
    keys = list(keys)
    framed = (df.withColumn("_tm_w", window)
              .withColumn("window_start", F.col("_tm_w.start"))
              .withColumn("window_end", F.col("_tm_w.end")).drop("_tm_w"))
    return framed.groupBy(*keys, "window_start", "window_end").applyInPandas(fn, schema)


def reduce_window(df: DataFrame, keys: Sequence[str], window: Column, seq: str,
                  fn: Callable[[dict, dict], dict], schema: T.StructType | str) -> DataFrame:
    """A user's pairwise reduce ``fn(acc, row) -> acc`` folded over each (key, window)
    in ``seq`` order, for logic aggregate columns cannot express. A window with one row
    passes through unchanged, as with the reference's reduce. Output rows follow
    ``schema`` (window bounds are available as ``window_start`` / ``window_end``).
    Like :func:`process_window`, this loads one group into one Python worker: keep it to
    groups of bounded size and use :func:`window_reduce` for the common case."""
    names = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).names

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        recs = pdf.sort_values(seq, kind="stable").to_dict("records")
        acc = recs[0]
        for rec in recs[1:]:
            acc = fn(acc, rec)
        return pd.DataFrame([{n: acc.get(n) for n in names}])

    return process_window(df, keys, window, fold, schema)
