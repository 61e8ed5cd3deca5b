"""Time, session, count and all-row windows.

Time windows are ``[start, end)`` and aligned to the epoch, like Spark's ``window``.
The same functions serve processing time and event time: the caller picks the time
column (an arrival stamp or an event-time field).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import col, interval
from tidemark.plans.prefix import Scan, prefix_scan, running_number


def tumbling(ts: str | Column, size: str) -> Column:
    """Tumbling window column."""
    return F.window(col(ts), size)


def sliding(ts: str | Column, size: str, slide: str) -> Column:
    """Sliding window column; a row lies in ``size / slide`` windows."""
    return F.window(col(ts), size, slide)


def session(ts: str | Column, gap: str | Column) -> Column:
    """Spark's native session window (fixed or per-row gap). Used by the
    streaming path; the batch path uses :func:`session_agg`, which splits hot keys.

    A per-row gap may be given as the same day-time interval expression the batch path
    takes; it is rendered as the interval text ``session_window`` reads."""
    if isinstance(gap, Column):
        micros = F.unix_micros(F.timestamp_seconds(F.lit(0)) + gap)
        gap = F.concat(micros.cast("string"), F.lit(" microseconds"))
    return F.session_window(col(ts), gap)


def window_agg(df: DataFrame, keys: Sequence[str], window: Column,
               aggs: Sequence[Column]) -> DataFrame:
    """Keyed (or, with no keys, all-row: W8) windowed aggregate, flattened to
    ``keys, window_start, window_end, aggs``.

    Aggregates are partial (map-side) first, so a hot key or a non-keyed window is
    pre-combined in every task before the shuffle instead of sending all rows to one.
    """
    keys = list(keys)
    g = df.groupBy(*keys, window.alias("_tm_w")).agg(*aggs)
    rest = [c for c in g.columns if c not in keys + ["_tm_w"]]
    return g.select(*keys, F.col("_tm_w.start").alias("window_start"),
                    F.col("_tm_w.end").alias("window_end"), *rest)


def session_agg(df: DataFrame, keys: Sequence[str], ts: str, gap: str | Column,
                tiebreak: str, aggs: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """Session windows (W3, W9 with a per-row gap) for bounded input, skew-safe.

    A row opens a new session when its time is later than every earlier row's
    ``ts + gap`` of the same key (so rows exactly one gap apart share a session, as in
    Spark's ``session_window``). The session end is ``max(ts + gap)``.

    Both steps are running aggregates, computed with :func:`prefix_scan`, so a hot key is
    split over many tasks instead of sorted in one. Aggregates must be ordinary
    (mergeable) aggregate columns. The scan checkpoints its input rows: pass only the
    columns the keys, time, tie-breaker, gap and aggregates use.
    """
    keys = list(keys)
    gap_col = interval(gap) if isinstance(gap, str) else gap
    order = [ts, tiebreak]
    d = df.withColumn("_tm_end", F.col(ts) + gap_col)
    d = prefix_scan(d, order, {"_tm_prev_end": Scan("max", F.col("_tm_end"), inclusive=False)},
                    partition_by=keys, ranges=ranges, keep_slice=True)
    d = d.withColumn("_tm_new", (F.col("_tm_prev_end").isNull()
                                 | (F.col(ts) > F.col("_tm_prev_end"))).cast("long"))
    # the flags are a cheap function of the checkpointed first scan, so the second
    # scan's rows and summary both read them from there (same slices, same partitioning)
    d = prefix_scan(d, order, {"_tm_sid": Scan("sum", F.col("_tm_new"))},
                    partition_by=keys, ranges=ranges, keep_slice=True)
    # sessions may span slices, so they are shuffled by session, pre-aggregated
    g = d.groupBy(*keys, "_tm_sid").agg(F.min(ts).alias("session_start"),
                                        F.max("_tm_end").alias("session_end"), *aggs)
    return g.drop("_tm_sid")


def count_tumbling(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], size: int,
                   aggs: Sequence[Column], ranges: int | None = None,
                   bucket: Column | None = None) -> DataFrame:
    """Per key, consecutive groups of ``size`` rows in ``order_by``; only full
    groups are emitted (the trailing partial group never fires). ``group_no`` is 0-based.

    Row numbers come from the skew-safe running count; the groups themselves hold at
    most ``size`` rows, so the final aggregate is evenly spread.
    """
    keys = list(keys)
    d = running_number(df, order_by, keys, name="_tm_rn", ranges=ranges, bucket=bucket)
    d = d.withColumn("group_no", F.floor((F.col("_tm_rn") - 1) / size).cast("bigint"))
    g = d.groupBy(*keys, "group_no").agg(F.count(F.lit(1)).alias("_tm_n"), *aggs)
    return g.where(F.col("_tm_n") == size).drop("_tm_n")


def count_sliding(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], size: int,
                  slide: int, aggs: Sequence[Column] | dict[str, Column], ranges: int | None = None,
                  bucket: Column | None = None) -> DataFrame:
    """Per key, fire on every ``slide``-th row with the last ``size`` rows (up to
    ``size``: the first firings hold fewer). ``fire_seq`` is the row number that fired.

    ``aggs`` maps output names to aggregate columns (a list of aliased aggregates is also
    accepted). Each row is copied to the at most ``ceil(size / slide)`` firings that include
    it and every firing is an ordinary aggregate group; a firing exists only if its own row
    does.
    """
    keys = list(keys)
    d = running_number(df, order_by, keys, name="_tm_rn", ranges=ranges, bucket=bucket)
    agg_cols = [agg.alias(name) for name, agg in aggs.items()] if isinstance(aggs, dict) else list(aggs)
    fires = F.filter(F.sequence(F.col("_tm_rn"), F.col("_tm_rn") + (size - 1)),
                     lambda f: f % slide == 0)
    d = d.withColumn("fire_seq", F.explode(fires))
    g = d.groupBy(*keys, "fire_seq").agg(F.max("_tm_rn").alias("_tm_last"), *agg_cols)
    return g.where(F.col("_tm_last") == F.col("fire_seq")).drop("_tm_last")
