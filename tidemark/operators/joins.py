"""Window join (J1) and interval join (J2, J3): inner equi-joins on a key with a time
condition.

Catalyst plans the plain interval join as an equi-join on the key with the time range
as a residual filter, so every pair of rows of one key is compared: a hot key becomes
quadratic in one task. :func:`interval_join` therefore buckets time: the left
row goes to the bucket of its time, the right row to the (few) buckets its range can
reach, and the equi-join runs on (key, bucket). Only rows that can match meet, each pair
is produced exactly once, and AQE can split a skewed (key, bucket) partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import epoch_micros, interval, interval_seconds
from tidemark.operators.lateness import join_lateness


def _rename_key(right: DataFrame, on: str) -> DataFrame:
    return right.withColumnRenamed(on, "_tm_rkey")


def _div(micros: Column, width: int) -> Column:
    """Whole-number bucket of a time (floor also before the epoch)."""
    w = F.lit(width).cast("bigint")
    return F.call_function("div", micros - F.pmod(micros, w), w)


def window_join(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str,
                size: str) -> DataFrame:
    """Pairs with the same key whose times fall in the same tumbling window.
    Output: key, window_start, window_end, the other left and right columns."""
    lw = F.window(F.col(left_ts), size)
    rw = F.window(F.col(right_ts), size)
    l = left.withColumn("window_start", lw.start).withColumn("window_end", lw.end)
    r = _rename_key(right, on).withColumn("_tm_rws", rw.start)
    j = l.join(r, (l[on] == r["_tm_rkey"]) & (l["window_start"] == r["_tm_rws"]), "inner")
    rest_l = [c for c in left.columns if c != on]
    rest_r = [c for c in right.columns if c != on]
    return j.select(on, "window_start", "window_end", *rest_l, *rest_r)


def window_join_watermarked(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str, size: str,
                            arrival: Sequence[str], delay: str) -> DataFrame:
    """J1 under the joint watermark of both inputs, without allowed lateness: a row that
    arrives after its window has ended joins nothing. ``arrival`` orders the rows of both;
    these columns are in both inputs and not in the output."""
    l, r = join_lateness(left, right, left_ts, right_ts, arrival, delay, window=size)
    gone = ["late", *arrival]
    return window_join(l.where(~F.col("late")).drop(*gone), r.where(~F.col("late")).drop(*gone), on, left_ts, right_ts, size)


def interval_join(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str,
                  lower: str, upper: str, bucket_width: str | None = None) -> DataFrame:
    """Pairs with the same key and ``left_ts - lower <= right_ts <= left_ts + upper``
    (both ends closed; bounds may differ). Output: key, the other left and right columns.

    The join is on (key, time bucket); ``bucket_width`` defaults to ``lower + upper`` so each
    right row reaches at most two buckets, and the rows compared stay within a constant
    factor of the pairs produced.
    """
    lo, hi = interval_seconds(lower), interval_seconds(upper)

    def cond_range(l: DataFrame, r: DataFrame):
        return ((r[right_ts] >= l[left_ts] - interval(lower))
                & (r[right_ts] <= l[left_ts] + interval(upper)))

    rest_l = [c for c in left.columns if c != on]
    rest_r = [c for c in right.columns if c != on]
    r0 = _rename_key(right, on)
    width = interval_seconds(bucket_width) if bucket_width else max(lo + hi, 1)
    w_us = int(math.ceil(width * 1_000_000))
    l = left.withColumn("_tm_b", _div(epoch_micros(left_ts), w_us))
    r_us = epoch_micros(right_ts)
    first = _div(r_us - int(hi * 1_000_000), w_us)
    last = _div(r_us + int(lo * 1_000_000), w_us)
    r = r0.withColumn("_tm_rb", F.explode(F.sequence(first, last)))
    j = l.join(r, (l[on] == r["_tm_rkey"]) & (l["_tm_b"] == r["_tm_rb"]) & cond_range(l, r), "inner")
    return j.select(on, *rest_l, *rest_r)
