"""Streaming forms of the window, aggregate, join and top-N operators.

They are the batch operators with a watermark declared; Spark keeps the per-key window
state in the state store (RocksDB), partitioned by the grouping key, and emits a window
in append mode once the watermark passes its end.

Known differences from the batch definitions, documented rather than hidden:
* Spark filters late rows with the *previous* micro-batch's watermark and silently drops
  them; the exact late set and allowed-lateness refinements come from
  :mod:`tidemark.streaming.lateness`.
* Append mode does not flush open windows at the end of a bounded input; run bounded
  inputs through the batch path, or use update/complete mode.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import epoch_micros, interval, interval_seconds, to_stream_time
from tidemark.operators.topn import top_n
from tidemark.operators.windows import window_agg


def with_event_time(df: DataFrame, ts: str, delay: str, source: str | Column | None = None) -> DataFrame:
    """L1-L3 for streams: event time (zone-aware, as ``withWatermark`` requires) plus a
    watermark of ``delay`` (``"0 seconds"`` = ascending timestamps)."""
    col = F.col(source) if isinstance(source, str) else (source if source is not None else F.col(ts))
    return df.withColumn(ts, to_stream_time(col)).withWatermark(ts, delay)


def windowed(df: DataFrame, keys: Sequence[str], window: Column, aggs: Sequence[Column]) -> DataFrame:
    """W1-W3, W6-W8 on a stream: identical to the batch ``window_agg``."""
    return window_agg(df, keys, window, aggs)


def running_counts(lines_or_pairs: DataFrame, keys: Sequence[str], value: str | None = None,
                   name: str = "n") -> DataFrame:
    """A1/A3 on a stream: keyed running total, emitted per micro-batch in update mode
    (one row per changed key) -- the per-record form is
    :func:`tidemark.streaming.state.running_sum_stream`."""
    agg = F.count(F.lit(1)) if value is None else F.sum(F.col(value).cast("bigint"))
    return lines_or_pairs.groupBy(*keys).agg(agg.alias(name))


def window_join(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str,
                size: str) -> DataFrame:
    """J1 on two watermarked streams: equality on key and window start. The redundant
    bound ``|right_ts - left_ts| < size`` (true for any same-window pair) lets Spark evict
    each side's state once the other side's watermark has passed."""
    l = left.withColumn("window_start", F.window(left_ts, size).start)
    r = (right.withColumnRenamed(on, "_tm_rkey")
         .withColumn("_tm_rws", F.window(right_ts, size).start))
    cond = ((l[on] == r["_tm_rkey"]) & (l["window_start"] == r["_tm_rws"])
            & (r[right_ts] > l[left_ts] - interval(size)) & (r[right_ts] < l[left_ts] + interval(size)))
    j = l.join(r, cond, "inner")
    rest_l = [c for c in left.columns if c != on]
    rest_r = [c for c in right.columns if c != on]
    return j.select(on, "window_start", (F.col("window_start") + interval(size)).alias("window_end"),
                    *rest_l, *rest_r)


def interval_join(left: DataFrame, right: DataFrame, on: str, left_ts: str, right_ts: str,
                  lower: str, upper: str, bucketed: bool = True) -> DataFrame:
    """J2 on two watermarked streams: Spark's stream-stream join keeps each side's rows
    in state until the other side's watermark passes the range, then evicts them. The
    joint watermark is the minimum of the inputs' (``multipleWatermarkPolicy=min``).

    As in the batch form, the key is extended by a time bucket of width
    ``lower + upper`` (the right row is copied to the at most two buckets its range
    reaches), so a new row is compared only with buffered rows of nearby time, not with
    every buffered row of its key."""
    r = right.withColumnRenamed(on, "_tm_rkey")
    l = left
    cond = ((l[on] == r["_tm_rkey"])
            & (r[right_ts] >= l[left_ts] - interval(lower))
            & (r[right_ts] <= l[left_ts] + interval(upper)))
    if bucketed:
        lo, hi = interval_seconds(lower), interval_seconds(upper)
        w_us = int(max(lo + hi, 1) * 1_000_000)
        l = l.withColumn("_tm_b", F.floor(epoch_micros(left_ts) / w_us))
        r_us = epoch_micros(right_ts)
        r = r.withColumn("_tm_rb", F.explode(F.sequence(F.floor((r_us - int(hi * 1_000_000)) / w_us),
                                                       F.floor((r_us + int(lo * 1_000_000)) / w_us))))
        cond = ((l[on] == r["_tm_rkey"]) & (l["_tm_b"] == r["_tm_rb"])
                & (r[right_ts] >= l[left_ts] - interval(lower))
                & (r[right_ts] <= l[left_ts] + interval(upper)))
    j = l.join(r, cond, "inner")
    rest_l = [c for c in left.columns if c != on]
    rest_r = [c for c in right.columns if c != on]
    return j.select(on, *rest_l, *rest_r)


def top_n_writer(group_by: Sequence[str], order_by: Sequence[Column], n: int,
                 salt_cols: Sequence[str], write):
    """ST4 on a stream, as a ``foreachBatch`` function over the append-mode output of a
    windowed count: all keys of a window are released in the same micro-batch (when
    the watermark passes its end), so ranking inside the batch is exact. ``write``
    receives ``(top_rows, batch_id)``."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        write(top_n(batch, group_by, order_by, n, salt_cols), batch_id)

    return fn
