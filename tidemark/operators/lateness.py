"""Event time, watermarks, allowed lateness and late-row side outputs (L1-L7), as a
deterministic replay over a bounded table in arrival order.

Definitions (D = out-of-orderness bound, L = allowed lateness). For each row in arrival
order, ``wm = max(event time of all earlier rows) - D``; null before the first row.

* window rows: *on time* if ``wm`` is null or ``window_end > wm``; *allowed late* if
  ``window_end + L > wm``; otherwise *late* (side output).
* join rows: ``wm = min(max earlier left time, max earlier right time) - D``, null until
  both sides have a row; a row is *late* if ``ts < wm`` (interval join) or if its window has
  ended, ``window_end <= wm`` (window join).

This is the per-row limit of a periodically emitted watermark, so the result does not
depend on timing. Spark's own streaming late filter lags one micro-batch and drops
instead of emitting, so it is not used as the definition; the streaming operator in
:mod:`tidemark.streaming.lateness` reproduces this replay exactly.

The watermark is a running maximum over the *global* arrival order. It is computed with
the two-level :func:`tidemark.plans.prefix.prefix_scan` (buckets of an integer arrival
order given as ``bucket``, else range slices of it), never with an unpartitioned window that would pull the table into one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import col, interval
from tidemark.plans.prefix import Scan, prefix_scan

ON_TIME = "on_time"
ALLOWED_LATE = "allowed_late"
LATE = "late"


def with_event_time(df: DataFrame, seconds_field: str, name: str = "ts") -> DataFrame:
    """L1: assign event time from an integer field in seconds."""
    return df.withColumn(name, F.timestamp_seconds(F.col(seconds_field)))


def arrival_watermark(df: DataFrame, ts: str, arrival: Sequence[str], delay: str,
                      name: str = "wm", ranges: int | None = None,
                      carried: Column | None = None, bucket: Column | None = None) -> DataFrame:
    """L2 (delay ``"0 seconds"``) / L3: the watermark each row meets on arrival.

    ``carried`` is the maximum event time of rows that came before ``df`` (the earlier
    micro-batches of a stream); null for a whole table."""
    s = prefix_scan(df, arrival, {"_tm_max": Scan("max", F.col(ts), inclusive=False)},
                    ranges=ranges, bucket=bucket)
    seen = F.col("_tm_max") if carried is None else F.greatest(carried, F.col("_tm_max"))
    return s.withColumn(name, seen - interval(delay)).drop("_tm_max")


def classify_window_rows(df: DataFrame, ts: str, arrival: Sequence[str], size: str,
                         delay: str, allowed: str = "0 seconds", name: str = "lateness",
                         ranges: int | None = None, carried: Column | None = None,
                         bucket: Column | None = None, slide: str | None = None) -> DataFrame:
    """Tag each row ``on_time`` / ``allowed_late`` / ``late`` for its window; adds
    ``window_start``, ``window_end``, ``wm`` and ``name``. With ``slide`` the windows are
    sliding ones, and a row has one class for each window that it is in."""
    d = arrival_watermark(df, ts, arrival, delay, ranges=ranges, carried=carried, bucket=bucket)
    # the window comes behind the scan: a sliding one multiplies the rows
    w = F.window(F.col(ts), size, slide)
    d = d.withColumn("_tm_w", w).withColumns({"window_start": F.col("_tm_w.start"), "window_end": F.col("_tm_w.end")}).drop("_tm_w")
    end, wm = F.col("window_end"), F.col("wm")
    return d.withColumn(name, F.when(wm.isNull() | (end > wm), F.lit(ON_TIME))
                        .when(end + interval(allowed) > wm, F.lit(ALLOWED_LATE))
                        .otherwise(F.lit(LATE)))


def watermarked_windows(df: DataFrame, keys: Sequence[str], ts: str, arrival: Sequence[str],
                        size: str, delay: str, aggs: Sequence, ranges: int | None = None,
                        bucket: Column | None = None, slide: str | None = None) -> DataFrame:
    """W6/W7 + L2/L3 without allowed lateness: each event-time window as it fires
    once the watermark passes its end, aggregating its on-time rows; rows arriving after
    that are dropped (no side output). A window holding only late rows never fires."""
    c = classify_window_rows(df, ts, arrival, size, delay, ranges=ranges, bucket=bucket, slide=slide)
    keys = list(keys)
    return (c.where(F.col("lateness") == ON_TIME)
            .groupBy(*keys, "window_start", "window_end").agg(*aggs))


def side_outputs(classified: DataFrame, name: str = "lateness") -> dict[str, DataFrame]:
    """Output tag -> DataFrame. ``main`` holds the rows the windows count (on time
    and allowed late), ``late`` the rows past the allowed lateness."""
    return {"main": classified.where(F.col(name) != LATE),
            "late": classified.where(F.col(name) == LATE)}


def refinements(classified: DataFrame, keys: Sequence[str], arrival: Sequence[str],
                name: str = "lateness", ranges: int | None = None) -> DataFrame:
    """Every firing of every (key, window), with the row count it reports.

    The window first fires when the watermark passes its end, with its on-time rows
    (``firing = 0``, only if it has any). Each allowed-late row then fires it again with
    the updated count: the i-th such row (in arrival order) gives ``firing = i`` and
    ``n = on-time rows + i``. Late rows never fire.
    """
    keys = list(keys)
    wkeys = keys + ["window_start", "window_end"]
    classified = classified.select(*wkeys, *arrival, name)
    base = classified.groupBy(*wkeys).agg(
        F.count(F.when(F.col(name) == ON_TIME, 1)).alias("_tm_n0"))
    first = base.where(F.col("_tm_n0") > 0).select(
        *wkeys, F.lit(0).cast("bigint").alias("firing"), F.col("_tm_n0").alias("n"))
    allowed = classified.where(F.col(name) == ALLOWED_LATE)
    ranked = prefix_scan(allowed, arrival, {"firing": Scan("count", F.lit(1))},
                         partition_by=wkeys, ranges=ranges)
    later = (ranked.join(base, on=wkeys, how="inner")
             .select(*wkeys, F.col("firing").cast("bigint").alias("firing"),
                     (F.col("_tm_n0") + F.col("firing")).alias("n")))
    return first.unionByName(later)


def join_lateness(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str,
                  arrival: Sequence[str], delay: str, ranges: int | None = None,
                  bucket: Column | None = None, window: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Flag each row of both join inputs ``late`` under the joint watermark (the
    minimum of the two sides'), both inputs sharing one arrival order. A row is late if its
    time is below the watermark, or with ``window`` (the size of tumbling windows) if its
    window's end is not above it.

    Returns ``(left, right)`` with a boolean ``late`` column added. Both read the rows that
    the scan has stored; nothing is stored a second time.
    """
    tagged = (left.withColumn("_tm_side", F.lit("L")).withColumn("_tm_t", F.col(left_ts))
              .unionByName(right.withColumn("_tm_side", F.lit("R"))
                           .withColumn("_tm_t", F.col(right_ts)), allowMissingColumns=True))
    is_left = F.col("_tm_side") == "L"
    s = prefix_scan(tagged, arrival, {
        "_tm_ml": Scan("max", F.when(is_left, F.col("_tm_t")), inclusive=False),
        "_tm_mr": Scan("max", F.when(~is_left, F.col("_tm_t")), inclusive=False)},
        ranges=ranges, bucket=bucket)
    wm = F.when(F.col("_tm_ml").isNotNull() & F.col("_tm_mr").isNotNull(),
                F.least("_tm_ml", "_tm_mr") - interval(delay))
    past = F.col("_tm_t") < wm if window is None else F.window(F.col("_tm_t"), window).end <= wm
    s = s.withColumn("late", F.coalesce(past, F.lit(False)))
    l_out = s.where(is_left).select(*left.columns, "late")
    r_out = s.where(~is_left).select(*right.columns, "late")
    return l_out, r_out
