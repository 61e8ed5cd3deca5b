"""Allowed lateness and late-row side outputs on a stream (L5, L6), exactly.

Spark's own watermark handling cannot express these: it filters late rows one
micro-batch behind, drops them instead of emitting them, and never re-fires a window.
This operator runs inside ``foreachBatch`` and reproduces the batch replay of
:mod:`tidemark.operators.lateness` for the same arrival order, whatever the micro-batch
boundaries:

* the running maximum event time is carried from batch to batch, and inside a batch the
  per-row watermark is the skew-safe prefix maximum in arrival order;
* per (key, window) the state holds the on-time count, the number of allowed-late
  refinements so far and whether the first firing happened;
* a window fires (``firing = 0``) once the watermark reaches its end; each allowed-late
  row re-fires it with the updated count; late rows go to their own output;
* state for windows past ``end + allowed`` is dropped, so it stays bounded by the open
  windows.

State and outputs are versioned by batch id under ``state_dir`` / ``out_dir``: a
replayed batch reads the state version before it and overwrites its own outputs, so
retries and restarts produce no duplicates. The per-batch metadata row is written last
and marks the batch complete.
"""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions.time import interval
from tidemark.operators.lateness import ALLOWED_LATE, LATE, ON_TIME, classify_window_rows
from tidemark.plans.prefix import Scan, prefix_scan
from tidemark.session import delete_path

# State versions kept behind the newest committed one (a replay needs the one before it).
KEEP_VERSIONS = 2


def _join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts]) if "://" in base else os.path.join(base, *parts)


def _prune(spark: SparkSession, state_dir: str, parts: Sequence[str], batch_id: int) -> None:
    """Drop the state version that fell out of the retention window. Only versions older
    than the one a replay of the current batch would read are removed."""
    old = batch_id - KEEP_VERSIONS - 1
    if old >= 0:
        for part in parts:
            delete_path(spark, _join(state_dir, part, f"v={old}"))


class LatenessOperator:
    """Use as ``stream.writeStream.foreachBatch(op)``; after a bounded input ends, call
    :meth:`flush` to fire the windows the final watermark closes, then read
    :meth:`outputs`."""

    def __init__(self, state_dir: str, out_dir: str, keys: Sequence[str], ts: str,
                 arrival: Sequence[str], size: str, delay: str, allowed: str = "0 seconds",
                 ranges: int | None = None):
        self.state_dir, self.out_dir = state_dir, out_dir
        self.keys, self.ts, self.arrival = list(keys), ts, list(arrival)
        self.size, self.delay, self.allowed, self.ranges = size, delay, allowed, ranges
        self.wkeys = self.keys + ["window_start", "window_end"]

    # ------------------------------------------------------------------ state versions
    def _previous(self, spark: SparkSession, batch_id: int):
        try:
            meta = spark.read.parquet(_join(self.state_dir, "meta"))
        except AnalysisException:
            return None, None
        row = meta.where(F.col("v") < batch_id).orderBy(F.col("v").desc()).limit(1).collect()
        if not row:
            return None, None
        return row[0]["v"], row[0]["max_us"]

    def _windows(self, spark: SparkSession, version, like: DataFrame) -> DataFrame:
        if version is None:
            return like.select(*self.wkeys).limit(0).select(
                *self.wkeys, F.lit(0).cast("bigint").alias("n0"),
                F.lit(0).cast("bigint").alias("n_late"), F.lit(False).alias("fired"))
        return spark.read.parquet(_join(self.state_dir, "windows", f"v={version}"))

    # ------------------------------------------------------------------ one micro-batch
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev_v, prev_max = self._previous(spark, batch_id)
        ts = F.col(self.ts)
        ts_type = batch.schema[self.ts].dataType
        carried = F.timestamp_micros(F.lit(prev_max)).cast(ts_type) if prev_max is not None \
            else F.lit(None).cast(ts_type)
        rows = classify_window_rows(batch, self.ts, self.arrival, self.size, self.delay,
                                    self.allowed, ranges=self.ranges, carried=carried)
        # the classification reads the scan's checkpoint plus a broadcast summary, so the
        # outputs below re-read it cheaply instead of storing another copy

        # state after this batch
        counts = rows.groupBy(*self.wkeys).agg(
            F.count(F.when(F.col("lateness") == ON_TIME, 1)).alias("b_on"),
            F.count(F.when(F.col("lateness") == ALLOWED_LATE, 1)).alias("b_late"))
        old = self._windows(spark, prev_v, rows)
        st = (old.join(counts, on=self.wkeys, how="full_outer")
              .select(*self.wkeys,
                      (F.coalesce("n0", F.lit(0)) + F.coalesce("b_on", F.lit(0))).alias("n0"),
                      F.coalesce("n_late", F.lit(0)).alias("n_late_before"),
                      (F.coalesce("n_late", F.lit(0)) + F.coalesce("b_late", F.lit(0))).alias("n_late"),
                      F.coalesce("fired", F.lit(False)).alias("fired")))
        batch_max = rows.agg(F.max(F.unix_micros(ts.cast("timestamp"))).alias("m")).collect()[0]["m"]
        new_max = max([m for m in (prev_max, batch_max) if m is not None], default=None)
        wm_now = (F.timestamp_micros(F.lit(new_max)).cast(ts_type) - interval(self.delay)) \
            if new_max is not None else None
        st = st.checkpoint(eager=True)

        # firings: allowed-late refinements, then first firings the watermark now allows
        allowed = rows.where(F.col("lateness") == ALLOWED_LATE)
        ranked = prefix_scan(allowed, self.arrival, {"_tm_i": Scan("count", F.lit(1))},
                             partition_by=self.wkeys, ranges=self.ranges)
        refine = (ranked.join(st.select(*self.wkeys, "n0", "n_late_before"), on=self.wkeys)
                  .select(*self.wkeys, (F.col("n_late_before") + F.col("_tm_i")).alias("firing"),
                          (F.col("n0") + F.col("n_late_before") + F.col("_tm_i")).alias("n")))
        due = (~F.col("fired")) & (F.col("n0") > 0)
        due = due & (F.col("window_end") <= wm_now) if wm_now is not None else F.lit(False)
        first = st.where(due).select(*self.wkeys, F.lit(0).cast("bigint").alias("firing"),
                                     F.col("n0").alias("n"))
        firings = first.unionByName(refine).withColumn("batch_id", F.lit(batch_id).cast("long"))

        # outputs, then state, then the metadata row that marks the batch complete
        rows.drop("_tm_slice").write.mode("overwrite").parquet(
            _join(self.out_dir, "classified", f"batch={batch_id}"))
        rows.where(F.col("lateness") == LATE).drop("_tm_slice").write.mode("overwrite").parquet(
            _join(self.out_dir, "late", f"batch={batch_id}"))
        firings.write.mode("overwrite").parquet(_join(self.out_dir, "firings", f"batch={batch_id}"))
        keep = st.withColumn("fired", F.col("fired") | due)
        if wm_now is not None:
            keep = keep.where(F.col("window_end") + interval(self.allowed) > wm_now)
        keep.drop("n_late_before").write.mode("overwrite").parquet(
            _join(self.state_dir, "windows", f"v={batch_id}"))
        spark.createDataFrame([(new_max,)], "max_us bigint") \
            .write.mode("overwrite").parquet(_join(self.state_dir, "meta", f"v={batch_id}"))
        _prune(spark, self.state_dir, ["windows", "meta"], batch_id)

    # ------------------------------------------------------------------ end of input
    def flush(self, spark: SparkSession) -> None:
        """The final watermark of a bounded input closes every window: emit the first
        firing of each window that has on-time rows and has not fired yet."""
        last, _ = self._previous(spark, 1 << 62)
        if last is None:
            return
        st = spark.read.parquet(_join(self.state_dir, "windows", f"v={last}"))
        final = st.where(~F.col("fired") & (F.col("n0") > 0)).select(
            *self.wkeys, F.lit(0).cast("bigint").alias("firing"), F.col("n0").alias("n"),
            F.lit(last).cast("long").alias("batch_id"))
        final.write.mode("overwrite").parquet(_join(self.out_dir, "firings", "batch=final"))

    def outputs(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Side outputs by tag: ``classified`` (every row with its class), ``late`` and
        ``firings`` (first firings and refinements)."""
        out = {}
        for name in ("classified", "late", "firings"):
            try:
                out[name] = spark.read.parquet(_join(self.out_dir, name)).drop("batch")
            except AnalysisException:
                out[name] = None
        return out


def both_sides(left: DataFrame, right: DataFrame, side: str = "side") -> DataFrame:
    """Two input streams (e.g. two topics) as the one stream the late interval join
    reads: rows tagged ``"L"`` / ``"R"`` in ``side``, columns aligned by name (a column
    only one side has is null on the other)."""
    return (left.withColumn(side, F.lit("L"))
            .unionByName(right.withColumn(side, F.lit("R")), allowMissingColumns=True))


class IntervalJoinLateOperator:
    """J3 / L7 on a stream, exactly: an interval join of two inputs whose late rows go
    to per-side outputs, as the batch ``join_lateness`` + ``interval_join`` define it.

    The input is one stream carrying both sides (``side`` = ``"L"`` or ``"R"``; a union of
    two sources), with the key, the event time ``ts``, the arrival order columns and
    payload columns. Per micro-batch:

    * each row meets the joint watermark ``min(max left ts, max right ts) - delay`` of the
      rows before it (carried across batches, prefix maximum inside the batch) and is
      late if its time is below it;
    * non-late rows join the other side's buffered and new non-late rows, so every pair
      is produced once, in the batch where its later row arrives;
    * a buffered row is dropped once no future non-late row can reach it: left rows when
      ``ts + upper < wm``, right rows when ``ts + lower < wm`` (the watermark never moves
      back), so the buffers hold only the retention horizon.
    """

    def __init__(self, state_dir: str, out_dir: str, key: str, ts: str, arrival: Sequence[str],
                 payload: Sequence[str], lower: str, upper: str, delay: str, side: str = "side",
                 ranges: int | None = None):
        self.state_dir, self.out_dir = state_dir, out_dir
        self.key, self.ts, self.arrival, self.payload = key, ts, list(arrival), list(payload)
        self.lower, self.upper, self.delay, self.side, self.ranges = lower, upper, delay, side, ranges
        self.cols = [key, ts, *self.payload]

    def _previous(self, spark: SparkSession, batch_id: int):
        try:
            meta = spark.read.parquet(_join(self.state_dir, "meta"))
        except AnalysisException:
            return None, None, None
        row = meta.where(F.col("v") < batch_id).orderBy(F.col("v").desc()).limit(1).collect()
        return (row[0]["v"], row[0]["max_l"], row[0]["max_r"]) if row else (None, None, None)

    def _buffer(self, spark: SparkSession, version, name: str, like: DataFrame) -> DataFrame:
        if version is None:
            return like.select(*self.cols).limit(0)
        return spark.read.parquet(_join(self.state_dir, name, f"v={version}"))

    def _pairs(self, left: DataFrame, right: DataFrame) -> DataFrame:
        from tidemark.operators.joins import interval_join

        l = left.select(self.key, *[F.col(c).alias(f"l_{c}") for c in [self.ts, *self.payload]])
        r = right.select(self.key, *[F.col(c).alias(f"r_{c}") for c in [self.ts, *self.payload]])
        return interval_join(l, r, self.key, f"l_{self.ts}", f"r_{self.ts}", self.lower, self.upper)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev_v, max_l, max_r = self._previous(spark, batch_id)
        ts = F.col(self.ts)
        ts_type = batch.schema[self.ts].dataType
        is_left = F.col(self.side) == "L"
        us = F.unix_micros(ts.cast("timestamp"))
        rows = prefix_scan(batch, self.arrival, {
            "_tm_ml": Scan("max", F.when(is_left, us), inclusive=False),
            "_tm_mr": Scan("max", F.when(~is_left, us), inclusive=False)}, ranges=self.ranges)
        ml = F.greatest(F.lit(max_l).cast("bigint"), F.col("_tm_ml"))
        mr = F.greatest(F.lit(max_r).cast("bigint"), F.col("_tm_mr"))
        wm = F.when(ml.isNotNull() & mr.isNotNull(),
                    F.timestamp_micros(F.least(ml, mr)).cast(ts_type) - interval(self.delay))
        rows = rows.withColumn("late", F.coalesce(ts < wm, F.lit(False))).drop("_tm_ml", "_tm_mr")

        m = rows.agg(F.max(F.when(is_left, us)).alias("l"), F.max(F.when(~is_left, us)).alias("r")).collect()[0]
        new_l = max([x for x in (max_l, m["l"]) if x is not None], default=None)
        new_r = max([x for x in (max_r, m["r"]) if x is not None], default=None)

        fresh_l = rows.where(is_left & ~F.col("late")).select(*self.cols)
        fresh_r = rows.where(~is_left & ~F.col("late")).select(*self.cols)
        buf_l = self._buffer(spark, prev_v, "left", rows)
        buf_r = self._buffer(spark, prev_v, "right", rows)
        pairs = self._pairs(buf_l.unionByName(fresh_l), fresh_r).unionByName(self._pairs(fresh_l, buf_r))

        pairs.write.mode("overwrite").parquet(_join(self.out_dir, "joined", f"batch={batch_id}"))
        for tag, cond in (("left_late", is_left), ("right_late", ~is_left)):
            rows.where(cond & F.col("late")).select(*self.cols).write.mode("overwrite").parquet(
                _join(self.out_dir, tag, f"batch={batch_id}"))
        keep_l, keep_r = buf_l.unionByName(fresh_l), buf_r.unionByName(fresh_r)
        if new_l is not None and new_r is not None:
            wm_now = F.timestamp_micros(F.lit(min(new_l, new_r))).cast(ts_type) - interval(self.delay)
            keep_l = keep_l.where(ts + interval(self.upper) >= wm_now)
            keep_r = keep_r.where(ts + interval(self.lower) >= wm_now)
        keep_l.write.mode("overwrite").parquet(_join(self.state_dir, "left", f"v={batch_id}"))
        keep_r.write.mode("overwrite").parquet(_join(self.state_dir, "right", f"v={batch_id}"))
        spark.createDataFrame([(new_l, new_r)], "max_l bigint, max_r bigint").write.mode(
            "overwrite").parquet(_join(self.state_dir, "meta", f"v={batch_id}"))
        _prune(spark, self.state_dir, ["left", "right", "meta"], batch_id)

    def outputs(self, spark: SparkSession) -> dict[str, DataFrame]:
        out = {}
        for name in ("joined", "left_late", "right_late"):
            try:
                out[name] = spark.read.parquet(_join(self.out_dir, name)).drop("batch")
            except AnalysisException:
                out[name] = None
        return out
