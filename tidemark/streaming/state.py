"""Keyed state for streams (ST1, ST2, ST5, A3 per record) with ``transformWithStateInPandas``.

Each processor keeps a few numbers per key in the RocksDB state store and emits one
row per input row (or per count-window firing). Rows of one key inside a micro-batch
are ordered by an explicit sequence column (arrival order), and the per-batch work is
vectorized in pandas; only the handful of state values per key is read and written.

Time mode is ``None`` where nothing depends on event time: in that mode no row is dropped
by a watermark. The windowed top-N uses event-time timers.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from typing import Any, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


# What stands for a null, whose place is told by a flag, so that whole numbers stay whole
# next to it. Column names that reach a state function must not begin with an underscore.
_FILL = {"tinyint": 0, "smallint": 0, "int": 0, "bigint": 0, "float": 0.0, "double": 0.0, "string": ""}


def _filled(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    fill = _FILL.get(kind.simpleString())
    return F.col(column) if fill is None else F.coalesce(column, F.lit(fill).cast(kind))


def _batch(rows: Iterator[pd.DataFrame], seq: str | Sequence[str]) -> pd.DataFrame:
    """One key's rows of one micro-batch, in arrival order (``seq``: one column or a
    list of columns, compared in turn)."""
    frames = list(rows)
    pdf = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
    return pdf.sort_values(list(seq) if not isinstance(seq, str) else seq,
                           kind="stable").reset_index(drop=True)


class RunningCountProcessor(StatefulProcessor):
    """ST1: per key, a map ``level -> rows seen``; each row gets the count of its level
    so far (including itself). ``level_type`` is the level column's SQL type; a null level
    is a level of its own."""

    def __init__(self, level: str, seq: str, out: str = "running_n", level_type: str = "string"):
        self.level, self.seq, self.out, self.level_type = level, seq, out, level_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", f"level {self.level_type}, missing boolean", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _batch(rows, self.seq)
        # a column with a null may come as floats: whole numbers are made whole again
        whole = self.level_type in ("tinyint", "smallint", "int", "bigint")
        code, levels = pd.factorize(pdf[self.level], use_na_sentinel=True)
        prev, names = {}, {}
        for c in sorted(set(code)):
            missing = c < 0
            level = levels[c] if not missing else (0 if whole else None)
            level = int(level) if whole else level.item() if hasattr(level, "item") else level
            names[c] = (level, bool(missing))
            got = self.counts.getValue(names[c])
            prev[c] = got[0] if got else 0
        codes = pd.Series(code)
        pdf[self.out] = codes.groupby(codes).cumcount() + 1 + codes.map(prev)
        for c, n in pdf[self.out].groupby(codes).max().items():
            self.counts.updateValue(names[c], (int(n),))
        yield pdf

    def close(self) -> None:
        pass


class RunningAggProcessor(StatefulProcessor):
    """A3 / ST2: per key a value state ``(sum, count)``; each row gets the running sum
    or running average (double) of ``value`` so far. Whole numbers are summed as longs,
    others as doubles; nulls are skipped, as by the batch form: the sum is null before the
    first value."""

    def __init__(self, value: str, seq: str, out: str, kind: str = "avg", whole: bool = True):
        self.value, self.seq, self.out, self.kind, self.whole = value, seq, out, kind, whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", f"s {'long' if self.whole else 'double'}, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _batch(rows, self.seq)
        got = self.acc.get()
        s0, n0 = (got[0], got[1]) if got else (0, 0)
        value, there = pdf[self.value], pdf[self.value].notna()
        plain = value.where(there, 0).astype("int64" if self.whole else "float64")
        s, n = plain.cumsum() + s0, there.astype("int64").cumsum() + n0
        if self.kind == "sum":
            pdf[self.out] = (s.astype("Int64") if self.whole else s).where(n > 0)
        else:
            pdf[self.out] = s.astype("float64") / n.where(n > 0)
        self.acc.update((int(s.iloc[-1]) if self.whole else float(s.iloc[-1]), int(n.iloc[-1])))
        yield pdf

    def close(self) -> None:
        pass


class CountWindowProcessor(StatefulProcessor):
    """ST5 for W4 / W5: per key a list state buffering the last rows and a value state
    with the row number. Fires every ``slide`` rows with the last ``size`` rows (up to
    ``size``); ``slide == size`` gives tumbling windows, which fire only when full.

    Output per firing: key columns, ``fire_seq`` (row number of the firing row),
    ``group_no`` (tumbling only, 0-based), ``n``, ``first_seq``, ``last_seq`` and the sum of
    ``value``.
    """

    def __init__(self, keys: Sequence[str], seq: str, value: str, size: int, slide: int):
        self.keys, self.seq, self.value, self.size, self.slide = list(keys), seq, value, size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("buf", "rn long, seq long, value long")
        self.rn = handle.getValueState("rn", "rn long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _batch(rows, self.seq)
        got = self.rn.get()
        rn0 = got[0] if got else 0
        new = pd.DataFrame({"rn": range(rn0 + 1, rn0 + len(pdf) + 1),
                            "seq": pdf[self.seq].astype("int64").values,
                            "value": pdf[self.value].astype("int64").values})
        old = pd.DataFrame(list(self.buf.get()), columns=["rn", "seq", "value"]) \
            if self.buf.exists() else new.iloc[0:0]
        allr = pd.concat([old, new], ignore_index=True).astype("int64")
        last_rn = rn0 + len(pdf)
        first_fire = ((rn0 // self.slide) + 1) * self.slide
        fires = np.arange(first_fire, last_rn + 1, self.slide, dtype="int64")
        # row numbers are contiguous: a firing's rows are a slice, its sum a difference
        base = int(allr.rn.iloc[0])
        hi, lo = fires - base + 1, np.maximum(fires - self.size - base + 1, 0)
        total = np.concatenate(([0], np.cumsum(allr.value.to_numpy())))
        seqs = allr.seq.to_numpy()  # in arrival order, so rising
        res = pd.DataFrame({"fire_seq": fires, "n": hi - lo, "first_seq": seqs[lo[:len(fires)]] if len(fires) else fires,
                            "last_seq": seqs[hi - 1] if len(fires) else fires, "value_sum": total[hi] - total[lo]})
        keep_from = last_rn - self.size + 2 if self.slide != self.size \
            else (last_rn // self.size) * self.size + 1
        keep = allr[allr.rn >= keep_from]
        self.buf.clear()
        if len(keep):
            self.buf.put([tuple(int(x) for x in r) for r in keep.itertuples(index=False)])
        self.rn.update((last_rn,))
        for i, k in enumerate(self.keys):
            res.insert(i, k, key[i])
        if self.slide == self.size:
            res.insert(len(self.keys) + 1, "group_no", (res.fire_seq - 1) // self.size)
        yield res

    def close(self) -> None:
        pass


class SlidingStates:
    """The merged state of the last ``size`` values, without an inverse of ``merge``: two stacks,
    one of states merged up to the older end, one with a running state. Each value is merged at
    most twice on its way."""

    def __init__(self, size: int, merge: Callable[[Any, Any], Any]):
        self.size, self.merge = size, merge
        self.older: list = []  # the top is the merged state of all of it
        self.newer: list = []
        self.running: Any = None

    def push(self, state: Any) -> None:
        if len(self) == self.size:
            if not self.older:
                for s in reversed(self.newer):
                    self.older.append(self.merge(s, self.older[-1]) if self.older else s)
                self.newer = []
            self.older.pop()
        self.running = self.merge(self.running, state) if self.newer else state
        self.newer.append(state)

    def __len__(self) -> int:
        return len(self.older) + len(self.newer)

    def merged(self) -> Any:
        if not self.older or not self.newer:
            return self.running if self.newer else self.older[-1]
        return self.merge(self.older[-1], self.running)


class CountWindowAggProcessor(StatefulProcessor):
    """ST5 for W4 / W5 with a user's aggregate (``start`` of a value, ``merge``, ``result``):
    per key the number of rows so far, and a list of those values that a later firing still
    needs (fewer than ``size``). Rows are taken in the order of all of ``seq`` columns."""

    def __init__(self, keys: Sequence[str], seq: Sequence[str], value: str, value_type: str, size: int, slide: int,
                 start: Callable[[Any], Any], merge: Callable[[Any, Any], Any], result: Callable[[Any], dict], names: Sequence[str]):
        self.keys, self.seq, self.value, self.value_type = list(keys), list(seq), value, value_type
        self.size, self.slide, self.start, self.merge, self.result, self.names = size, slide, start, merge, result, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", f"value {self.value_type}, missing boolean")
        self.rows = handle.getValueState("rows", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _batch(rows, self.seq)
        got = self.rows.get()
        at = got[0] if got else 0
        held = [None if missing else value for value, missing in self.held.get()] if self.held.exists() else []
        window = SlidingStates(self.size, self.merge)
        for value in held:
            window.push(self.start(value))
        values = [None if missing else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v.item() if hasattr(v, "item") else v
                  for v, missing in zip(pdf[self.value], pdf["tm_missing"], strict=True)]
        out: dict[str, list] = {c: [] for c in ("fire_seq", "n", *self.names)}
        for at, value in enumerate(values, at + 1):
            window.push(self.start(value))
            if at % self.slide == 0:
                result = self.result(window.merged())
                for name, v in (("fire_seq", at), ("n", len(window)), *((c, result[c]) for c in self.names)):
                    out[name].append(v)
        need = at % self.size if self.slide == self.size else self.size - 1
        kept = [*held, *values][-need:] if need else []
        self.held.put([(_FILL.get(self.value_type, v) if v is None else v, v is None) for v in kept]) if kept else self.held.clear()
        self.rows.update((at,))
        fired = out["fire_seq"]
        res = {k: [key[i]] * len(fired) for i, k in enumerate(self.keys)} | {"fire_seq": fired}
        if self.slide == self.size:
            res["group_no"] = [(f - 1) // self.size for f in fired]
        yield pd.DataFrame(res | out, dtype=object)

    def close(self) -> None:
        pass


def count_window_agg_stream(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str], value: str, size: int, slide: int | None,
                            start: Callable[[Any], Any], merge: Callable[[Any, Any], Any], result: Callable[[Any], dict],
                            schema: T.StructType | str) -> DataFrame:
    """W4 (``slide`` None) / W5 on a stream with any aggregate: keys, ``fire_seq`` (the row that
    fires), ``group_no`` (tumbling), ``n`` and the columns ``schema`` of ``result``.

    ``start`` makes the state of one value (None for a null), ``merge(a, b)`` joins the state of
    values with that of the ones behind them, ``result`` gives the columns. ``merge`` must be
    associative and must not change its arguments; it needs no inverse (minimum, maximum) and
    may depend on the order. Tumbling windows fire when full; a sliding one holds up to
    ``size`` rows. Work is linear in the rows, and a micro-batch also reads the fewer than
    ``size`` values held."""
    _use_rocksdb(df)
    slide, seq = slide or size, [seq] if isinstance(seq, str) else list(seq)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [df.schema[k] for k in keys] + [T.StructField("fire_seq", T.LongType())]
    if slide == size:
        fields.append(T.StructField("group_no", T.LongType()))
    fields += [T.StructField("n", T.LongType()), *schema.fields]
    kind = df.schema[value].dataType
    rows = df.select(*dict.fromkeys([*keys, *seq]), _filled(df, value).alias("tm_value"), F.col(value).isNull().alias("tm_missing"))
    return rows.groupBy(*keys).transformWithStateInPandas(
        CountWindowAggProcessor(keys, seq, "tm_value", kind.simpleString(), size, slide, start, merge, result, schema.names),
        T.StructType(fields), "append", "None")


class BestOfProcessor(StatefulProcessor):
    """ST3 / U8 / ST4: per group, its first column the end of a window, a list of the at most
    ``n`` keys with most rows so far, ties to the smaller key (a null key is the smallest),
    and an event-time timer at that end. When the watermark passes it, they come out, with
    their rank if ``ranked``, and the state goes. Input rows hold a key each, with its rows
    counted, and may come in any number of batches."""

    def __init__(self, key: str, n: int, key_type: str, ranked: bool):
        self.key, self.n, self.key_type, self.ranked = key, n, key_type, ranked

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", f"key {self.key_type}, missing boolean, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        for pdf in rows:  # one Arrow batch after the other
            values = (k.to_pydatetime() if isinstance(k, pd.Timestamp) else k.item() if hasattr(k, "item") else k
                      for k in pdf[self.key])
            new = zip(values, map(bool, pdf["tm_missing"]), map(int, pdf["n"]), strict=True)
            held = heapq.nsmallest(self.n, [*held, *new], key=lambda r: (-r[2], not r[1], 0 if r[1] else r[0]))
        self.best.put(held)
        self.handle.registerTimer(int(pd.Timestamp(key[0]).timestamp() * 1000))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.best.get()]
        self.best.clear()
        out = pd.DataFrame({"window_end": [key[0]] * len(held), self.key: pd.Series([k for k, _, _ in held], dtype=object),
                            "tm_missing": [m for _, m, _ in held], "n": [c for _, _, c in held]})
        if self.ranked:
            out["rank"] = range(1, len(held) + 1)
        else:  # event time of the next step: the last moment of the window
            out["tm_at"] = out["window_end"] - pd.Timedelta(microseconds=1)
        yield out

    def close(self) -> None:
        pass


def window_top_n_stream(df: DataFrame, key: str, ts: str, size: str, slide: str, n: int, slices: int = 32) -> DataFrame:
    """ST4 with timers on a watermarked stream (``ts`` carries the watermark): ``window_end,
    rank, <key>, n`` for the sliding windows as they end.

    Three steps, each on the watermark of the one before: rows are counted per window and
    key by the built-in aggregate (pre-aggregated, so a hot key is a few rows); each window's
    keys are dealt to ``slices`` groups that keep their ``n`` best; these ``slices * n`` rows
    at most are merged per window. No state of one key holds a window. A null key counts
    like any other, as in the batch form; late rows are dropped."""
    _use_rocksdb(df)
    field = df.schema[key]
    kind = field.dataType
    counts = df.select(ts, key).groupBy(F.window(ts, size, slide).alias("_tm_w"), key).agg(F.count(F.lit(1)).alias("n"))
    dealt = counts.select(F.window_time("_tm_w").alias("tm_at"), F.col("_tm_w.end").alias("window_end"),
                          F.pmod(F.xxhash64(key), F.lit(slices)).alias("tm_slice"), _filled(df, key).alias(key),
                          F.col(key).isNull().alias("tm_missing"), "n")
    kept = [T.StructField("window_end", T.TimestampType()), T.StructField(key, kind),
            T.StructField("tm_missing", T.BooleanType()), T.StructField("n", T.LongType())]
    simple = kind.simpleString()
    sliced = dealt.groupBy("window_end", "tm_slice").transformWithStateInPandas(
        BestOfProcessor(key, n, simple, False), T.StructType([*kept, T.StructField("tm_at", T.TimestampType())]),
        "append", "EventTime", eventTimeColumnName="tm_at")
    merged = sliced.groupBy("window_end").transformWithStateInPandas(
        BestOfProcessor(key, n, simple, True), T.StructType([*kept, T.StructField("rank", T.LongType())]), "append", "EventTime")
    return merged.select("window_end", "rank", F.when(~F.col("tm_missing"), F.col(key)).alias(key), "n")


def _whole(df: DataFrame, value: str) -> bool:
    return isinstance(df.schema[value].dataType, T.IntegralType)


def _schema(df: DataFrame, extra: list[T.StructField]) -> T.StructType:
    _use_rocksdb(df)
    return T.StructType(list(df.schema.fields) + extra)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _use_rocksdb(df: DataFrame) -> None:
    """``transformWithState`` keeps its state only in the RocksDB state store: select it
    for queries started from now on unless the session already did."""
    conf = df.sparkSession.conf
    if ROCKSDB.split(".")[-1] not in (conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def running_count_stream(df: DataFrame, keys: Sequence[str], level: str, seq: str | Sequence[str],
                         out: str = "running_n") -> DataFrame:
    """ST1 per record on a stream (the batch form is ``operators.running.running_count``
    with keys + level)."""
    schema = _schema(df, [T.StructField(out, T.LongType())])
    return df.groupBy(*keys).transformWithStateInPandas(
        RunningCountProcessor(level, seq, out, df.schema[level].dataType.simpleString()), schema, "append", "None")


def running_avg_stream(df: DataFrame, keys: Sequence[str], value: str, seq: str | Sequence[str],
                       out: str = "running_avg") -> DataFrame:
    """ST2 per record on a stream."""
    schema = _schema(df, [T.StructField(out, T.DoubleType())])
    return df.groupBy(*keys).transformWithStateInPandas(
        RunningAggProcessor(value, seq, out, "avg", _whole(df, value)), schema, "append", "None")


def running_sum_stream(df: DataFrame, keys: Sequence[str], value: str, seq: str | Sequence[str],
                       out: str = "running_sum") -> DataFrame:
    """A3 per record on a stream (one output per input row)."""
    whole = _whole(df, value)
    schema = _schema(df, [T.StructField(out, T.LongType() if whole else T.DoubleType())])
    return df.groupBy(*keys).transformWithStateInPandas(
        RunningAggProcessor(value, seq, out, "sum", whole), schema, "append", "None")


def count_window_stream(df: DataFrame, keys: Sequence[str], seq: str, value: str, size: int,
                        slide: int | None = None) -> DataFrame:
    """W4 (``slide`` omitted) / W5 on a stream."""
    slide = slide or size
    _use_rocksdb(df)
    fields = [df.schema[k] for k in keys] + [T.StructField("fire_seq", T.LongType())]
    if slide == size:
        fields.append(T.StructField("group_no", T.LongType()))
    fields += [T.StructField(c, T.LongType()) for c in ("n", "first_seq", "last_seq", "value_sum")]
    return df.groupBy(*keys).transformWithStateInPandas(
        CountWindowProcessor(keys, seq, value, size, slide), T.StructType(fields), "append", "None")
