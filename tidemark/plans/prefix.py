"""Ordered running aggregates that stay parallel under skew.

``Window.partitionBy(key).orderBy(seq)`` puts every row of a key into one task, and
``Window.orderBy(seq)`` with no key puts the whole table into one task. Both break when
one key (or the whole stream) holds a large share of the rows. The scan below is the
classic two-level parallel prefix:

1. Rows are cut into *slices* that are contiguous in the order within each key. A hot
   key simply spans many slices.
2. Inside each (key, slice) a normal running window computes the local prefix.
3. A small summary, one row per (key, slice), gives each slice the total of all earlier
   slices of its key (an exclusive running aggregate over slice totals).
4. The summary is joined back on (key, slice) and combined with the local prefix.

Slices come from one of two places:

* ``bucket``: a deterministic column, monotone in the order, with a bound on rows per
  bucket known to the caller -- e.g. ``floor(event_id / 2**20)`` for a unique id order
  holds at most 2**20 rows per (key, bucket). No range shuffle and no checkpoint, but
  the summary holds one row per (key, bucket) the key touches: with many sparse keys
  whose ids interleave (users in a global event id space) that is as many rows as the
  data. Use it only for few, dense keys; the default below is right for both.
* otherwise ``repartitionByRange`` over (keys, order) into ``ranges`` sample-balanced
  slices, numbered by ``spark_partition_id``. A sparse key lies in one slice, a hot key
  spans many, so the summary has about ``#keys + ranges`` rows. The range sampler is seeded per RDD, so
  two separately planned copies of the exchange could cut differently; the sliced rows,
  with their local running values, are therefore checkpointed once (to the shared
  ``spark.checkpoint.dir``) and the summary and every later branch read those rows. This
  also cuts the lineage, so a lost executor never re-slices.

There is one plan for every input size and every key distribution; only the number of
slices follows the data (:func:`slice_count`: at most ``tidemark.scan.sliceRows`` rows each
on average, so a task's share has an absolute bound).

Only associative aggregates qualify (sum, count, max, min). The order must be total
(include a unique tie-breaker) for the result to be deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import default_ranges, ensure_checkpoint_dir

SLICE = "_tm_slice"


@dataclass(frozen=True)
class Scan:
    """One running aggregate: ``kind`` in sum/count/max/min over ``expr``.

    ``inclusive`` includes the current row (``ROWS UNBOUNDED PRECEDING``); otherwise only
    the rows before it (``... AND 1 PRECEDING``), as SQL does: null (or 0 for count) when
    there is no earlier row.
    """

    kind: str
    expr: Column
    inclusive: bool = True


_LOCAL = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
# How slice totals combine across slices: counts add up like sums.
_ACROSS = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, before: Column, local: Column) -> Column:
    if kind == "count":
        return F.coalesce(before, F.lit(0)) + F.coalesce(local, F.lit(0))
    if kind == "sum":
        return F.when(before.isNull() & local.isNull(), F.lit(None)).otherwise(
            F.coalesce(before, F.lit(0)) + F.coalesce(local, F.lit(0)))
    if kind == "max":
        return F.greatest(before, local)  # greatest/least skip nulls
    return F.least(before, local)


# Rows of an average range slice.
SLICE_ROWS = 1_000_000


def slice_count(df: DataFrame) -> int:
    """Range slices for ``df``: the shuffle partitions (or ``tidemark.scan.ranges``), and more
    where the counted rows need them to stay at ``tidemark.scan.sliceRows`` a slice."""
    spark = df.sparkSession
    rows = int(spark.conf.get("tidemark.scan.sliceRows", str(SLICE_ROWS)))
    return max(default_ranges(spark), -(-df.count() // rows))


def slice_rows(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (),
               ranges: int | None = None) -> DataFrame:
    """Range-slice ``df`` over (keys, order): adds ``SLICE``. The result must be read by
    one branch only (see :func:`prefix_scan`, which checkpoints right after it)."""
    n = ranges or slice_count(df)
    return (df.repartitionByRange(n, *[F.col(c) for c in list(partition_by) + list(order_by)])
            .withColumn(SLICE, F.spark_partition_id()))


def prefix_scan(df: DataFrame, order_by: Sequence[str], scans: dict[str, Scan],
                partition_by: Sequence[str] = (), ranges: int | None = None,
                keep_slice: bool = False, bucket: Column | None = None) -> DataFrame:
    """Add one column per entry of ``scans``: its running aggregate over ``order_by``
    (ascending) within ``partition_by``.

    In range mode the rows are checkpointed with all their columns (nothing can prune
    through a checkpoint): select the columns the caller needs before scanning.

    ``bucket`` supplies deterministic slices (see the module notes). If ``df`` already
    carries a slice column from an earlier scan with the same keys and order
    (``keep_slice=True``), that slicing is reused.
    """
    if df.isStreaming:
        raise ValueError("ordered scans are batch operators; on streams use "
                         "tidemark.streaming.state (per-key state) or tidemark.streaming.lateness "
                         "(foreachBatch), which apply them per micro-batch")
    keys = list(partition_by)
    order = list(order_by)
    for kind in (s.kind for s in scans.values()):
        if kind not in _LOCAL:
            raise ValueError(f"prefix_scan supports sum/count/max/min, not {kind!r}")

    ranged = False
    if SLICE in df.columns:
        sliced = df
    elif bucket is not None:
        sliced = df.withColumn(SLICE, bucket)
    else:
        ranged = True
        sliced = slice_rows(df, order, keys, ranges)

    # Null-safe grouping columns shared by the local window, the summary and the join:
    # the join then reuses the window's hash partitioning instead of shuffling the rows
    # again when the summary is too large to broadcast.
    gexprs = _group_columns(sliced, keys)
    gcols = list(gexprs)
    part = gcols + [SLICE]
    if not all(c in sliced.columns for c in gcols):  # reused as is after a kept slicing
        sliced = sliced.withColumns(gexprs)

    local_w = Window.partitionBy(*part).orderBy(*order)
    incl = local_w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    excl = local_w.rowsBetween(Window.unboundedPreceding, -1)
    local_cols = {f"_tm_local_{name}": _LOCAL[s.kind](s.expr).over(incl if s.inclusive else excl)
                  for name, s in scans.items()}
    with_local = sliced.withColumns(local_cols)
    if ranged:
        # Slicing and the local window run once, inside this checkpoint; the summary
        # below and every later consumer read the stored rows (still partitioned by
        # key and slice), so a chained scan on the same slicing needs no new shuffle.
        with_local = materialize(with_local)
        sliced = with_local

    # One row per (key, slice): the slice's total for every scan, then the total of all
    # earlier slices of the same key.
    totals = sliced.groupBy(*part).agg(
        *[_LOCAL[s.kind](s.expr).alias(f"_tm_tot_{name}") for name, s in scans.items()])
    before_w = (Window.partitionBy(*gcols).orderBy(SLICE)
                .rowsBetween(Window.unboundedPreceding, -1))
    before = totals.select(
        *part, *[_ACROSS[s.kind](F.col(f"_tm_tot_{name}")).over(before_w).alias(f"_tm_before_{name}")
                 for name, s in scans.items()])

    if ranged and not keys:
        # one row per slice: the size is bounded by the slice count, so broadcasting is safe
        before = F.broadcast(before)
    joined = with_local.join(before, on=part, how="left")
    out = joined.withColumns({
        name: _combine(s.kind, F.col(f"_tm_before_{name}"), F.col(f"_tm_local_{name}"))
        for name, s in scans.items()})
    drop = [c for c in out.columns if c.startswith(("_tm_local_", "_tm_before_"))]
    if not keep_slice:
        drop += gcols + [SLICE]
    return out.drop(*drop)


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` into the shared ``spark.checkpoint.dir`` when it feeds more than
    one branch of a plan: each branch then reads the stored rows instead of recomputing
    the scans and shuffles behind them, and the lineage is cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _zero(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(F.lit(0)).cast(dtype)
    raise TypeError(f"prefix_scan keys must be atomic, not {dtype.simpleString()}")


def _group_columns(df: DataFrame, keys: Sequence[str]) -> dict[str, Column]:
    """Per key: the value with nulls replaced, plus a null flag (so null stays its own
    group, as in ``partitionBy``)."""
    out = {}
    for i, k in enumerate(keys):
        field = df.schema[k]
        out[f"_tm_g{i}"] = F.coalesce(F.col(k), _zero(field.dataType)) if field.nullable else F.col(k)
        if field.nullable:
            out[f"_tm_z{i}"] = F.col(k).isNull()
    return out


def running_number(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (),
                   name: str = "rn", ranges: int | None = None, keep_slice: bool = False,
                   bucket: Column | None = None) -> DataFrame:
    """1-based row number in ``order_by`` within ``partition_by`` (a running count)."""
    return prefix_scan(df, order_by, {name: Scan("count", F.lit(1))}, partition_by,
                       ranges=ranges, keep_slice=keep_slice, bucket=bucket)


# Width of a bucket for orders by a dense integer: at most so many rows share a slice,
# times the rows that share a value.
ID_BUCKET_ROWS = 1 << 17


def id_buckets(id_col: str, rows: int = ID_BUCKET_ROWS) -> Column:
    """Deterministic slices for an order by a dense integer; a null has a slice of its own,
    before all others, as in the order."""
    return F.coalesce(F.floor(F.col(id_col) / rows), F.lit(-(1 << 62)))
