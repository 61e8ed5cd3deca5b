"""User functions over groups that need not fit a worker.

* :func:`process_groups` hands a function all rows of one group as a stream of Arrow
  batches; a task holds one batch at a time, whatever the size of the group.
* :func:`user_aggregate` runs a user's create / add / merge / result. Each task adds its own
  rows up first; only states are shuffled, and they are merged in two steps, so a key that
  most rows share costs a task no more than the others.
* :func:`fold_ordered` folds rows in order with any associative function. Rows are dealt by
  ranges of (keys, order), so a hot key lies in many tasks, one behind the other; each folds
  its stretch, and the few stretches of a key are folded in their order.
"""

from __future__ import annotations

import itertools
import pickle
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

OUT_ROWS = 10_000     # rows of an output batch
HELD_STATES = 50_000  # states that a task holds before it sends them on
FAN_IN = 32           # first-step groups of a key's states
_STATE, _PART = "_tm_state", "_tm_part"


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _changes(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """One row of codes per key column; equal keys have equal codes, null included."""
    return np.array([batch.column(n).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for n in names])


def _runs(batch: pa.RecordBatch, names: Sequence[str], codes: np.ndarray) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The batch cut where a key column changes: (key, rows)."""
    if not len(batch):
        return
    edges = [0, *(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
    for a, e in itertools.pairwise(edges):
        yield tuple(batch.column(n)[a].as_py() for n in names), batch.slice(a, e - a)


def _batches(rows: Iterable[dict], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(schema)
    rows = iter(rows)
    while part := list(itertools.islice(rows, OUT_ROWS)):
        yield pa.RecordBatch.from_pylist(part, schema=arrow)


def _over_groups(df: DataFrame, keys: Sequence[str], fn: Callable[[dict, Iterator[pa.RecordBatch]], Iterable[dict]],
                 schema: T.StructType) -> DataFrame:
    keys = list(keys)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        runs = (r for b in batches for r in _runs(b, keys, _changes(b, keys)))
        for key, run in itertools.groupby(runs, key=lambda r: r[0]):
            yield from fn(dict(zip(keys, key, strict=True)), (b for _, b in run))

    return df.mapInArrow(lambda batches: _batches(rows(batches), schema), schema)


def process_groups(df: DataFrame, keys: Sequence[str], fn: Callable[[dict, Iterator[pa.RecordBatch]], Iterable[dict]],
                   schema: T.StructType | str, order: Sequence[str | Column] = ()) -> DataFrame:
    """``fn(key, batches)`` for each group of ``keys`` (window bounds included),
    its rows in ``order``; what it yields are rows of ``schema``.

    ``batches`` is read while Spark sorts and spills on the JVM's side. ``fn`` may leave rows
    unread. Null keys make a group. The group itself is one task's work, as the feature
    asks: use :func:`user_aggregate` or :func:`fold_ordered` where states can be merged.
    """
    sorted_rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return _over_groups(sorted_rows, keys, fn, _struct(schema))


class UserAggregate(ABC):
    """An aggregate in user code. States are pickled between tasks."""

    @abstractmethod
    def create(self) -> Any:
        """The state of no rows."""

    @abstractmethod
    def add(self, state: Any, rows: pa.RecordBatch) -> Any:
        """The state with these rows added, in any order."""

    @abstractmethod
    def merge(self, a: Any, b: Any) -> Any:
        """The state of the rows of both."""

    @abstractmethod
    def result(self, state: Any) -> dict:
        """The result columns."""


def user_aggregate(df: DataFrame, keys: Sequence[str], agg: UserAggregate, schema: T.StructType | str) -> DataFrame:
    """``agg`` over each group of ``keys``: the keys and the result columns ``schema``."""
    keys = list(keys)
    key_schema = df.select(*keys).schema
    partial = T.StructType([*key_schema.fields, T.StructField(_PART, T.IntegerType()), T.StructField(_STATE, T.BinaryType())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}
        part = TaskContext.get().partitionId() % FAN_IN

        def sent() -> Iterator[pa.RecordBatch]:
            yield from _batches(({**dict(zip(keys, k, strict=True)), _PART: part, _STATE: pickle.dumps(s)} for k, s in states.items()), partial)
            states.clear()

        for b in batches:
            codes = _changes(b, keys)
            order = np.lexsort(codes)
            for key, rows in _runs(b.take(pa.array(order)), keys, codes[:, order]):
                states[key] = agg.add(states[key] if key in states else agg.create(), rows)
            if len(states) > HELD_STATES:
                yield from sent()
        yield from sent()

    def merged(batches: Iterator[pa.RecordBatch]) -> Any:
        states = (pickle.loads(s) for b in batches for s in b.column(_STATE).to_pylist())
        state = next(states)
        for s in states:
            state = agg.merge(state, s)
        return state

    states = df.mapInArrow(add_up, partial)
    first = process_groups(states, [*keys, _PART], lambda key, b: [{**key, _STATE: pickle.dumps(merged(b))}], partial)
    out = T.StructType([*key_schema.fields, *_struct(schema).fields])
    return process_groups(first, keys, lambda key, b: [{**key, **agg.result(merged(b))}], out)


def fold_ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: Callable[[dict], Any],
                 combine: Callable[[Any, Any], Any], result: Callable[[Any], dict], schema: T.StructType | str) -> DataFrame:
    """``combine`` folded over the rows of each group of ``keys``, in ``order``.

    ``start`` makes the state of one row; ``combine(a, b)`` joins the state of rows with that
    of the rows behind them. It must be associative, and need not be commutative. Rows that
    are equal in ``order`` are folded in any order: name enough columns.
    """
    keys, order = list(keys), list(order)
    key_schema = df.select(*keys).schema
    partial = T.StructType([*key_schema.fields, T.StructField(_PART, T.IntegerType()), T.StructField(_STATE, T.BinaryType())])

    def folded(states: Iterator[Any]) -> Any:
        state = next(states)
        for s in states:
            state = combine(state, s)
        return state

    def stretch(key: dict, batches: Iterator[pa.RecordBatch]) -> list[dict]:
        state = folded(start(r) for b in batches for r in b.to_pylist())
        return [{**key, _PART: TaskContext.get().partitionId(), _STATE: pickle.dumps(state)}]

    ranges = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    stretches = _over_groups(ranges, keys, stretch, partial)
    out = T.StructType([*key_schema.fields, *_struct(schema).fields])
    return process_groups(stretches, keys, lambda key, batches: [
        {**key, **result(folded(pickle.loads(s) for b in batches for s in b.column(_STATE).to_pylist()))}], out, order=[_PART])
