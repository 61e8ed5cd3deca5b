"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters that str.split() takes for white space and the tokenizers' \s does not.
UNSHARED_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"\s")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class ChunkCache(dict):
    """``chunk -> make(chunk)``, remembered for short chunks. At ``limit`` entries the older
    half goes, but for what was asked for since, so that a worker's memory stays bounded
    whatever the vocabulary."""

    def __init__(self, make: Callable, limit: int = 300_000, longest: int = 48):
        super().__init__()
        self.make, self.half, self.longest, self.older = make, limit // 2, longest, {}

    def __missing__(self, chunk):
        value = self.older.pop(chunk, None)
        if value is None:
            value = self.make(chunk)
            if len(chunk) > self.longest:
                return value
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[chunk] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.older = {}


def release(*caches: ChunkCache) -> None:
    """At the end of a task: what is remembered goes, and so do the memory pool's free pages.
    A Python worker outlives its tasks, so what it keeps would count against the executor
    in every later stage, whatever runs there; a task fills its caches in little time."""
    for c in caches:
        c.forget()
    pa.default_memory_pool().release_unused()


def slices_at_space(text: str, size: int = 1 << 20) -> Iterator[str]:
    """The text in slices of about ``size`` characters, each but the last ending behind a
    white space character, so that word lists of a very long text are never whole in
    memory. Joined, the slices are the text."""
    start, n = 0, len(text)
    while n - start > size:
        m = _SPACE.search(text, start + size)
        if m is None:
            break
        yield text[start:m.end()]
        start = m.end()
    if start < n or not n:
        yield text[start:]


# A table of at most this many flat rows (some 64 bytes each) may be broadcast.
BROADCAST_ROWS = 1_000_000


def join_counted(big: DataFrame, small: DataFrame, on, how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join with a materialised ``small`` side: broadcast if its rows (or ``rows``, the
    number of flat entries that it holds) are within :data:`BROADCAST_ROWS`, so that
    ``big`` is not shuffled; else by shuffle."""
    n = small.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return big.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, on, how)


def first_by_hash(rows: DataFrame, hashed: Column, wanted: list[tuple[Column, int]]) -> DataFrame:
    """Rows with the smallest hashes: for each condition and number of ``wanted``, at most that
    many of the rows that meet it; a row is returned once.

    The hashes' ranges, by their length in bits and the six leading ones, are counted first
    (under 2,000 numbers at any size of the input); the cut is the end of the last range
    that fits. So the rows are found by a filter: nothing is ordered, shuffled or held in
    one task. Within about 3 % of the number is reached, and all rows if they fit."""
    at = F.shiftrightunsigned(hashed, 1)
    bits = F.greatest(F.char_length(F.bin(at)) - 6, F.lit(0))
    low = F.expr("shiftleft(shiftright(_at, _shift), _shift)")
    counted = (rows.select(at.alias("_at"), bits.alias("_shift"), *[c.alias(f"_c{i}") for i, (c, _) in enumerate(wanted)])
               .groupBy(low.alias("low")).agg(*[F.count_if(F.col(f"_c{i}")).alias(f"n{i}") for i in range(len(wanted))])
               .orderBy("low").collect())
    keep = F.lit(False)
    for i, (condition, limit) in enumerate(wanted):
        total, cut = 0, None
        for r in counted:
            total += r[f"n{i}"]
            if total > limit:
                cut = r["low"]
                break
        keep = keep | (condition if cut is None else (at < cut) & condition)
    return rows.filter(keep)
