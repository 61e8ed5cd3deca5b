import random
from collections import defaultdict

import pyarrow as pa
import pytest

from tidemark.operators import user_functions as uf


def spread():  # a local class goes to the workers by value
    class Spread(uf.UserAggregate):
        def create(self):
            return (0, 0)

        def add(self, state, rows):
            v = [x for x in rows.column("v").to_pylist() if x is not None]
            return state[0] + len(v), state[1] + sum(v)

        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1]

        def result(self, state):
            return {"n": state[0], "total": state[1]}

    return Spread


def table(spark, n=5000, seed=1):
    """Nine of ten rows share a key; keys, values and a few orders are null."""
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.9 else rng.choice(["a", "b", None, ""]), rng.choice([1, 2, None]), i, rng.choice([None, rng.randrange(100)])) for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, w int, seq long, v int").repartition(7)


def groups(rows):
    out = defaultdict(list)
    for k, w, s, v in sorted(rows, key=lambda r: r[2]):
        out[k, w].append((s, v))
    return out


def test_user_aggregate_merges_states(spark):
    rows, df = table(spark)
    got = {(r.k, r.w): (r.n, r.total) for r in uf.user_aggregate(df, ["k", "w"], spread()(), "n long, total long").collect()}
    assert got == {k: (sum(v is not None for _, v in g), sum(v or 0 for _, v in g)) for k, g in groups(rows).items()}


def test_a_hot_key_reaches_a_worker_as_states_only(spark):
    """90 % of 200,000 rows have one key: no task of the merge sees more than its states."""
    df = spark.range(0, 200_000, 1, 40).selectExpr("if(id % 10 < 9, 0L, id) k", "1 v")

    class Count(spread()):
        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1] + 1_000_000  # counts the merges

    top = uf.user_aggregate(df, ["k"], Count(), "n long, total long").filter("k = 0").collect()[0]
    assert top.n == 180_000 and top.total // 1_000_000 < 100


def test_fold_keeps_the_order_and_splits_hot_keys(spark):
    rows, df = table(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = uf.fold_ordered(df, ["k", "w"], ["seq"], lambda r: [r["seq"]], lambda a, b: a + b, lambda s: {"seqs": s}, "seqs array<long>")
        got = {(r.k, r.w): list(r.seqs) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {k: [s for s, _ in g] for k, g in groups(rows).items()}


def test_process_groups_streams_over_batches(spark):
    rows, df = table(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        def gaps(key, batches):
            n, parts, last = 0, 0, None
            for b in batches:
                parts += 1
                assert isinstance(b, pa.RecordBatch) and len(b) <= 100
                for s in b.column("seq").to_pylist():
                    assert last is None or s > last
                    n, last = n + 1, s
            yield {"k": key["k"], "w": key["w"], "n": n, "parts": parts}

        got = {(r.k, r.w): r for r in uf.process_groups(df, ["k", "w"], gaps, "k string, w int, n long, parts int", order=["seq"]).collect()}
        assert {k: r.n for k, r in got.items()} == {k: len(g) for k, g in groups(rows).items()}
        assert max(r.parts for r in got.values()) > 10  # many batches a group
        first = uf.process_groups(df, ["k"], lambda key, b: [{"k": key["k"], "n": len(next(b))}], "k string, n int").collect()
        assert {r.k for r in first} == {r[0] for r in rows}  # rows left unread are skipped
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("call", [
    lambda df: uf.user_aggregate(df, ["k"], spread()(), "n long, total long"),
    lambda df: uf.fold_ordered(df, ["k"], ["seq"], lambda r: 1, lambda a, b: a + b, lambda s: {"n": s}, "n long"),
    lambda df: uf.process_groups(df, ["k"], lambda key, b: [], "n long")])
def test_empty_input(spark, call):
    assert call(spark.createDataFrame([], "k string, w int, seq long, v int")).count() == 0
