import math
import random

from tidemark.llm.queries import ORACLE
from tidemark.llm.topk import quantise, top_products


def brute(rows, k, queries):
    vs = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in vs:
        if queries(i):
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vs if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def run(spark, rows, k=5, queries=lambda i: i % 5 == 0, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("dim", __import__("pyspark").sql.functions.lit(1)).repartition(3)
    v = quantise(df)
    got = top_products(v.filter("vec_id % 5 = 0"), v, k=k, **kw).collect()
    return sorted(tuple(r) for r in got)


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, rng.gauss(0, 1)]) for _ in range(16)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(20)]  # equal vectors tie
    rows += [(1000, None), (None, [1.0] * 16), (1005, []), (1010, [float("nan")] * 16), (1015, [1.0, None] * 8), (1020, [float("inf")] + [0.0] * 15),
             (1025, [1.0, 2.0]), (1030, [2.0, 1.0])]
    assert run(spark, rows, chunks=3) == brute(rows, 5, lambda i: i % 5 == 0)


def test_pruning_in_several_blocks(spark, monkeypatch):
    import tidemark.llm.topk as topk
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(33)]) for i in range(400)]
    assert run(spark, rows, k=3, chunks=2) == brute(rows, 3, lambda i: i % 5 == 0)


def test_large_components_are_exact(spark):
    rows = [(i, [1e13 + i, -3.0 * i]) for i in range(0, 8)]
    got = run(spark, rows, k=2)
    want = [(q, r, j, max(-2 ** 63, min(2 ** 63 - 1, s))) for q, r, j, s in brute(rows, 2, lambda i: i % 5 == 0)]
    assert [(q, r) for q, r, _, _ in got] == [(q, r) for q, r, _, _ in want] and [s for *_, s in got] == [s for *_, s in want]


def test_empty(spark):
    assert run(spark, []) == []


def test_sql_is_there():
    assert "op9_exact_topk" in ORACLE
