import itertools

import pytest
from pyspark.sql import functions as F

from support import rows
from fixtures import SESSION_ROWS
from tidemark.operators import aggregates, windows
from tidemark.plans.prefix import id_buckets


def timed(spark, data, schema="k string, t int"):
    return spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_seconds("t"))


def test_tumbling_and_sliding(spark):
    df = timed(spark, [("a", 1), ("a", 9), ("a", 12), ("b", 5)])
    tum = windows.window_agg(df, ["k"], windows.tumbling("ts", "10 seconds"), [F.count("*").alias("n")])
    got = [(k, s.second + 60 * s.minute, n) for k, s, e, n in rows(tum)]
    assert sorted(got) == [("a", 0, 2), ("a", 10, 1), ("b", 0, 1)]
    sl = windows.window_agg(df, ["k"], windows.sliding("ts", "10 seconds", "5 seconds"),
                            [F.count("*").alias("n")])
    # every row lies in size/slide = 2 windows
    assert sum(r["n"] for r in sl.collect()) == 2 * df.count()
    # a negative-start window [-5, 5) appears for the row at t = 1 only
    assert sl.where(F.col("window_start") < F.timestamp_seconds(F.lit(0))).count() == 1


def test_window_all_partial_aggregation(spark):
    df = timed(spark, [("a", 1), ("b", 2), ("c", 15)])
    out = windows.window_agg(df, [], windows.tumbling("ts", "10 seconds"), [F.count("*").alias("n")])
    assert sorted(r["n"] for r in out.collect()) == [1, 2]


def test_session_every_input_order(spark):
    for perm in itertools.permutations(SESSION_ROWS):
        df = timed(spark, list(perm))
        out = windows.session_agg(df, ["k"], "ts", "12 seconds", "t", [F.count("*").alias("n")])
        got = sorted((r.session_start.second, r.session_end.second, r.n) for r in out.collect())
        assert got == [(0, 24, 2), (25, 37, 1)]


@pytest.mark.parametrize("sliced", [False, True])
def test_session_matches_native_session_window(spark, request, sliced):
    if sliced:
        request.getfixturevalue("sliced_scans")
    data = [("a", t) for t in (0, 3, 20, 21, 50, 62, 63, 100)] + [("b", t) for t in (1, 30, 41)]
    df = timed(spark, data)
    mine = windows.session_agg(df, ["k"], "ts", "10 seconds", "t", [F.count("*").alias("n")], ranges=3)
    native = df.groupBy("k", windows.session("ts", "10 seconds").alias("s")).agg(F.count("*").alias("n"))
    assert rows(mine, "k", "session_start", "session_end", "n") == rows(
        native.select("k", F.col("s.start").alias("session_start"),
                      F.col("s.end").alias("session_end"), "n"))


def test_dynamic_gap_session(spark):
    df = timed(spark, [("a", 0, 5), ("a", 8, 5), ("a", 30, 20), ("a", 45, 1)],
               "k string, t int, gap int")
    gap = F.make_dt_interval(secs=F.col("gap"))
    out = windows.session_agg(df, ["k"], "ts", gap, "t", [F.count("*").alias("n")])
    got = sorted((r.session_start.second, r.session_end.second, r.n) for r in out.collect())
    # 0..5 and 8..13 are separate (8 > 5); 30..50 absorbs 45
    assert got == [(0, 5, 1), (8, 13, 1), (30, 50, 2)]


@pytest.mark.parametrize("sliced", [False, True])
def test_count_windows(spark, request, sliced):
    if sliced:
        request.getfixturevalue("sliced_scans")
    df = spark.createDataFrame([("a", i) for i in range(1, 12)] + [("b", 100), ("b", 101)],
                               "k string, seq long")
    tum = windows.count_tumbling(df, ["k"], ["seq"], 5, [F.collect_list("seq").alias("s")])
    got = sorted((r.k, r.group_no, sorted(r.s)) for r in tum.collect())
    assert got == [("a", 0, [1, 2, 3, 4, 5]), ("a", 1, [6, 7, 8, 9, 10])]
    sl = windows.count_sliding(df, ["k"], ["seq"], 5, 2, [F.collect_list("seq").alias("s")],
                               bucket=id_buckets("seq", rows=3))
    got = {(r.k, r.fire_seq): sorted(r.s) for r in sl.collect()}
    assert got[("a", 2)] == [1, 2]
    assert got[("a", 4)] == [1, 2, 3, 4]
    assert got[("a", 6)] == [2, 3, 4, 5, 6]
    assert got[("a", 10)] == [6, 7, 8, 9, 10]
    assert ("a", 12) not in got and got[("b", 2)] == [100, 101]
    assert len(got) == 6


def test_window_reduce_single_record_passes_through(spark):
    df = spark.createDataFrame([(1, "u", 10, "x", "m1", 1), (2, "u", 5, "y", "m2", 3),
                                (3, "v", 7, "z", "m3", 2)],
                               "id long, name string, age long, address string, email string, t int")
    df = df.withColumn("ts", F.timestamp_seconds("t"))
    out = aggregates.window_reduce(df, ["name"], windows.tumbling("ts", "12 seconds"), "id",
                                   ["id"], "age", ["address", "email"])
    got = rows(out, "name", "id", "age", "address", "email")
    assert got == [("u", 1, 15, "", ""), ("v", 3, 7, "z", "m3")]


def test_process_window_hook(spark):
    import pandas as pd

    df = timed(spark, [("a", 1), ("a", 2), ("b", 3)])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [pdf.k.iloc[0]], "n": [len(pdf)]})

    out = aggregates.process_window(df, ["k"], windows.tumbling("ts", "10 seconds"), fn,
                                    "k string, n long")
    assert rows(out) == [("a", 2), ("b", 1)]


def test_reduce_window_user_fold(spark):
    df = spark.createDataFrame([(1, "u", 10, 1), (2, "u", 5, 3), (3, "v", 7, 2)],
                               "id long, name string, age long, t int").withColumn("ts", F.timestamp_seconds("t"))

    def add_ages(a, b):
        return {**a, "age": a["age"] + b["age"], "note": "merged"}

    out = aggregates.reduce_window(df, ["name"], windows.tumbling("ts", "12 seconds"), "id", add_ages,
                                   "name string, id long, age long, note string")
    assert rows(out) == [("u", 1, 15, "merged"), ("v", 3, 7, None)]
