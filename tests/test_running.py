import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import rows
from fixtures import SENSOR_LINES, SENSOR_RUNNING_AVG, SENSOR_RUNNING_COUNT
from tidemark.functions import parse
from tidemark.operators import running, topn
from tidemark.plans.prefix import Scan, id_buckets, prefix_scan


def sensors(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(SENSOR_LINES)], "seq long, value string")
    return df.select("seq", *parse.parse_reading("value"))


def test_running_count_and_avg_sensor(spark):
    df = sensors(spark)
    c = running.running_count(df, ["id", "vc"], ["seq"])
    assert [r.running_n for r in c.orderBy("seq").collect()] == SENSOR_RUNNING_COUNT
    a = running.running_avg(df, ["id"], ["seq"], "vc")
    assert [r.running_avg for r in a.orderBy("seq").collect()] == pytest.approx(SENSOR_RUNNING_AVG)


def test_running_sum_word_stream(spark):
    words = ["hello", "HPP", "hello", "DYL", "hello"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "seq long, word string")
    s = running.running_sum(df.withColumn("n", F.lit(1)), ["word"], ["seq"], "n")
    assert [r.running_sum for r in s.orderBy("seq").collect()] == [1, 1, 2, 1, 3]


@pytest.mark.parametrize("mode", ["ranges", "bucket"])
def test_prefix_scan_hot_key_matches_single_window(spark, sliced_scans, mode):
    rnd = random.Random(3)
    # one key holds most rows, as a hot key would
    data = [(i, "hot" if rnd.random() < 0.7 else rnd.choice("abc"), rnd.randint(-5, 9)) for i in range(400)]
    df = spark.createDataFrame(data, "seq long, k string, v int")
    kw = {"ranges": 7} if mode == "ranges" else {"bucket": id_buckets("seq", rows=16)}
    got = prefix_scan(df, ["seq"], {"s": Scan("sum", F.col("v")), "mx": Scan("max", F.col("v"), False),
                                    "c": Scan("count", F.lit(1)), "mn": Scan("min", F.col("v"))},
                      partition_by=["k"], **kw)
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mx"),
                    F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"),
                    F.min("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("mn"))
    assert rows(got, "seq", "s", "mx", "c", "mn") == rows(ref, "seq", "s", "mx", "c", "mn")


@pytest.mark.parametrize("sliced", [False, True])
def test_prefix_scan_global_order(spark, request, sliced):
    if sliced:
        request.getfixturevalue("sliced_scans")
    data = [(i, (i * 37) % 101) for i in range(300)]
    df = spark.createDataFrame(data, "seq long, v int")
    got = prefix_scan(df, ["seq"], {"m": Scan("max", F.col("v"), inclusive=False)}, ranges=5)
    expected, best = [], None
    for i, v in data:
        expected.append((i, best))
        best = v if best is None else max(best, v)
    assert rows(got, "seq", "m") == expected


def test_top_n_salted_exact(spark):
    rnd = random.Random(11)
    data = [(w, k, rnd.randint(1, 6)) for w in range(5) for k in range(60)]
    df = spark.createDataFrame(data, "w int, k int, n int")
    got = topn.top_n(df, ["w"], [F.col("n").desc(), F.col("k").asc()], 3, salt_cols=["k"], salt_buckets=4)
    expected = []
    for w in range(5):
        best = sorted([(-n, k) for ww, k, n in data if ww == w])[:3]
        expected += [(w, i + 1, k, -nn) for i, (nn, k) in enumerate(best)]
    assert rows(got, "w", "rank", "k", "n") == sorted(expected)


def test_prefix_scan_null_key_is_its_own_group(spark, sliced_scans):
    data = [(i, None if i % 3 == 0 else "a", 1) for i in range(60)]
    df = spark.createDataFrame(data, "seq long, k string, v long")
    got = prefix_scan(df, ["seq"], {"c": Scan("sum", F.col("v"))}, partition_by=["k"], ranges=5)
    seen = {}
    expected = []
    for i, k, _ in data:
        seen[k] = seen.get(k, 0) + 1
        expected.append((i, seen[k]))
    assert rows(got, "seq", "c") == expected


def test_hot_key_is_split_into_balanced_slices(spark):
    """A key holding 70% of the rows spans many slices, none much larger than
    total / ranges -- so no task of the running window sees the whole key."""
    from tidemark.plans.prefix import SLICE, slice_rows

    rnd = random.Random(5)
    data = [(i, "hot" if rnd.random() < 0.7 else f"k{rnd.randint(0, 50)}") for i in range(4000)]
    df = spark.createDataFrame(data, "seq long, k string")
    sliced = slice_rows(df, ["seq"], ["k"], ranges=8)
    sizes = {(r.k, r[SLICE]): r["count"] for r in sliced.groupBy("k", SLICE).count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) >= 5
    assert max(sizes.values()) <= 2 * len(data) / 8


def test_one_plan_whatever_the_keys(spark):
    """Even keys and a key with nine tenths of the rows take the same plan; its tasks stay
    balanced and give the single-window answer."""
    from tidemark.plans.prefix import SLICE

    even = spark.createDataFrame([(i, f"k{i % 20}", 1) for i in range(4000)], "seq long, k string, v long")
    hot = spark.createDataFrame([(i, "hot" if i % 10 else f"k{i % 20}", 1) for i in range(4000)], "seq long, k string, v long")
    plans = []
    for df in (even, hot):
        got = prefix_scan(df, ["seq"], {"c": Scan("count", F.lit(1))}, partition_by=["k"], ranges=8, keep_slice=True)
        sizes = [r["count"] for r in got.groupBy(SLICE).count().collect()]
        assert len(sizes) >= 6 and max(sizes) <= 2 * 4000 / 8
        ref = df.select("seq", F.count(F.lit(1)).over(
            Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
        assert rows(got, "seq", "c") == rows(ref, "seq", "c")
        plans.append([w for w in got._jdf.queryExecution().optimizedPlan().toString().split() if w.isalpha()])
    assert plans[0] == plans[1]


def test_slices_follow_the_rows(spark):
    from tidemark.plans.prefix import slice_count

    df = spark.range(1000)
    assert slice_count(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("tidemark.scan.sliceRows", "10")
    try:
        assert slice_count(df) == 100
    finally:
        spark.conf.unset("tidemark.scan.sliceRows")
