import pytest
from pyspark.sql import functions as F

from support import rows
from fixtures import OOO_ARRIVAL, OOO_CLASS
from tidemark.operators import lateness


def trace(spark):
    data = [("a", age, i) for i, age in enumerate(OOO_ARRIVAL)]
    return (spark.createDataFrame(data, "name string, age int, seq long")
            .withColumn("ts", F.timestamp_seconds("age")))


@pytest.mark.parametrize("sliced", [False, True])
def test_classification_trace(spark, request, sliced):
    if sliced:
        request.getfixturevalue("sliced_scans")
    c = lateness.classify_window_rows(trace(spark), "ts", ["seq"], "10 seconds", "3 seconds",
                                      "2 seconds", ranges=3)
    got = [r.lateness for r in c.orderBy("seq").collect()]
    assert got == OOO_CLASS
    wm = [r.wm for r in c.orderBy("seq").collect()]
    assert wm[0] is None and wm[1].timestamp() == -2 and wm[8].timestamp() == 24


def test_side_outputs_and_property(spark):
    c = lateness.classify_window_rows(trace(spark), "ts", ["seq"], "10 seconds", "3 seconds", "2 seconds")
    outs = lateness.side_outputs(c)
    assert [r.age for r in outs["late"].collect()] == [3]
    assert outs["main"].count() + outs["late"].count() == len(OOO_ARRIVAL)


@pytest.mark.parametrize("sliced", [False, True])
def test_refinements_trace(spark, request, sliced):
    if sliced:
        request.getfixturevalue("sliced_scans")
    c = lateness.classify_window_rows(trace(spark), "ts", ["seq"], "10 seconds", "3 seconds", "2 seconds")
    ref = lateness.refinements(c, ["name"], ["seq"])
    got = sorted((int(r.window_start.timestamp()), r.firing, r.n) for r in ref.collect())
    assert got == [(0, 0, 3), (0, 1, 4), (10, 0, 3), (20, 0, 1), (40, 0, 1)]


def test_zero_delay_watermark(spark):
    c = lateness.classify_window_rows(trace(spark), "ts", ["seq"], "10 seconds", "0 seconds")
    # ascending watermark: 5 arrives after 12 -> its window [0,10) ended at wm 12
    got = {r.age: r.lateness for r in c.collect()}
    assert got[5] == "late" and got[13] == "on_time" and got[1] == "on_time"


@pytest.mark.parametrize("sliced", [False, True])
def test_join_lateness(spark, request, sliced):
    if sliced:
        request.getfixturevalue("sliced_scans")
    left = spark.createDataFrame([(1, 10, 0), (2, 2, 3), (3, 30, 4)], "id long, t int, seq long") \
        .withColumn("lts", F.timestamp_seconds("t"))
    right = spark.createDataFrame([(7, 20, 1), (8, 5, 2), (9, 1, 5)], "id long, t int, seq long") \
        .withColumn("rts", F.timestamp_seconds("t"))
    l, r = lateness.join_lateness(left, right, "lts", "rts", ["seq"], "3 seconds")
    # seq0 L10 (wm null) ; seq1 R20 (wm null: right side unseen before) ; seq2 R5: wm=min(10,20)-3=7 -> late
    # seq3 L2: wm=7 -> late ; seq4 L30: wm 7 -> ok ; seq5 R1: wm=min(30,20)-3=17 -> late
    assert rows(l, "id", "late") == [(1, False), (2, True), (3, False)]
    assert rows(r, "id", "late") == [(7, False), (8, True), (9, True)]


def test_watermarked_windows_drop_late_rows(spark):
    out = lateness.watermarked_windows(trace(spark), ["name"], "ts", ["seq"], "10 seconds", "3 seconds",
                                       [F.count("*").alias("n")])
    got = sorted((int(r.window_start.timestamp()), r.n) for r in out.collect())
    assert got == [(0, 3), (10, 3), (20, 1), (40, 1)]
    asc = lateness.watermarked_windows(trace(spark), ["name"], "ts", ["seq"], "10 seconds", "0 seconds",
                                       [F.collect_list("age").alias("ages")])
    got = {int(r.window_start.timestamp()): sorted(r.ages) for r in asc.collect()}
    assert got == {0: [1, 9], 10: [12, 13, 15], 20: [27], 40: [40]}
