from pyspark.sql import functions as F

from support import rows
from fixtures import (INTERVAL_JOIN_RIGHT, INTERVAL_ONLY, JOIN_EXPECTED, JOIN_LEFT, WINDOW_JOIN_RIGHT,
                      WINDOW_ONLY)
from tidemark.operators import joins


def sides(spark, left, right):
    l = spark.createDataFrame(left, "k string, lt int").withColumn("lts", F.timestamp_seconds("lt"))
    r = spark.createDataFrame(right, "k string, rt int, v int").withColumn("rts", F.timestamp_seconds("rt"))
    return l, r


def test_window_join_literals(spark):
    l, r = sides(spark, JOIN_LEFT, WINDOW_JOIN_RIGHT)
    out = joins.window_join(l, r, "k", "lts", "rts", "5 seconds")
    assert rows(out, "k", "lt", "rt", "v") == JOIN_EXPECTED


def test_interval_join_literals(spark):
    l, r = sides(spark, JOIN_LEFT, INTERVAL_JOIN_RIGHT)
    out = joins.interval_join(l, r, "k", "lts", "rts", "2 seconds", "2 seconds")
    assert rows(out, "k", "lt", "rt", "v") == JOIN_EXPECTED


def test_joins_told_apart(spark):
    l, r = sides(spark, [INTERVAL_ONLY[0], WINDOW_ONLY[0]], [INTERVAL_ONLY[1], WINDOW_ONLY[1]])
    w = joins.window_join(l, r, "k", "lts", "rts", "5 seconds")
    i = joins.interval_join(l, r, "k", "lts", "rts", "2 seconds", "2 seconds")
    assert [x[0] for x in rows(w, "k")] == ["i"]
    assert [x[0] for x in rows(i, "k")] == ["h"]


def test_interval_join_asymmetric_bounds_and_buckets(spark):
    import random

    rnd = random.Random(7)
    left = [(rnd.choice("xyz"), rnd.randint(0, 300)) for _ in range(120)]
    right = [(rnd.choice("xyz"), rnd.randint(0, 300), i) for i in range(120)]
    l, r = sides(spark, left, right)
    r2 = r.withColumnRenamed("k", "k2")
    plain = (l.join(r2, (l["k"] == r2["k2"]) & (r2["rts"] >= l["lts"] - F.expr("INTERVAL 3 seconds"))
                    & (r2["rts"] <= l["lts"] + F.expr("INTERVAL 11 seconds"))).drop("k2"))
    for width in (None, "1 second", "5 seconds", "60 seconds"):
        b = joins.interval_join(l, r, "k", "lts", "rts", "3 seconds", "11 seconds", bucket_width=width)
        assert rows(b, "k", "lt", "rt", "v") == rows(plain, "k", "lt", "rt", "v")
    brute = sorted((a, t, u, v) for a, t in left for b2, u, v in right if a == b2 and t - 3 <= u <= t + 11)
    assert rows(plain, "k", "lt", "rt", "v") == brute


def test_interval_join_of_wall_clock_times_where_clocks_change(spark):
    """timestamp_ntz values are what they read, in any session zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = {}
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            for day in ("2024-11-03", "2024-03-10", "1969-12-31"):
                times = [f"{day} {h:02d}:{m:02d}:00.25" for h in range(5) for m in (0, 30)]
                left = spark.createDataFrame([(1, i, t) for i, t in enumerate(times)], "k int, l int, t string").selectExpr("k", "l", "cast(t as timestamp_ntz) lt")
                right = left.selectExpr("k", "l as r", "lt as rt")
                j = joins.interval_join(left, right, "k", "lt", "rt", "1 hour", "1 hour")
                found[z, day] = rows(j, "l", "r")
                assert found[z, day] == [(a, b) for a in range(10) for b in range(10) if abs(a - b) <= 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_window_join_drops_rows_behind_the_joint_watermark(spark):
    """Windows of 10 s, delay 0: once both sides have passed 10, a row of [0, 10) joins
    nothing; while one side lags, the watermark does too."""
    left = spark.createDataFrame([("a", 1, 0, "l0"), ("a", 25, 2, "l1"), ("a", 3, 3, "l2"), ("a", 4, 5, "l3"), ("a", 26, 6, "l4")], "k string, t int, seq int, l string")
    right = spark.createDataFrame([("a", 2, 1, "r0"), ("a", 21, 4, "r1"), ("a", 5, 7, "r2"), ("b", 26, 8, "r3")], "k string, t int, seq int, r string")
    left, right = (x.withColumn(f"{c}t", F.timestamp_seconds("t")).drop("t") for x, c in ((left, "l"), (right, "r")))
    out = joins.window_join_watermarked(left, right, "k", "lt", "rt", "10 seconds", ["seq"], "0 seconds")
    # l2 comes while the right side is at 2 only; l3 and r2 come when both are past 20
    assert out.columns == ["k", "window_start", "window_end", "l", "lt", "r", "rt"]
    assert sorted((r.l, r.r) for r in out.collect()) == [("l0", "r0"), ("l1", "r1"), ("l2", "r0"), ("l4", "r1")]
    # while one side has no row there is no watermark, and nothing is late
    alone = joins.window_join_watermarked(left, right.where("r = 'r2'"), "k", "lt", "rt", "10 seconds", ["seq"], "0 seconds")
    assert sorted((r.l, r.r) for r in alone.collect()) == [("l0", "r2"), ("l2", "r2"), ("l3", "r2")]
