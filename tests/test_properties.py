"""Randomised checks of the scan-based operators against plain Python over the same rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import lateness, windows
from tidemark.plans.prefix import Scan, prefix_scan

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ROWS = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 120)), min_size=1, max_size=60)


@SETTINGS
@given(data=ROWS, ranges=st.integers(1, 6))
def test_running_sum_and_max(spark, data, ranges):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(data)], "seq long, k string, v long")
    out = prefix_scan(df, ["seq"], {"s": Scan("sum", F.col("v")), "m": Scan("max", F.col("v"), False)},
                      partition_by=["k"], ranges=ranges)
    got = {r.seq: (r.s, r.m) for r in out.collect()}
    run, best = {}, {}
    for i, (k, v) in enumerate(data):
        run[k] = run.get(k, 0) + v
        assert got[i] == (run[k], best.get(k))
        best[k] = max(best.get(k, v), v)


@SETTINGS
@given(data=ROWS, gap=st.integers(1, 20), ranges=st.integers(1, 5))
def test_sessions_match_brute_force(spark, data, gap, ranges):
    df = (spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(data)], "seq long, k string, t long")
          .withColumn("ts", F.timestamp_seconds("t")))
    out = windows.session_agg(df, ["k"], "ts", f"{gap} seconds", "seq", [F.count("*").alias("n")],
                              ranges=ranges).collect()
    got = sorted((r.k, int(r.session_start.timestamp()), int(r.session_end.timestamp()), r.n)
                 for r in out)
    expected = []
    for k in sorted({k for k, _ in data}):
        ts = sorted(t for kk, t in data if kk == k)
        start, end, n = ts[0], ts[0] + gap, 1
        for t in ts[1:]:
            if t > end:
                expected.append((k, start, end, n))
                start, end, n = t, t + gap, 1
            else:
                end, n = max(end, t + gap), n + 1
        expected.append((k, start, end, n))
    assert got == sorted(expected)


@SETTINGS
@given(times=st.lists(st.integers(0, 100), min_size=1, max_size=50), delay=st.integers(0, 10),
       allowed=st.integers(0, 10))
def test_lateness_classes_partition_input(spark, times, delay, allowed):
    df = (spark.createDataFrame(list(enumerate(times)), "seq long, t long")
          .withColumn("ts", F.timestamp_seconds("t")))
    c = lateness.classify_window_rows(df, "ts", ["seq"], "10 seconds", f"{delay} seconds",
                                      f"{allowed} seconds", ranges=3)
    got = {r.seq: r.lateness for r in c.collect()}
    mx = None
    for i, t in enumerate(times):
        wm = None if mx is None else mx - delay
        end = (t // 10 + 1) * 10
        want = "on_time" if wm is None or end > wm else ("allowed_late" if end + allowed > wm else "late")
        assert got[i] == want
        mx = t if mx is None else max(mx, t)


@SETTINGS
@given(data=ROWS, size=st.integers(1, 6), slide=st.integers(1, 6))
def test_count_windows_match_brute_force(spark, data, size, slide):
    df = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(data)], "seq long, k string")
    sl = windows.count_sliding(df, ["k"], ["seq"], size, slide, [F.collect_list("seq").alias("s")], ranges=3)
    got = sorted((r.k, r.fire_seq, tuple(sorted(r.s))) for r in sl.collect())
    framed = windows.count_sliding(df, ["k"], ["seq"], size, slide, {"s": F.collect_list("seq")}, ranges=3)
    assert sorted((r.k, r.fire_seq, tuple(sorted(r.s))) for r in framed.collect()) == got
    expected = []
    for k in sorted({k for k, _ in data}):
        seqs = [i for i, (kk, _) in enumerate(data) if kk == k]
        for f in range(slide, len(seqs) + 1, slide):
            expected.append((k, f, tuple(seqs[max(0, f - size):f])))
    assert got == sorted(expected)


@SETTINGS
@given(left=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), min_size=1, max_size=25),
       right=st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 40)), min_size=1, max_size=25))
def test_window_join_matches_brute_force(spark, left, right):
    from tidemark.operators import joins

    l = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(left)], "k string, lt long, li long") \
        .withColumn("lts", F.timestamp_seconds("lt"))
    r = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(right)], "k string, rt long, ri long") \
        .withColumn("rts", F.timestamp_seconds("rt"))
    got = sorted((x.li, x.ri) for x in joins.window_join(l, r, "k", "lts", "rts", "5 seconds").collect())
    want = sorted((i, j) for i, (a, t) in enumerate(left) for j, (b, u) in enumerate(right)
                  if a == b and t // 5 == u // 5)
    assert got == want


@SETTINGS
@given(data=ROWS, size=st.integers(1, 6))
def test_count_tumbling_matches_brute_force(spark, data, size):
    df = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(data)], "seq long, k string")
    out = windows.count_tumbling(df, ["k"], ["seq"], size, [F.collect_list("seq").alias("s")], ranges=3)
    got = sorted((r.k, r.group_no, tuple(sorted(r.s))) for r in out.collect())
    want = []
    for k in sorted({k for k, _ in data}):
        seqs = [i for i, (kk, _) in enumerate(data) if kk == k]
        want += [(k, g, tuple(seqs[g * size:(g + 1) * size])) for g in range(len(seqs) // size)]
    assert got == sorted(want)


@SETTINGS
@given(times=st.lists(st.integers(0, 100), min_size=1, max_size=50), delay=st.integers(0, 10))
def test_lateness_classes_with_sliced_scan(spark, times, delay):
    """The same rule with three slices of the arrival order."""
    df = (spark.createDataFrame(list(enumerate(times)), "seq long, t long")
          .withColumn("ts", F.timestamp_seconds("t")))
    c = lateness.classify_window_rows(df, "ts", ["seq"], "10 seconds", f"{delay} seconds", ranges=3)
    got = {r.seq: r.wm for r in c.collect()}
    mx = None
    for i, t in enumerate(times):
        want = None if mx is None else mx - delay
        assert (got[i] is None and want is None) or int(got[i].timestamp()) == want
        mx = t if mx is None else max(mx, t)
