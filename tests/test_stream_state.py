import os

import pytest

from fixtures import SENSOR_LINES, SENSOR_RUNNING_AVG, SENSOR_RUNNING_COUNT
from streamutil import json_stream, run_to_memory, write_batches
from tidemark.streaming import state


def sensor_batches(splits):
    recs = []
    for i, line in enumerate(SENSOR_LINES):
        k, vc, c = line.split(",")
        recs.append({"seq": i, "id": k, "vc": int(vc), "count": int(c)})
    out, start = [], 0
    for s in splits:
        out.append(recs[start:start + s])
        start += s
    return out


@pytest.mark.parametrize("splits", [[5], [2, 1, 2], [1, 1, 1, 1, 1]])
def test_running_count_and_avg_stream(spark, scratch, splits):
    src = os.path.join(scratch, "in")
    write_batches(src, sensor_batches(splits))
    df = json_stream(spark, src, "seq long, id string, vc long, count long")
    cnt = run_to_memory(state.running_count_stream(df, ["id"], "vc", "seq"), os.path.join(scratch, "c1"))
    assert [r.running_n for r in cnt.orderBy("seq").collect()] == SENSOR_RUNNING_COUNT
    avg = run_to_memory(state.running_avg_stream(df, ["id"], "vc", "seq"), os.path.join(scratch, "c2"))
    assert [r.running_avg for r in avg.orderBy("seq").collect()] == pytest.approx(SENSOR_RUNNING_AVG)


@pytest.mark.parametrize("splits", [[11], [3, 4, 4], [1] * 11])
def test_count_windows_stream(spark, scratch, splits):
    recs = [{"seq": i, "k": "a", "v": i} for i in range(1, 12)]
    batches, start = [], 0
    for s in splits:
        batches.append(recs[start:start + s])
        start += s
    src = os.path.join(scratch, "in")
    write_batches(src, batches)
    df = json_stream(spark, src, "seq long, k string, v long")
    tum = run_to_memory(state.count_window_stream(df, ["k"], "seq", "v", 5), os.path.join(scratch, "c1"))
    assert sorted((r.group_no, r.first_seq, r.last_seq, r.n) for r in tum.collect()) == [
        (0, 1, 5, 5), (1, 6, 10, 5)]
    sl = run_to_memory(state.count_window_stream(df, ["k"], "seq", "v", 5, 2), os.path.join(scratch, "c2"))
    got = sorted((r.fire_seq, r.n, r.first_seq, r.value_sum) for r in sl.collect())
    assert got == [(2, 2, 1, 3), (4, 4, 1, 10), (6, 5, 2, 20), (8, 5, 4, 30), (10, 5, 6, 40)]


def test_running_count_restart_from_checkpoint(spark, scratch):
    """ST6: stop after two batches, add input, restart from the same checkpoint: the
    per-record counts continue as in an uninterrupted run (state restored, no replay)."""
    import json
    import time

    batches = sensor_batches([2, 1, 2])
    src = os.path.join(scratch, "in")
    write_batches(src, batches[:2])
    df = json_stream(spark, src, "seq long, id string, vc long, count long")
    out = os.path.join(scratch, "out")
    ck = os.path.join(scratch, "ck")
    from tidemark.streaming.run import run_bounded

    def go():
        run_bounded(state.running_count_stream(df, ["id"], "vc", "seq"), sink="parquet", path=out,
                    checkpoint=ck)

    go()
    p = os.path.join(src, "part-late.json")
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(r) for r in batches[2]) + "\n")
    t = time.time()
    os.utime(p, (t, t))
    go()
    got = spark.read.parquet(out)
    assert [r.running_n for r in got.orderBy("seq").collect()] == SENSOR_RUNNING_COUNT


def test_processing_time_windows(spark, scratch):
    """W1 on processing time: rows are stamped on arrival; every row lands in exactly one
    tumbling window of its micro-batch's time."""
    from pyspark.sql import functions as F

    from tidemark.operators import windows
    from tidemark.streaming import sources

    src = os.path.join(scratch, "in")
    write_batches(src, [[{"v": i} for i in range(5)], [{"v": i} for i in range(5, 12)]])
    df = sources.with_arrival_time(json_stream(spark, src, "v long"))
    agg = windows.window_agg(df, [], windows.tumbling("arrival_ts", "12 seconds"), [F.count("*").alias("n")])
    got = run_to_memory(agg, os.path.join(scratch, "ck"), mode="complete")
    assert sum(r.n for r in got.collect()) == 12


def test_per_record_word_count_on_text_stream(spark, scratch):
    """A3 per record on a text stream: one running count per word occurrence."""
    from fixtures import HELLO_LINES
    from pyspark.sql import functions as F

    from tidemark.functions import parse
    from tidemark.streaming import sources

    src = os.path.join(scratch, "txt")
    os.makedirs(src)
    for i, chunk in enumerate([HELLO_LINES[:2], HELLO_LINES[2:]]):
        p = os.path.join(src, f"f{i}.txt")
        with open(p, "w") as f:
            f.write("\n".join(chunk))
        os.utime(p, (1_000_000 + i, 1_000_000 + i))
    lines = sources.numbered_text_stream(spark, src, max_files_per_trigger=1)
    pairs = parse.words(lines, keep=["file_time", "file", "line_no"], position="word_no") \
        .withColumn("n", F.lit(1))
    seq = ["file_time", "file", "line_no", "word_no"]
    out = run_to_memory(state.running_sum_stream(pairs, ["word"], "n", seq), os.path.join(scratch, "ck"))
    got = sorted((r.word, r.running_sum) for r in out.collect())
    assert len(got) == 10
    assert [n for w, n in got if w == "hello"] == [1, 2, 3, 4, 5]
    assert all(n == 1 for w, n in got if w != "hello")


def test_count_windows_restart_from_checkpoint(spark, scratch):
    """ST5 + ST6: the buffered rows of an open count window survive a restart."""
    import json
    import time

    from tidemark.streaming.run import run_bounded

    recs = [{"seq": i, "k": "a", "v": i} for i in range(1, 12)]
    src = os.path.join(scratch, "in")
    write_batches(src, [recs[:3], recs[3:7]])
    df = json_stream(spark, src, "seq long, k string, v long")
    out = os.path.join(scratch, "out")
    ck = os.path.join(scratch, "ck")

    def go():
        run_bounded(state.count_window_stream(df, ["k"], "seq", "v", 5, 2), sink="parquet", path=out,
                    checkpoint=ck)

    go()
    p = os.path.join(src, "part-late.json")
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs[7:]) + "\n")
    t = time.time()
    os.utime(p, (t, t))
    go()
    got = sorted((r.fire_seq, r.n, r.first_seq, r.value_sum) for r in spark.read.parquet(out).collect())
    assert got == [(2, 2, 1, 3), (4, 4, 1, 10), (6, 5, 2, 20), (8, 5, 4, 30), (10, 5, 6, 40)]


@pytest.mark.parametrize("splits", [[6], [1, 2, 3], [3, 3]])
def test_null_levels_and_values_equal_batch(spark, scratch, splits):
    from pyspark.sql import functions as F

    from tidemark.operators import running

    recs = [{"seq": i, "k": "a", "level": lv, "v": v} for i, (lv, v) in enumerate(
        [(1, None), (1, 1.9), (None, 1.9), (1, None), (None, -0.5), (2, 0.25)])]
    it = iter(recs)
    write_batches(os.path.join(scratch, "in"), [[next(it) for _ in range(n)] for n in splits])
    schema = "seq long, k string, level int, v double"
    whole = spark.createDataFrame([tuple(r.values()) for r in recs], schema)

    def stream():
        return json_stream(spark, os.path.join(scratch, "in"), schema)

    def compare(got, want, name):
        a = {r["seq"]: r[name] for r in got.collect()}
        assert a == {r["seq"]: r[name] for r in want.collect()}, name

    compare(run_to_memory(state.running_count_stream(stream(), ["k"], "level", "seq"), os.path.join(scratch, "c1")),
            running.running_count(whole, ["k", "level"], ["seq"]), "running_n")
    compare(run_to_memory(state.running_avg_stream(stream(), ["k"], "v", "seq"), os.path.join(scratch, "c2")),
            running.running_avg(whole, ["k"], ["seq"], "v"), "running_avg")
    compare(run_to_memory(state.running_sum_stream(stream(), ["k"], "v", "seq"), os.path.join(scratch, "c3")),
            running.running_sum(whole, ["k"], ["seq"], "v"), "running_sum")
    ints = stream().withColumn("v", F.col("level"))
    compare(run_to_memory(state.running_sum_stream(ints, ["k"], "v", "seq"), os.path.join(scratch, "c4")),
            running.running_sum(whole.withColumn("v", F.col("level")), ["k"], ["seq"], "v"), "running_sum")


def test_count_windows_of_one_large_key(spark, scratch):
    """A hundred thousand rows of one key in one batch."""
    import time

    n = 100_000
    write_batches(os.path.join(scratch, "in"), [[{"seq": i, "k": "a", "v": i % 7} for i in range(n)]])
    t = time.time()
    got = run_to_memory(state.count_window_stream(json_stream(spark, os.path.join(scratch, "in"), "seq long, k string, v long"), ["k"], "seq", "v", 50, 10),
                        os.path.join(scratch, "c")).orderBy("fire_seq").collect()
    assert len(got) == n // 10 and time.time() - t < 120
    assert [got[0][c] for c in ("n", "first_seq", "last_seq")] == [10, 0, 9]
    assert got[-1]["value_sum"] == sum(i % 7 for i in range(n - 50, n)) and got[-1]["n"] == 50


@pytest.mark.parametrize("kind", ["int", "string"])
def test_top_n_by_timers_equals_batch(spark, scratch, kind):
    import random

    from pyspark.sql import functions as F

    from tidemark.operators import topn, windows

    rng = random.Random(4)
    # behind the epoch, where a stream's first watermark stands; some keys are null
    recs = [{"t": t, "age": rng.choice([1, 2, 3, 4, None])} for t in range(1000, 1120) for _ in range(rng.randint(0, 3))]
    cut = len(recs) // 3
    write_batches(os.path.join(scratch, "in"), [recs[:cut], recs[cut:2 * cut], recs[2 * cut:], [{"t": 1400, "age": 9}], [{"t": 1005, "age": 1}], [{"t": 1500, "age": 9}]])
    stream = json_stream(spark, os.path.join(scratch, "in"), "t long, age int").withColumn("ts", F.timestamp_seconds("t")).withWatermark("ts", "3 seconds")
    stream = stream.withColumn("age", F.col("age").cast(kind))
    got = run_to_memory(state.window_top_n_stream(stream, "age", "ts", "10 seconds", "5 seconds", 2, slices=3), os.path.join(scratch, "c"))
    got = [(int(r["window_end"].timestamp()), r["rank"], r["age"], r["n"]) for r in got.collect()]
    df = spark.createDataFrame([(r["t"], r["age"]) for r in recs], "t long, age int").withColumn("ts", F.timestamp_seconds("t")).withColumn("age", F.col("age").cast(kind))
    counts = windows.window_agg(df, ["age"], windows.sliding("ts", "10 seconds", "5 seconds"), [F.count("*").alias("n")])
    best = topn.top_n(counts, ["window_start", "window_end"], [F.col("n").desc(), F.col("age").asc()], 2, salt_cols=["age"])
    want = [(int(r["window_end"].timestamp()), r["rank"], r["age"], r["n"]) for r in best.collect()]
    # the late row counts nowhere; the windows of t = 1400 end under t = 1500
    assert sorted(map(repr, [g for g in got if g[0] < 1300])) == sorted(map(repr, want))
    assert any(w[2] is None for w in want) and [str(g[2]) for g in got if g[0] >= 1300] == ["9", "9"]


def test_top_n_of_a_window_over_many_batches_and_a_restart(spark, scratch):
    """A window whose rows come in many batches, with thousands of keys and one hot one;
    the query is stopped in the midst and started again."""
    from pyspark.sql import functions as F

    src, names = os.path.join(scratch, "in"), [f"k{i:05d}" for i in range(4000)]
    batches = [[{"t": 1001 + b, "k": k} for k in names[b::3]] + [{"t": 1002, "k": "hot"}] * 500 + [{"t": 1003, "k": "k00007"}] * b for b in range(3)]
    write_batches(src, batches[:2])
    stream = json_stream(spark, src, "t long, k string").withColumn("ts", F.timestamp_seconds("t")).withWatermark("ts", "5 seconds")
    top = state.window_top_n_stream(stream, "k", "ts", "10 seconds", "10 seconds", 3, slices=4)

    def run():
        q = (top.writeStream.format("parquet").option("path", os.path.join(scratch, "out")).outputMode("append")
             .option("checkpointLocation", os.path.join(scratch, "c")).trigger(availableNow=True).start())
        q.awaitTermination(300)
        return spark.read.schema(top.schema).parquet(os.path.join(scratch, "out"))

    assert run().count() == 0
    write_batches(os.path.join(scratch, "more"), [*batches[2:], [{"t": 1100, "k": "end"}]])
    for i, f in enumerate(sorted(os.listdir(os.path.join(scratch, "more")))):
        os.replace(os.path.join(scratch, "more", f), os.path.join(src, f"later-{i}.json"))
    got = run().orderBy("window_end", "rank").collect()
    assert [(int(r["window_end"].timestamp()), r["rank"], r["k"], r["n"]) for r in got] == [
        (1010, 1, "hot", 1500), (1010, 2, "k00007", 4), (1010, 3, "k00000", 1)]


def test_two_stacks_give_the_last_values():
    for size in (1, 2, 3, 7):
        window = state.SlidingStates(size, lambda a, b: a + b)
        for i in range(40):
            window.push((i,))
            assert window.merged() == tuple(range(max(0, i + 1 - size), i + 1))


@pytest.mark.parametrize("slide", [None, 3, 11])
def test_count_windows_with_any_aggregate_equal_batch(spark, scratch, slide):
    """Minimum, maximum, sum and the values in their order (not commutative, no inverse);
    two order columns, nulls among the values, a null key, micro-batches of uneven size."""
    import random

    from pyspark.sql import functions as F

    from tidemark.operators import windows

    rng, size = random.Random(slide or 0), 7
    recs = [{"d": i // 10, "s": i % 10, "k": rng.choice(["a", "a", "a", "b", None]), "v": rng.choice([None, *range(-9, 10)])} for i in range(200)]
    cuts = [0, 1, 60, 61, 130, 200]
    write_batches(os.path.join(scratch, "in"), [recs[a:b] for a, b in zip(cuts, cuts[1:])])
    schema = "d long, s int, k string, v long"

    def result(values):
        there = [v for v in values if v is not None]
        return {"lo": min(there, default=None), "hi": max(there, default=None), "total": sum(there) if there else None,
                "trail": ",".join(map(str, there))}

    stream = state.count_window_agg_stream(
        json_stream(spark, os.path.join(scratch, "in"), schema), ["k"], ["d", "s"], "v", size, slide,
        lambda v: (v,), lambda a, b: a + b, result, "lo long, hi long, total long, trail string")
    got = run_to_memory(stream, os.path.join(scratch, "c"))
    df = spark.createDataFrame([tuple(r.values()) for r in recs], schema).withColumn("v", F.col("v"))
    inner = F.array_sort(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("d", "s", "v"))))
    aggs = [F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("v").alias("total"),
            F.array_join(F.transform(inner, lambda r: r["v"].cast("string")), ",").alias("trail")]
    want = (windows.count_tumbling(df, ["k"], ["d", "s"], size, aggs) if slide is None
            else windows.count_sliding(df, ["k"], ["d", "s"], size, slide, aggs))
    at = "group_no" if slide is None else "fire_seq"

    def plain(d):
        return sorted(map(repr, (tuple(r) for r in d.select("k", at, "n", "lo", "hi", "total", "trail").collect())))

    # a batch firing with a slide wider than its size leaves rows out as the stream does
    assert plain(got) == plain(want) and got.count() > 10


def test_count_windows_of_one_large_key_with_a_maximum(spark, scratch):
    n, size = 100_000, 1000
    write_batches(os.path.join(scratch, "in"), [[{"seq": i, "k": "a", "v": i * 7919 % 10_007} for i in range(a, a + n // 2)] for a in (0, n // 2)])
    calls = spark.sparkContext.accumulator(0)

    def merge(a, b):
        calls.add(1)
        return max(a, b)

    got = run_to_memory(state.count_window_agg_stream(
        json_stream(spark, os.path.join(scratch, "in"), "seq long, k string, v long"), ["k"], "seq", "v", size, 100,
        lambda v: v, merge, lambda m: {"hi": m}, "hi long"), os.path.join(scratch, "c")).orderBy("fire_seq").collect()
    v = [i * 7919 % 10_007 for i in range(n)]
    assert [r["hi"] for r in got] == [max(v[max(0, e - size):e]) for e in range(100, n + 1, 100)]
    assert calls.value <= 3 * (n + 2 * size)  # linear: not size merges for each firing or row
