import glob
import os

from pyspark.sql import functions as F

from support import rows
from fixtures import HELLO_LINES, USER_LINES
from streamutil import json_stream, write_batches
from tidemark.streaming import rolled, sinks
from tidemark.streaming.run import run_bounded

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def written(spark, out):
    """value -> file, and the files' sizes, of what readers see."""
    df = spark.read.option("recursiveFileLookup", "true").text(out).select("value", "_metadata.file_path")
    files = [f for f in glob.glob(os.path.join(out, "*", "*")) if not os.path.basename(os.path.dirname(f)).startswith("_")]
    return sorted(r.value for r in df.collect()), files


def test_rolling_text_sink_round_trip(spark, scratch):
    src = os.path.join(scratch, "in")
    recs = [{"value": v, "ts": f"2024-01-01T0{i % 3}:00:00"} for i, v in enumerate(HELLO_LINES * 3)]
    write_batches(src, [recs[:7], recs[7:]])
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    def run():
        df = json_stream(spark, src, "value string, ts timestamp")
        sinks.rolling_text_sink(df, out, time_col="ts", roll_bytes=20, prefix="SinkToFile", suffix=".log",
                                checkpoint=ck, available_now=True).awaitTermination(120)

    run()
    values, files = written(spark, out)
    assert values == sorted(HELLO_LINES * 3)
    assert {os.path.basename(os.path.dirname(f)) for f in files} == {"2024-01-01--00", "2024-01-01--01", "2024-01-01--02"}
    assert all(os.path.basename(f).startswith("SinkToFile-") and f.endswith(".log") for f in files)
    longest = max(len(v.encode()) + 1 for v in HELLO_LINES)
    assert len(files) >= 8 and max(map(os.path.getsize, files)) < 20 + longest
    # the last batch again, as after a crash between the write and Spark's own commit
    os.remove(os.path.join(ck, "commits", "1"))
    for crc in glob.glob(os.path.join(ck, "commits", ".1.crc")):
        os.remove(crc)
    run()
    again, names = written(spark, out)
    assert again == values and sorted(names) == sorted(files)
    assert not glob.glob(os.path.join(out, "_staging", "*"))


def test_a_crash_between_manifest_and_moves_is_finished(scratch):
    from pyspark import TaskContext
    import pyarrow as pa

    class Crash(Exception):
        pass

    class Once(rolled._StreamWriter):
        def _fs(self):
            fs, base = super()._fs()
            moved = []

            class Fs:
                def __getattr__(self, name):
                    return getattr(fs, name)

                def move(self, a, b):
                    if self is not None and "_staging" in a:
                        moved.append(a)
                        if len(moved) > 1:
                            raise Crash
                    fs.move(a, b)

            return Fs(), base

    out = os.path.join(scratch, "o")
    batch = [pa.RecordBatch.from_arrays([pa.array([f"row {i}" for i in range(9)]), pa.array(["h"] * 9)], names=["value", "bucket"])]
    opts = {"path": out, "writer_id": "w", "roll_bytes": "12"}
    TaskContext._taskContext = context = TaskContext()
    context._partitionId = 0
    try:
        first = Once(opts)
        message = first.write(iter(batch))
        try:
            first.commit([message], 0)
        except Crash:
            pass
        assert len(glob.glob(os.path.join(out, "h", "*"))) == 1
        again = rolled._StreamWriter(opts)  # the replay after the restart
        again.commit([again.write(iter(batch))], 0)
        third = rolled._StreamWriter(opts)
        third.abort([None, third.write(iter(batch))], 1)
    finally:
        TaskContext._taskContext = None
    lines = [line for f in glob.glob(os.path.join(out, "h", "*")) for line in open(f).read().splitlines()]
    assert sorted(lines) == [f"row {i}" for i in range(9)]
    assert [os.path.basename(p) for p in glob.glob(os.path.join(out, "_commits", "*"))] == ["w-000000"]


def test_text_buckets_batch(spark, scratch):
    df = spark.createDataFrame([(v,) for v in HELLO_LINES] + [(None,)], "value string")
    out = os.path.join(scratch, "b")
    sinks.write_text_buckets(df, out, roll_bytes=1, prefix="p", suffix=".txt")
    values, files = written(spark, out)
    assert values == sorted(["", *HELLO_LINES]) and len(files) == len(HELLO_LINES) + 1
    sinks.write_text_buckets(spark.range(400_000).selectExpr("concat('line ', id) value"), os.path.join(scratch, "big"))
    values, files = written(spark, os.path.join(scratch, "big"))
    assert len(values) == 400_000 and max(map(os.path.getsize, files)) < rolled.ROLL_BYTES + 20


def test_a_failed_batch_leaves_no_file(spark, scratch):
    import pytest
    out = os.path.join(scratch, "f")
    df = spark.range(0, 1000, 1, 4).selectExpr("if(id = 999, raise_error('stop'), string(id)) value")
    with pytest.raises(Exception, match="stop"):
        sinks.write_text_buckets(df, out)
    assert not [f for f in glob.glob(os.path.join(out, "**", "*"), recursive=True) if os.path.isfile(f)]


def test_jdbc_sink_replay_adds_no_rows(spark, scratch):
    url = f"jdbc:derby:memory:tm{os.getpid()}{abs(hash(scratch)) % 10000};create=true"
    # Derby rejects typed nulls for CLOB-mapped strings, so fill all four fields here
    parts = F.split("value", ",")
    users = spark.createDataFrame([(v,) for v in USER_LINES], "value string").select(
        parts[0].alias("name"), parts[1].cast("int").alias("age"), parts[2].alias("address"),
        parts[3].alias("email"))
    write = sinks.jdbc_writer(url, "users", ["name", "age", "address", "email"], DERBY,
                              column_types="id VARCHAR(32), name VARCHAR(64), address VARCHAR(64), email VARCHAR(64)")
    write(users, 0)
    write(users, 0)  # the same batch again, as after a failure
    write(users.limit(2), 1)
    back = spark.read.jdbc(url, "users", properties=DERBY)
    assert back.count() == len(USER_LINES) + 2
    assert back.select("id").distinct().count() == len(USER_LINES) + 2
    assert all(len(r.id) == 32 for r in back.select("id").collect())
    assert back.where(F.col("create_time") == F.current_date()).count() == back.count()


def test_random_ids_are_hex(spark):
    from tidemark.functions.ids import random_id

    ids = [r.i for r in spark.range(5).select(random_id().alias("i")).collect()]
    assert len(set(ids)) == 5 and all(len(i) == 32 and int(i, 16) >= 0 for i in ids)


def test_multi_output_writer_idempotent(spark, scratch):
    src = os.path.join(scratch, "in")
    write_batches(src, [[{"v": i} for i in range(5)], [{"v": i} for i in range(5, 9)]])
    out = os.path.join(scratch, "out")
    fn = sinks.multi_output_writer({"even": lambda b: b.where(F.col("v") % 2 == 0),
                                    "odd": lambda b: b.where(F.col("v") % 2 == 1)}, out)
    run_bounded(json_stream(spark, src, "v long"), foreach_batch=fn, checkpoint=os.path.join(scratch, "ck"))
    static = spark.read.schema("v long").json(src)
    fn(static.where(F.col("v") < 5), 0)  # replay of batch 0 overwrites, no duplicates
    assert sorted(r.v for r in spark.read.parquet(os.path.join(out, "even")).collect()) == [0, 2, 4, 6, 8]
    assert sorted(r.v for r in spark.read.parquet(os.path.join(out, "odd")).collect()) == [1, 3, 5, 7]


def test_console_static(spark, capsys):
    sinks.console(spark.createDataFrame([("x",)], "value string"), label="main")
    sinks.console(spark.createDataFrame([("y",)], "value string"), label="late", stderr=True)
    got = capsys.readouterr()
    assert "main" in got.out and "late" in got.err


def test_console_prints_every_row(spark, scratch, capfd):
    sinks.console(spark.range(1000).selectExpr("concat('line', id) value"), label="all")
    out = capfd.readouterr().out.split()
    assert sum(w.startswith("line") for w in out) == 1000
    write_batches(os.path.join(scratch, "in"), [[{"value": f"row{i}"} for i in range(1000)]])
    sinks.console(json_stream(spark, os.path.join(scratch, "in"), "value string"), label="stream", available_now=True,
                  checkpoint=os.path.join(scratch, "c")).awaitTermination(120)
    out = capfd.readouterr().out.split()
    assert sum(w.startswith("row") for w in out) == 1000


def test_ids_repeat_after_a_shuffle(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1), ("c", 3)] * 20, "x string, y int")
    one, two = (sorted(r["id"] for r in sinks.jdbc_rows(d, ["x", "y"], 5).collect()) for d in (df, df.repartition(7)))
    assert one == two and len(set(one)) == 80
