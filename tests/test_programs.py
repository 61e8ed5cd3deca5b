"""The reference's programs end to end, on file streams: source -> parse -> operator ->
sink, as a user switching over would write them."""

import os
import time

from pyspark.sql import functions as F

from support import rows
from fixtures import HELLO_LINES, USER_LINES
from streamutil import run_to_memory
from tidemark.functions import parse
from tidemark.operators import aggregates
from tidemark.sources import files
from tidemark.streaming import sinks, sources
from tidemark.streaming import operators as so
from tidemark.streaming.run import run_bounded


def write_lines(directory, chunks):
    os.makedirs(directory, exist_ok=True)
    for i, chunk in enumerate(chunks):
        p = os.path.join(directory, f"f{i:03d}.txt")
        with open(p, "w", encoding="utf-8") as f:
            f.write("\n".join(chunk))
        os.utime(p, (1_000_000 + i, 1_000_000 + i))


def test_file_source_to_console(spark, scratch):
    """FileSourceDemo / CollectionSourceDemo: lines to the console."""
    src = os.path.join(scratch, "in")
    write_lines(src, [HELLO_LINES])
    q = sinks.console(sources.text_stream(spark, src), label="file_source", available_now=True,
                      checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    assert q.lastProgress["numInputRows"] == 5
    sinks.console(files.elements(spark, ["a", "b"]), label="elements")


def test_filter_program(spark, scratch):
    """FilterDemo: user lines -> parse -> keep age > 18."""
    src = os.path.join(scratch, "in")
    write_lines(src, [USER_LINES[:3], USER_LINES[3:]])
    users = sources.text_stream(spark, src, max_files_per_trigger=1).select(*parse.parse_user("value"))
    out = run_to_memory(users.where(F.col("age") > 18), os.path.join(scratch, "ck"))
    assert rows(out, "name", "age") == [("ann", 19), ("bob", 30)]


def test_checkpointed_line_count_program(spark, scratch):
    """CheckPointDemo01: line -> (line, 1) -> keyed running sum, recoverable from its
    checkpoint across a restart."""
    src = os.path.join(scratch, "in")
    write_lines(src, [["a", "b", "a"]])
    ck = os.path.join(scratch, "ck")
    out = os.path.join(scratch, "out")

    def run():
        counts = so.running_counts(parse.line_pairs(sources.text_stream(spark, src)), ["line"], "n")
        fn = sinks.multi_output_writer({"counts": lambda b: b}, out)
        run_bounded(counts, foreach_batch=fn, checkpoint=ck, output_mode="update")

    run()
    p = os.path.join(src, "f999.txt")
    with open(p, "w") as f:
        f.write("a\nc")
    t = time.time()
    os.utime(p, (t, t))
    run()
    last = spark.read.parquet(os.path.join(out, "counts"))
    final = {r.line: r.n for r in last.orderBy("batch").collect()}  # later batches override
    assert final == {"a": 3, "b": 1, "c": 1}


def generated(spark, out):
    df = spark.read.option("recursiveFileLookup", "true").text(out)
    return sorted(int(r.value.removeprefix("输入数字为：")) for r in df.collect())


def test_generator_to_rolling_files_program(spark, scratch):
    """SinkFile: bounded rate-limited generator -> rolling text files by hour, by itself to
    its end, with a restart on the way."""
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    def begin():
        gen = sources.generator_stream(spark, 3000, rows_per_second=100, partitions=3, name=os.path.basename(scratch))
        return sinks.rolling_text_sink(gen, out, roll_interval="1 second", prefix="SinkToFile", suffix=".log", checkpoint=ck)

    q = begin()
    deadline = time.time() + 60
    while time.time() < deadline and not (q.lastProgress and q.lastProgress["numInputRows"]):
        time.sleep(0.2)
    q.stop()
    first = generated(spark, out)
    assert 0 < len(first) < 3000 and first == list(range(len(first)))
    sources.run_to_end(begin(), 3000, 90)
    assert generated(spark, out) == list(range(3000))


def test_generator_ends_under_available_now(spark, scratch):
    out = os.path.join(scratch, "out")
    gen = sources.generator_stream(spark, 99_999, rows_per_second=None, partitions=14)
    q = sinks.rolling_text_sink(gen, out, checkpoint=os.path.join(scratch, "ck"), available_now=True)
    assert q.awaitTermination(90) and generated(spark, out) == list(range(99_999))


def test_generator_ranges():
    reader = sources._GeneratorReader({"count": "10", "tasks": "4"})
    parts = reader.partitions({"next": 3}, {"next": 10})
    assert [(p.first, p.end) for p in parts] == [(3, 4), (4, 6), (6, 8), (8, 10)]
    assert reader.partitions({"next": 10}, {"next": 10}) == [] and reader.latestOffset() == {"next": 10}
    assert [i for p in parts for b in reader.read(p) for i in b.column(0).to_pylist()] == list(range(3, 10))


def test_users_to_jdbc_program(spark, scratch):
    """MysqlSourceSink: user lines -> rows with a 32-hex id and today's date -> JDBC."""
    src = os.path.join(scratch, "in")
    write_lines(src, [USER_LINES[:4], USER_LINES[4:]])
    url = f"jdbc:derby:memory:prog{abs(hash(scratch)) % 100000};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    parts = F.split("value", ",")
    users = sources.text_stream(spark, src, max_files_per_trigger=1).select(
        parts[0].alias("name"), parts[1].cast("int").alias("age"), parts[2].alias("address"),
        parts[3].alias("email"))
    write = sinks.jdbc_writer(url, "users", ["name", "age", "address", "email"], props,
                              column_types="id VARCHAR(32), name VARCHAR(64), address VARCHAR(64), email VARCHAR(64)")
    run_bounded(users, foreach_batch=write, checkpoint=os.path.join(scratch, "ck"))
    back = spark.read.jdbc(url, "users", properties=props)
    assert back.count() == len(USER_LINES)
    assert sorted(back.columns) == sorted(["id", "name", "age", "address", "email", "create_time", "batch_id"])


def test_batch_word_count_program(spark, scratch):
    """DataSetApiBatchCount: a text file -> words -> counts, printed."""
    p = os.path.join(scratch, "hello.txt")
    with open(p, "w") as f:
        f.write("\n".join(HELLO_LINES))
    counts = aggregates.word_count(files.read_lines(spark, p))
    sinks.console(counts)
    assert dict(rows(counts))["hello"] == 5
