"""Streaming sources (S2, S3, S5, S6) and arrival time.

Every source returns a streaming DataFrame of text lines in column ``value``; parsing
and everything after it is shared with the batch path.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.parse import generated_text, lines_of
from tidemark.session import checkpoint_path


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                latest_first: bool = False) -> DataFrame:
    """New text files in a directory as a stream of lines (``value``).
    Replayable: the file list of every micro-batch is in the query's offset log."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if latest_first:
        reader = reader.option("latestFirst", "true")
    return reader.load(path)


def topic_options(servers: str, topic: str, starting: str = "latest", **extra: str) -> dict[str, str]:
    """Options of a message-topic source that starts at the latest offset."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    opts.update(extra)
    return opts


def topic_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 **extra: str) -> DataFrame:
    """Lines from a topic, with the broker's record time as ``arrival_ts`` (for
    processing-time windows). Needs the Kafka connector package on the classpath."""
    raw = spark.readStream.format("kafka").options(**topic_options(servers, topic, starting, **extra)).load()
    return raw.select(F.col("value").cast("string").alias("value"),
                      F.col("timestamp").alias("arrival_ts"))


@dataclass
class IndexRange(InputPartition):
    first: int
    end: int


class _GeneratorReader(DataSourceStreamReader):
    """Offsets ``{"next": n}``, 0 to ``count``; a batch is the range between two of them, cut
    for as many tasks as asked for. The offset that is due follows from the time since the
    first start, which is stored once, so a restarted stream goes on with the same clock and
    no offset goes back."""

    def __init__(self, options: dict):
        self.count, self.tasks = int(options["count"]), int(options["tasks"])
        self.rate, self.clock = float(options.get("rate", 0)), options.get("clock")
        self.started: float | None = None

    def _started(self) -> float:
        if self.started is None:
            fs, path = pafs.FileSystem.from_uri(self.clock)
            if fs.get_file_info(path).type == pafs.FileType.NotFound:
                fs.create_dir(path.rpartition("/")[0])
                with fs.open_output_stream(path) as f:
                    f.write(repr(time.time()).encode())
            with fs.open_input_stream(path) as f:
                self.started = float(f.read())
        return self.started

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        due = int((time.time() - self._started()) * self.rate) if self.rate else self.count
        return {"next": min(self.count, due)}

    def partitions(self, start: dict, end: dict) -> list[IndexRange]:
        a, n = start["next"], end["next"] - start["next"]
        parts = min(self.tasks, n)
        return [IndexRange(a + n * i // parts, a + n * (i + 1) // parts) for i in range(parts)]

    def read(self, partition: IndexRange) -> Iterator[pa.RecordBatch]:
        for a in range(partition.first, partition.end, 10_000):
            index = pa.array(range(a, min(a + 10_000, partition.end)), pa.int64())
            now = pa.array([time.time_ns() // 1000] * len(index), pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([index, now], names=["id", "arrival_ts"])

    def commit(self, end: dict) -> None:
        pass


class GeneratorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_generator"

    def schema(self) -> str:
        return "id long, arrival_ts timestamp"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _GeneratorReader(dict(self.options))


def generator_stream(spark: SparkSession, count: int, rows_per_second: float | None = 1000,
                     partitions: int | None = None, name: str | None = None) -> DataFrame:
    """A bounded generator: indexes ``0 .. count-1``, each mapped to its text.

    With ``rows_per_second`` the indexes come due at that rate from the first start on, and
    :func:`run_to_end` ends the query after the last; give a ``name`` to go on with the same
    clock after a restart. With None all are due at once, and an ``availableNow`` query
    stops behind the last."""
    spark.dataSource.register(GeneratorSource)
    reader = (spark.readStream.format(GeneratorSource.name()).option("count", str(count))
              .option("tasks", str(partitions or spark.sparkContext.defaultParallelism)))
    if rows_per_second:
        clock = checkpoint_path(spark, "generators", name or uuid.uuid4().hex, "started")
        reader = reader.option("rate", str(rows_per_second)).option("clock", clock)
    return reader.load().select(generated_text("id").alias("value"), "arrival_ts")


def run_to_end(query: StreamingQuery, count: int, timeout_s: float | None = None) -> None:
    """Wait until the generator under ``query`` has committed ``count`` rows, then stop it."""
    deadline = time.monotonic() + timeout_s if timeout_s else None
    while query.isActive:
        progress = query.lastProgress
        ends = [re.search(r"next\D+(\d+)", str(s["endOffset"])) for s in progress["sources"]] if progress else []
        if any(e and int(e[1]) >= count for e in ends):
            query.stop()
        elif deadline and time.monotonic() > deadline:
            query.stop()
            raise TimeoutError("the generator did not come to its end")
        else:
            query.awaitTermination(0.2)
    if query.exception():
        raise query.exception()


def generator_batch(spark: SparkSession, count: int, partitions: int | None = None) -> DataFrame:
    """S6, bounded batch form: the same rows, spread over ``partitions`` tasks."""
    return spark.range(0, count, numPartitions=partitions).select(generated_text("id").alias("value"))


def with_arrival_time(df: DataFrame, name: str = "arrival_ts") -> DataFrame:
    """Processing time as a column: the ingest time of the micro-batch (W1-W3 on
    processing time group by this column)."""
    return df if name in df.columns else df.withColumn(name, F.current_timestamp())


def numbered_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S2 with an arrival order per line: each new file is read whole and split into
    lines with their position, so ``(file_time, file, line_no)`` orders the lines of a
    stream the way they were written (keyed state needs this for per-record output)."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(path).select(
        "value", F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file"))
    return files.select("file_time", "file", F.posexplode(lines_of("value")).alias("line_no", "value"))
