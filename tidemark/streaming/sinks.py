"""Sinks (K1-K4): console, several outputs per micro-batch, rolling text files, JDBC.

Every writer that runs inside ``foreachBatch`` is idempotent per batch id, so a batch
replayed after a failure or restart leaves no duplicates.
"""

from __future__ import annotations

import os
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.ids import deterministic_id, random_id
from tidemark.streaming import rolled
from tidemark.streaming.run import default_checkpoint, start

# Fixed value: directory name layout of the rolling file sink's time buckets.
BUCKET_FORMAT = "yyyy-MM-dd--HH"


def _join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts]) if "://" in base else os.path.join(base, *parts)


# ---------------------------------------------------------------------------- K1 console
def _print_rows(df: DataFrame, label: str | None, stderr: bool) -> None:
    import sys

    out = sys.stderr if stderr else sys.stdout
    prefix = f"{label}> " if label else ""
    for row in df.toLocalIterator():  # one partition at a time
        print(prefix + (str(row[0]) if len(row) == 1 else str(tuple(row))), file=out)


def console(df: DataFrame, label: str | None = None, stderr: bool = False, **kw) -> StreamingQuery | None:
    """K1 / K2: print every row, one a line (to stderr with ``stderr``, as the reference
    prints side outputs), with ``label`` before it. A static DataFrame is printed now; of a
    stream each micro-batch is, by a query named ``label``."""
    if not df.isStreaming:
        _print_rows(df, label, stderr)
        return None
    return start(df, foreach_batch=lambda batch, _: _print_rows(batch, label, stderr), query_name=label, **kw)


# ---------------------------------------------------------------------------- K2 side outputs
def multi_output_writer(outputs: dict[str, Callable[[DataFrame], DataFrame]], out_dir: str,
                        fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """One ``foreachBatch`` function writing several tagged outputs of each
    micro-batch (e.g. main rows and late rows) to ``out_dir/<tag>/batch=<id>``. Each
    batch overwrites only its own folder, so replays are idempotent."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once for all outputs
        try:
            for tag, make in outputs.items():
                make(batch).write.mode("overwrite").format(fmt).save(
                    _join(out_dir, tag, f"batch={batch_id}"))
        finally:
            batch.unpersist()

    return fn


# ---------------------------------------------------------------------------- K3 rolling files
def with_time_bucket(df: DataFrame, time_col: str | None = None, fmt: str = BUCKET_FORMAT,
                     name: str = "bucket") -> DataFrame:
    """Bucket rows by hour of their time (or of the write when ``time_col`` is None)."""
    t = F.col(time_col) if time_col else F.current_timestamp()
    return df.withColumn(name, F.date_format(t, fmt))


def rolling_text_sink(df: DataFrame, path: str, value: str = "value", time_col: str | None = None,
                      roll_interval: str = "10 seconds", roll_bytes: int = rolled.ROLL_BYTES,
                      prefix: str = "part", suffix: str = "", checkpoint: str | None = None, **kw) -> StreamingQuery:
    """K3: UTF-8 text rows into ``path/<yyyy-MM-dd--HH>/<prefix>-...<suffix>``.

    A file is closed when it has ``roll_bytes`` encoded bytes, and with its micro-batch, so
    after ``roll_interval`` (the trigger). Each micro-batch is committed as a whole
    (:mod:`tidemark.streaming.rolled`): a batch that comes again adds nothing. Read the
    files with ``recursiveFileLookup``; unfinished ones are in folders that Spark skips.
    """
    df.sparkSession.dataSource.register(rolled.RolledText)
    out = with_time_bucket(df, time_col).select(F.col(value).cast("string").alias("value"), "bucket")
    checkpoint = checkpoint or default_checkpoint(df)
    return start(out, sink=rolled.FORMAT, trigger=roll_interval, checkpoint=checkpoint,
                 options={"path": path, "prefix": prefix, "suffix": suffix, "roll_bytes": str(roll_bytes),
                          "writer_id": rolled.writer_id(checkpoint)}, **kw)


def write_text_buckets(df: DataFrame, path: str, value: str = "value", time_col: str | None = None,
                       roll_bytes: int = rolled.ROLL_BYTES, prefix: str = "part", suffix: str = "") -> None:
    """K3, batch form: all files or, if a task fails for good, none."""
    df.sparkSession.dataSource.register(rolled.RolledText)
    out = with_time_bucket(df, time_col).select(F.col(value).cast("string").alias("value"), "bucket")
    (out.write.format(rolled.FORMAT).mode("append").option("path", path).option("prefix", prefix)
     .option("suffix", suffix).option("roll_bytes", str(roll_bytes)).save())


# ---------------------------------------------------------------------------- K4 JDBC
def jdbc_rows(batch: DataFrame, columns: Sequence[str], batch_id: int | None = None,
              deterministic: bool = True, id_col: str = "id", date_col: str = "create_time") -> DataFrame:
    """The target table's row: a 32-hex id, the given columns, today's date. A
    deterministic id (content, number among the batch's equal rows, batch id) lets a replayed
    batch be recognised: it doesn't depend on the order of rows or partitions, so it is
    the same after a shuffle, and equal rows of one batch still get distinct ids."""
    if deterministic:
        same = Window.partitionBy(*columns).orderBy(F.lit(1))
        batch = batch.withColumn("_tm_same", F.row_number().over(same))
        ident = deterministic_id(*columns, F.col("_tm_same"), batch_id=batch_id)
    else:
        ident = random_id()
    return batch.select(ident.alias(id_col), *columns, F.current_date().alias(date_col))


def table_exists(spark, url: str, table: str, properties: dict[str, str]) -> bool:
    """Whether the database's catalogue lists the table (``schema.table`` or ``table``)."""
    jvm = spark.sparkContext._jvm
    if properties.get("driver"):
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    con = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        schema, _, name = table.replace('"', "").replace("`", "").rpartition(".")
        for variant in {name, name.upper(), name.lower()}:
            if con.getMetaData().getTables(None, schema or None, variant, None).next():
                return True
        return False
    finally:
        con.close()


def jdbc_writer(url: str, table: str, columns: Sequence[str], properties: dict[str, str],
                batchsize: int = 100, batch_col: str | None = "batch_id", deterministic: bool = True,
                column_types: str | None = None) -> Callable[[DataFrame, int], None]:
    """K4: a ``foreachBatch`` function inserting each micro-batch through JDBC in
    statements of ``batchsize`` rows (failed tasks are retried by Spark).

    With ``batch_col`` the rows carry their batch id; before inserting, the ids already
    stored for this batch are read back (a bounded, pushed-down query) and skipped, so a
    replayed batch inserts nothing twice. Without it the sink is at-least-once, like the
    reference's.
    """
    props = dict(properties)
    props["batchsize"] = str(batchsize)

    def fn(batch: DataFrame, batch_id: int) -> None:
        rows = jdbc_rows(batch, columns, batch_id, deterministic)
        if batch_col:
            rows = rows.withColumn(batch_col, F.lit(batch_id).cast("long"))
            spark = batch.sparkSession
            if table_exists(spark, url, table, props):
                # the filter is pushed into the database with the dialect's quoting
                done = (spark.read.jdbc(url, table, properties=props)
                        .where(F.col(batch_col) == batch_id).select("id"))
                rows = rows.join(done, on="id", how="left_anti")
        w = rows.write.mode("append")
        if column_types:
            w = w.option("createTableColumnTypes", column_types)
        w.jdbc(url, table, properties=props)

    return fn
