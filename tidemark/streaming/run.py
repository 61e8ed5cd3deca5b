"""Recoverable runs (ST6): start a streaming query with a durable checkpoint and a
trigger; bounded inputs run to completion with ``availableNow``.

Exactly-once comes from Spark's offset log plus state snapshots per micro-batch, a
replayable source (files, topics) and an idempotent sink (the file sink's commit log, or
``foreachBatch`` writers keyed by batch id). The checkpoint lives under the shared
``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import checkpoint_path


def default_checkpoint(df: DataFrame, name: str | None = None) -> str:
    return checkpoint_path(df.sparkSession, "streams", name or f"q-{uuid.uuid4().hex[:12]}")


def start(df: DataFrame, *, sink: str | None = None, path: str | None = None,
          output_mode: str = "append", checkpoint: str | None = None,
          trigger: str | None = "5 seconds", available_now: bool = False,
          foreach_batch=None, query_name: str | None = None,
          partition_by: list[str] | None = None, options: dict | None = None) -> StreamingQuery:
    """Start ``df`` into a sink (format name, or ``foreach_batch`` function).

    ``trigger`` is the micro-batch interval (the checkpoint interval of the reference);
    ``available_now`` processes everything available, in as many batches as the source's
    rate limits say, and stops.
    """
    w = df.writeStream.outputMode(output_mode).option(
        "checkpointLocation", checkpoint or default_checkpoint(df, query_name))
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif sink:
        w = w.format(sink)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start(path) if path else w.start()


def run_bounded(df: DataFrame, timeout_s: float | None = None, **kw) -> StreamingQuery:
    """Process all available input and wait for the query to stop."""
    q = start(df, available_now=True, **kw)
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()
    return q
