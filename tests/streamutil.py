"""Helpers for file-driven stream tests: one JSON file per micro-batch."""

from __future__ import annotations

import json
import os
import time
import uuid


def write_batches(directory: str, batches: list[list[dict]]) -> None:
    os.makedirs(directory, exist_ok=True)
    base = time.time() - 10_000
    for i, batch in enumerate(batches):
        path = os.path.join(directory, f"part-{i:05d}.json")
        with open(path + ".tmp", "w") as f:
            for r in batch:
                f.write(json.dumps(r) + "\n")
        # the file source orders files by modification time: make arrival order explicit
        os.utime(path + ".tmp", (base + i, base + i))
        os.replace(path + ".tmp", path)


def json_stream(spark, directory: str, schema: str, per_trigger: int = 1):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
            .json(directory))


def run_to_memory(df, checkpoint: str, mode: str = "append"):
    name = "t_" + uuid.uuid4().hex[:10]
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(300)
    if q.exception():
        raise q.exception()
    return df.sparkSession.table(name)
