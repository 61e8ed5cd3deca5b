"""Session helpers: one place for the settings every job in the library assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on. Time zone UTC so that event-time formatting and
# window bounds do not depend on the machine; AQE so that shuffle partition counts,
# join strategies and skewed join partitions are re-planned from runtime sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpointed scan slices are dropped from the shared folder once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks. On a cluster, use the cluster's session
    and call :func:`ensure_checkpoint_dir` instead."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is used as is; if it
    is missing there, this fails rather than write to a machine-local folder. Only in
    local mode (tests, benchmarks) a scratch folder is created and set when it is unset.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...): "
                             "ordered scans and stream operators cut lineage there")
        current = fallback or tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-path of the shared checkpoint folder (for streaming checkpoints and
    lineage-cutting tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


def default_ranges(spark: SparkSession) -> int:
    """Number of range slices used by ordered scans: ``tidemark.scan.ranges`` if set
    (size it so that a slice fits a task: input bytes / ~256 MB), else the shuffle
    partition count."""
    v = spark.conf.get("tidemark.scan.ranges", None)
    return int(v) if v else int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Rows go to Python in batches of about ``size`` bytes, unless the session has a size of
    its own: ten thousand texts together, as Spark would send them, are held by the
    executor and by its Python workers once each, and no result depends on it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` on whatever file system it names (local, HDFS, S3)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
