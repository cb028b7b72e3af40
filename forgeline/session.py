"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  Timestamps are stored as TIMESTAMP_NTZ, so the
# session time zone only matters for the few LTZ conversions; it is pinned anyway.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "forgeline",
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (the cluster supplies its own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FORGELINE_DRIVER_MEMORY", "8g"))
        # checkpoint files of DataFrames no longer referenced are removed by the cleaner
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def pin_session(spark: SparkSession) -> None:
    """Apply the runtime-settable part of SESSION_CONF to an existing session."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # other settings may be left as the cluster has them; results depend on these two
            if k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
                raise


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used as
    is.  Only when it is unset under a ``local`` master (tests) is a private folder
    created; a cluster without the setting is an error, because a machine-local
    folder cannot be read back after an executor is lost.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir must name a folder on shared storage")
        conf_dir = tempfile.mkdtemp(prefix="forgeline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that no DataFrame still reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def shuffled_by_size(spark: SparkSession, df: DataFrame, bytes_per_partition: int = 16 << 20) -> Iterator[int]:
    """Within, a shuffle begins with a partition for so many bytes of the files that ``df`` reads (the session's number at
    least; AQE joins small ones), so that the rows one task sorts do not grow with the input."""
    total = 0
    for name in df.inputFiles():
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        total += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getLen()
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    n = max(int(before or spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bytes_per_partition))
    spark.conf.set(INITIAL_PARTITIONS, n)
    try:
        yield n
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)
