"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every pipeline run relies on: UTC wall clock for date-time text, ANSI casts
# (we use try_cast where the reference tolerates bad input), AQE for runtime
# re-partitioning and skew splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "pubspark",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    if "spark.sql.files.minPartitionNum" not in conf:
        # The record parse is CPU-bound and uneven per byte; several input splits per core let
        # the scheduler balance it. Inert for large inputs (bytes per core > split size).
        spark.conf.set("spark.sql.files.minPartitionNum", str(4 * spark.sparkContext.defaultParallelism))
    ensure_checkpoint_dir(spark)
    return spark


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a table that is written are deleted when it is written, and not
    when the driver happens to collect its garbage; the session's own setting comes back."""
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a shared filesystem and we use it as is. It may be
    unset only on a local master (tests, one machine), where a scratch folder serves; any other
    master raises, because a machine-local folder is invisible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="pubspark-ckpt-")
    sc.setCheckpointDir(current)
    return current
