"""Incremental landing with Structured Streaming.

New raw envelope files dropped into a folder are picked up by a file-source stream. Each micro-batch
is a batch run over its files (:func:`pubspark.plans.batch.process`) that keeps what its runs had from
other files, so the result does not depend on how files are split into batches and equals the batch
run's; a replayed file replaces itself. A broken envelope goes to the quarantine and keeps its run
back, as in the batch run. With ``refresh_silver=True`` the silver tables and validation report follow.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubspark.plans.batch import process
from pubspark.sources.raw import BROKEN_COLUMN, ENVELOPE_SCHEMA, envelope_fields, run_id


def envelope_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 100,
                    multi_line: bool = True, run_from_partition: bool = False) -> DataFrame:
    env = (spark.readStream.schema(ENVELOPE_SCHEMA + (", run string" if run_from_partition else ""))
           .option("multiLine", multi_line).option("columnNameOfCorruptRecord", BROKEN_COLUMN)
           .option("maxFilesPerTrigger", max_files_per_trigger).json(landing_dir))
    run = F.col("run") if run_from_partition else run_id(F.col("_metadata.file_name"))
    return env.select(*envelope_fields(), F.col("_metadata.file_path").alias("source_file"), run.alias("run"))


def start_bronze_stream(spark: SparkSession, landing_dir: str, out_root: str,
                        checkpoint_location: str | None = None, once: bool = True,
                        refresh_silver: bool = False, as_of=None, max_files_per_trigger: int = 100,
                        multi_line: bool = True, run_from_partition: bool = False):
    """Start the landing stream; returns the ``StreamingQuery``. The checkpoint location must be
    on shared storage; by default it lives under the session's ``spark.checkpoint.dir``.
    ``max_files_per_trigger`` bounds a micro-batch and thereby the runs it touches; it does not
    change the result."""
    if checkpoint_location is None:
        base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
        checkpoint_location = os.path.join(base, "bronze-landing")

    def write_batch(batch: DataFrame, _epoch: int) -> None:
        process(batch, out_root, as_of, keep_other_files=True, silver=refresh_silver)

    writer = (envelope_stream(spark, landing_dir, max_files_per_trigger, multi_line, run_from_partition)
              .writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
