"""Reading files by path, bounded fetches, and tables landed for the rest of a query."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pubspark.session import ensure_checkpoint_dir, freed_shuffles


def query_file(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Query a file by its quoted path, as in ``SELECT ... FROM parquet.`path```."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def fetch_bounded(df: DataFrame, max_rows: int):
    """Bring a result to the driver as pandas. The caller states the bound; a result beyond it
    raises and nothing is cut."""
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it instead of fetching")
    return head


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder and read it back:
    cuts the lineage like a checkpoint, and later reads prune columns and push filters down."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
