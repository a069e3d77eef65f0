"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubspark.llm.common import discard, materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component`` (its smallest id) of every id in ``links (a long, b long)``.

    Each round hangs, for every id, its larger neighbours and then its smaller ones below the
    smallest id around it, until nothing changes; about as many rounds as the logarithm of the
    longest path. Every round is a written table, so nothing is gathered on the driver and a
    lost executor costs one round's tasks at most. Minima are summed per task before the
    shuffle; joins on an id with very many links are left to Spark's skew handling.
    """
    edges = materialize(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        both = edges.toDF("u", "v").unionByName(edges.toDF("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(low.withColumnRenamed("m", "lo")).distinct())
        before, edges = edges, materialize(small, "links")
        discard(before)
    roots = edges.select(F.col("lo").alias("id")).distinct().withColumn("component", F.col("id"))
    out = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots)
    out._folder = edges._folder  # for ``discard``
    return out
