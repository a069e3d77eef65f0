"""The quadratic SQL of the operators on pairs gives their rows, edges of the vectors included."""

import duckdb
from pyspark.sql import functions as F

from pubspark.llm import chosen_paths, pair_sql, subspace_join
from tests.llm.edge import SF, by_id, documents


def rows(sql, name, table):
    con = duckdb.connect()
    con.register(name, table)
    return sorted(con.execute(sql).fetchall(), key=repr)


def test_vectors(spark):
    table = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0]), (4, [0.1, 1.0]), (5, [1.0, 1.0]), (6, None), (7, [0.0, 0.0]),
             (8, [None, 1.0]), (9, [float("nan"), 1.0]), (10, [1.0]), (11, [-1.0, 0.0]), (12, [1.0, 0.0])]
    more = spark.read.parquet(f"{SF}/embeddings.parquet").select((F.col("vec_id") + 1000).alias("vec_id"), "embedding")
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>").unionByName(more)
    assert by_id(subspace_join.near_vectors(df)) == rows(pair_sql.near_vectors_sql(), "embeddings", df.toArrow())


def test_documents(spark):
    df = documents(spark)
    got = by_id(chosen_paths.near_duplicates(df).drop("own"))
    assert got == rows(pair_sql.near_duplicates_sql(), "documents", df.select("doc_id", "text").toArrow())
