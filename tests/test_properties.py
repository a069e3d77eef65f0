"""Property tests: single-scan forms equal their UNION ALL definitions; results do not depend
on input partitioning; helpers for bounded fetches and parameterised SQL."""

import os

import pytest
from pyspark.sql import functions as F

from pubspark.functions import json_array_elements
from pubspark.operators.profiling import column_profile
from pubspark.operators.silver import build_silver, silver_identifiers
from pubspark.plans import catalog
from pubspark.plans.analytics import run_sql_file
from pubspark.sources.layers import fetch_bounded, query_file

SF = "/root/testdata/sf0.001"


def multiset(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


def test_identifiers_equal_union_of_three_branches(spark):
    b = catalog.bronze(spark, SF)

    def branch(col, typ, typed):
        e = b.select("doi", F.posexplode(json_array_elements(F.col(col))).alias("pos", "e"))
        value = F.try_variant_get("e", "$.value" if typed else "$", "string")
        sub = F.try_variant_get("e", "$.type", "string") if typed else F.lit(None).cast("string")
        return e.select("doi", F.lit(typ).alias("identifier_type"), value.alias("identifier_value"),
                        sub.alias("identifier_subtype"), (F.col("pos") + 1).cast("int").alias("identifier_position"))

    union = (branch("issn_type_json", "ISSN", True).unionByName(branch("isbn_type_json", "ISBN", True))
             .unionByName(branch("alternative_ids_json", "alternative_id", False))
             .where("identifier_value IS NOT NULL AND trim(identifier_value) != ''"))
    assert multiset(silver_identifiers(b)) == multiset(union)


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_silver_independent_of_partitioning(spark, parts):
    b = catalog.bronze(spark, SF)
    base = build_silver(b, "2025-01-01")
    moved = build_silver(b.repartition(parts, F.rand(seed=parts)), "2025-01-01")
    for name in base:
        assert multiset(base[name]) == multiset(moved[name]), name


def test_column_profile_approx_close(spark):
    p = build_silver(catalog.bronze(spark, SF), "2025-01-01")["publications"].select("doi", "publisher")
    exact = {r["column"]: r["unique_values"] for r in column_profile(p).collect()}
    approx = {r["column"]: r["unique_values"] for r in column_profile(p, approx=True).collect()}
    for c in exact:
        assert abs(approx[c] - exact[c]) <= max(2, 0.1 * exact[c])


def test_fetch_bounded_and_query_file(spark, scratch_dir):
    path = os.path.join(scratch_dir, "t.parquet")
    spark.range(5).write.parquet(path)
    assert len(fetch_bounded(query_file(spark, path), max_rows=5)) == 5
    with pytest.raises(ValueError):
        fetch_bounded(query_file(spark, path), max_rows=4)


def test_sql_file_by_path(spark, scratch_dir):
    path = os.path.join(scratch_dir, "q.sql")
    with open(path, "w") as f:
        f.write("-- count rows\nSELECT count(*) AS n FROM {t};\n")
    assert run_sql_file(spark, path, t=spark.range(7)).first().n == 7
