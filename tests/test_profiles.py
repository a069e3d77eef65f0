"""Profiles kept per run and merged: exact counts, sketch errors, only new runs are read."""

from pyspark.sql import functions as F

from pubspark.operators.profiling import column_profile
from pubspark.plans.batch import read_silver, run_pipeline
from pubspark.plans.profiles import column_sketches, merged_profile, refresh_profiles
from tests.test_pipeline import ITEMS_1, ITEMS_2, write_envelope


def test_merged_profile_follows_the_runs(spark, scratch_dir):
    inp, out = f"{scratch_dir}/in", f"{scratch_dir}/out"

    def check():
        got = {r.column: (r.dtype, r.nulls, r.null_percent, r.about_unique) for r in merged_profile(spark, out).collect()}
        exact = column_profile(read_silver(spark, out, "publications", None).drop("run", "day")).collect()
        assert got == {r.column: (r.dtype, r.nulls, r.null_percent, r.unique_values) for r in exact}  # few values: exact

    write_envelope(inp, "20260101T000000", ITEMS_1)
    run_pipeline(spark, inp, out, as_of="2025-01-01")
    assert refresh_profiles(spark, out) is not None and refresh_profiles(spark, out) is None
    check()
    write_envelope(inp, "20260101T000000", ITEMS_2)  # replaced
    write_envelope(inp, "20260102T000000", ITEMS_1)  # new
    run_pipeline(spark, inp, out, as_of="2025-01-01")
    refresh_profiles(spark, out)
    check()


def test_sketch_error(spark):
    df = spark.range(200_000).select(
        F.concat(F.lit("v"), F.col("id") % 50_000).alias("text"), (F.col("id") % 7).cast("int").alias("few"),
        F.timestamp_seconds("id").alias("ts"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 3000).cast("int")).alias("day"),
        F.when(F.col("id") % 2 == 0, F.col("id") / 3).alias("half"), (F.col("id") % 5).alias("run"))
    got = (column_sketches(df).groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"),
                                                    F.sum("nulls").alias("nulls")).collect())
    want = {"text": 50_000, "few": 7, "ts": 200_000, "day": 3000, "half": 100_000}
    assert {r.column for r in got} == set(want)
    assert all(abs(r.n - want[r.column]) <= 0.05 * want[r.column] for r in got)
    assert {r.column: r.nulls for r in got}["half"] == 100_000
