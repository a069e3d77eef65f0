"""Merging runs into the current publications equals de-duplicating all runs again."""

import json
import os
import random

from pubspark.plans.batch import current_publications, run_pipeline
from pubspark.plans.current import CURRENT, merge_current, read_current
from pubspark.sources.lake import live_runs, read_log
from pubspark.plans import analytics as A


def items(r, n):
    return [{"DOI": f"10.1/{r.randrange(25)}", "title": [f"t{r.randrange(1000)}"],
             "deposited": {"date-time": f"2024-01-{r.randrange(1, 28):02d}T00:00:00Z"} if r.random() < 0.8 else None}
            for _ in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def bring(spark, folder, out, run, what):
    os.makedirs(f"{folder}/{run}", exist_ok=True)
    with open(f"{folder}/{run}/metadata_raw_{run}.json", "w", encoding="utf-8") as f:
        json.dump({"message": {"items": what}}, f)
    run_pipeline(spark, f"{folder}/{run}", out, as_of="2025-01-01")


def test_merges_equal_the_rebuild_also_after_replacing_runs(spark, scratch_dir):
    r, out = random.Random(3), f"{scratch_dir}/out"
    for step, run in enumerate(("a", "b", "c", "a", "b")):
        # the last time run b comes without rows: all its DOIs fall back on other runs, or go
        bring(spark, f"{scratch_dir}/in", out, run, items(r, 20) if step < 4 else [])
        assert merge_current(spark, out, buckets=8) is not None
        assert rows(read_current(spark, out)) == rows(current_publications(spark, out))
    assert merge_current(spark, out, buckets=8) is None  # nothing is pending


def test_only_touched_buckets_are_written(spark, scratch_dir):
    out = f"{scratch_dir}/out"
    bring(spark, f"{scratch_dir}/in", out, "a", [{"DOI": f"10.1/{k}", "title": ["t"]} for k in range(40)])
    bring(spark, f"{scratch_dir}/in", out, "b", [{"DOI": "10.1/3", "title": ["new"], "deposited": {"date-time": "2024-01-01T00:00:00Z"}}])
    merge_current(spark, out, spark.createDataFrame([("a",)], "run string"), buckets=8)
    before = {r.run: r.build for r in live_runs(spark, out, CURRENT).collect()}
    merge_current(spark, out, buckets=8)
    after = {r.run: r.build for r in live_runs(spark, out, CURRENT).collect()}
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert read_current(spark, out).where("title = 'new'").count() == 1
    assert read_current(spark, out, log=read_log(spark, out, 3)).where("title = 'new'").count() == 0  # as it was


def test_many_repetitions_of_one_row(spark):
    one = spark.createDataFrame([("10.1/a", 300_000_000), ("10.1/b", 1), ("10.1/c", 2)], "doi string, _n long")
    got = A.repeated(one, "_n", ("doi",))
    assert {r.doi: r["count"] for r in got.groupBy("doi").count().collect()} == {"10.1/a": 300_000_000, "10.1/b": 1, "10.1/c": 2}
    small = A.repeated(spark.createDataFrame([(k, k) for k in range(1, 40)], "doi long, n long"), "n", ("doi",), chunk=7)
    assert {r.doi: r["count"] for r in small.groupBy("doi").count().collect()} == {k: k for k in range(1, 40)}
