"""What tables written on the way leave on disk, and what a date costs."""

import glob
import re
import time

from pyspark.sql import functions as F

from pubspark import functions as PF
from pubspark.operators.parse import parse_items, parse_works
from pubspark.plans import batch, catalog
from pubspark.sources import staging
from pubspark.sources.lake import write_build
from pubspark.sources.layers import land
from tests.helpers import raw_df


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark, scratch_dir):
    before, kept = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = spark.range(1000).withColumn("day", F.current_date()).repartition(4, "id")
    assert land(rows, "rows").count() == 1000
    write_build(rows, scratch_dir, "layer", "b1")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not {f for f in left if f.endswith(".data")}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept


def test_staged_files_are_compressed_and_bounded(spark, scratch_dir, monkeypatch):
    monkeypatch.setattr(staging, "WORKS_PER_FILE", 3)
    monkeypatch.setattr(catalog, "ENVELOPES_PER_FILE", 3)
    raw = raw_df(spark, [{"DOI": f"10.1/{k}"} for k in range(8)]).coalesce(1).withColumns(
        {"source_file": F.lit("f"), "run": F.lit("r")})
    staged = parse_works(parse_items(raw, keep=("source_file", "run")), keep=("record_hash", "source_file", "run"))
    staging.write_staging(staged, f"{scratch_dir}/s")
    assert len(glob.glob(f"{scratch_dir}/s/works/run=r/*.json.gz")) == 3
    assert staging.read_staging(spark, f"{scratch_dir}/s", staged.schema).count() == 8
    catalog.write_documents(spark.range(7).coalesce(1).select(F.col("id").cast("string")), f"{scratch_dir}/d")
    assert len(glob.glob(f"{scratch_dir}/d/*.txt.gz")) == 3 and spark.read.text(f"{scratch_dir}/d").count() == 7


def test_publications_of_one_day_are_shuffled_once(spark, scratch_dir, monkeypatch):
    asked = {}
    monkeypatch.setattr(batch, "write_build", lambda df, root, layer, build, rebalance=False: asked.update(
        {(layer, build): rebalance}) or write_build(df, root, layer, build, rebalance))
    items = raw_df(spark, [{"DOI": "10.1/a", "author": [{"name": "n"}]}, {"DOI": "10.1/b"}]).withColumn("run", F.lit("r"))
    for build, day in (("one", "date'2025-01-01'"), ("two", "IF(raw_item LIKE '%a%', date'2025-01-01', date'2025-01-02')")):
        bronze = batch.bronze_with_status(items.withColumn("day", F.expr(day)), keep=("run", "day"), nested=batch.NESTED_LISTS)
        batch.write_silver(bronze.where("parse_ok").drop("parse_ok", "bad_item"), scratch_dir, build)
    assert {b: asked["silver/publications", b] for b in ("one", "two")} == {"one": False, "two": True}


def test_a_date_is_found_by_one_path(spark):
    df = raw_df(spark, [{"d": {"date-parts": p}} for p in (
        [[2024]], [[2024, None]], [[2024, 2, 3, "x"]], [["2024", "5"]], [[2024, "x"]], [], [[]], [2024], [[[2024]]], "x",
        [[2024.7, 2]], [[True, 2]], [[12345, 13, 99]])] + [{}]).select(F.try_parse_json("raw_item").alias("i"))
    got = PF.date_parts(F.col("i"), "d")
    assert len(set(re.findall(r"\$\['d'\]\S*", str(got._jc.toString())))) <= 1
    assert [tuple(r) for r in df.select(got["date"], got["precision"]).collect()] == [
        ("2024-01-01", "year"), (None, None), ("2024-02-03", "day"), ("2024-05-01", "month"), (None, None), (None, None),
        (None, None), (None, None), (None, None), (None, None), ("2024-02-01", "month"), ("0001-02-01", "month"),
        ("12345-13-99", "day"), (None, None)]


def test_bronze_only_columns_lands_only_those(spark, monkeypatch):
    landed = {}
    monkeypatch.setattr(catalog, "land", lambda df, name: landed.update({name: df.columns}) or land(df, name))
    monkeypatch.setattr(catalog, "raw_items", lambda *a: raw_df(spark, [{"DOI": "10.1/a", "score": 2.5, "ISSN": ["1"]}, {}]))
    got = {r.column: (r.dtype, r.non_null_rows) for r in catalog.q_bronze_only_columns(spark, "none").collect()}
    assert set(got) == set(catalog.BRONZE_COLUMNS) - set(catalog.REQUIRED_PUBLICATION_COLUMNS)
    assert got["score"] == ("double", 1) and got["issn_json"] == ("string", 2)
    assert "score" in landed["bronze"] and "title" not in landed["bronze"] and "extra_metadata_json" not in landed["bronze"]
