"""Queries land and read only what they need, with the same rows."""

import os

from pyspark.sql import functions as F

from pubspark.operators import profiling
from pubspark.operators.parse import parse_items
from pubspark.operators.silver import build_silver, silver_publications
from pubspark.operators.validation import validation_report
from pubspark.plans import catalog
from tests.helpers import bronze_of, raw_df

SF = "/root/testdata/sf0.001"
ITEMS = [{"DOI": f"10.1/{i % 7}", "title": [f"t{i}"], "type": "book" if i % 2 else "article", "author": [{"name": "n"}],
          "published": {"date-parts": [[2000 + i]]}, "deposited": {"date-time": f"2024-01-{1 + i % 9:02d}T00:00:00Z"}}
         for i in range(40)]


def test_publications_with_some_columns(spark):
    b = bronze_of(spark, ITEMS)
    some = silver_publications(b.select("doi", "title", "deposited_datetime", "indexed_datetime", "record_hash"), columns=("title",))
    assert some.columns == ["doi", "title", "deposited_datetime", "indexed_datetime"]
    whole = silver_publications(b).select(*some.columns)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.collect()))


def test_queries_land_only_their_columns(spark):
    landed = spark.read.parquet(*catalog.q_publication_type_distribution(spark, SF).inputFiles())
    assert {"doi", "publication_type", "deposited_datetime", "record_hash"} <= set(landed.columns)
    assert not {"abstract", "authors", "authors_json", "extra_metadata_json"} & set(landed.columns)


def test_report_on_pruned_tables(spark):
    b = bronze_of(spark, ITEMS)
    s = build_silver(b, "2025-01-01")
    tables = ("publications", "publication_authors", "identifiers", "quality_issues")
    whole = validation_report(*(s[t] for t in tables), checked_at=F.lit(None))
    pruned = {**s, "publications": silver_publications(b, columns=())}
    names = tuple(s[t].columns for t in tables)
    some = validation_report(*(pruned[t] for t in tables), checked_at=F.lit(None), columns=names)
    assert sorted(map(str, whole.collect())) == sorted(map(str, some.collect()))
    missing = validation_report(*(pruned[t] for t in tables), checked_at=F.lit(None)).where("status = 'fail'")
    assert missing.count() == 1


def test_envelope_files_are_compressed_and_bounded(spark, scratch_dir):
    path, n = os.path.join(scratch_dir, "in"), catalog.ENVELOPES_PER_FILE
    rows = spark.range(n + 5, numPartitions=1).select(F.format_string('{"message": {"items": [%d]}}', "id").alias("envelope"),
                                                      F.lit("r").alias("run"))
    catalog.write_envelopes(rows, path)
    files = [f for f in os.listdir(f"{path}/run=r") if f.endswith(".txt.gz")]
    assert len(files) == 2
    assert spark.read.text(path).count() == n + 5


def test_a_streamed_run_comes_in_few_files(spark, monkeypatch):
    seen = []

    class Stop(Exception):
        pass

    def stream(spark, path, *args, **kwargs):
        seen.append(path)
        raise Stop

    monkeypatch.setattr(catalog, "start_bronze_stream", stream)
    try:
        catalog.q_streamed_works(spark, SF)
    except Stop:
        pass
    files = [len([f for f in os.listdir(f"{seen[0]}/{d}") if f.startswith("part-")])
             for d in os.listdir(seen[0]) if d.startswith("run=")]
    assert files and max(files) == 1


def test_path_inventory_takes_only_the_wanted_fields(spark, monkeypatch):
    plans = []

    def land(df, name):
        if name == "values":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df, name)

    kept = profiling.land
    monkeypatch.setattr(profiling, "land", land)
    items = parse_items(raw_df(spark, [*ITEMS, {"title": None, "author": {"a": [1]}}, ["title"], "x"])).where("item IS NOT NULL")
    got = profiling.path_inventory(items, fields=("title", "author")).where("path <> ''")
    assert "variant_explode" not in plans[0]
    every = profiling.path_inventory(items).where("path LIKE 'title%' OR path LIKE 'author%'")
    assert got.count() and sorted(map(str, got.collect())) == sorted(map(str, every.collect()))
