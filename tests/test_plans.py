"""Physical-plan properties that matter at scale."""

import os

from pyspark.sql import functions as F

from pubspark.operators.silver import silver_identifiers, silver_publications, silver_quality_issues
from pubspark.operators.validation import validation_report
from pubspark.operators.silver import build_silver
from pubspark.plans import catalog
from tests.helpers import bronze_of

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written_bronze(spark, scratch_dir, items):
    path = os.path.join(scratch_dir, "bronze")
    bronze_of(spark, items).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


ITEMS = [{"DOI": f"10.1/{i % 7}", "title": [f"t{i}"], "ISSN": ["x"],
          "issn-type": [{"value": f"{i}", "type": "print"}], "alternative-id": [f"a{i}"],
          "author": [{"name": "n"}, {"given": "g"}],
          "deposited": {"date-time": f"2024-01-{1 + i % 28:02d}T00:00:00Z"}} for i in range(60)]


def test_top1_is_reduced_before_shuffle(spark, scratch_dir):
    b = written_bronze(spark, scratch_dir, ITEMS)
    p = silver_publications(b)
    phys = plan_text(p)
    assert "WindowGroupLimit" in phys
    # the partial top-1 runs map-side, i.e. below (printed after) the exchange on the DOI
    exchange = phys.index("Exchange hashpartitioning(doi")
    assert "Partial" in phys[exchange:] and "WindowGroupLimit" in phys[exchange:]
    assert p.count() == 7


def test_doi_filter_pushed_to_scan(spark, scratch_dir):
    b = written_bronze(spark, scratch_dir, ITEMS)
    phys = plan_text(silver_publications(b))
    assert "PushedFilters: [IsNotNull(doi)]" in phys


def test_identifiers_single_scan(spark, scratch_dir):
    b = written_bronze(spark, scratch_dir, ITEMS)
    phys = plan_text(silver_identifiers(b))
    assert phys.count("FileScan parquet") == 1
    assert "Exchange" not in phys


def test_quality_issues_two_scans(spark, scratch_dir):
    b = written_bronze(spark, scratch_dir, ITEMS)
    phys = plan_text(silver_quality_issues(b, "2025-01-01"))
    assert phys.count("FileScan parquet") == 2


def test_no_python_udfs_anywhere(spark, shared_landings):
    for name in catalog.QUERIES:
        phys = plan_text(catalog.QUERIES[name](spark, SF))
        assert "PythonUDF" not in phys and "BatchEvalPython" not in phys and "ArrowEvalPython" not in phys


def test_hot_doi_is_correct(spark):
    """One DOI holding a third of all rows: dedup keeps one row, counts stay whole."""
    hot = [{"DOI": "10.1/HOT", "title": [f"h{i}"], "author": [{"name": "n"}],
            "deposited": {"date-time": f"2024-01-01T00:00:{i % 60:02d}Z"},
            "indexed": {"date-time": f"2024-02-01T00:{i // 60:02d}:{i % 60:02d}Z"}} for i in range(300)]
    cold = [{"DOI": f"10.1/c{i}", "title": ["c"], "author": [{"given": "g"}]} for i in range(600)]
    b = bronze_of(spark, hot + cold).repartition(8)
    s = build_silver(b, "2025-01-01")
    pubs = s["publications"]
    assert pubs.count() == 601
    assert pubs.where("doi = '10.1/hot'").first().title == "h299"
    issues = s["quality_issues"].where("issue_type = 'author_name_only_unparsed'")
    assert issues.agg(F.sum("affected_row_count")).first()[0] == 300
    rep = validation_report(pubs, s["publication_authors"], s["identifiers"], s["quality_issues"])
    got = {r.check_name: r.metric_value for r in rep.collect()}
    assert got["unique_publication_doi"] == "rows=601, distinct_dois=601"
    assert got["authors_have_matching_publication"] == "0"


def test_hot_author_name_and_anti_join(spark):
    """A name carried by a third of all author rows: distinct counts stay exact, and the anti
    join's build side is reduced to distinct DOIs before the shuffle."""
    from pubspark.operators.profiling import publications_without_authors
    from pubspark.plans import analytics as A

    items = ([{"DOI": f"10.1/h{i % 50}", "title": ["t"],
               "author": [{"given": "Hot", "family": "Name", "sequence": "first" if i % 2 else "additional"}]}
              for i in range(400)]
             + [{"DOI": f"10.1/c{i}", "title": ["t"], "author": [{"given": f"G{i}", "family": "F"}]}
                for i in range(800)]
             + [{"DOI": "10.1/none", "title": ["t"]}])
    s = build_silver(bronze_of(spark, items).repartition(6), "2025-01-01")
    top = A.author_publication_stats(spark, s["publication_authors"]).first()
    assert (top.author_name, top.publication_count, top.first_author_count) == ("Hot Name", 50, 200)
    orphans = publications_without_authors(s["publications"], s["publication_authors"])
    assert [r.doi for r in orphans.collect()] == ["10.1/none"]
    phys = plan_text(orphans)
    assert "LeftAnti" in phys and phys.count("HashAggregate(keys=[doi") >= 2


def test_orphan_check_aggregates_before_anti_join(spark, scratch_dir):
    from pubspark.operators.validation import orphan_count

    b = written_bronze(spark, scratch_dir, ITEMS)
    s = build_silver(b, "2025-01-01")
    phys = plan_text(orphan_count(s["publication_authors"], s["publications"]))
    anti = phys.index("LeftAnti")
    assert "HashAggregate(keys=[doi" in phys[anti:]  # the per-DOI count feeds the join


def test_bronze_parses_each_record_once(spark):
    from pubspark.operators.parse import bronze_with_status
    from tests.helpers import raw_df

    phys = plan_text(bronze_with_status(raw_df(spark, ITEMS)))
    assert phys.count("parseJson") + phys.count("try_parse_json") <= 1 + phys.count("parse_json([]")


def test_silver_reads_nested_bronze_without_parsing(spark):
    silver = catalog.silver(spark, SF)
    for name in ("publication_authors", "identifiers", "quality_issues"):
        plan = silver[name]._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "parse_json" not in plan and "parsejson" not in plan
    # the JSON text gives the same rows
    from pubspark.operators.parse import NESTED_LISTS
    again = build_silver(silver["bronze"].drop(*NESTED_LISTS), catalog.AS_OF)
    for name in ("publication_authors", "identifiers", "quality_issues"):
        assert silver[name].exceptAll(again[name]).isEmpty() and again[name].exceptAll(silver[name]).isEmpty()
