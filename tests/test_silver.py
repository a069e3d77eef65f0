"""Silver builders: de-duplication, authors, identifiers, quality issues."""

from pyspark.sql import functions as F

from pubspark.operators.silver import (
    record_issues,
    silver_authors,
    silver_identifiers,
    silver_publications,
    silver_quality_issues,
)
from tests.helpers import bronze_of, rows, srt

DEP = lambda t: {"date-parts": [[2024, 1, 1]], "date-time": t}

ITEMS = [
    {"DOI": "10.1/A", "title": ["old"], "deposited": DEP("2024-01-01T00:00:00Z"),
     "indexed": DEP("2024-02-01T00:00:00Z")},
    {"DOI": "10.1/a ", "title": ["new"], "deposited": DEP("2024-03-01T00:00:00Z"),
     "indexed": DEP("2024-01-01T00:00:00Z")},
    {"DOI": "10.1/a", "title": ["undated"]},
    {"DOI": "10.1/b", "title": ["b1"], "deposited": DEP("2024-01-01T00:00:00Z"),
     "indexed": DEP("2024-01-05T00:00:00Z")},
    {"DOI": "10.1/b", "title": ["b2"], "deposited": DEP("2024-01-01T00:00:00Z"),
     "indexed": DEP("2024-01-09T00:00:00Z")},
    {"title": ["no doi"], "ISSN": ["x"], "issn-type": [{"value": "1111-2222", "type": "print"}]},
]


def test_publications_latest_version(spark):
    p = silver_publications(bronze_of(spark, ITEMS))
    assert rows(p, "doi", "title") == [("10.1/a", "new"), ("10.1/b", "b2")]
    assert dict(p.dtypes)["deposited_datetime"] == "timestamp"
    assert dict(p.dtypes)["reference_count"] == "int"
    assert len(p.columns) == 33


def test_publications_tie_is_deterministic(spark):
    tie = [{"DOI": "t", "title": [f"v{i}"], "deposited": DEP("2024-01-01T00:00:00Z"),
            "indexed": DEP("2024-01-01T00:00:00Z")} for i in range(6)]
    b = bronze_of(spark, tie)
    first = silver_publications(b).first().title
    again = silver_publications(b.repartition(5)).first().title
    assert first == again


def test_publications_idempotent(spark):
    p = silver_publications(bronze_of(spark, ITEMS))
    # running the dedup over its own output changes nothing
    again = silver_publications(p.withColumn("deposited_datetime", F.col("deposited_datetime").cast("string"))
                                .withColumn("indexed_datetime", F.col("indexed_datetime").cast("string"))
                                .withColumn("published_date", F.col("published_date").cast("string"))
                                .withColumn("published_print_date", F.col("published_print_date").cast("string"))
                                .withColumn("published_online_date", F.col("published_online_date").cast("string"))
                                .withColumn("issued_date", F.col("issued_date").cast("string"))
                                .withColumn("created_datetime", F.col("created_datetime").cast("string")))
    assert rows(again, "doi", "title") == rows(p, "doi", "title")


def test_authors(spark):
    items = [{"DOI": "d", "author": [
        {"given": "A", "family": "B", "ORCID": "https://orcid.org/0000-1", "sequence": "first",
         "affiliation": []},
        {"family": "B", "name": "X", "ORCID": "http://orcid.org/0000-2"},
        {"name": "X", "affiliation": None},
        {},
    ]}, {"DOI": None, "author": [{"given": "Z"}]}, {"DOI": "e", "author": []}]
    a = silver_authors(bronze_of(spark, items))
    got = rows(a, "given_name", "family_name", "raw_author_name", "orcid", "affiliations_json",
               "author_parse_status")
    assert got == srt([
        ("A", "B", None, "0000-1", "[]", "parsed_person_name"),
        (None, "B", "X", "0000-2", None, "parsed_person_name"),
        (None, None, "X", None, "null", "name_only_unparsed"),
        (None, None, None, None, None, "missing_author_name"),
    ])


def test_identifiers_single_scan(spark):
    items = [{"DOI": "d", "issn-type": [{"value": "1", "type": "print"}, {"value": " ", "type": "e"}],
              "isbn-type": [{"value": "978", "type": "print"}], "alternative-id": ["", "alt"]},
             {"issn-type": [{"value": "9", "type": "print"}]}]
    i = silver_identifiers(bronze_of(spark, items))
    assert rows(i, "doi", "identifier_type", "identifier_value", "identifier_subtype",
                "identifier_position") == srt([
        ("d", "ISBN", "978", "print", 1), ("d", "ISSN", "1", "print", 1),
        ("d", "alternative_id", "alt", None, 2), (None, "ISSN", "9", "print", 1)])
    assert dict(i.dtypes)["identifier_position"] == "int"


def test_quality_issues(spark):
    items = [{"DOI": "a"},  # no title, no authors
             {"DOI": "b", "title": ["t"], "author": [{"name": "n"}, {"name": "m"}, {"given": "g"}],
              "published": {"date-parts": [[20206]]}},
             {"title": ["t"], "author": [{"name": "n"}]},
             {"DOI": "b", "title": ["t"], "author": [{"name": "z"}]}]
    q = silver_quality_issues(bronze_of(spark, items), as_of="2025-01-01")
    assert rows(q, "doi", "issue_type", "affected_row_count") == srt([
        ("a", "missing_authors", 1), ("a", "missing_title", 1),
        ("b", "author_name_only_unparsed", 3), ("b", "future_published_date", 1),
        (None, "author_name_only_unparsed", 1), (None, "missing_doi", 1)])


def test_record_rules_equal_union_form(spark):
    """The single-scan rule table equals one filtered SELECT per rule, UNION ALL'd."""
    b = bronze_of(spark, [{"DOI": "a"}, {"title": ["t"], "published": {"date-parts": [[3000]]}},
                          {"DOI": "c", "title": ["x"], "author": [{"given": "g"}]}])
    single = record_issues(b, "2025-01-01")
    union = (b.where("title IS NULL").select("doi", F.lit("missing_title").alias("issue_type"))
             .unionByName(b.where("authors_json IS NULL OR authors_json = '[]'")
                          .select("doi", F.lit("missing_authors").alias("issue_type")))
             .unionByName(b.where("try_cast(published_date AS DATE) > DATE'2025-01-01'")
                          .select("doi", F.lit("future_published_date").alias("issue_type")))
             .unionByName(b.where("doi IS NULL").select("doi", F.lit("missing_doi").alias("issue_type"))))
    assert rows(single, "doi", "issue_type") == rows(union, "doi", "issue_type")
