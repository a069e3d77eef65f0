"""Record-level parsing (normalisation, first element, date parts, abstract cleanup, extras)."""

import pytest
from pyspark.sql import functions as F

from pubspark.functions.casts import try_date
from tests.helpers import bronze_of


def one(spark, item, col):
    return bronze_of(spark, [item]).select(col).first()[0]


@pytest.mark.parametrize("doi,expected", [
    (" 10.5555/ABC ", "10.5555/abc"), ("", None), (None, None), ("  ", ""),
    (" 10.1/X\t", "10.1/x"), ("\x1c10.1/y", "10.1/y"),
])
def test_normalize_doi(spark, doi, expected):
    item = {"title": ["t"]} if doi is None else {"DOI": doi}
    assert one(spark, item, "doi") == expected


def test_normalize_doi_absent(spark):
    assert one(spark, {"title": ["t"]}, "doi") is None


@pytest.mark.parametrize("title,expected", [
    (["a", "b"], "a"), ([], None), ("a", None), ([None], None), ([12], "12"),
])
def test_first_from_list(spark, title, expected):
    assert one(spark, {"DOI": "x", "title": title}, "title") == expected


@pytest.mark.parametrize("parts,text,precision", [
    ([[2024]], "2024-01-01", "year"),
    ([[2024, 3]], "2024-03-01", "month"),
    ([[2024, 3, 9]], "2024-03-09", "day"),
    ([[2024, 3, 9, 1]], "2024-03-09", "day"),
    ([[None]], None, None), ([[]], None, None), ([], None, None), ([["x"]], None, None),
    ([[2024, None]], None, None),
    ([["2024", "3"]], "2024-03-01", "month"),
    ([[2026, 13, 1]], "2026-13-01", "day"),
    ([[20206]], "20206-01-01", "year"),
    ([[2024.7, 3]], "2024-03-01", "month"),
    ([[True, 2]], "0001-02-01", "month"),
])
def test_date_parts(spark, parts, text, precision):
    b = bronze_of(spark, [{"DOI": "x", "published": {"date-parts": parts}}])
    r = b.select("published_date", "published_date_precision").first()
    assert (r[0], r[1]) == (text, precision)


def test_date_parts_not_object(spark):
    b = bronze_of(spark, [{"DOI": "x", "published": [[2024]]}])
    assert b.select("published_date").first()[0] is None


def test_silver_date_guard(spark):
    df = spark.createDataFrame([("2026-01",), ("2026-13-01",), ("2024-02-29",), ("20206-01-01",)], "t string")
    out = [r[0] for r in df.select(try_date(F.col("t")).cast("string")).collect()]
    assert out == [None, None, "2024-02-29", "+20206-01-01"]


@pytest.mark.parametrize("abstract,expected", [
    ("<jats:p>A <b>b</b></jats:p>", "A b"), ("<p></p>", None), ("", None),
    ("  plain\n\ttext  ", "plain text"), ("x<br/>y", "x y"),
])
def test_clean_abstract(spark, abstract, expected):
    assert one(spark, {"DOI": "x", "abstract": abstract}, "abstract") == expected


@pytest.mark.parametrize("resource,expected", [
    ({"primary": {"URL": "u"}}, "u"), ({"primary": "u"}, None), ("u", None),
])
def test_resource_url(spark, resource, expected):
    assert one(spark, {"DOI": "x", "resource": resource}, "resource_url") == expected


def test_extra_metadata(spark):
    assert one(spark, {"DOI": "a", "subject": ["s"]}, "extra_metadata_json") == '{"subject":["s"]}'
    assert one(spark, {"DOI": "a"}, "extra_metadata_json") == "{}"


def test_lists_absent_vs_null(spark):
    b = bronze_of(spark, [{"DOI": "a"}, {"DOI": "b", "author": None, "license": [{"URL": "l"}]}])
    got = {r.doi: (r.authors_json, r.license_json) for r in b.collect()}
    assert got == {"a": ("[]", "[]"), "b": (None, '[{"URL":"l"}]')}


def test_counts_rounding(spark):
    b = bronze_of(spark, [{"DOI": "a", "is-referenced-by-count": 2.5, "reference-count": "1.6",
                           "references-count": 3.5},
                          {"DOI": "b", "is-referenced-by-count": "2.5", "reference-count": -2.5,
                           "references-count": "x"}])
    got = {r.doi: (r.is_referenced_by_count, r.reference_count, r.references_count) for r in b.collect()}
    assert got == {"a": (2, 2, 4), "b": (3, -2, None)}


def test_malformed_item_dropped(spark):
    b = bronze_of(spark, ['{"DOI": "a"}', "{bad json"])
    assert [r.doi for r in b.collect()] == ["a"]


@pytest.mark.parametrize("doi,expected", [(12, "12"), (0, None), (True, "true"), (False, None), ([], None)])
def test_normalize_doi_non_string(spark, doi, expected):
    assert one(spark, {"DOI": doi}, "doi") == expected


@pytest.mark.parametrize("title,expected", [([{"a": 1}], '{"a":1}'), ([True], "true"), ([1.5], "1.5")])
def test_first_from_list_nested_and_scalars(spark, title, expected):
    assert one(spark, {"DOI": "x", "title": title}, "title") == expected


def test_raw_author_rows_skip_non_objects(spark):
    from pubspark.operators.parse import parse_items
    from pubspark.plans.analytics import raw_author_rows
    from tests.helpers import raw_df

    items = [{"DOI": "D", "author": [{"given": "a", "affiliation": [{"name": "x"}]}, "just text", None, 3]}]
    got = [tuple(r) for r in raw_author_rows(parse_items(raw_df(spark, items))).collect()]
    assert got == [("D", "a", None, None, '[{"name":"x"}]')]
