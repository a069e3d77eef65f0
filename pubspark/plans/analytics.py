"""Analytic queries over the silver tables (and raw items for exploration queries).

The three report queries are parameterised Spark SQL files (``{name}`` placeholders bound to
DataFrames by ``spark.sql(text, **frames)``); the notebook-style questions are DataFrame plans.
Top-k reports end in ``orderBy(...).limit(k)``, which Spark plans as a per-partition
``TakeOrderedAndProject``: only k rows per partition reach the final merge.
"""

from __future__ import annotations

import os
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubspark.functions.json_fields import get

SQL_DIR = "sql"
REPORTS = {
    "author_publication_stats": ("authors",),
    "publisher_type_summary": ("publications",),
    "quality_issue_summary": ("quality_issues",),
}


def sql_text(name: str) -> str:
    return resources.files("pubspark.plans").joinpath(SQL_DIR, f"{name}.sql").read_text()


def run_sql_file(spark: SparkSession, path_or_name: str, **frames: DataFrame) -> DataFrame:
    """Run a parameterised SQL file; each ``{param}`` is bound to a DataFrame of ``frames``."""
    text = (open(path_or_name).read() if os.path.exists(path_or_name) else sql_text(path_or_name))
    lines = [ln for ln in text.splitlines() if not ln.lstrip().startswith("--")]
    return spark.sql("\n".join(lines).strip().rstrip(";"), **frames)


# Q1
def author_publication_stats(spark: SparkSession, authors: DataFrame) -> DataFrame:
    return run_sql_file(spark, "author_publication_stats", authors=authors)


# Q2
def publisher_type_summary(spark: SparkSession, publications: DataFrame) -> DataFrame:
    return run_sql_file(spark, "publisher_type_summary", publications=publications)


# Q3
def quality_issue_summary(spark: SparkSession, quality_issues: DataFrame) -> DataFrame:
    return run_sql_file(spark, "quality_issue_summary", quality_issues=quality_issues)


# Q4
def publication_type_distribution(publications: DataFrame) -> DataFrame:
    return (publications.groupBy("publication_type").agg(F.count(F.lit(1)).alias("publication_count"))
            .orderBy(F.col("publication_count").desc(), F.col("publication_type").asc_nulls_last()))


# Q5
def top_publishers(publications: DataFrame, k: int = 20) -> DataFrame:
    return (publications.groupBy("publisher").agg(F.count(F.lit(1)).alias("len"))
            .orderBy(F.col("len").desc(), F.col("publisher").asc_nulls_last()).limit(k))


_DATE_COMBO = ("published_date", "issued_date", "published_print_date", "published_online_date")


# Q6
def date_combination_distribution(publications: DataFrame) -> DataFrame:
    return (publications.groupBy(*_DATE_COMBO).agg(F.count(F.lit(1)).alias("len"))
            .orderBy(F.col("len").desc(), *[F.col(c).asc_nulls_last() for c in _DATE_COMBO]))


# Q7
def issued_published_differences(publications: DataFrame) -> DataFrame:
    p, i = F.col("published_date"), F.col("issued_date")
    return publications.where(p.isNotNull() & i.isNotNull() & (p != i)).select(
        "doi", "title", "published_date", "issued_date", "published_print_date",
        "published_online_date")


# Rows that one step of :func:`repeated` makes of a row at most.
REPEAT_CHUNK = 1 << 20


def repeated(df: DataFrame, times: str, spread: tuple[str, ...], chunk: int = REPEAT_CHUNK) -> DataFrame:
    """Each row as often as its column ``times`` says (dropped). Large numbers are first cut into chunks,
    which are dealt out by ``spread`` and their number, and then each becomes rows: no array is longer
    than ``chunk`` up to ``chunk`` squared repetitions, and a single row's repetitions are made by many tasks."""
    n, at = F.col(times), F.col("_chunk")
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / chunk))))
    rows = chunks.repartition(*spread, "_chunk").withColumn("_last", F.least(F.lit(chunk), n - at * chunk))
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), "_last"))).drop(
        "_i", "_last", "_chunk", times)


# Q8 (J3): inner join of issue DOIs back to publications; duplicate issue rows repeat matches.
# Issues are counted per DOI before the join, so a DOI that very many records share (a blank one)
# is one row there, and its match is repeated afterwards.
def future_dated_publications(publications: DataFrame, quality_issues: DataFrame) -> DataFrame:
    dois = (quality_issues.where(F.col("issue_type") == "future_published_date").groupBy("doi")
            .agg(F.count(F.lit(1)).alias("_n")))
    matched = publications.join(dois, on="doi", how="inner").select(
        "doi", "title", "published_date", "published_print_date", "published_online_date", "issued_date", "_n")
    return repeated(matched, "_n", ("doi",))


# Q9
def multi_valued_field_examples(items: DataFrame, field: str = "original-title",
                                limit: int | None = 5) -> DataFrame:
    """Raw values of ``field`` that are lists with more than one element (as JSON text)."""
    arr = get(F.col("item"), field, as_type="array<variant>")
    out = items.where(F.size(arr) > 1).select(F.to_json(get(F.col("item"), field)).alias(field))
    return out.limit(limit) if limit else out


# Q10
def quality_issue_rows_per_type(quality_issues: DataFrame) -> DataFrame:
    return (quality_issues.groupBy("issue_type").agg(F.count(F.lit(1)).alias("len"))
            .orderBy(F.col("len").desc(), "issue_type"))


# Q11
def raw_author_rows(items: DataFrame) -> DataFrame:
    """Authors straight from raw items: DOI as given, given/family/ORCID, affiliation JSON.
    Elements that are not objects are skipped."""
    authors = items.select(
        get(F.col("item"), "DOI", as_type="string").alias("doi"),
        F.explode(get(F.col("item"), "author", as_type="array<variant>")).alias("a"))
    is_obj = F.schema_of_variant(F.col("a")).startswith("OBJECT")
    return authors.where(is_obj).select(
        "doi",
        F.try_variant_get("a", "$.given", "string").alias("given"),
        F.try_variant_get("a", "$.family", "string").alias("family"),
        F.try_variant_get("a", "$.ORCID", "string").alias("orcid"),
        F.to_json(F.try_variant_get("a", "$.affiliation", "variant")).alias("affiliation"),
    )
