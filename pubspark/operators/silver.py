"""Silver tables built from bronze: publications, authors, identifiers, quality issues.

Shuffle budget: publications need one exchange on ``doi`` (top-1 per DOI, reduced map-side by
``WindowGroupLimit`` so a DOI repeated across many runs does not pile up in one task);
authors and identifiers are narrow (explode); quality issues need one aggregate on ``doi``
for the name-only-author rule, with partial aggregation before the exchange.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubspark import functions as PF
from pubspark.schemas import (
    IDENT_ALT,
    IDENT_ISBN,
    IDENT_ISSN,
    ISSUE_FUTURE_DATE,
    ISSUE_MISSING_AUTHORS,
    ISSUE_MISSING_DOI,
    ISSUE_MISSING_TITLE,
    ISSUE_NAME_ONLY,
    REQUIRED_PUBLICATION_COLUMNS,
    STATUS_MISSING,
    STATUS_NAME_ONLY,
    STATUS_PARSED,
)

_DATE_STEMS = ("published_date", "published_print_date", "published_online_date", "issued_date")
_TS_COLS = ("created_datetime", "deposited_datetime", "indexed_datetime")
#: Columns by which the newest version of a DOI is chosen.
VERSION_COLUMNS = ("doi", "deposited_datetime", "indexed_datetime")
_INT_COLS = ("reference_count", "references_count", "is_referenced_by_count")


def as_of_date(as_of: str | _dt.date | Column | None) -> Column:
    """The reference date for 'future' checks; defaults to the current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def _typed_publication_columns(columns: tuple[str, ...] | None = None) -> list[Column]:
    out = []
    for c in REQUIRED_PUBLICATION_COLUMNS:
        if columns is not None and c not in VERSION_COLUMNS and c not in columns:
            continue
        if c in _DATE_STEMS:
            out.append(PF.try_date(F.col(c)).alias(c))
        elif c in _TS_COLS:
            out.append(PF.try_timestamp(F.col(c)).alias(c))
        elif c in _INT_COLS:
            out.append(PF.try_int(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return out


def silver_publications(bronze: DataFrame, by: tuple[str, ...] = (), columns: tuple[str, ...] | None = None) -> DataFrame:
    """One row per non-NULL DOI (per ``by`` group, e.g. run): the most recently deposited (then
    indexed) version, typed.

    Ties on both timestamps are broken by the record content hash (``record_hash`` when bronze
    carries it) and then by the row's own values, so that rows still tied are equal and reruns
    pick the same one.

    ``columns`` are the publication columns wanted beside those that choose a version (all by
    default): bronze need not hold the others, and they are neither shuffled nor sorted.
    """
    return newest_versions(typed_versions(bronze, by, columns), "_tiebreak", by).drop("_tiebreak")


def typed_versions(bronze: DataFrame, by: tuple[str, ...] = (), columns: tuple[str, ...] | None = None) -> DataFrame:
    """Typed publication columns (all, or ``columns``) of every record with a DOI, and ``_tiebreak``."""
    tiebreak = (F.col("record_hash") if "record_hash" in bronze.columns
                else F.xxhash64(*[F.col(c) for c in bronze.columns]))
    return bronze.where(F.col("doi").isNotNull()).select(
        *_typed_publication_columns(columns), tiebreak.alias("_tiebreak"), *by)


def newest_versions(typed: DataFrame, tiebreak: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The newest of the typed versions of each DOI (per ``by`` group)."""
    rest = [c for c in typed.columns if c not in {"doi", "deposited_datetime", "indexed_datetime", tiebreak, *by}]
    w = Window.partitionBy(*by, "doi").orderBy(
        *[F.col(c).desc_nulls_last() for c in ("deposited_datetime", "indexed_datetime", tiebreak, *rest)])
    return typed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _author_fields(author: Column) -> dict[str, Column]:
    def s(key: str) -> Column:
        return F.try_variant_get(author, f"$['{key}']", "string")

    given, family, name = s("given"), s("family"), s("name")
    status = (F.when(given.isNotNull() | family.isNotNull(), F.lit(STATUS_PARSED))
              .when(name.isNotNull(), F.lit(STATUS_NAME_ONLY))
              .otherwise(F.lit(STATUS_MISSING)))
    return {
        "given_name": given,
        "family_name": family,
        "raw_author_name": name,
        "orcid": PF.strip_orcid(s("ORCID")),
        "sequence": s("sequence"),
        # JSON null -> text 'null', absent -> NULL (to_json of a variant null is 'null').
        "affiliations_json": F.to_json(F.try_variant_get(author, "$['affiliation']", "variant")),
        "author_parse_status": status,
    }


def nested_list(bronze: DataFrame, name: str) -> Column:
    """A nested list of bronze as an array of VARIANT: from its VARIANT column where bronze has one,
    else parsed from its JSON text."""
    if name in bronze.columns:
        return F.try_variant_get(F.col(name), "$", "array<variant>")
    return PF.json_array_elements(F.col(f"{name}_json"))


def exploded_authors(bronze: DataFrame, keep: tuple[str, ...] = ("doi",)) -> DataFrame:
    """One row per element of ``authors_json`` (inner: empty/NULL/malformed lists give no rows)."""
    return bronze.select(
        *[F.col(c) for c in keep],
        F.explode(nested_list(bronze, "authors")).alias("_author"),
    )


def silver_authors(bronze: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Publication-author rows (from bronze before DOI de-duplication, non-NULL DOI only)."""
    ex = exploded_authors(bronze.where(F.col("doi").isNotNull()), keep=("doi", *by))
    fields = _author_fields(F.col("_author"))
    return ex.select("doi", *[v.alias(k) for k, v in fields.items()], *by)


def silver_identifiers(bronze: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """ISSN, ISBN and alternative ids as one long table, 1-based position per list.

    One scan: the three lists become an array of (type, list, typed) structs, exploded once,
    then each list is pos-exploded. NULL/blank values are dropped; NULL DOIs are kept.
    """
    lists = F.array(*[
        F.struct(F.lit(t).alias("t"), nested_list(bronze, name).alias("j"), F.lit(typed).alias("typed"))
        for t, name, typed in ((IDENT_ISSN, "issn_type", True), (IDENT_ISBN, "isbn_type", True),
                               (IDENT_ALT, "alternative_ids", False))])
    per_list = bronze.select("doi", *by, F.inline(lists))
    elems = per_list.select("doi", *by, "t", "typed", F.posexplode("j").alias("pos", "e"))
    value = F.when(F.col("typed"), F.try_variant_get("e", "$.value", "string")).otherwise(
        F.try_variant_get("e", "$", "string"))
    subtype = F.when(F.col("typed"), F.try_variant_get("e", "$.type", "string"))
    out = elems.select(
        "doi",
        F.col("t").alias("identifier_type"),
        value.alias("identifier_value"),
        subtype.alias("identifier_subtype"),
        (F.col("pos") + 1).cast("int").alias("identifier_position"),
        *by,
    )
    return out.where(F.col("identifier_value").isNotNull() & (F.trim("identifier_value") != ""))


def _issue(cond: Column, issue: tuple[str, str]) -> Column:
    return F.when(cond, F.struct(F.lit(issue[0]).alias("issue_type"),
                                 F.lit(issue[1]).alias("issue_description")))


def record_issues(bronze: DataFrame, as_of=None, by: tuple[str, ...] = ()) -> DataFrame:
    """Per-record rules (missing title/authors/DOI, future published date) in a single scan."""
    rules = F.array(
        _issue(F.col("title").isNull(), ISSUE_MISSING_TITLE),
        _issue(F.col("authors_json").isNull() | (F.col("authors_json") == "[]"), ISSUE_MISSING_AUTHORS),
        _issue(PF.try_date(F.col("published_date")) > as_of_date(as_of), ISSUE_FUTURE_DATE),
        _issue(F.col("doi").isNull(), ISSUE_MISSING_DOI),
    )
    hits = bronze.select("doi", *by, F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("i"))
    return hits.select("doi", "i.issue_type", "i.issue_description",
                       F.lit(1).cast("bigint").alias("affected_row_count"), *by)


def name_only_author_issues(bronze: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per DOI (NULL DOI is a group), the number of authors with a name but no given/family."""
    ex = exploded_authors(bronze, keep=("doi", *by))
    a = F.col("_author")
    cond = (F.try_variant_get(a, "$.name", "string").isNotNull()
            & F.try_variant_get(a, "$.given", "string").isNull()
            & F.try_variant_get(a, "$.family", "string").isNull())
    return (ex.where(cond).groupBy(*by, "doi").agg(F.count(F.lit(1)).alias("affected_row_count"))
            .select("doi", F.lit(ISSUE_NAME_ONLY[0]).alias("issue_type"),
                    F.lit(ISSUE_NAME_ONLY[1]).alias("issue_description"), "affected_row_count", *by))


def name_only_issues_of_authors(authors: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """:func:`name_only_author_issues` of the publications in a silver authors table, which has
    parsed the authors already (it holds no rows with NULL DOI)."""
    named = authors.where(F.col("author_parse_status") == STATUS_NAME_ONLY)
    return (named.groupBy(*by, "doi").agg(F.count(F.lit(1)).alias("affected_row_count"))
            .select("doi", F.lit(ISSUE_NAME_ONLY[0]).alias("issue_type"),
                    F.lit(ISSUE_NAME_ONLY[1]).alias("issue_description"), "affected_row_count", *by))


def silver_quality_issues(bronze: DataFrame, as_of=None, by: tuple[str, ...] = (),
                          authors: DataFrame | None = None) -> DataFrame:
    """All quality issues: two scans of bronze instead of one per rule. With a written ``authors``
    table only the authors of records without a DOI are parsed again."""
    if authors is None:
        names = name_only_author_issues(bronze, by)
    else:
        names = name_only_issues_of_authors(authors, by).unionByName(
            name_only_author_issues(bronze.where(F.col("doi").isNull()), by))
    return record_issues(bronze, as_of, by).unionByName(names)


def build_silver(bronze: DataFrame, as_of=None, by: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The four silver tables. ``by`` (e.g. ``("run",)``) keeps groups apart: de-duplication
    and per-DOI counts are computed within each group, so many runs are built in one pass."""
    return {
        "publications": silver_publications(bronze, by),
        "publication_authors": silver_authors(bronze, by),
        "identifiers": silver_identifiers(bronze, by),
        "quality_issues": silver_quality_issues(bronze, as_of, by),
    }
