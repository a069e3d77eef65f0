"""Record parsing: raw JSON items -> staged works -> bronze rows.

One narrow projection per layer; no shuffle. Works are independent, so the stage scales with
the number of input partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubspark import functions as PF
from pubspark.functions.json_fields import get
from pubspark.schemas import (
    BRONZE_COLUMNS,
    LIST_FIELDS,
    OBJECT_FIELDS,
    PUBLICATION_DATE_FIELDS,
    SYSTEM_DATE_FIELDS,
)

# Staged scalar columns taken as text: (staged column, raw key).
_TEXT_FIELDS = (
    ("publication_type", "type"), ("publisher", "publisher"), ("source", "source"),
    ("prefix", "prefix"), ("member", "member"), ("volume", "volume"), ("issue", "issue"),
    ("page", "page"), ("url", "URL"), ("language", "language"),
    ("article_number", "article-number"),
)
_COUNT_FIELDS = (
    ("reference_count", "reference-count"), ("references_count", "references-count"),
    ("is_referenced_by_count", "is-referenced-by-count"),
)


def parse_items(raw: DataFrame, text_col: str = "raw_item", keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw item text -> ``item`` VARIANT column (NULL for text that is not JSON) plus
    ``record_hash`` (64-bit hash of the exact item text, used to tell record versions apart).
    There is no filter here: pushed below the projection it would parse every record twice."""
    return raw.select(F.try_parse_json(F.col(text_col)).alias("item"),
                      F.xxhash64(F.col(text_col)).alias("record_hash"), *[F.col(c) for c in keep])


def _staged_columns(item: Column) -> list[Column]:
    cols: list[Column] = [
        PF.normalize_doi(get(item, "DOI")).alias("doi"),
        PF.first_from_list(item, "title").alias("title"),
        PF.clean_abstract(get(item, "abstract")).alias("abstract"),
    ]
    text = dict(_TEXT_FIELDS)
    for name in ("publication_type", "publisher", "source", "prefix", "member"):
        cols.append(PF.json_text(item, text[name]).alias(name))
    cols += [
        get(item, "score", as_type="double").alias("score"),
        PF.first_from_list(item, "container-title").alias("container_title"),
        PF.first_from_list(item, "short-container-title").alias("short_container_title"),
    ]
    for key, stem in PUBLICATION_DATE_FIELDS:
        parsed = PF.date_parts(item, key)
        cols += [parsed["date"].alias(stem), parsed["precision"].alias(f"{stem}_precision")]
    for key, stem in SYSTEM_DATE_FIELDS:
        cols += [PF.date_parts(item, key)["date"].alias(f"{stem}_date"),
                 PF.date_time(item, key).alias(f"{stem}_datetime")]
    for name, key in _COUNT_FIELDS:
        cols.append(PF.try_long_rounded(get(item, key)).alias(name))
    for name in ("volume", "issue", "page", "url"):
        cols.append(PF.json_text(item, text[name]).alias(name))
    cols.append(PF.resource_url(item).alias("resource_url"))
    for key, name in LIST_FIELDS:
        v = get(item, key)
        cols.append(F.coalesce(v, F.parse_json(F.lit("[]"))).alias(name))
    for name in ("language", "article_number"):
        cols.append(PF.json_text(item, text[name]).alias(name))
    for key, name in OBJECT_FIELDS:
        cols.append(get(item, key).alias(name))
    return cols


def parse_works(items: DataFrame, item_col: str = "item", keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten each raw work (VARIANT) into the staged record.

    Scalars become typed columns; list/object fields stay VARIANT (lists default to ``[]``
    when absent, a present JSON null stays a variant null); unmodelled keys go to
    ``extra_metadata_json``.
    """
    # One projection. The extra-metadata filter is a lambda (higher-order) function that Spark
    # evaluates outside whole-stage code generation; isolating it in its own projection was
    # measured slower (the whole item is then materialised as a map between the two), so the
    # record parse stays a single expression-codegen projection.
    item = F.col(item_col)
    return items.select(*_staged_columns(item), PF.extra_metadata_json(item).alias("extra_metadata_json"),
                        *[F.col(c) for c in keep])


_NESTED_TO_BRONZE = tuple((name, f"{name}_json") for _, name in LIST_FIELDS) + tuple(
    (name, f"{name}_json") for _, name in OBJECT_FIELDS)


#: Staged lists that silver takes apart; bronze may keep them as VARIANT beside their text.
NESTED_LISTS = ("authors", "issn_type", "isbn_type", "alternative_ids")


def to_bronze(staged: DataFrame, keep: tuple[str, ...] = (), nested: tuple[str, ...] = ()) -> DataFrame:
    """Staged works -> bronze: nested values as JSON text (JSON null -> SQL NULL), 46 columns; the
    ``nested`` ones also as VARIANT under their staged names, to be read without another parse."""
    variants = [F.when(~F.is_variant_null(n), F.col(n)).alias(n) for n in nested]
    nested = dict(_NESTED_TO_BRONZE)
    renamed = {v: k for k, v in nested.items()}
    out = []
    for c in BRONZE_COLUMNS:
        if c in renamed:
            v = F.col(renamed[c])
            out.append(F.when(v.isNotNull() & ~F.is_variant_null(v), F.to_json(v)).alias(c))
        else:
            out.append(F.col(c))
    return staged.select(*out, *[F.col(k) for k in keep], *variants)


def bronze_with_status(raw: DataFrame, text_col: str = "raw_item", keep: tuple[str, ...] = (),
                       nested: tuple[str, ...] = ()) -> DataFrame:
    """Raw item text -> bronze in one narrow stage that parses each record once. Every input row
    gives a row; ``parse_ok`` tells whether its text was JSON, and ``bad_item`` keeps the text
    that was not (the quarantine)."""
    keep = (*keep, "record_hash")
    items = parse_items(raw, text_col, (*keep[:-1], text_col))
    ok = F.col("item").isNotNull()
    marked = items.select("item", *keep, ok.alias("parse_ok"), F.when(~ok, F.col(text_col)).alias("bad_item"))
    keep = (*keep, "parse_ok", "bad_item")
    return to_bronze(parse_works(marked, keep=keep), keep=keep, nested=nested)


def bronze_from_raw(raw: DataFrame, text_col: str = "raw_item", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze rows of the items that parse; over a written table of :func:`bronze_with_status`
    the same choice is a pushed-down filter and the parse runs once."""
    return bronze_with_status(raw, text_col, keep).where("parse_ok").drop("parse_ok", "bad_item")
