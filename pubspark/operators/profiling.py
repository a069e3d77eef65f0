"""Data profiling operators (exploration and QA questions) as distributed aggregates.

All of them are single-pass aggregates (partial aggregation map-side, then one small final
stage) or group-bys with map-side combine; none collects data to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubspark.functions.json_fields import get, py_strip
from pubspark.sources.layers import land


# A8
def duplicate_keys(df: DataFrame, key: str = "doi") -> DataFrame:
    """Keys that occur more than once (NULL keys skipped), with their row count."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1))


# A9
def conflicting_versions(df: DataFrame, key: str = "doi", version: str = "record_hash") -> DataFrame:
    """Keys with more than one distinct record version."""
    return (df.groupBy(key).agg(F.count_distinct(version).alias("version_count"))
            .where(F.col("version_count") > 1))


# A10 / A11: one-row coverage counts of named predicates.
def coverage(df: DataFrame, checks: dict[str, Column], total: str = "total") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(total),
                  *[F.count_if(cond).alias(name) for name, cond in checks.items()])


def date_consistency(publications: DataFrame) -> DataFrame:
    i, p = F.col("issued_date"), F.col("published_date")
    both = i.isNotNull() & p.isNotNull()
    return coverage(publications, {
        "both_dates_present": both,
        "both_dates_missing": i.isNull() & p.isNull(),
        "same_issued_and_published": both & (i == p),
        "different_issued_and_published": both & (i != p),
    }, total="total_publications")


def _value_bits(column: str, kind: str) -> tuple[Column, Column]:
    """Two 64-bit columns ``high, low`` that are equal for equal values and NULL for NULL."""
    c = F.col(column)
    exact = {"date": F.unix_date, "timestamp": F.unix_micros}
    if kind in ("tinyint", "smallint", "int", "bigint", "boolean") or kind in exact:
        low = exact.get(kind, lambda x: x)(c).cast("bigint")
        high = F.when(c.isNotNull(), F.lit(0).cast("bigint"))
    else:
        # a hash function of its own for each half: the second starts from another seed
        low = F.when(c.isNotNull(), F.xxhash64(c))
        high = F.when(c.isNotNull(), F.xxhash64(F.lit(1), c))
    return high.alias("high"), low.alias("low")


# A12
def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, NULL count, NULL percent (2 decimals), distinct values (NULL counts as
    a value). Exact distinct counts unpivot to (column, 128 bits of the value) rows that are
    de-duplicated with map-side combine: numbers, dates and timestamps are their own bits, other
    values of any length two 64-bit hashes. ``approx=True`` uses HyperLogLog sketches in a single
    pass instead."""
    cols = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    nulls = df.agg(F.count(F.lit(1)).alias("_height"),
                   *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    per_col = nulls.select("_height", F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 F.col(f"n{i}").alias("nulls")) for i, c in enumerate(cols)])))
    if approx:
        d = df.agg(*[(F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int")))
                     .alias(f"d{i}") for i, c in enumerate(cols)])
        distinct = d.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("position"), F.col(f"d{i}").cast("bigint").alias("unique_values"))
            for i in range(len(cols))])))
    else:
        pairs = df.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("position"), *_value_bits(c, types[c])) for i, c in enumerate(cols)])))
        distinct = (pairs.distinct()
                    .groupBy("position").agg(F.count(F.lit(1)).alias("unique_values")))
    out = per_col.join(distinct, "position", "left")
    return out.select(
        "column", "dtype", "nulls",
        # half to even on the shortest decimal form, as Python's round() does on exact ties
        F.bround(F.col("nulls") / F.col("_height") * 100, 2).alias("null_percent"),
        F.coalesce("unique_values", F.lit(0)).alias("unique_values"), "position",
    ).orderBy("position").drop("position")


# A13
def key_frequency(items: DataFrame, item_col: str = "item", field: str | None = None) -> DataFrame:
    """How many records carry each key; with ``field`` (a list of objects), over its elements."""
    obj = F.col(item_col)
    if field is not None:
        elems = items.select(F.explode(get(obj, field, as_type="array<variant>")).alias("_o"))
        obj, items = F.col("_o"), elems
    keys = items.select(F.explode(F.map_keys(F.try_variant_get(obj, "$", "map<string,variant>"))).alias("key"))
    return (keys.groupBy("key").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), "key"))


def json_type_name(v: Column) -> Column:
    """Python type name of a JSON value: list/str/dict/int/float/bool; absent and null -> NoneType."""
    s = F.schema_of_variant(v)
    return (F.when(v.isNull() | (s == "VOID"), "NoneType")
            .when(s.startswith("ARRAY"), "list").when(s.startswith("OBJECT"), "dict")
            .when(s == "STRING", "str").when(s == "BOOLEAN", "bool")
            .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
            .otherwise("float"))


# A14
def json_type_distribution(items: DataFrame, field: str) -> DataFrame:
    t = json_type_name(get(F.col("item"), field))
    return items.groupBy(t.alias("type_name")).agg(F.count(F.lit(1)).alias("count"))


# A13 / A14: every path of the items in one walk, level by level
def path_inventory(items: DataFrame, item_col: str = "item", fields: tuple[str, ...] | None = None) -> DataFrame:
    """``path, type_name, count, min_length, max_length`` of all values at all depths. A path names
    the keys down to the value, with ``[]`` for the elements of a list (``author[].given``); the
    lengths are those of lists, else NULL. The items themselves have the empty path; ``fields`` are the
    top-level keys to go into (all by default).

    A level is exploded from the nested values of the one above, which are landed, so every value
    is visited once and only lists and objects go on; the number of levels is the data's depth.
    """
    spark = items.sparkSession
    level = items.select(F.lit("").alias("path"), F.col(item_col).alias("value"))
    found = None
    while True:
        named = level.select("path", json_type_name(F.col("value")).alias("type_name"), "value")
        length = F.when(F.col("type_name") == "list", F.size(F.try_variant_get("value", "$", "array<variant>")))
        counts = land(named.groupBy("path", "type_name").agg(
            F.count(F.lit(1)).alias("count"), F.min(length).alias("min_length"), F.max(length).alias("max_length")), "paths")
        found = counts if found is None else found.unionByName(counts)
        if counts.where(F.col("type_name").isin("list", "dict")).isEmpty():
            return found
        nested = named.where(F.col("type_name").isin("list", "dict"))
        if fields is not None and found is counts:
            # Only the wanted fields are taken out of an item, and not every key of it first.
            wanted = F.array(*[F.struct(F.lit(f).alias("key"), get(F.col("value"), f).alias("inner_value"))
                               for f in dict.fromkeys(fields)])
            inner = nested.select("path", "type_name", F.inline(wanted)).where(F.col("inner_value").isNotNull())
        else:
            inner = nested.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).toDF("pos", "key", "inner_value"))
        path = (F.when(F.col("type_name") == "list", F.concat("path", F.lit("[]")))
                .when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key")))
        level = land(inner.select(path.alias("path"), F.col("inner_value").alias("value")), "values")


# A14
def field_types(items: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The types of several top-level fields from one pass: ``field, type_name, count``."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), json_type_name(get(F.col("item"), f)).alias("type_name"))
                      for f in fields])
    return items.select(F.inline(pairs)).groupBy("field", "type_name").agg(F.count(F.lit(1)).alias("count"))


# A15
def list_length_distribution(items: DataFrame, field: str) -> DataFrame:
    arr = get(F.col("item"), field, as_type="array<variant>")
    n = F.size(arr)
    return (items.where(arr.isNotNull()).groupBy(n.alias("length"))
            .agg(F.count(F.lit(1)).alias("count")))


# P8
def non_empty_lists(df: DataFrame, column: str) -> DataFrame:
    """Values of a JSON-list text column with at least one element."""
    return df.where(F.json_array_length(column) > 0).select(column)


# P12
def columns_missing_in(df: DataFrame, other: DataFrame) -> DataFrame:
    """Columns of ``df`` that ``other`` lacks, with their types and non-NULL rows."""
    missing = sorted(set(df.columns) - set(other.columns))
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(c).alias(c) for c in missing])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(c).alias("non_null_rows"))
        for c in missing])))


# A16
def missing_vs_empty(items: DataFrame, field: str) -> DataFrame:
    v = get(F.col("item"), field)
    arr = get(F.col("item"), field, as_type="array<variant>")
    empty = arr.isNotNull() & (F.size(arr) == 0)
    return items.agg(F.count_if(v.isNull()).alias("missing_count"),
                     F.count_if(empty).alias("empty_list_count"))


def _truthy(v: Column) -> Column:
    """Python truthiness of a JSON value (None, false, 0, '', [] and {} are falsy)."""
    js = F.to_json(v)
    return v.isNotNull() & ~F.is_variant_null(v) & ~js.isin("false", "0", "0.0", '""', "[]", "{}")


# A17
def with_without(items: DataFrame, field: str = "author") -> DataFrame:
    has = _truthy(get(F.col("item"), field))
    return items.agg(F.count_if(has).alias(f"with_{field}"),
                     F.count_if(~has).alias(f"without_{field}"))


# A18
def list_size_per_record(items: DataFrame, field: str = "author", k: int | None = 10) -> DataFrame:
    """doi, first title and the size of a list field per raw record; top-k by size."""
    item = F.col("item")
    arr = get(item, field, as_type="array<variant>")
    n = F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr))  # also right without ANSI mode
    out = items.select(get(item, "DOI", as_type="string").alias("doi"),
                       get(item, "title", 0, as_type="string").alias("title"),
                       n.alias(f"{field}_count"))
    if k:
        out = out.orderBy(F.col(f"{field}_count").desc(), F.col("doi").asc_nulls_last(),
                          F.col("title").asc_nulls_last()).limit(k)
    return out


# A19
def rows_per_key(df: DataFrame, key: str = "doi", name: str = "author_count",
                 k: int | None = None) -> DataFrame:
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    if k:
        out = out.orderBy(F.col(name).desc(), F.col(key).asc_nulls_last()).limit(k)
    return out


# J2
def publications_without_authors(publications: DataFrame, authors: DataFrame) -> DataFrame:
    """Publications whose DOI has no author row. The author side is reduced to distinct DOIs
    (map-side) first: a DOI with a huge share of author rows would otherwise sit, unsplittable,
    on the build side of the anti join."""
    return (publications.join(authors.select("doi").distinct(), on="doi", how="left_anti")
            .select("doi", "title", "publisher", "publication_type"))


# A20
def silver_summary(publications: DataFrame, authors: DataFrame, quality_issues: DataFrame) -> DataFrame:
    """One row: publications, authors, quality_issues, duplicate_dois, publications_without_authors."""
    p = publications.agg(F.count(F.lit(1)).alias("publications"))
    a = authors.agg(F.count(F.lit(1)).alias("authors"))
    q = quality_issues.agg(F.count(F.lit(1)).alias("quality_issues"))
    dup = (publications.groupBy("doi").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .agg(F.count(F.lit(1)).alias("duplicate_dois")))
    orphan = publications_without_authors(publications, authors).agg(
        F.count(F.lit(1)).alias("publications_without_authors"))
    return p.crossJoin(a).crossJoin(q).crossJoin(dup).crossJoin(orphan)


# R11
def doi_hygiene(items: DataFrame) -> DataFrame:
    """Per raw DOI string: outer-space and upper-case flags and the normalized form."""
    doi = get(F.col("item"), "DOI", as_type="string")
    base = items.select(doi.alias("original")).where(F.col("original").isNotNull())
    o = F.col("original")
    return base.select(
        "original",
        (o != py_strip(o)).alias("has_outer_spaces"),
        (o != F.lower(o)).alias("has_uppercase"),
        F.lower(py_strip(o)).alias("normalized"),
    )


def problematic_dois(hygiene: DataFrame) -> DataFrame:
    return hygiene.where(F.col("has_outer_spaces") | F.col("has_uppercase"))


def doi_hygiene_totals(hygiene: DataFrame) -> DataFrame:
    return hygiene.agg(F.count(F.lit(1)).alias("total_dois"),
                       F.count_if("has_uppercase").alias("uppercase_count"),
                       F.count_if("has_outer_spaces").alias("outer_space_count"))


# U2
def value_difference(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` in ``a`` that are not in ``b`` (set difference; NULL equals
    NULL as in EXCEPT). Both sides are de-duplicated map-side before the anti join, so a hot
    value costs one row per map task on either side."""
    left = a.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    right = b.select(F.col(column).alias("_v")).distinct()
    # ``_n > 0`` always holds; referencing the aggregate keeps the anti join above the left
    # de-duplication (otherwise the optimizer pushes the join below it).
    cond = left[column].eqNullSafe(right["_v"]) & (left["_n"] > 0)
    return left.join(right, cond, "left_anti").select(column)
