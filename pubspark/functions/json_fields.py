"""Field extraction from open-schema JSON work items held in VARIANT columns.

Each function returns a Spark Column expression; the whole record parse therefore runs inside
whole-stage generated code on the executors, one pass per record.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pubspark.schemas import KNOWN_FIELDS, ORCID_PREFIXES

# Python's str.strip()/re '\s' treat U+001C..U+001F as whitespace too; Java's Unicode '\s'
# does not, so the class is widened by hand.
_PY_SPACE = r"[\s\x{1c}-\x{1f}]"
_STRIP_RE = rf"(?U)^{_PY_SPACE}+|{_PY_SPACE}+$"
_COLLAPSE_RE = rf"(?U){_PY_SPACE}+"
_TAG_RE = r"<[^>]+>"


def path(*keys: str | int) -> str:
    """Variant path for nested keys, bracket-quoted so keys may contain '-'."""
    parts = ["$"]
    for k in keys:
        parts.append(f"[{k}]" if isinstance(k, int) else f"['{k}']")
    return "".join(parts)


def get(item: Column, *keys: str | int, as_type: str | None = None) -> Column:
    """Value at ``keys`` as ``as_type`` (VARIANT when None); NULL when absent or not castable."""
    return F.try_variant_get(item, path(*keys), as_type or "variant")


def json_text(item: Column, *keys: str | int) -> Column:
    """Scalar as text: strings as is, numbers/booleans as their JSON text, nested as JSON."""
    return get(item, *keys, as_type="string")


def py_strip(s: Column) -> Column:
    """Python-compatible str.strip() (Unicode whitespace)."""
    return F.regexp_replace(s, _STRIP_RE, "")


def normalize_doi(value: Column) -> Column:
    """DOI normalization: falsy values -> NULL, otherwise stripped and lower-cased text.

    ``value`` is the DOI as VARIANT. A blank string is not falsy, so it becomes '' (not NULL).
    """
    txt = F.try_variant_get(value, "$", "string")
    falsy = txt.isNull() | (txt == "") | F.to_json(value).isin("0", "0.0", "false", "[]", "{}")
    return F.when(falsy, F.lit(None).cast("string")).otherwise(F.lower(py_strip(txt)))


def first_from_list(item: Column, key: str) -> Column:
    """First element of a list field as text; NULL for non-lists, empty lists, null elements."""
    return get(item, key, 0, as_type="string")


def date_parts(item: Column, key: str) -> Column:
    """``{"date-parts": [[y, m?, d?]]}`` -> struct(text 'YYYY-MM-DD', precision).

    Missing month/day default to 1; precision is year/month/day by the number of parts. If any
    present part is not integer-convertible (or the shape is wrong) both fields are NULL.
    Parts convert like Python ``int()``: numbers truncate, numeric strings parse, booleans are 0/1.
    """
    # One path for all parts: those that do not convert, also a JSON null, are NULL elements, absent ones
    # are beyond the list's size. A path into something that is no list finds nothing.
    parts = get(item, key, "date-parts", 0, as_type="array<bigint>")
    n = F.size(parts)
    one = F.lit(1).cast("bigint")
    year = F.get(parts, F.lit(0))
    month = F.when(n > 1, F.get(parts, F.lit(1))).otherwise(one)
    day = F.when(n > 2, F.get(parts, F.lit(2))).otherwise(one)
    ok = year.isNotNull() & month.isNotNull() & day.isNotNull()
    # The formatter is slow and rarely needed: plain parts are put together as text.
    plain = year.between(1000, 9999) & month.between(0, 99) & day.between(0, 99)
    text = F.when(plain, F.concat(year.cast("string"), F.lit("-"), _two_digits(month), F.lit("-"), _two_digits(day))).when(
        ok, F.format_string("%04d-%02d-%02d", year, month, day))
    precision = F.when(ok, F.when(n > 2, "day").when(n > 1, "month").otherwise("year"))
    return F.struct(text.alias("date"), precision.alias("precision"))


def _two_digits(n: Column) -> Column:
    """Numbers from 0 to 99."""
    return F.lpad(n.cast("string"), 2, "0")


def date_time(item: Column, key: str) -> Column:
    """``date-time`` text of a date object (NULL if the field is not an object)."""
    return json_text(item, key, "date-time")


def resource_url(item: Column) -> Column:
    """``resource.primary.URL``; NULL unless both levels are objects."""
    return json_text(item, "resource", "primary", "URL")


def clean_abstract(value: Column) -> Column:
    """Abstract text without markup tags, whitespace collapsed and stripped; empty -> NULL."""
    txt = F.try_variant_get(value, "$", "string")
    falsy = txt.isNull() | (txt == "") | F.to_json(value).isin("0", "0.0", "false", "[]", "{}")
    no_tags = F.regexp_replace(txt, _TAG_RE, " ")
    collapsed = py_strip(F.regexp_replace(no_tags, _COLLAPSE_RE, " "))
    return F.when(falsy, F.lit(None).cast("string")).otherwise(F.nullif(collapsed, F.lit("")))


def item_as_map(item: Column) -> Column:
    """A JSON object as ``map<string, variant>`` (NULL for non-objects)."""
    return F.try_variant_get(item, "$", "map<string,variant>")


def extra_metadata_from_map(as_map: Column, known: tuple[str, ...] = KNOWN_FIELDS) -> Column:
    """JSON object text of the entries whose key is not modelled as a column."""
    return F.when(as_map.isNotNull(), F.to_json(F.map_filter(as_map, lambda k, v: ~k.isin(*known))))


def extra_metadata_json(item: Column, known: tuple[str, ...] = KNOWN_FIELDS) -> Column:
    """JSON object text of every key that is not modelled as a column."""
    return extra_metadata_from_map(item_as_map(item), known)


def json_array_elements(json_col: Column) -> Column:
    """Elements of a JSON array held as text, as ``array<variant>``.

    NULL, JSON null, non-arrays and malformed text give NULL, i.e. no rows when exploded.
    """
    return F.try_variant_get(F.try_parse_json(json_col), "$", "array<variant>")


def strip_orcid(orcid: Column) -> Column:
    """Remove the ORCID URL prefixes, one after the other."""
    out = orcid
    for prefix in ORCID_PREFIXES:
        out = F.replace(out, F.lit(prefix), F.lit(""))
    return out
