"""Column -> Column functions used by the layer builders (no Python UDFs)."""

from pubspark.functions.casts import try_date, try_int, try_long_rounded, try_timestamp
from pubspark.functions.json_fields import (
    clean_abstract,
    date_parts,
    date_time,
    extra_metadata_json,
    first_from_list,
    json_array_elements,
    json_text,
    normalize_doi,
    py_strip,
    resource_url,
    strip_orcid,
)

__all__ = [
    "clean_abstract", "date_parts", "date_time", "extra_metadata_json", "first_from_list",
    "json_array_elements", "json_text", "normalize_doi",
    "py_strip", "resource_url", "strip_orcid", "try_date", "try_int", "try_long_rounded",
    "try_timestamp",
]
