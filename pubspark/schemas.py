"""Column names, fixed field lists and layer schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# FIXED VALUES (must equal the behaviour being reproduced; do not edit)
# ---------------------------------------------------------------------------------------------

# Keys of a raw work item that are modelled as columns; every other key is kept in
# extra_metadata.
KNOWN_FIELDS = (
    "indexed", "reference-count", "references-count", "publisher", "content-domain", "DOI",
    "type", "created", "source", "is-referenced-by-count", "prefix", "member", "deposited",
    "score", "resource", "issued", "URL", "published", "published-print", "published-online",
    "container-title", "short-container-title", "title", "ISSN", "issn-type", "author",
    "volume", "issue", "page", "journal-issue", "link", "license", "abstract", "alternative-id",
    "ISBN", "isbn-type", "language", "article-number",
)

# ORCID URL prefixes removed from author identifiers, in the order they are removed.
ORCID_PREFIXES = ("https://orcid.org/", "http://orcid.org/")

# Author parse status labels.
STATUS_PARSED = "parsed_person_name"
STATUS_NAME_ONLY = "name_only_unparsed"
STATUS_MISSING = "missing_author_name"

# Quality issue types and their descriptions.
ISSUE_MISSING_TITLE = ("missing_title", "Publication has no title")
ISSUE_MISSING_AUTHORS = ("missing_authors", "Publication has no authors")
ISSUE_FUTURE_DATE = ("future_published_date", "Published date is later than current date")
ISSUE_MISSING_DOI = ("missing_doi", "Publication has no DOI")
ISSUE_NAME_ONLY = (
    "author_name_only_unparsed",
    "Author record has name field but no given/family fields; value is preserved but not used "
    "for author analytics as it may contain unmapped affiliation text",
)

# Identifier types.
IDENT_ISSN = "ISSN"
IDENT_ISBN = "ISBN"
IDENT_ALT = "alternative_id"

# Required columns per silver table (validation report schema checks).
REQUIRED_PUBLICATION_COLUMNS = (
    "doi", "title", "abstract", "publication_type", "publisher", "language", "article_number",
    "license_json", "extra_metadata_json", "source", "prefix", "member", "container_title",
    "short_container_title", "published_date", "published_date_precision",
    "published_print_date", "published_print_date_precision", "published_online_date",
    "published_online_date_precision", "issued_date", "issued_date_precision",
    "created_datetime", "deposited_datetime", "indexed_datetime", "reference_count",
    "references_count", "is_referenced_by_count", "volume", "issue", "page", "url",
    "resource_url",
)
REQUIRED_AUTHOR_COLUMNS = (
    "doi", "given_name", "family_name", "raw_author_name", "orcid", "sequence",
    "affiliations_json", "author_parse_status",
)
REQUIRED_IDENTIFIER_COLUMNS = (
    "doi", "identifier_type", "identifier_value", "identifier_subtype", "identifier_position",
)
REQUIRED_QUALITY_COLUMNS = ("doi", "issue_type", "issue_description", "affected_row_count")

# Validation check names and detail texts, in report order.
CHECKS = (
    ("schema_publications_required_columns",
     "silver_publications should contain required analytical columns"),
    ("schema_authors_required_columns",
     "silver_publication_authors should contain required author columns"),
    ("schema_identifiers_required_columns",
     "silver_publication_identifiers should contain required identifier columns"),
    ("schema_quality_required_columns",
     "silver_quality_issues should contain required quality columns"),
    ("unique_publication_doi", "silver_publications should have one row per DOI"),
    ("no_missing_publication_doi", "silver_publications should not contain missing DOI values"),
    ("authors_have_matching_publication",
     "Every author row should match a DOI in silver_publications"),
    ("identifiers_have_matching_publication",
     "Every identifier row should match a DOI in silver_publications"),
    ("freshness_max_indexed_datetime", "Latest indexed_datetime found in silver_publications"),
    ("quality_issue_count", "Number of quality issue records generated in silver_quality_issues"),
)

# Staging metadata source label, and the pattern of the layer prefix in raw file names
# (``<source>_raw_<run>.json``): the run id is the file stem after it.
SOURCE_LABEL = "metadata-api"
RAW_PREFIX_PATTERN = r"^(?:[A-Za-z0-9-]+_)?raw_"

# Date fields parsed from {"date-parts": [[y, m, d]]} objects: (raw key, column stem).
PUBLICATION_DATE_FIELDS = (
    ("published", "published_date"),
    ("published-print", "published_print_date"),
    ("published-online", "published_online_date"),
    ("issued", "issued_date"),
)
SYSTEM_DATE_FIELDS = (("created", "created"), ("deposited", "deposited"), ("indexed", "indexed"))

# List-valued raw keys that default to an empty list when absent: (raw key, staged column).
LIST_FIELDS = (
    ("ISSN", "issn"), ("issn-type", "issn_type"), ("alternative-id", "alternative_ids"),
    ("ISBN", "isbn"), ("isbn-type", "isbn_type"), ("author", "authors"),
    ("license", "license"), ("link", "links"),
)
# Object-valued raw keys kept as they are (NULL when absent).
OBJECT_FIELDS = (("content-domain", "content_domain"), ("journal-issue", "journal_issue"))

# Bronze column order (46 columns).
BRONZE_COLUMNS = (
    "doi", "title", "abstract", "publication_type", "publisher", "source", "prefix", "member",
    "score", "container_title", "short_container_title",
    "published_date", "published_print_date", "published_online_date", "issued_date",
    "published_date_precision", "published_print_date_precision",
    "published_online_date_precision", "issued_date_precision",
    "created_date", "created_datetime", "deposited_date", "deposited_datetime",
    "indexed_date", "indexed_datetime",
    "reference_count", "references_count", "is_referenced_by_count", "volume", "issue", "page",
    "url", "resource_url",
    "issn_json", "issn_type_json", "authors_json", "license_json", "links_json",
    "content_domain_json", "journal_issue_json", "alternative_ids_json", "isbn_json",
    "isbn_type_json", "language", "article_number", "extra_metadata_json",
)

# ---------------------------------------------------------------------------------------------
# Layer schemas (our own decisions: fixed types instead of per-run inference)
# ---------------------------------------------------------------------------------------------

_BRONZE_DOUBLE = {"score"}
_BRONZE_LONG = {"reference_count", "references_count", "is_referenced_by_count"}

BRONZE_SCHEMA = T.StructType([
    T.StructField(c, T.DoubleType() if c in _BRONZE_DOUBLE
                  else T.LongType() if c in _BRONZE_LONG else T.StringType(), True)
    for c in BRONZE_COLUMNS
])
