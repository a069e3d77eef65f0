"""Independent DuckDB formulations of the registered queries.

Each statement computes the expected answer straight from the warehouse tables (pre-registered
views ``orders``, ``lineitem``, ``events``, ...), without JSON: the item derivation rules of
:mod:`pubspark.sources.warehouse` are restated as plain column arithmetic, and the pipeline's
semantics (normalisation, date-parts, casts, de-duplication, explode, rules) as ordinary SQL.

Key-arithmetic conditions (``o_orderkey % 23 = 0`` ...) restate the rules by which the item
builders dirty individual fields; they never sample rows. Every statement, like every Spark
query, covers the whole tables.
"""

from __future__ import annotations

from pubspark.schemas import BRONZE_COLUMNS, REQUIRED_PUBLICATION_COLUMNS

# --- per-order facts (one row per order) -------------------------------------------------------
_WORKS = """
lines AS (
    SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey
),
base AS (
    SELECT o.*, l.n_lines,
           o_orderkey // 2 AS pair,
           CAST(o_orderdate AS DATE) AS od,
           CAST(o_orderdate AS DATE) + 1 AS nd,
           year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d
    FROM orders o LEFT JOIN lines l ON l.l_orderkey = o.o_orderkey
),
works AS (
    SELECT
        o_orderkey, o_custkey, o_orderstatus, n_lines,
        CASE WHEN o_orderkey % 23 = 0 OR o_orderkey % 41 = 0 THEN NULL
             WHEN o_orderkey % 43 = 0 THEN ''
             ELSE '10.' || CAST(5000 + pair % 40 AS VARCHAR) || '/ord.' || CAST(pair AS VARCHAR) END AS doi,
        CASE WHEN o_orderkey % 23 = 0 THEN NULL
             WHEN o_orderkey % 41 = 0 THEN ''
             WHEN o_orderkey % 43 = 0 THEN '  '
             ELSE ' 10.' || CAST(5000 + pair % 40 AS VARCHAR) || '/ORD.' || CAST(pair AS VARCHAR) || ' ' END AS raw_doi,
        CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 19 = 0 THEN NULL
             ELSE 'Order ' || CAST(o_orderkey AS VARCHAR) || ' priority ' || o_orderpriority END AS title,
        CASE WHEN o_orderkey % 4 = 0 THEN 'Order of ' || o_orderpriority || ' priority' END AS abstract,
        CASE o_orderstatus WHEN 'F' THEN 'journal-article' WHEN 'O' THEN 'book-chapter'
             ELSE 'proceedings-article' END AS publication_type,
        CASE WHEN o_custkey % 31 = 0 THEN NULL
             ELSE 'Publisher ' || CAST(o_custkey % 30 AS VARCHAR) END AS publisher,
        'metadata-api' AS source,
        '10.' || CAST(5000 + pair % 40 AS VARCHAR) AS prefix,
        CAST(o_custkey % 100 AS VARCHAR) AS member,
        o_totalprice / 1000 AS score,
        'Journal ' || CAST(o_custkey % 25 AS VARCHAR) AS container_title,
        CASE WHEN o_orderkey % 2 = 0 THEN 'J' || CAST(o_custkey % 25 AS VARCHAR) END AS short_container_title,
        CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 37 = 0 THEN NULL
             WHEN o_orderkey % 47 = 0 THEN printf('%04d-%02d-01', y, m)
             WHEN o_orderkey % 31 = 0 THEN printf('%04d-13-%02d', y, d)
             WHEN o_orderkey % 29 = 0 THEN printf('%04d-%02d-%02d', y + 40, m, d)
             WHEN o_orderkey % 4 = 0 THEN printf('%04d-01-01', y)
             WHEN o_orderkey % 4 = 1 THEN printf('%04d-%02d-01', y, m)
             ELSE printf('%04d-%02d-%02d', y, m, d) END AS published_text,
        CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 37 = 0 THEN NULL
             WHEN o_orderkey % 47 = 0 THEN 'month'
             WHEN o_orderkey % 31 = 0 OR o_orderkey % 29 = 0 THEN 'day'
             WHEN o_orderkey % 4 = 0 THEN 'year'
             WHEN o_orderkey % 4 = 1 THEN 'month'
             ELSE 'day' END AS published_date_precision,
        CASE WHEN o_orderkey % 3 = 0 THEN printf('%04d-%02d-01', y, m) END AS published_print_text,
        CASE WHEN o_orderkey % 3 = 0 THEN 'month' END AS published_print_date_precision,
        CASE WHEN o_orderkey % 5 = 0 THEN strftime(nd, '%Y-%m-%d') END AS published_online_text,
        CASE WHEN o_orderkey % 5 = 0 THEN 'day' END AS published_online_date_precision,
        strftime(CASE WHEN o_orderkey % 6 = 0 THEN nd ELSE od END, '%Y-%m-%d') AS issued_text,
        'day' AS issued_date_precision,
        strftime(od, '%Y-%m-%d') AS created_date,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_datetime_text,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE printf('%04d-01-01', y) END AS deposited_date,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE printf('%04d-01-01T00:00:00Z', y) END AS deposited_datetime_text,
        strftime(o_orderdate + to_seconds(o_orderkey), '%Y-%m-%d') AS indexed_date,
        strftime(o_orderdate + to_seconds(o_orderkey), '%Y-%m-%dT%H:%M:%SZ') AS indexed_datetime_text,
        o_orderdate AS created_ts,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE make_timestamp(y, 1, 1, 0, 0, 0) END AS deposited_ts,
        o_orderdate + to_seconds(o_orderkey) AS indexed_ts,
        n_lines AS reference_count,
        CASE WHEN o_orderkey % 3 = 0 THEN n_lines END AS references_count,
        CASE WHEN o_orderkey % 7 = 0 THEN CAST(round_even(o_totalprice / 1000, 0) AS BIGINT)
             ELSE CAST(floor(o_totalprice) AS BIGINT) % 500 END AS is_referenced_by_count,
        CAST(y - 1990 AS VARCHAR) AS volume,
        CAST(m AS VARCHAR) AS issue,
        CAST(d AS VARCHAR) || '-' || CAST(d + 9 AS VARCHAR) AS page,
        'https://doi.org/10.' || CAST(5000 + pair % 40 AS VARCHAR) || '/ord.' || CAST(pair AS VARCHAR) AS url,
        CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'https://example.org/ord/' || CAST(o_orderkey AS VARCHAR) END AS resource_url,
        printf('%04d-%04d', o_custkey % 10000, o_orderkey % 10000) AS issn1,
        CASE WHEN o_orderkey % 17 = 0 THEN ' '
             ELSE printf('%04d-%04d', o_orderkey % 10000, o_custkey % 10000) END AS issn2,
        CASE WHEN o_orderkey % 2 = 0 THEN 'en' END AS language,
        CASE WHEN o_orderkey % 10 = 0 THEN 'e' || CAST(o_orderkey AS VARCHAR) END AS article_number,
        CASE WHEN o_orderkey % 8 = 0
             THEN '[{"URL":"https://license.example/' || CAST(o_orderkey % 3 AS VARCHAR) || '"}]'
             ELSE '[]' END AS license_json,
        '{' || concat_ws(',',
            CASE o_orderkey % 5
                WHEN 0 THEN '"original-title":["Orig A ' || CAST(o_orderkey AS VARCHAR) || '","Orig B ' || CAST(o_orderkey AS VARCHAR) || '"]'
                WHEN 1 THEN '"original-title":"Orig ' || CAST(o_orderkey AS VARCHAR) || '"'
                WHEN 2 THEN '"original-title":["Only ' || CAST(o_orderkey AS VARCHAR) || '"]' END,
            CASE WHEN o_orderkey % 3 = 0 THEN '"subject":["' || o_orderstatus || '"]' END,
            '"x-priority":"' || o_orderpriority || '"') || '}' AS extra_metadata_json
    FROM base
)"""

_TYPED = """
typed AS (
    SELECT doi, title, abstract, publication_type, publisher, language, article_number,
           license_json, extra_metadata_json, source, prefix, member, container_title,
           short_container_title,
           TRY_CAST(published_text AS DATE) AS published_date, published_date_precision,
           TRY_CAST(published_print_text AS DATE) AS published_print_date, published_print_date_precision,
           TRY_CAST(published_online_text AS DATE) AS published_online_date, published_online_date_precision,
           TRY_CAST(issued_text AS DATE) AS issued_date, issued_date_precision,
           created_ts AS created_datetime, deposited_ts AS deposited_datetime, indexed_ts AS indexed_datetime,
           CAST(reference_count AS INTEGER) AS reference_count,
           CAST(references_count AS INTEGER) AS references_count,
           CAST(is_referenced_by_count AS INTEGER) AS is_referenced_by_count,
           volume, issue, page, url, resource_url
    FROM works
),
pubs AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY doi ORDER BY deposited_datetime DESC NULLS LAST,
                                     indexed_datetime DESC NULLS LAST) AS rn
        FROM typed WHERE doi IS NOT NULL)
    WHERE rn = 1
)"""

# --- one row per line item as an author (all orders, including NULL DOI) ----------------------
_AUTHORS = """
author_src AS (
    SELECT w.doi, li.*,
           (l_returnflag = 'R' AND l_linestatus = 'F') AS named,
           (l_quantity < 3) AS empty
    FROM lineitem li JOIN works w ON w.o_orderkey = li.l_orderkey
),
all_authors AS (
    SELECT doi,
        CASE WHEN named OR empty THEN NULL WHEN l_tax = 0 THEN '' WHEN l_discount = 0 THEN NULL
             ELSE 'Given' || CAST(l_partkey % 60 AS VARCHAR) END AS given_name,
        CASE WHEN named OR empty THEN NULL ELSE 'Family' || CAST(l_suppkey % 25 AS VARCHAR) END AS family_name,
        CASE WHEN named THEN 'Consortium ' || CAST(l_suppkey % 9 AS VARCHAR) END AS raw_author_name,
        CASE WHEN NOT (named OR empty) AND l_partkey % 3 = 0
             THEN printf('0000-0002-%04d-%04d', l_partkey, l_suppkey) END AS orcid,
        CASE WHEN l_linenumber = 1 AND NOT (named OR empty) THEN 'first' ELSE 'additional' END AS sequence,
        CASE WHEN named OR empty THEN NULL
             WHEN l_suppkey % 2 = 0 THEN '[{"name":"Institute ' || CAST(l_suppkey % 7 AS VARCHAR) || '"}]'
             ELSE '[]' END AS affiliations_json,
        CASE WHEN named THEN 'name_only_unparsed' WHEN empty THEN 'missing_author_name'
             ELSE 'parsed_person_name' END AS author_parse_status
    FROM author_src
),
authors AS (SELECT * FROM all_authors WHERE doi IS NOT NULL)"""

_IDENTS = """
identifiers AS (
    SELECT doi, 'ISSN' AS identifier_type, issn1 AS identifier_value, 'print' AS identifier_subtype,
           1 AS identifier_position FROM works WHERE o_orderkey % 10 <> 3
    UNION ALL
    SELECT doi, 'ISSN', issn2, 'electronic', 2 FROM works WHERE o_orderkey % 10 <> 3 AND trim(issn2) <> ''
    UNION ALL
    SELECT doi, 'ISBN', '978-' || CAST(o_orderkey AS VARCHAR), 'print', 1 FROM works WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT doi, 'alternative_id', 'ALT-' || CAST(o_orderkey AS VARCHAR), NULL, 1 FROM works
    WHERE o_orderkey % 10 <> 3
)"""

_ISSUES = """
issues AS (
    SELECT doi, 'missing_title' AS issue_type, 'Publication has no title' AS issue_description,
           CAST(1 AS BIGINT) AS affected_row_count FROM works WHERE title IS NULL
    UNION ALL
    SELECT doi, 'missing_authors', 'Publication has no authors', 1 FROM works WHERE n_lines IS NULL
    UNION ALL
    SELECT doi, 'future_published_date', 'Published date is later than current date', 1
    FROM works WHERE TRY_CAST(published_text AS DATE) > DATE '2025-01-01'
    UNION ALL
    SELECT doi, 'missing_doi', 'Publication has no DOI', 1 FROM works WHERE doi IS NULL
    UNION ALL
    SELECT doi, 'author_name_only_unparsed',
           'Author record has name field but no given/family fields; value is preserved but not used for author analytics as it may contain unmapped affiliation text',
           count(*)
    FROM all_authors WHERE author_parse_status = 'name_only_unparsed' GROUP BY doi
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# The same facts restricted to the orders of the latest order year (the latest run when works
# are landed one run per order year).
_LATEST_ORDERS = ("(SELECT * FROM orders WHERE year(o_orderdate) = "
                  "(SELECT max(year(o_orderdate)) FROM orders))")
_WORKS_LATEST = _WORKS.replace("FROM orders o LEFT JOIN lines l", f"FROM {_LATEST_ORDERS} o LEFT JOIN lines l")
assert _WORKS_LATEST != _WORKS


ORDERS = _with(_WORKS)
SILVER = _with(_WORKS, _TYPED, _AUTHORS, _IDENTS, _ISSUES)
SILVER_LATEST = _with(_WORKS_LATEST, _TYPED, _AUTHORS, _IDENTS, _ISSUES)
_LATEST_RUN = "(SELECT CAST(max(year(o_orderdate)) AS VARCHAR) FROM orders)"

_AUTHOR_JSON = """,
author_json AS (
    SELECT l_orderkey, '[' || string_agg(
        '{' || concat_ws(',',
            CASE WHEN NOT (named OR empty) AND l_partkey % 3 = 0 THEN '"ORCID":"' ||
                 (CASE WHEN l_partkey % 2 = 0 THEN 'https://orcid.org/' ELSE 'http://orcid.org/' END) ||
                 printf('0000-0002-%04d-%04d', l_partkey, l_suppkey) || '"' END,
            CASE WHEN named OR empty THEN NULL
                 WHEN l_suppkey % 2 = 0 THEN '"affiliation":[{"name":"Institute ' || CAST(l_suppkey % 7 AS VARCHAR) || '"}]'
                 ELSE '"affiliation":[]' END,
            CASE WHEN NOT (named OR empty) THEN '"family":"Family' || CAST(l_suppkey % 25 AS VARCHAR) || '"' END,
            CASE WHEN named OR empty THEN NULL WHEN l_tax = 0 THEN '"given":""' WHEN l_discount = 0 THEN NULL
                 ELSE '"given":"Given' || CAST(l_partkey % 60 AS VARCHAR) || '"' END,
            CASE WHEN named THEN '"name":"Consortium ' || CAST(l_suppkey % 9 AS VARCHAR) || '"' END,
            '"sequence":"' || CASE WHEN l_linenumber = 1 AND NOT (named OR empty) THEN 'first' ELSE 'additional' END || '"'
        ) || '}', ','
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) || ']'
        AS authors_json
    FROM (SELECT *, (l_returnflag = 'R' AND l_linestatus = 'F') AS named, (l_quantity < 3) AS empty FROM lineitem)
    GROUP BY l_orderkey
)"""

_BRONZE_SELECT = """
SELECT doi, title, abstract, publication_type, publisher, source, prefix, member, score,
       container_title, short_container_title,
       published_text AS published_date, published_print_text AS published_print_date,
       published_online_text AS published_online_date, issued_text AS issued_date,
       published_date_precision, published_print_date_precision, published_online_date_precision,
       issued_date_precision, created_date, created_datetime_text AS created_datetime,
       deposited_date, deposited_datetime_text AS deposited_datetime, indexed_date,
       indexed_datetime_text AS indexed_datetime, reference_count, references_count,
       is_referenced_by_count, volume, issue, page, url, resource_url,
       '["' || issn1 || '"]' AS issn_json,
       CASE WHEN o_orderkey % 10 = 3 THEN '[]'
            ELSE '[{"type":"print","value":"' || issn1 || '"},{"type":"electronic","value":"' || issn2 || '"}]'
       END AS issn_type_json,
       coalesce(aj.authors_json, '[]') AS authors_json,
       '[]' AS links_json,
       CAST(NULL AS VARCHAR) AS content_domain_json,
       CAST(NULL AS VARCHAR) AS journal_issue_json,
       CASE WHEN o_orderstatus = 'O' THEN '["978-' || CAST(o_orderkey AS VARCHAR) || '"]' ELSE '[]' END AS isbn_json,
       CASE WHEN o_orderstatus = 'O'
            THEN '[{"type":"print","value":"978-' || CAST(o_orderkey AS VARCHAR) || '"}]' ELSE '[]' END AS isbn_type_json,
       CASE WHEN o_orderkey % 10 = 3 THEN '[]'
            WHEN o_orderkey % 2 = 0 THEN '["ALT-' || CAST(o_orderkey AS VARCHAR) || '",""]'
            ELSE '["ALT-' || CAST(o_orderkey AS VARCHAR) || '"]' END AS alternative_ids_json,
       license_json, language, article_number, extra_metadata_json
FROM works LEFT JOIN author_json aj ON aj.l_orderkey = works.o_orderkey"""

_PY_WS = r"[\t\n\x0b\f\r \x{1c}-\x{1f}\x{85}\p{Z}]"

ORACLE_SQL: dict[str, str] = {
    "bronze_works": ORDERS + _AUTHOR_JSON + _BRONZE_SELECT,
    "silver_publications": SILVER + " SELECT * FROM pubs",
    "silver_authors": SILVER + " SELECT * FROM authors",
    "silver_identifiers": SILVER + " SELECT * FROM identifiers",
    "silver_quality_issues": SILVER + " SELECT * FROM issues",
    "validation_report": SILVER + """,
stats AS (
    SELECT (SELECT count(*) FROM pubs) AS n_pubs,
           (SELECT count(DISTINCT doi) FROM pubs) AS n_dois,
           (SELECT count(*) FROM pubs WHERE doi IS NULL) AS n_null,
           (SELECT count(*) FROM authors a WHERE NOT EXISTS (SELECT 1 FROM pubs p WHERE p.doi = a.doi)) AS a_orph,
           (SELECT count(*) FROM identifiers i WHERE i.doi IS NULL OR NOT EXISTS (SELECT 1 FROM pubs p WHERE p.doi = i.doi)) AS i_orph,
           (SELECT max(indexed_datetime) FROM pubs) AS max_idx,
           (SELECT count(*) FROM issues) AS n_issues
)
SELECT 'schema_publications_required_columns' AS check_name, 'pass' AS status, '[]' AS metric_value,
       'silver_publications should contain required analytical columns' AS details FROM stats
UNION ALL SELECT 'schema_authors_required_columns', 'pass', '[]',
       'silver_publication_authors should contain required author columns' FROM stats
UNION ALL SELECT 'schema_identifiers_required_columns', 'pass', '[]',
       'silver_publication_identifiers should contain required identifier columns' FROM stats
UNION ALL SELECT 'schema_quality_required_columns', 'pass', '[]',
       'silver_quality_issues should contain required quality columns' FROM stats
UNION ALL SELECT 'unique_publication_doi', CASE WHEN n_pubs = n_dois THEN 'pass' ELSE 'fail' END,
       'rows=' || n_pubs || ', distinct_dois=' || n_dois, 'silver_publications should have one row per DOI' FROM stats
UNION ALL SELECT 'no_missing_publication_doi', CASE WHEN n_null = 0 THEN 'pass' ELSE 'fail' END,
       CAST(n_null AS VARCHAR), 'silver_publications should not contain missing DOI values' FROM stats
UNION ALL SELECT 'authors_have_matching_publication', CASE WHEN a_orph = 0 THEN 'pass' ELSE 'fail' END,
       CAST(a_orph AS VARCHAR), 'Every author row should match a DOI in silver_publications' FROM stats
UNION ALL SELECT 'identifiers_have_matching_publication', CASE WHEN i_orph = 0 THEN 'pass' ELSE 'fail' END,
       CAST(i_orph AS VARCHAR), 'Every identifier row should match a DOI in silver_publications' FROM stats
UNION ALL SELECT 'freshness_max_indexed_datetime', 'info', coalesce(strftime(max_idx, '%Y-%m-%d %H:%M:%S'), 'None'),
       'Latest indexed_datetime found in silver_publications' FROM stats
UNION ALL SELECT 'quality_issue_count', 'info', CAST(n_issues AS VARCHAR),
       'Number of quality issue records generated in silver_quality_issues' FROM stats""",
    "author_publication_stats": SILVER + """
SELECT author_name, count(DISTINCT doi) AS publication_count,
       CAST(sum(CASE WHEN sequence = 'first' THEN 1 ELSE 0 END) AS BIGINT) AS first_author_count
FROM (SELECT doi, sequence, nullif(trim(concat_ws(' ', given_name, family_name)), '') AS author_name
      FROM authors WHERE given_name IS NOT NULL OR family_name IS NOT NULL)
WHERE author_name IS NOT NULL
GROUP BY author_name
ORDER BY publication_count DESC, first_author_count DESC, author_name
LIMIT 20""",
    "publisher_type_summary": SILVER + """
SELECT publisher, publication_type, count(*) AS publication_count,
       avg(is_referenced_by_count) AS avg_citation_count
FROM pubs GROUP BY publisher, publication_type
ORDER BY publication_count DESC, publisher NULLS LAST, publication_type NULLS LAST
LIMIT 20""",
    "quality_issue_summary": SILVER + """
SELECT issue_type, count(DISTINCT doi) AS affected_publications,
       CAST(sum(affected_row_count) AS BIGINT) AS affected_rows
FROM issues GROUP BY issue_type""",
    "publication_type_distribution": SILVER + """
SELECT publication_type, count(*) AS publication_count FROM pubs GROUP BY publication_type""",
    "top_publishers": SILVER + """
SELECT publisher, count(*) AS len FROM pubs GROUP BY publisher
ORDER BY len DESC, publisher NULLS LAST LIMIT 20""",
    "date_combination_distribution": SILVER + """
SELECT published_date, issued_date, published_print_date, published_online_date, count(*) AS len
FROM pubs GROUP BY ALL""",
    "issued_published_differences": SILVER + """
SELECT doi, title, published_date, issued_date, published_print_date, published_online_date
FROM pubs WHERE published_date IS NOT NULL AND issued_date IS NOT NULL AND published_date <> issued_date""",
    "future_dated_publications": SILVER + """
SELECT p.doi, p.title, p.published_date, p.published_print_date, p.published_online_date, p.issued_date
FROM pubs p JOIN issues i ON i.doi = p.doi AND i.issue_type = 'future_published_date'""",
    "multi_valued_titles": """
SELECT '["Orig A ' || CAST(o_orderkey AS VARCHAR) || '","Orig B ' || CAST(o_orderkey AS VARCHAR) || '"]'
       AS "original-title"
FROM orders WHERE o_orderkey % 5 = 0""",
    "quality_issue_rows_per_type": SILVER + """
SELECT issue_type, count(*) AS len FROM issues GROUP BY issue_type""",
    "raw_author_rows": ORDERS + """
SELECT w.raw_doi AS doi,
       CASE WHEN named OR empty THEN NULL WHEN l_tax = 0 THEN '' WHEN l_discount = 0 THEN NULL
            ELSE 'Given' || CAST(l_partkey % 60 AS VARCHAR) END AS given,
       CASE WHEN named OR empty THEN NULL ELSE 'Family' || CAST(l_suppkey % 25 AS VARCHAR) END AS family,
       CASE WHEN NOT (named OR empty) AND l_partkey % 3 = 0
            THEN (CASE WHEN l_partkey % 2 = 0 THEN 'https://orcid.org/' ELSE 'http://orcid.org/' END)
                 || printf('0000-0002-%04d-%04d', l_partkey, l_suppkey) END AS orcid,
       CASE WHEN named OR empty THEN NULL
            WHEN l_suppkey % 2 = 0 THEN '[{"name":"Institute ' || CAST(l_suppkey % 7 AS VARCHAR) || '"}]'
            ELSE '[]' END AS affiliation
FROM (SELECT *, (l_returnflag = 'R' AND l_linestatus = 'F') AS named, (l_quantity < 3) AS empty FROM lineitem) li
JOIN works w ON w.o_orderkey = li.l_orderkey""",
    "duplicate_dois": ORDERS + """
SELECT doi, count(*) AS row_count FROM works WHERE doi IS NOT NULL GROUP BY doi HAVING count(*) > 1""",
    "conflicting_versions": ORDERS + """
SELECT doi, count(*) AS version_count FROM works GROUP BY doi HAVING count(*) > 1""",
    "publication_coverage": SILVER + """
SELECT count(*) AS total_publications,
       count(*) FILTER (WHERE doi IS NULL) AS missing_doi,
       count(*) FILTER (WHERE title IS NULL) AS missing_title,
       count(*) FILTER (WHERE published_date IS NULL) AS missing_published_date,
       count(*) FILTER (WHERE publisher IS NULL) AS missing_publisher,
       count(*) FILTER (WHERE container_title IS NULL) AS missing_container_title,
       count(*) FILTER (WHERE abstract IS NOT NULL) AS has_abstract,
       count(*) FILTER (WHERE language IS NOT NULL) AS has_language,
       count(*) FILTER (WHERE article_number IS NOT NULL) AS has_article_number,
       count(*) FILTER (WHERE license_json <> '[]') AS has_license
FROM pubs""",
    "date_consistency": SILVER + """
SELECT count(*) AS total_publications,
       count(*) FILTER (WHERE issued_date IS NOT NULL AND published_date IS NOT NULL) AS both_dates_present,
       count(*) FILTER (WHERE issued_date IS NULL AND published_date IS NULL) AS both_dates_missing,
       count(*) FILTER (WHERE issued_date = published_date) AS same_issued_and_published,
       count(*) FILTER (WHERE issued_date <> published_date) AS different_issued_and_published
FROM pubs""",
    "author_key_frequency": """
WITH a AS (SELECT (l_returnflag = 'R' AND l_linestatus = 'F') AS named, (l_quantity < 3) AS empty,
                  l_tax, l_discount, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT 'given' AS key, count(*) FILTER (WHERE NOT (named OR empty) AND NOT (l_tax <> 0 AND l_discount = 0)) AS count FROM a
UNION ALL SELECT 'family', count(*) FILTER (WHERE NOT (named OR empty)) FROM a
UNION ALL SELECT 'name', count(*) FILTER (WHERE named) FROM a
UNION ALL SELECT 'ORCID', count(*) FILTER (WHERE NOT (named OR empty) AND l_partkey % 3 = 0) FROM a
UNION ALL SELECT 'sequence', count(*) FROM a
UNION ALL SELECT 'affiliation', count(*) FILTER (WHERE NOT (named OR empty)) FROM a""",
    "original_title_types": """
SELECT CASE o_orderkey % 5 WHEN 0 THEN 'list' WHEN 1 THEN 'str' WHEN 2 THEN 'list' ELSE 'NoneType' END AS type_name,
       count(*) AS count
FROM orders GROUP BY 1""",
    "title_length_distribution": """
SELECT CAST(len(string_split(text, chr(10))) AS INTEGER) AS length, count(*) AS count
FROM documents WHERE text IS NOT NULL GROUP BY 1""",
    "title_missing_vs_empty": """
SELECT count(*) FILTER (WHERE o_orderkey % 13 = 0) AS missing_count,
       count(*) FILTER (WHERE o_orderkey % 13 <> 0 AND o_orderkey % 19 = 0) AS empty_list_count
FROM orders""",
    "with_without_authors": """
SELECT count(*) FILTER (WHERE n IS NOT NULL) AS with_author, count(*) FILTER (WHERE n IS NULL) AS without_author
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l.l_orderkey = o_orderkey""",
    "top_author_counts": ORDERS + """
SELECT raw_doi AS doi,
       CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 19 = 0 THEN NULL ELSE title END AS title,
       CAST(coalesce(n_lines, 0) AS INTEGER) AS author_count
FROM works ORDER BY author_count DESC, raw_doi NULLS LAST, title NULLS LAST LIMIT 10""",
    "authors_per_publication": SILVER + """
SELECT doi, count(*) AS author_count FROM authors GROUP BY doi""",
    "publications_without_authors": SILVER + """
SELECT doi, title, publisher, publication_type FROM pubs p
WHERE NOT EXISTS (SELECT 1 FROM authors a WHERE a.doi = p.doi)""",
    "silver_summary": SILVER + """
SELECT (SELECT count(*) FROM pubs) AS publications,
       (SELECT count(*) FROM authors) AS authors,
       (SELECT count(*) FROM issues) AS quality_issues,
       (SELECT count(*) FROM (SELECT doi FROM pubs GROUP BY doi HAVING count(*) > 1)) AS duplicate_dois,
       (SELECT count(*) FROM pubs p WHERE NOT EXISTS (SELECT 1 FROM authors a WHERE a.doi = p.doi))
           AS publications_without_authors""",
    "problematic_dois": ORDERS + """
SELECT raw_doi AS original, raw_doi <> trim(raw_doi) AS has_outer_spaces,
       raw_doi <> lower(raw_doi) AS has_uppercase, lower(trim(raw_doi)) AS normalized
FROM works WHERE raw_doi IS NOT NULL AND (raw_doi <> trim(raw_doi) OR raw_doi <> lower(raw_doi))""",
    "doi_hygiene_totals": ORDERS + """
SELECT count(*) AS total_dois,
       count(*) FILTER (WHERE raw_doi <> lower(raw_doi)) AS uppercase_count,
       count(*) FILTER (WHERE raw_doi <> trim(raw_doi)) AS outer_space_count
FROM works WHERE raw_doi IS NOT NULL""",
    "dois_without_identifiers": SILVER + """
SELECT doi FROM pubs EXCEPT SELECT doi FROM identifiers""",
    "clean_page_abstracts": f"""
SELECT '10.7/page.' || CAST(page_id AS VARCHAR) AS doi, url,
       nullif(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
              '{_PY_WS}+', ' ', 'g'), '^{_PY_WS}+|{_PY_WS}+$', '', 'g'), '') AS abstract
FROM pages""",
    "event_extra_metadata": """
SELECT '10.9/user.' || CAST(user_id AS VARCHAR) AS doi,
       event_type || ' ' || CAST(event_id AS VARCHAR) AS title,
       '{"event-type":"' || event_type || '","props":' || replace(props, ': ', ':') || '}' AS extra_metadata_json
FROM events""",
    "latest_event_per_user": """
SELECT '10.9/user.' || CAST(user_id AS VARCHAR) AS doi,
       event_type || ' ' || CAST(event_id AS VARCHAR) AS title,
       ts AS deposited_datetime, make_timestamp(event_id * 1000000) AS indexed_datetime
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
    "conversation_author_stats": """
SELECT author_name, count(DISTINCT conv_id) AS publication_count,
       CAST(sum(CASE WHEN turn = 0 THEN 1 ELSE 0 END) AS BIGINT) AS first_author_count
FROM (SELECT conv_id, turn,
             CASE WHEN role = 'user' THEN 'U' || CAST(turn AS VARCHAR)
                  WHEN role = 'assistant' THEN 'A' || CAST(turn % 3 AS VARCHAR) END AS author_name
      FROM conversations)
WHERE author_name IS NOT NULL
GROUP BY author_name
ORDER BY publication_count DESC, first_author_count DESC, author_name
LIMIT 20""",
    "conversation_name_only_issues": """
SELECT '10.6/conv.' || CAST(conv_id AS VARCHAR) AS doi, 'author_name_only_unparsed' AS issue_type,
       'Author record has name field but no given/family fields; value is preserved but not used for author analytics as it may contain unmapped affiliation text' AS issue_description,
       count(*) AS affected_row_count
FROM conversations WHERE role = 'system' GROUP BY conv_id""",
}

# The staged layer round trip (JSON lines with nested JSON values) gives bronze unchanged.
ORACLE_SQL["staging_roundtrip_bronze"] = ORACLE_SQL["bronze_works"]
ORACLE_SQL["staging_metadata"] = """
SELECT 'metadata-api' AS source, 'orders' AS raw_file, count(*) AS work_count FROM orders"""

# De-duplication across every run equals de-duplication of the whole table.
ORACLE_SQL["publications_across_runs"] = ORACLE_SQL["silver_publications"]
ORACLE_SQL["publications_merged_by_year"] = ORACLE_SQL["silver_publications"]

# Layered build over one run per order year; the reports read the latest run only.
for _name, _base in (("latest_run_validation", "validation_report"),
                     ("envelope_latest_run_validation", "validation_report"),
                     ("latest_run_author_stats", "author_publication_stats")):
    assert ORACLE_SQL[_base].startswith(SILVER)
    ORACLE_SQL[_name] = SILVER_LATEST + ORACLE_SQL[_base][len(SILVER):]

# Profile of every column of the publications: the statement is put together from the schema's
# column names, in the tables' order.
_PROFILED = {c: "string" for c in REQUIRED_PUBLICATION_COLUMNS} | {
    c: "date" for c in REQUIRED_PUBLICATION_COLUMNS if c.endswith("_date")} | {
    c: "timestamp" for c in REQUIRED_PUBLICATION_COLUMNS if c.endswith("_datetime")} | dict.fromkeys(
    ("reference_count", "references_count", "is_referenced_by_count"), "int")
ORACLE_SQL["column_profile"] = SILVER + ", h AS (SELECT count(*) AS n FROM pubs), prof AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
        count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS unique_values FROM pubs"""
    for c, t in _PROFILED.items()) + """)
SELECT "column", dtype, nulls, round_even(nulls / n * 100, 2) AS null_percent,
       CAST(unique_values AS BIGINT) AS unique_values
FROM prof, h"""

_PAGES = """WITH pages AS (
    SELECT CAST(year(o_orderdate) AS VARCHAR) AS run, o_orderkey // 200 AS page, count(*) AS n,
           count(*) FILTER (WHERE o_orderkey % 97 = 0) AS bad
    FROM orders GROUP BY ALL)"""
ORACLE_SQL["envelope_quarantine"] = _PAGES + """
SELECT run, coalesce(sum(n - bad) FILTER (WHERE page % 7 <> 3), 0)::BIGINT AS works,
       coalesce(sum(bad) FILTER (WHERE page % 7 <> 3), 0)::BIGINT AS quarantined_items,
       count(*) FILTER (WHERE page % 7 = 3) AS quarantined_envelopes
FROM pages GROUP BY run"""
ORACLE_SQL["envelope_fields"] = _PAGES + """
SELECT run, 'ok' AS status, count(*) AS envelopes, sum(n)::BIGINT AS total_results, sum(n)::BIGINT AS items
FROM pages WHERE page % 7 <> 3 GROUP BY run"""
_TITLE_FIELD_COUNTS = """
SELECT 'title' AS field, CASE WHEN o_orderkey % 13 = 0 THEN 'NoneType' ELSE 'list' END AS type_name FROM orders
UNION ALL SELECT 'container-title', 'list' FROM orders UNION ALL SELECT 'short-container-title', 'list' FROM orders
UNION ALL SELECT 'original-title', CASE o_orderkey % 5 WHEN 0 THEN 'list' WHEN 1 THEN 'str' WHEN 2 THEN 'list'
    ELSE 'NoneType' END FROM orders"""
ORACLE_SQL["title_field_types"] = f"""
SELECT field, type_name, count(*) AS count FROM ({_TITLE_FIELD_COUNTS}) GROUP BY ALL"""
# One row per value: its path, type and list length.
_PATHS = """
SELECT path, type_name, count(*) AS count, min(len)::INTEGER AS min_length, max(len)::INTEGER AS max_length
FROM ({}) GROUP BY path, type_name"""
ORACLE_SQL["title_and_author_paths"] = """
WITH o AS (SELECT o_orderkey AS k FROM orders),
l AS (
    SELECT *, NOT (l_returnflag = 'R' AND l_linestatus = 'F') AND l_quantity >= 3 AS person,
           l_returnflag = 'R' AND l_linestatus = 'F' AS named
    FROM lineitem JOIN o ON k = l_orderkey)""" + _PATHS.format("""
    SELECT '' AS path, 'dict' AS type_name, NULL AS len FROM o
    UNION ALL SELECT 'title', 'list', CASE WHEN k % 19 = 0 THEN 0 ELSE 2 END FROM o WHERE k % 13 <> 0
    UNION ALL SELECT 'title[]', 'str', NULL FROM o, range(2) WHERE k % 13 <> 0 AND k % 19 <> 0
    UNION ALL SELECT 'container-title', 'list', 1 FROM o UNION ALL SELECT 'container-title[]', 'str', NULL FROM o
    UNION ALL SELECT 'short-container-title', 'list', (k % 2 = 0)::INT FROM o
    UNION ALL SELECT 'short-container-title[]', 'str', NULL FROM o WHERE k % 2 = 0
    UNION ALL SELECT 'original-title', 'list', CASE k % 5 WHEN 0 THEN 2 ELSE 1 END FROM o WHERE k % 5 IN (0, 2)
    UNION ALL SELECT 'original-title', 'str', NULL FROM o WHERE k % 5 = 1
    UNION ALL SELECT 'original-title[]', 'str', NULL FROM o, range(2) r(i) WHERE k % 5 = 0 OR (k % 5 = 2 AND i = 0)
    UNION ALL SELECT 'author', 'list', count(*) FROM l GROUP BY k
    UNION ALL SELECT 'author[]', 'dict', NULL FROM l UNION ALL SELECT 'author[].sequence', 'str', NULL FROM l
    UNION ALL SELECT 'author[].given', 'str', NULL FROM l WHERE person AND (l_tax = 0 OR l_discount <> 0)
    UNION ALL SELECT 'author[].family', 'str', NULL FROM l WHERE person
    UNION ALL SELECT 'author[].name', 'str', NULL FROM l WHERE named
    UNION ALL SELECT 'author[].ORCID', 'str', NULL FROM l WHERE person AND l_partkey % 3 = 0
    UNION ALL SELECT 'author[].affiliation', 'list', (l_suppkey % 2 = 0)::INT FROM l WHERE person
    UNION ALL SELECT 'author[].affiliation[]', 'dict', NULL FROM l WHERE person AND l_suppkey % 2 = 0
    UNION ALL SELECT 'author[].affiliation[].name', 'str', NULL FROM l WHERE person AND l_suppkey % 2 = 0""")
ORACLE_SQL["conversation_paths"] = _PATHS.format("""
    SELECT '' AS path, 'dict' AS type_name, NULL AS len FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL SELECT 'DOI', 'str', NULL FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id IS NOT NULL
    UNION ALL SELECT unnest(['title', 'title[]']), unnest(['list', 'str']), unnest([1, NULL])
        FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id IS NOT NULL
    UNION ALL SELECT 'abstract', 'str', NULL FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL SELECT 'author', 'list', count(*) FROM conversations GROUP BY conv_id
    UNION ALL SELECT unnest(['author[]', 'author[].sequence']), unnest(['dict', 'str']), NULL FROM conversations
    UNION ALL SELECT unnest(CASE role WHEN 'user' THEN ['author[].given', 'author[].ORCID']
        WHEN 'assistant' THEN ['author[].family'] WHEN 'system' THEN ['author[].name'] END), 'str', NULL FROM conversations""")
ORACLE_SQL["cast_values"] = """
WITH v AS (
    SELECT o_orderkey,
        CASE o_orderkey % 9 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
            WHEN 2 THEN 'T12:00:00' WHEN 3 THEN '12:00:00' WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN 5 THEN strftime(o_orderdate, '%Y-13-01T00:00:00Z') WHEN 6 THEN 'no date'
            WHEN 7 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.25Z')
            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS t,
        CAST(o_custkey AS VARCHAR) || CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '.5'
            WHEN 2 THEN '.49999999999' WHEN 3 THEN '.25' ELSE '.50000000001' END AS n
    FROM orders)
SELECT o_orderkey, TRY_CAST(t AS TIMESTAMP) AS date_time,
       CAST(round_even(CAST(n AS DOUBLE), 0) AS BIGINT) AS from_number, TRY_CAST(n AS BIGINT) AS from_text
FROM v"""
ORACLE_SQL["failed_checks"] = SILVER + """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS run, 'identifiers_have_matching_publication' AS check_name,
       CAST(sum(CASE WHEN o_orderkey % 10 <> 3 THEN 2 + (trim(issn2) <> '')::INT ELSE 0 END
                + (w.o_orderstatus = 'O')::INT) AS VARCHAR) AS metric_value
FROM works w JOIN orders USING (o_orderkey) WHERE doi IS NULL
GROUP BY 1
HAVING sum(CASE WHEN o_orderkey % 10 <> 3 THEN 2 + (trim(issn2) <> '')::INT ELSE 0 END
           + (w.o_orderstatus = 'O')::INT) > 0"""
ORACLE_SQL["bronze_by_path"] = ORDERS + " SELECT doi, title, publisher, published_text AS published_date FROM works"
_BRONZE_ONLY = sorted(set(BRONZE_COLUMNS) - set(REQUIRED_PUBLICATION_COLUMNS))
ORACLE_SQL["bronze_only_columns"] = ORDERS + _AUTHOR_JSON + ", bronze AS (" + _BRONZE_SELECT + ") " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{'double' if c == 'score' else 'string'}' AS dtype, count({c}) AS non_null_rows FROM bronze"""
    for c in _BRONZE_ONLY)
ORACLE_SQL["author_coverage"] = SILVER + """
SELECT count(*) AS total_author_rows, count(*) FILTER (WHERE doi IS NULL) AS missing_doi,
       count(*) FILTER (WHERE given_name IS NULL) AS missing_given_name,
       count(*) FILTER (WHERE family_name IS NULL) AS missing_family_name, count(orcid) AS authors_with_orcid
FROM authors"""
ORACLE_SQL["publication_date_coverage"] = SILVER + """
SELECT count(*) AS total_publications, count(published_date) AS has_published_date,
       count(issued_date) AS has_issued_date, count(published_print_date) AS has_published_print_date,
       count(published_online_date) AS has_published_online_date
FROM pubs"""
ORACLE_SQL["raw_author_orcid"] = f"""
SELECT count(*) AS total_author_rows, count(orcid) AS authors_with_orcid,
       count(*) - count(orcid) AS authors_without_orcid
FROM ({ORACLE_SQL["raw_author_rows"]})"""
ORACLE_SQL["author_affiliations"] = f"""
SELECT affiliation FROM ({ORACLE_SQL["raw_author_rows"]}) WHERE affiliation <> '[]'"""
_ALWAYS = ("container-title", "short-container-title", "type", "source", "prefix", "member", "score",
           "is-referenced-by-count", "issued", "created", "indexed", "volume", "issue", "page", "URL", "resource",
           "ISSN", "x-priority")
_SOMETIMES = {
    "DOI": "o_orderkey % 23 <> 0", "title": "o_orderkey % 13 <> 0", "original-title": "o_orderkey % 5 < 3",
    "publisher": "publisher IS NOT NULL", "reference-count": "n_lines IS NOT NULL",
    "references-count": "o_orderkey % 3 = 0 AND n_lines IS NOT NULL", "published": "o_orderkey % 17 <> 0",
    "published-print": "o_orderkey % 3 = 0", "published-online": "o_orderkey % 5 = 0",
    "deposited": "o_orderkey % 11 <> 0", "issn-type": "o_orderkey % 10 <> 3", "ISBN": "o_orderstatus = 'O'",
    "isbn-type": "o_orderstatus = 'O'", "alternative-id": "o_orderkey % 10 <> 3", "language": "o_orderkey % 2 = 0",
    "article-number": "o_orderkey % 10 = 0", "abstract": "o_orderkey % 4 = 0", "license": "o_orderkey % 8 = 0",
    "author": "n_lines IS NOT NULL", "subject": "o_orderkey % 3 = 0"}
ORACLE_SQL["item_key_frequency"] = ORDERS + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{k}' AS key, count(*) FILTER (WHERE {cond}) AS count FROM works"
    for k, cond in (dict.fromkeys(_ALWAYS, "true") | _SOMETIMES).items()) + ") WHERE count > 0"
ORACLE_SQL["top_dois_by_authors"] = SILVER + """
SELECT doi, count(*) AS author_count FROM authors GROUP BY doi ORDER BY author_count DESC, doi LIMIT 20"""
ORACLE_SQL["identifiers_without_publication"] = SILVER + " SELECT doi FROM identifiers EXCEPT SELECT doi FROM pubs"
ORACLE_SQL["conversation_abstracts"] = f"""
SELECT '10.6/conv.' || CAST(conv_id AS VARCHAR) AS doi,
       nullif(regexp_replace(regexp_replace(regexp_replace(string_agg(text, ' ' ORDER BY turn, role, text),
              '<[^>]+>', ' ', 'g'), '{_PY_WS}+', ' ', 'g'), '^{_PY_WS}+|{_PY_WS}+$', '', 'g'), '') AS abstract
FROM conversations GROUP BY conv_id"""
ORACLE_SQL["staging_envelopes"] = ORDERS + """
SELECT doi, title, publisher, reference_count, 'orders' AS staged_from FROM works"""
ORACLE_SQL["run_stamps"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS utc_iso,
       strftime(o_orderdate, '%Y%m%dT%H%M%S') AS run_stamp,
       CAST(o_orderdate AS DATE) > current_date AS in_future
FROM orders"""
ORACLE_SQL["split_envelope_works"] = ORACLE_SQL["bronze_by_path"]
ORACLE_SQL["staging_documents"] = ORDERS + _AUTHOR_JSON + _BRONZE_SELECT.replace("SELECT doi,", """
SELECT 'page-' || (o_orderkey // 200) AS staged_from, 'metadata-api' AS staged_source,
       '2025-01-01T00:00:00.000000+00:00' AS staged_at_utc,
       count(*) OVER (PARTITION BY o_orderkey // 200) AS staged_work_count, doi,""", 1)
ORACLE_SQL["quality_issues_from_authors"] = ORACLE_SQL["silver_quality_issues"]
ORACLE_SQL["fetched_top_publishers"] = ORACLE_SQL["top_publishers"]
ORACLE_SQL["limited_titles"] = """
SELECT least(count(*), 5) AS examples, least(count(*), 5) AS known FROM orders WHERE o_orderkey % 5 = 0"""
ORACLE_SQL["streamed_works"] = _PAGES + """
SELECT run || '-' || (page % 7) AS run, coalesce(sum(n - bad) FILTER (WHERE page % 7 <> 3), 0)::BIGINT AS works,
       coalesce(sum(bad) FILTER (WHERE page % 7 <> 3), 0)::BIGINT AS quarantined_items,
       count(*) FILTER (WHERE page % 7 = 3) AS quarantined_envelopes
FROM pages GROUP BY ALL"""
# Publications are de-duplicated within each order year; the profile covers those of all years.
_PUBS_BY_RUN = _with(_WORKS, _TYPED.replace("PARTITION BY doi", "PARTITION BY year(created_datetime), doi"))
assert "year(created_datetime)" in _PUBS_BY_RUN
ORACLE_SQL["merged_profile"] = _PUBS_BY_RUN + ", prof AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM pubs"""
    for c, t in _PROFILED.items()) + """)
SELECT "column", dtype, rows, nulls, round_even(nulls / rows * 100, 2) AS null_percent, TRUE AS near_exact FROM prof"""
