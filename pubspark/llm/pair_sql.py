"""DuckDB SQL for the operators on pairs: every pair compared, components by recursion.

Quadratic, so only for small tables; it shares no code with the operators.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_REACHED = """
reached(r, t) AS (
  SELECT r, r FROM nodes UNION SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.t),
lowest AS (SELECT reached.r, min(n.id) AS low FROM reached JOIN nodes n ON n.r = reached.t GROUP BY reached.r)"""


def near_vectors_sql(threshold: float = 0.9) -> str:
    """The rows of ``subspace_join.near_vectors``."""
    dot = "list_sum(list_transform(list_zip({0}, {1}), lambda z: z[1] * z[2]))"
    return f"""
WITH RECURSIVE nodes AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id AS id,
    CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e FROM embeddings),
usable AS MATERIALIZED (SELECT r, e, {dot.format('e', 'e')} AS square FROM nodes WHERE e IS NOT NULL AND id IS NOT NULL),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE {dot.format('a.e', 'b.e')} / sqrt(a.square * b.square) >= {threshold}),
{_REACHED}
SELECT id AS vec_id, count(links.b) AS n_links, any_value(low) AS component_id, id = any_value(low) AS kept
FROM nodes JOIN lowest USING (r) LEFT JOIN links ON links.a = r GROUP BY r, id"""


def near_duplicates_sql(percent: int = 85, shingle: int = 5) -> str:
    """The rows of ``chosen_paths.near_duplicates`` for tables whose ``doc_id`` are not null."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id AS id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
nodes AS MATERIALIZED (
  SELECT r, id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {shingle - 2}), lambda i: array_to_string(w[i:i + {shingle - 1}], ' ')) END) AS shingles
  FROM words),
sets AS MATERIALIZED (SELECT r, len(shingles) AS n, unnest(shingles) AS s FROM nodes),
halves AS (
  SELECT a.r AS a, b.r AS b FROM sets a JOIN sets b USING (s) WHERE a.r < b.r GROUP BY a.r, b.r, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
links AS MATERIALIZED (SELECT a, b FROM halves UNION ALL SELECT b, a FROM halves),
{_REACHED}
SELECT id AS doc_id, len(shingles)::BIGINT AS n_shingles, low AS component_id, id = low AS kept
FROM nodes JOIN lowest USING (r)"""
