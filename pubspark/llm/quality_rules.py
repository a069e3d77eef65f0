"""Quality rules, line first: each line is judged on punctuation, navigation and boilerplate,
failing lines are removed, and a document that loses too much of its text is rejected.

A word is a maximal run of characters other than the six ASCII white-space characters. A line
(split at "\\n") with a word fails when

* its symbols ``#*$%&|<>`` or its exclamation marks exceed ``max_mark_pct`` per cent of its word
  characters (punctuation),
* two words or more, and at least ``min_separator_pct`` per cent of its words, are bare menu
  separators, or it has under ``min_line_words`` words and no closing punctuation (navigation),
* it equals an earlier line, or holds a boilerplate phrase and at most
  ``max_boilerplate_words`` words (boilerplate).

Defined results: null text reads as empty; an empty text has zero counts, fails the base rule
(fewer than 50 words) and is not kept. Rows are judged one by one, so repeated rows get equal
results and other columns play no part. All arithmetic is on integers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubspark.llm.common import as_batch, fresh_name, texts

SYMBOLS = "#*$%&|<>"
SEPARATORS = (b"|", "»".encode(), "›".encode(), "•".encode(), "·".encode(), b"/", b">", b">>")
CLOSING = ".!?…。！？؟।:;\"'”’»)]"
BOILERPLATE = ("all rights reserved", "cookie policy", "privacy policy", "terms of use",
               "terms of service", "enable javascript", "lorem ipsum", "click here",
               "sign up for our newsletter", "subscribe to our newsletter",
               "skip to main content", "add to cart")
WHITE = " \t\n\v\f\r"
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))


@dataclass(frozen=True)
class Limits:
    """Thresholds of the line rules and of the document verdict."""

    max_mark_pct: int = 10
    min_separator_pct: int = 20
    min_line_words: int = 4
    max_boilerplate_words: int = 30
    max_lost_pct: int = 50
    min_words: int = 50
    max_repeat_pct: int = 50


@dataclass
class Verdict:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    lost_chars: int
    clean_text: str


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    n, covered = 0, 0  # covered: first word position not yet counted
    for i, w in enumerate(windows):
        if counts[w] > 1:
            n += i + 3 - max(i, covered)
            covered = i + 3
    return n


def line_fails(line: str, words: list[bytes], chars: int, limits: Limits) -> bool:
    """Punctuation, navigation and boilerplate-phrase rules for one line that has a word."""
    marks = sum(line.count(c) for c in SYMBOLS)
    if 100 * max(marks, line.count("!")) > limits.max_mark_pct * chars:
        return True
    n = len(words)
    separators = sum(words.count(s) for s in SEPARATORS) if n > 2 else 0
    if separators >= 2 and 100 * separators >= limits.min_separator_pct * n:
        return True
    if n < limits.min_line_words and line.rstrip(WHITE)[-1] not in CLOSING:
        return True
    return n <= limits.max_boilerplate_words and _BOILERPLATE.search(line.lower()) is not None


def judge(text: str, limits: Limits = Limits()) -> Verdict:
    """Base counts, base rule and the line-first verdict of one text."""
    words: list[bytes] = []
    seen: set[str] = set()
    kept_lines, word_chars, lost, dups = [], 0, 0, 0
    for line in text.split("\n"):
        own = line.encode().split()
        if not own:
            kept_lines.append(line)
            continue
        words += own
        chars = len(line) - sum(line.count(c) for c in WHITE)
        word_chars += chars
        dup = line in seen
        seen.add(line)
        dups += dup
        if dup or line_fails(line, own, chars, limits):
            lost += chars
        else:
            kept_lines.append(line)
    n, repeat = len(words), repeated_words(words)
    failed = n < limits.min_words or 100 * repeat > limits.max_repeat_pct * n
    return Verdict(n, word_chars, sum(text.count(c) for c in SYMBOLS), dups, repeat, failed,
                   not failed and 100 * lost <= limits.max_lost_pct * word_chars, lost,
                   "\n".join(kept_lines))


COUNTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                    ("kept", pa.bool_()), ("lost_chars", pa.int64())])
DDL = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
       "n_repeat_words long, base_failed boolean, kept boolean, lost_chars long")


def quality_report(docs: DataFrame, limits: Limits = Limits(), with_text: bool = False) -> DataFrame:
    """One row per document: base counts, verdict, characters lost to the line rules and,
    ``with_text``, the text without its failing lines (``clean_text``). One narrow stage."""
    schema = COUNTS.append(pa.field("clean_text", pa.string())) if with_text else COUNTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [judge(t, limits) for t in texts(b)]
            cols = [[getattr(x, f.name) for x in v] for f in schema if f.name != "doc_id"]
            yield as_batch([b.column("doc_id"), *cols], schema)

    ddl = DDL + (", clean_text string" if with_text else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ddl)


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text the rules keep."""

    @F.pandas_udf("boolean")
    def good(text):
        return text.map(lambda t: judge(t or "", limits).kept)

    flag = fresh_name(docs, "quality_kept")
    return docs.withColumn(flag, good(F.col("text"))).filter(F.col(flag)).drop(flag)


def _alternatives(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def report_sql(table: str = "documents", limits: Limits = Limits()) -> str:
    """DuckDB SQL for :func:`quality_report` (without the text)."""
    word = r"[^\x20\x09-\x0D]+"
    seps = _alternatives(s.decode() for s in SEPARATORS)
    phrases = " OR ".join(f"contains(lower(line), {_alternatives([p])})" for p in BOILERPLATE)
    closing = "'" + CLOSING.replace("'", "''") + "'"
    symbol = r"[^#*$%&|<>]+"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {table}),
split AS (SELECT r, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS k FROM docs),
lines AS (
  SELECT r, k, line, regexp_extract_all(line, '{word}') AS words,
         length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         length(regexp_replace(line, '{symbol}', '', 'g')) AS marks,
         length(regexp_replace(line, '[^!]+', '', 'g')) AS bangs
  FROM split),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS dup,
         len(list_filter(words, lambda w: list_contains([{seps}], w))) AS seps, len(words) AS n
  FROM lines WHERE len(words) > 0),
per_line AS (
  SELECT *, dup OR 100 * greatest(marks, bangs) > {limits.max_mark_pct} * chars
         OR (n > 2 AND seps >= 2 AND 100 * seps >= {limits.min_separator_pct} * n)
         OR (n < {limits.min_line_words} AND NOT contains({closing}, right(words[-1], 1)))
         OR (n <= {limits.max_boilerplate_words} AND ({phrases})) AS fails
  FROM judged),
totals AS (
  SELECT r, sum(n)::BIGINT AS n_words, sum(chars)::BIGINT AS word_chars,
         sum(dup::INT)::BIGINT AS n_dup_lines,
         sum(CASE WHEN fails THEN chars ELSE 0 END)::BIGINT AS lost_chars
  FROM per_line GROUP BY r),
wl AS (SELECT r, regexp_extract_all(text, '{word}') AS ws FROM docs),
tri AS (
  SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM wl)),
hits AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS m FROM tri)
         WHERE m > 1),
reps AS (SELECT r, count(DISTINCT p)::BIGINT AS n_repeat_words
         FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM hits) GROUP BY r),
joined AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(text, '{symbol}', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost_chars, 0) AS lost_chars
  FROM docs LEFT JOIN totals USING (r) LEFT JOIN reps USING (r)),
based AS (
  SELECT *, n_words < {limits.min_words}
            OR 100 * n_repeat_words > {limits.max_repeat_pct} * n_words AS base_failed
  FROM joined)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost_chars <= {limits.max_lost_pct} * word_chars AS kept,
       lost_chars
FROM based"""
