"""Spelling variants: words that differ by one letter, grouped under their frequent form.

Method (PartEnum signatures): the letters of a word are a multiset, seen as a binary vector with one
dimension for each letter and count of it so far (first a, second a, ...). One inserted or deleted
letter changes one dimension, a replaced letter two, so near words are at Hamming distance at most
two. The dimensions are dealt into ``parts`` parts by a fixed rule. Vectors that differ in

* one dimension agree on all parts but one: one signature for each part left out,
* two dimensions agree on all parts but two: one signature for each pair of parts left out,

and this enumerates every way the differing dimensions can fall. Signatures are exact 64-bit sums of
the dimensions kept. Each also holds the length and one half of the word, since one letter leaves the
other half as it is: a word has every signature twice, with its first and with its second half, which
keeps words made of the same syllables apart. An equi-join finds all candidates; ``levenshtein``
verifies them inside the join, which thus emits near words only. A hash collision adds a candidate,
never a link.

Words come from the whole texts; counts are summed per Arrow batch and task before the shuffle. A
signature group is joined where it lies, and Spark splits a skewed one; ``parts`` sets its size
against the number of signatures (``parts * (parts + 3)`` rows a word).

Defined results: a null text has no words; a null ``doc_id`` reads as the empty text in the rule that
deletes letters; repeated rows count each time; texts of any length are read whole; a table
without rows or words gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubspark.llm.common import materialize, released, small_batches

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
DELETE_EVERY = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_TIMES = 10
PARTS = 3

_MASK = (1 << 64) - 1


def document_words(doc_id: int | None, text: str, least_length: int = LEAST_LENGTH) -> Counter:
    """The words of a text with their counts: lower-cased runs of letters, of which the rule by
    ``doc_id`` shortens some by one letter. Runs too short for a word are left out early."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
    runs = Counter(r for r in RUNS.findall(lowered) if len(r) >= least_length)
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % DELETE_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least_length:
                continue
        words[run] += n
    return words


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words: Counter = Counter()
        for doc_id, text in zip(b.column("doc_id"), b.column("text"), strict=True):
            words.update(document_words(doc_id.as_py(), text.as_py() or ""))
        if words:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])


def corpus_words(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of all words with at least ``least_count`` occurrences."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(released(_count_words), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


def _mixed(x: int) -> int:
    """A 64-bit mix (public splitmix64 finalizer)."""
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _MASK
    return x ^ (x >> 31)


class Dimensions:
    """Part and 64-bit value of each (letter, count so far); values of usual ones are kept."""

    def __init__(self, parts: int):
        self.parts, self.known = parts, {}

    def of(self, letter: str, seen: int) -> tuple[int, int]:
        got = self.known.get((letter, seen))
        if got is None:
            got = (ord(letter) + 2 * seen) % self.parts, _mixed(ord(letter) << 32 | seen)
            if seen < 64:
                self.known[letter, seen] = got
        return got

    def sums(self, word: str) -> list[int]:
        """Sum of the dimensions' values in each part."""
        out, seen = [0] * self.parts, {}
        for letter in word:
            k = seen.get(letter, 0)
            seen[letter] = k + 1
            part, value = self.of(letter, k)
            out[part] += value
        return [s & _MASK for s in out]


def _mixed_array(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _halves(words: list[str], shorter: int) -> list[np.ndarray]:
    """64-bit hashes of the first and of the second half of the words, halved as words ``shorter``
    letters shorter are."""
    cuts = [(len(w) - shorter) // 2 for w in words]
    texts = ([w[:c] for w, c in zip(words, cuts, strict=True)],
             [w[c + shorter:] for w, c in zip(words, cuts, strict=True)])
    return [np.array([int.from_bytes(blake2b(t.encode(), digest_size=8, salt=salt).digest()) for t in half], np.uint64)
            for half, salt in zip(texts, (b"first", b"second"), strict=True)]


def _signatures(left_out: int, parts: int, shorter: int = 0):
    """Rows ``key, word, n`` of all signatures with ``left_out`` parts left out and a half kept, for
    words that meet words of their length less ``shorter``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = Dimensions(parts)
        for b in batches:
            words = b.column("word").to_pylist()
            sums = np.array([dims.sums(w) for w in words], np.uint64).reshape(len(words), parts)
            length = np.array([len(w) - shorter for w in words], np.uint64)
            with np.errstate(over="ignore"):
                for half in _halves(words, shorter):
                    held = half + length * np.uint64(0x9E3779B97F4A7C15)
                    for out in combinations(range(parts), left_out):
                        kept = sums.sum(axis=1, dtype=np.uint64) - sums[:, list(out)].sum(axis=1, dtype=np.uint64)
                        key = _mixed_array(_mixed_array(held) ^ kept ^ np.uint64(_mixed(sum(1 << k for k in out))))
                        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), b.column("word"), b.column("n")],
                                                         ["key", "word", "n"])
    return run


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of words that differ by one inserted, deleted or replaced code
    point, once. ``words`` holds distinct ``word`` with ``n``; ``parts`` is at least 2."""
    def signed(left_out: int, shorter: int, name: str) -> DataFrame:
        return words.mapInArrow(_signatures(left_out, parts, shorter), "key long, word string, n long").alias(name)

    near = (F.col("a.key") == F.col("b.key")) & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    found = [F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n")]
    deleted = signed(1, 0, "a").join(signed(1, 1, "b"), near).select(*found)
    two = words.mapInArrow(_signatures(2, parts), "key long, word string, n long")
    replaced = two.alias("a").join(two.alias("b"), near & (F.col("a.word") < F.col("b.word"))).select(*found)
    # Two letters of one part are left out by several signatures, and one of two equal neighbours in
    # the middle is missing from either half: a pair may be found more than once.
    return deleted.unionByName(replaced).distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each chain of ``forms (word, form)``, which has no circles.

    Every round doubles the steps taken; the rounds are written tables, and as many as the
    logarithm of the longest chain.
    """
    chain = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(chain.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        chain = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return chain


def spelling_variants(docs: DataFrame, parts: int = PARTS, form_times: int = FORM_TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts.

    ``form`` is the near word of largest ``n`` (ties: smallest in code-point order) if that is at
    least ``form_times`` the word's ``n``; ``root`` the last form reached from the word.
    """
    with small_batches(docs.sparkSession):
        words = materialize(corpus_words(docs), "words")
    def way(word: str, near: str) -> Column:
        return F.struct(F.col(word).alias("word"), F.col(near).alias("near"), F.col(f"{near}_n").alias("near_n"))

    links = near_words(words, parts).select(F.inline(F.array(way("a", "b"), way("b", "a"))))
    best = links.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    graded = materialize(
        words.join(best, "word", "left")
        .withColumn("grown", -F.col("best.less") >= form_times * F.col("n"))
        .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                F.when(F.col("grown"), F.col("best.near")).alias("form"),
                F.when(F.col("grown"), -F.col("best.less")).alias("form_n")), "graded")
    roots = last_forms(graded.filter("form IS NOT NULL").select("word", "form"))
    return (graded.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def variants_sql() -> str:
    """The same rows in DuckDB: CRC-32 by its bitwise definition over each document's distinct runs, near
    words by equal remainders after one deletion at equal places, chains by recursion."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::BIGINT], range(8)), lambda c, k: {step}) AS v FROM range(256) r(i))),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
        ELSE [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h FROM runs, crc_table),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % {DELETE_EVERY} = 0
      THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
shorter AS (
  SELECT word, n, spot, substring(word, 1, spot - 1) || substring(word, spot + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS spot FROM words)),
deleted AS (
  SELECT DISTINCT s.word, s.n, w.word AS near, w.n AS near_n FROM shorter s JOIN words w ON w.word = s.rest),
links AS (
  SELECT word, n, near, near_n FROM deleted UNION ALL SELECT near, near_n, word, n FROM deleted
  UNION ALL SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN shorter b USING (spot, rest) WHERE a.word <> b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near,
    max(near_n) AS near_n FROM links GROUP BY word),
graded AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= {FORM_TIMES} * n THEN near END AS form, CASE WHEN near_n >= {FORM_TIMES} * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chains AS (
  SELECT word, word AS reached FROM graded
  UNION ALL SELECT c.word, g.form FROM chains c JOIN graded g ON g.word = c.reached WHERE g.form IS NOT NULL)
SELECT g.word, g.form, c.reached AS root, g.n, g.n_near, g.form_n
FROM graded g JOIN chains c ON c.word = g.word JOIN graded e ON e.word = c.reached AND e.form IS NULL"""
