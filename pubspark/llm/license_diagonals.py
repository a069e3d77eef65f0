r"""License scan by diagonal voting, in DataFrame operations only.

Texts are lower-cased in A-Z; a word is a run of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``. All rolling
word triples of all texts are hashed and joined to the triples of the license templates (a fixed
table of a few hundred rows), and the words themselves are compared, so a hit is a true one. A
hit of text position p on template position t votes for the diagonal p - t. Votes are
summed per text, template and diagonal; diagonals at most ``MAX_GAP`` apart (words put in or left
out) are merged; a merged span is verified when it holds ``MIN_PCT`` per cent of the template's
triples, ``MIN_TRIPLES`` or all of them at least, in a stretch not over twice the template's length;
neighbouring diagonals that make a longer stretch are several places and are verified one by one.

Base places are unmerged diagonals that hold every triple of a base phrase: its words stand there
consecutively.

Defined results: null text reads as empty; texts without a place have counts of 0, null first and
last words, empty labels and score 0; repeated rows get equal results, each its own row; an empty
table gives no rows; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pubspark.llm.common import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
K = 3
MAX_GAP = 3
MIN_PCT = 60
MIN_TRIPLES = 4

#: FIXED VALUES: the base phrases and their labels.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
#: FIXED VALUES: further texts by which licenses are recognised.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file "
                 "except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "creative commons attribution 4 0 international"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc0", "cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def template_triples() -> list[tuple]:
    """``(template, label, base, triples, t, a, b, c)``: every triple of every template."""
    rows = []
    for k, (label, text) in enumerate(BASE + TEMPLATES):
        w = text.split()
        n = len(w) - K + 1
        rows += [(k, label, k < len(BASE), n, t, *w[t:t + K]) for t in range(n)]
    return rows


def _words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1))


def _needed(triples: Column) -> Column:
    """Triples that a verified span must hold."""
    return F.greatest(F.ceil(triples * MIN_PCT / 100), F.least(triples, F.lit(MIN_TRIPLES)))


def _own_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def find_hits(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Distinct ``(doc_id, own, p, template, t, ...)``: triple p of the text is triple t of the
    template."""
    w = F.col("w")
    zipped = F.arrays_zip(w.alias("a"), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))).alias("b"),
                          F.slice(w, 3, F.greatest(F.size(w), F.lit(1))).alias("c"))
    rolled = (docs.select("doc_id", _own_hash(F.col("text")).alias("own"), _words(F.col("text")).alias("w"))
              .filter(F.size("w") >= K)
              .select("doc_id", "own", F.posexplode(zipped).alias("p", "g"))
              .select("doc_id", "own", "p", "g.*").toDF("doc_id", "own", "p", "x", "y", "z")
              .withColumn("h", F.xxhash64("x", "y", "z")))
    keyed = templates.withColumn("h", F.xxhash64("a", "b", "c"))
    same = ((F.col("x") == F.col("a")) & (F.col("y") == F.col("b")) & (F.col("z") == F.col("c")))
    return (rolled.join(F.broadcast(keyed), "h").filter(same)  # the templates are a fixed table
            .select("doc_id", "own", "p", "template", "label", "base", "triples", "t").distinct())


def diagonals(hits: DataFrame) -> DataFrame:
    """Votes per text, template and diagonal."""
    return (hits.withColumn("diagonal", F.col("p") - F.col("t"))
            .groupBy("doc_id", "own", "template", "label", "base", "triples", "diagonal")
            .agg(F.count(F.lit(1)).alias("votes"), F.min("p").alias("first"), F.max("p").alias("last")))


def verified_spans(votes: DataFrame) -> DataFrame:
    """``doc_id, own, label, base, first, last, coverage`` of merged and verified spans (last:
    the span's last word)."""
    by = Window.partitionBy("doc_id", "own", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > MAX_GAP, F.lit(True))
    run = Window.partitionBy("doc_id", "own", "template", "run")
    # A run longer than two templates holds several: each of its diagonals stands by itself.
    several = F.max("last").over(run) - F.min("first").over(run) + K > 2 * (F.col("triples") + K - 1)
    runs = (votes.withColumn("new", new.cast("int"))
            .withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("alone", F.when(several, F.col("diagonal")))
            .groupBy("doc_id", "own", "template", "label", "base", "triples", "run", "alone")
            .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last")))
    kept = F.least("votes", "triples")
    return (runs.filter(kept >= _needed(F.col("triples")))
            .select("doc_id", "own", "label", "base", "first", (F.col("last") + K - 1).alias("last"),
                    (kept / F.col("triples")).alias("coverage")))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(labels)), ",")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score`` (the largest verified coverage)."""
    spark: SparkSession = docs.sparkSession
    templates = spark.createDataFrame(
        template_triples(), "template int, label string, base boolean, triples int, t int, a string, "
                            "b string, c string")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    votes = materialize(diagonals(find_hits(docs, templates)), "license-votes")  # read three times
    whole = F.col("base") & (F.col("votes") == F.col("triples"))
    places = votes.filter(whole).select(
        "doc_id", "own", "label", F.lit(True).alias("place"), F.col("diagonal").alias("at"), F.lit(1.0).alias("coverage"))
    spans = verified_spans(votes.filter(~F.col("base"))).select(
        "doc_id", "own", "label", F.lit(False).alias("place"), F.col("first").alias("at"), "coverage")
    at_place = F.when(F.col("place"), F.col("at"))
    found = (places.unionByName(spans).groupBy("doc_id", "own")
             .agg(F.count(at_place).alias("n_base"), F.min(at_place).cast("long").alias("first_word"),
                  F.max(at_place).cast("long").alias("last_word"),
                  _joined(F.when(F.col("place"), F.col("label"))).alias("base_labels"),
                  _joined(F.col("label")).alias("labels"), F.max("coverage").alias("score")))
    counted = docs.select("doc_id", _own_hash(F.col("text")).alias("own"),
                          F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    joined = counted.alias("d").join(
        found.alias("f"), (F.col("d.own") == F.col("f.own")) & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")), "left")
    return joined.select(
        "d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def scan_sql(table: str = "documents") -> str:
    """DuckDB SQL for :func:`scan_licenses`: phrases are looked up word by word."""
    def quoted(v) -> str:
        return "'" + v + "'" if isinstance(v, str) else str(v)

    values = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in template_triples())
    return rf"""
WITH templates(template, label, base, triples, t, a, b, c) AS (VALUES {values}),
docs AS (SELECT row_number() OVER () AS r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
         FROM {table}),
places AS (SELECT r, w, unnest(range(1, greatest(len(w) - {K - 2}, 1))) AS i FROM docs),
hits AS (SELECT r, i - 1 AS p, templates.* FROM places
         JOIN templates ON w[i] = a AND w[i + 1] = b AND w[i + 2] = c),
votes AS (SELECT r, template, label, base, triples, p - t AS diagonal, count(*) AS votes,
                 min(p) AS first, max(p) AS last
          FROM hits GROUP BY ALL),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER by_diagonal <= {MAX_GAP} THEN 0 ELSE 1 END AS new
           FROM votes WHERE NOT base
           WINDOW by_diagonal AS (PARTITION BY r, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM marked),
runs AS (SELECT r, label, triples, sum(votes) AS votes
         FROM (SELECT *, CASE WHEN max(last) OVER w - min(first) OVER w + {K} > 2 * (triples + {K - 1})
                         THEN diagonal END AS alone
               FROM numbered WINDOW w AS (PARTITION BY r, template, run))
         GROUP BY r, template, label, triples, run, alone),
found AS (
  SELECT r, label, diagonal AS spot, true AS place, 1.0::DOUBLE AS coverage FROM votes
  WHERE base AND votes = triples
  UNION ALL
  SELECT r, label, NULL, false, least(votes, triples)::DOUBLE / triples FROM runs
  WHERE least(votes, triples) >= greatest(ceil(triples * {MIN_PCT} / 100.0), least(triples, {MIN_TRIPLES}))),
per_doc AS (
  SELECT r, count(spot) AS n_base, min(spot) AS first_word, max(spot) AS last_word,
         coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE place), '') AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(coverage) AS score
  FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN per_doc USING (r)"""
