"""Toxicity by maximum-scoring segments of token log-odds.

*Scores.* Over labelled training texts, a word's log-odds between toxic and other texts under an
informative Dirichlet prior (``prior_words`` pseudo-words, dealt out as the words are in all
training texts); a text counts each of its words once, so that a repetitive text does not weigh
more. Word beginnings of 4 to 7 letters are counted likewise, once for each different word, and
stand in for words that are too rare to tell. The posterior shares are gamma quantiles: low for toxic texts, high for the others, so the
log-odds is a lower confidence bound. A word or beginning counts as toxic when that is at least
``min_effect``; the largest bound that applies is a word's score. Every word also costs ``drift``, so that the expected score
of clean text is negative.

*Scan.* The Ruzzo-Tompa algorithm finds all maximal scoring segments of a text in linear time.

*Calibration.* Under extreme-value theory, ``n`` clean words hold a segment of score S or more
about ``n * exp(-lambda * S)`` times, where lambda solves ``sum p(w) exp(lambda * s(w)) = 1`` over
the clean words' shares (the factor K is at most 1, and 1 is used). Segments expected at
most ``most_expected`` times are significant passages. A text's statistic is the sum of
``lambda * S - log(n + 1)`` over them, or the best segment's where none is; a logistic curve,
fitted on training texts that the log-odds have not seen, turns it into the score.

Training uses at most about ``sample_rows`` labelled rows, a hash sample where there are more;
near copies (texts that share the smallest hash of their word triples) count once per
label. The model holds at most ``max_words`` words. Both bounds are parameters; neither
depends on the number of documents.

Defined results: null text reads as empty, has no passages and gets a score; a doc_id with several
labels counts as toxic if one says so; null doc_ids and null labels train nothing; without any
labelled row all words score alike. Rows are scored one by one, so repeated rows give equal
results; other columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubspark.llm.common import as_batch, fresh_name, materialize, texts

_WORD = re.compile(r"[^\W\d_]+")


BEGINNINGS = (7, 6, 5, 4)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a star."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) >= k)]


@dataclass(frozen=True)
class Settings:
    prior_words: float = 500.0
    confidence: float = 2.58
    min_effect: float = 1.5
    drift: float = 0.1
    most_expected: float = 0.05
    sample_rows: int = 200_000
    max_words: int = 50_000
    calibration_folds: int = 4


@dataclass(frozen=True)
class Model:
    scores: dict[str, float] = field(default_factory=dict)
    drift: float = 0.1
    scale: float = 1.0  # lambda
    most_expected: float = 0.05
    slope: float = 1.0
    offset: float = 0.0

    def word_score(self, word: str) -> float:
        """The largest score of the word and its beginnings, 0 without one."""
        get = self.scores.get
        best = get(word, 0.0)
        if len(word) >= 4:
            for k in BEGINNINGS:
                best = max(best, get(word[:k] + "*", 0.0))
        return best


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a text, by Ruzzo and Tompa.

    ``hits``: positions and scores of the words that score above 0; all others cost ``drift``.
    Each candidate keeps the sum before it, the sum at its end, and a link to the nearest
    earlier candidate with a smaller sum before it, so that no candidate is passed over twice.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, last, before, after, link
    total, at = 0.0, 0
    for place, score in hits:
        total -= drift * (place - at)
        at = place + 1
        first, before = place, total
        total += score
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                break
            first, before, link = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = link
        found.append((first, place, before, total, j))
    return [(a, b, after - before) for a, b, before, after, _ in found]


def passages(words: list[str], model: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """The text's statistic and its significant passages (first word, last word, score)."""
    score = model.word_score
    toxic = {w: s for w in set(words) if (s := score(w)) > 0}
    hits = [(i, toxic[w]) for i, w in enumerate(words) if w in toxic] if toxic else []
    size = math.log(len(words) + 1)
    if not hits:
        return -size, []
    found = [(a, b, s, model.scale * s - size) for a, b, s in segments(hits, model.drift)]
    sure = [x for x in found if x[3] >= -math.log(model.most_expected)]
    statistic = sum(x[3] for x in sure) if sure else max(x[3] for x in found)
    return statistic, [x[:3] for x in sure]


def probability(statistic: float, model: Model) -> float:
    z = model.slope * statistic + model.offset
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """``toxic, text, fold`` of labelled training documents, near copies once per label."""
    known = (labels.select(F.col("doc_id").cast("long"), "toxic")
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                     & ~is_held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n = known.count()
    if n > settings.sample_rows:
        share = int(settings.sample_rows / n * (1 << 30))
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    # at most about ``sample_rows`` rows of two numbers
    own = (docs.select(F.col("doc_id").cast("long"), "text").filter(~is_held_out(F.col("doc_id")))
           .join(F.broadcast(known), "doc_id").select("toxic", "text"))
    schema = pa.schema([("toxic", pa.int32()), ("text", pa.string()), ("key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield as_batch([b.column("toxic"), b.column("text"), list(map(copy_key, texts(b)))], schema)

    keyed = own.mapInArrow(run, "toxic int, text string, key long")
    return (keyed.groupBy("toxic", "key").agg(F.min("text").alias("text"))
            .withColumn("fold", F.pmod(F.xxhash64("key"), F.lit(settings.calibration_folds))))


def copy_key(text: str) -> int:
    """The smallest hash of the text's word triples; near copies mostly share it."""
    w = words_of(text)
    return min((xxhash.xxh64_intdigest(" ".join(w[i:i + 3])) >> 1 for i in range(max(1, len(w) - 2))))


def word_counts(train: DataFrame) -> DataFrame:
    """``word, clean, toxic``: training texts that hold the word, by label, summed per task before
    the shuffle."""
    schema = pa.schema([("word", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for label in (0, 1):
                counts: Counter[str] = Counter()
                for t, x in zip(texts(b), b.column("toxic").to_pylist(), strict=True):
                    if int(x > 0) == label:
                        for w in set(words_of(t)):
                            counts.update(features(w))
                yield as_batch([list(counts), [label] * len(counts), list(counts.values())], schema)

    rows = train.select("toxic", "text").mapInArrow(run, "word string, toxic int, n long")
    by = [F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)).alias(n) for k, n in ((0, "clean"), (1, "toxic"))]
    return rows.groupBy("word").agg(*by)


def gamma_quantile(shape: Column, z: float) -> Column:
    """Quantile of the gamma law at normal deviate ``z`` (Wilson and Hilferty's cube), 0 at least."""
    root = 1 - 1 / (9 * shape) + z / (3 * F.sqrt(shape))
    return shape * F.pow(F.greatest(root, F.lit(0.0)), 3) if z < 0 else shape * F.pow(F.greatest(root, F.lit(1.0)), 3)


def log_odds(counts: DataFrame, settings: Settings) -> tuple[dict[str, tuple[float, int]], int]:
    """Toxic words with their score and the clean texts that hold them; the sum of the latter over
    all words."""
    total = counts.filter(~F.col("word").endswith("*")).agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).first()
    clean, toxic = total["clean"] or 0, total["toxic"] or 0
    if not clean or not toxic:
        return {}, clean
    a0 = settings.prior_words
    prior = a0 * (F.col("clean") + F.col("toxic")) / (clean + toxic)
    low = gamma_quantile(F.col("toxic") + prior, -settings.confidence) / (toxic + a0)
    high = gamma_quantile(F.col("clean") + prior, settings.confidence) / (clean + a0)
    bound = F.log(F.greatest(low, F.lit(1e-12))) - F.log(high)
    rows = (counts.filter(F.col("toxic") > 1).withColumn("score", bound)
            .filter(F.col("score") >= settings.min_effect)
            .orderBy(F.col("score").desc(), "word").limit(settings.max_words).collect())
    return {r["word"]: (r["score"], r["clean"]) for r in rows}, clean


def solve_scale(scores: dict[str, tuple[float, int]], clean: int, drift: float) -> float:
    """Lambda of the extreme-value law for clean words (bisection); half an unseen word is added
    to each toxic word's count."""
    if not scores:
        return 1.0
    shares = [(s - drift, (n + 0.5) / (clean + 1)) for s, n in scores.values()]
    rest = max(1e-9, 1 - sum(p for _, p in shares))
    low, high = 0.0, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        value = rest * math.exp(-mid * drift) + sum(p * math.exp(min(600.0, mid * s)) for s, p in shares)
        low, high = (mid, high) if value < 1 else (low, mid)
    return max(low, 0.05)


def fit_curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic curve through ``(statistic, clean, toxic)`` counts; Newton
    steps from, and a weak pull towards, slope 1 and offset -2."""
    a, b = 1.0, -2.0
    for _ in range(50):
        ga, gb, haa, hab, hbb = a - 1.0, b + 2.0, 1.0, 0.0, 1.0
        for x, n0, n1 in bins:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * x + b))))
            e, w = (n0 + n1) * p - n1, (n0 + n1) * p * (1 - p)
            ga, gb, haa, hab, hbb = ga + e * x, gb + e, haa + w * x * x, hab + w * x, hbb + w
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2 / (abs(da) + abs(db) + 1e-12))
        a, b = max(0.01, a - step * da), b - step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on the labelled documents that are not held out."""
    train = materialize(training_texts(docs, labels, settings), "toxic-train")
    counts = materialize(word_counts(train.filter("fold <> 0")), "toxic-words")
    scores, clean = log_odds(counts, settings)
    model = Model({w: s - settings.drift for w, (s, _) in scores.items()}, settings.drift,
                  solve_scale(scores, clean, settings.drift), settings.most_expected)
    schema = pa.schema([("toxic", pa.int32()), ("x", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [passages(words_of(t), model)[0] for t in texts(b)]
            yield as_batch([b.column("toxic"), [round(max(-20.0, min(30.0, v)), 1) for v in x]], schema)

    # one row per tenth of the statistic's range, however many texts there are
    bins = (train.filter("fold = 0").select("toxic", "text").mapInArrow(run, "toxic int, x double")
            .groupBy("x").agg(F.sum((F.col("toxic") <= 0).cast("long")).alias("clean"),
                              F.sum((F.col("toxic") > 0).cast("long")).alias("toxic"))
            .orderBy("x").collect())
    slope, offset = fit_curve([(r["x"], r["clean"], r["toxic"]) for r in bins])
    return Model(model.scores, model.drift, model.scale, model.most_expected, slope, offset)


REPORT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()),
                    ("passages", pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()),
                                                     ("score", pa.float64())])))])


def toxicity_report(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted`` and its significant ``passages``
    (word positions from 0, last included). One narrow stage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("first_word", "last_word", "score")
        for b in batches:
            found = [passages(words_of(t), model) for t in texts(b)]
            score = [probability(x, model) for x, _ in found]
            yield as_batch([b.column("doc_id"), score, [int(s >= threshold) for s in score],
                            [[dict(zip(names, p, strict=True)) for p in ps] for _, ps in found]], REPORT)

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int, "
             "passages array<struct<first_word: long, last_word: long, score: double>>")
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "passages")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text scores below the threshold."""

    @F.pandas_udf("boolean")
    def clean(text):
        return text.map(lambda t: probability(passages(words_of(t or ""), model)[0], model) < threshold)

    flag = fresh_name(docs, "clean")
    return docs.withColumn(flag, clean(F.col("text"))).filter(F.col(flag)).drop(flag)
