"""Mixing sources to target weights: an exact plan of blocks, split over output shards.

The words of a source's documents lie on one line, in an order that a hash fixes, and the line is cut
into blocks of ``block_words`` words (the last may be shorter). A source gives whole rounds of all its
blocks and, in a last round, so many blocks that its taken words equal its target, rounded; the last
block drawn is cut for that. No round gives a block twice, so a word is taken at most three times.

Method (multivariate-hypergeometric splitting tree): the root holds every source's quota of blocks. A
node splits its quotas between the left and the right half of its output shards as drawing the left
half's blocks blindly from all of them would (hypergeometric, source by source, given the ones before),
so that every shard gets its exact number of blocks, every source gives its exact quota, and shards
differ as random draws do. Each node has its own seed, is split in one task, and hands its children the
first draw of every source, so the tree needs no sums over shards. A leaf's draws ``first .. first +
quota`` of a source are places in a permutation of the blocks (a Feistel network on the block numbers,
new keys each round): shards draw disjoint permuted blocks without seeing each other, and a document
finds the draws of its blocks by the inverse. A shard's pieces are then shuffled locally.

Bounds: a node is one row per source (targets need all sources together too); a shard holds
``shard_words`` words; places on the lines come from sums over hashed groups of about ``group_words``
words, and one task sees the groups of a source, not its documents. Nothing is collected on the driver.
Only the hash of its text tells documents with equal ids apart; texts travel only for ``mixed_texts``.

Defined results: a null text has size 0; sources are ordered by code point, a null source is one of
its own, last; rows equal in ``doc_id``, ``source`` and text are one document; documents of size 0 are
returned with nothing taken; a table without rows gives no rows; very long texts span many blocks;
other columns are not read. Reruns agree, also for other partitions of the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubspark.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_TIMES = 3


@dataclass(frozen=True)
class Settings:
    block_words: int = 128
    shard_words: int = 1 << 20
    group_words: int = 1 << 20
    fan_out: int = 64
    seed: int = 7


DEFAULTS = Settings()
_MASK = (1 << 64) - 1


def targets(sizes: np.ndarray, weights=WEIGHTS, most_times: int = MOST_TIMES) -> np.ndarray:
    """Words wanted of each source: shares of all sizes by repeating weights, at most ``most_times`` a
    source's size, the excess shared out again by weight until none is above."""
    weight = np.resize(np.asarray(weights, float), len(sizes))
    most, out = most_times * sizes.astype(float), np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    while free.any():
        out[free] = (sizes.sum() - out[~free].sum()) * weight[free] / weight[free].sum()
        above = free & (out > most)
        if not above.any():
            break
        out[above] = most[above]
        free &= ~above
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix (public splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Permutation:
    """A pseudo-random permutation of ``0 .. n - 1`` for each key: four Feistel rounds on the next
    power of four, walked until the value lies inside."""

    def __init__(self, n: np.ndarray, key: np.ndarray):
        self.n = n.astype(np.uint64)
        bits = np.ceil(np.log2(np.maximum(self.n, 2).astype(float)) / 2 + 1e-9).astype(np.uint64)
        self.half = np.maximum(bits, np.uint64(1))
        self.mask = (np.uint64(1) << self.half) - np.uint64(1)
        self.key = key.astype(np.uint64)

    def _take(self, at) -> Permutation:
        part = object.__new__(Permutation)
        part.n, part.half, part.mask, part.key = self.n[at], self.half[at], self.mask[at], self.key[at]
        return part

    def _rounds(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for r in reversed(range(4)) if back else range(4):
            if back:
                left, right = right ^ (_mixed(left ^ _mixed(self.key + np.uint64(r))) & self.mask), left
            else:
                left, right = right, left ^ (_mixed(right ^ _mixed(self.key + np.uint64(r))) & self.mask)
        return left << self.half | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = self._rounds(x.astype(np.uint64), back)
            outside = np.flatnonzero(out >= self.n)
            while len(outside):
                out[outside] = self._take(outside)._rounds(out[outside], back)
                outside = outside[out[outside] >= self.n[outside]]
        return out.astype(np.int64)

    def block(self, place: np.ndarray) -> np.ndarray:
        return self._walk(place, False)

    def place(self, block: np.ndarray) -> np.ndarray:
        return self._walk(block, True)


def _round_key(seed: int, number: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(number.astype(np.uint64) ^ np.uint64(seed & _MASK)) + turn.astype(np.uint64))


def source_plan(sources: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    """One row per source, in their order: its number, target, blocks, quota of draws, and the words of
    the last draw."""
    null = sources["source"].isna()
    sources = pd.concat([sources[~null].sort_values("source", key=lambda s: s.map(lambda t: t.encode())), sources[null]])
    size = sources["source_size"].to_numpy(np.int64)
    target = targets(size)
    wanted, width = np.rint(target).astype(np.int64), settings.block_words
    blocks = -(-size // width)
    turns, rest = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    np.floor_divide(wanted, size, out=turns, where=size > 0)
    np.remainder(wanted, size, out=rest, where=size > 0)
    extra = -(-rest // width)
    number = np.arange(len(size))
    # The source's last block may be short; if it is among the extra ones, they may hold too little.
    last = Permutation(np.maximum(blocks, 1), _round_key(settings.seed, number, turns)).place(np.maximum(blocks - 1, 0))
    missing = blocks * width - size
    holds = extra * width - np.where(last < extra, missing, 0)
    extra += holds < rest
    holds = extra * width - np.where(last < extra, missing, 0)
    last_width = np.where(last == extra - 1, width - missing, width)
    return pd.DataFrame({
        "source": sources["source"].to_numpy(object), "source_size": size, "number": number, "target": target,
        "blocks": blocks, "quota": turns * blocks + extra, "last_words": last_width - np.where(rest > 0, holds - rest, 0)})


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws are good; above a thousand million the law's normal limit."""
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    share = good / (good + bad)
    spread = np.sqrt(n * share * (1 - share) * (good + bad - n) / max(1, good + bad - 1))
    return int(min(high, max(low, round(rng.normal(n * share, spread)))))


def split_node(numbers: np.ndarray, first: np.ndarray, quota: np.ndarray, low: int, high: int, shards: int,
               draws: int, width: int, seed: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """The node's descendants of at most ``width`` shards: ``low, high``, numbers, firsts and quotas."""
    if high - low <= width:
        yield low, high, numbers, first, quota
        return
    middle = (low + high) // 2
    rng = np.random.default_rng([seed, low, high])
    n = middle * draws // shards - low * draws // shards
    rest, left = int(quota.sum()), np.zeros_like(quota)
    for k, q in enumerate(quota.tolist()):
        rest -= q
        left[k] = _hypergeometric(rng, q, rest, n)
        n -= int(left[k])
    for a, b, f, q in ((low, middle, first, left), (middle, high, first + left, quota - left)):
        some = q > 0
        yield from split_node(numbers[some], f[some], q[some], a, b, shards, draws, width, seed)


def _split(width: int, shards: int, draws: int, settings: Settings):
    def run(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values("number")
        low, high = int(node["low"].iloc[0]), int(node["high"].iloc[0])
        out = [pd.DataFrame({"low": a, "high": b, "number": number, "first": first, "quota": quota})
               for a, b, number, first, quota in split_node(
                   *(node[c].to_numpy(np.int64) for c in ("number", "first", "quota")),
                   low, high, shards, draws, width, settings.seed)]
        return pd.concat(out)
    return run


def shard_quotas(plan: DataFrame, shards: int, draws: int, settings: Settings) -> DataFrame:
    """``number, shard, first, quota``: the leaves of the splitting tree over ``draws`` blocks in all."""
    ddl = "low long, high long, number long, first long, quota long"
    nodes = plan.filter("quota > 0").select(
        F.lit(0).cast("long").alias("low"), F.lit(shards).cast("long").alias("high"), "number",
        F.lit(0).cast("long").alias("first"), "quota")
    width = shards
    while width > 1:
        width = -(-width // settings.fan_out)
        nodes = nodes.groupBy("low", "high").applyInPandas(_split(width, shards, draws, settings), ddl)
    return nodes.select("number", F.col("low").alias("shard"), "first", "quota")


def _draws(settings: Settings, step: int = 1 << 18):
    """Rows of taken pieces for documents on their source's line, ``step`` blocks at a time."""
    width = settings.block_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, size, number, blocks, quota, last = (
                b.column(c).to_numpy() for c in ("start", "size", "number", "blocks", "quota", "last_words"))
            begin = start // width
            touched = np.where(size > 0, (start + size - 1) // width - begin + 1, 0)
            upto = np.cumsum(touched)
            turns = int((-(-quota // np.maximum(blocks, 1))).max(initial=0))
            for low in range(0, int(upto[-1]) if len(upto) else 0, step):
                at = np.arange(low, min(low + step, int(upto[-1])))
                doc = np.searchsorted(upto, at, side="right")
                block = begin[doc] + at - (upto[doc] - touched[doc])
                for turn in range(turns):
                    order = Permutation(blocks[doc], _round_key(settings.seed, number[doc], np.full(len(doc), turn)))
                    draw = turn * blocks[doc] + order.place(block)
                    room = np.where(draw == quota[doc] - 1, last[doc], width)
                    a = np.maximum(start[doc], block * width)
                    z = np.minimum(start[doc] + size[doc], block * width + room)
                    some = (draw < quota[doc]) & (z > a)
                    rows = pa.array(doc[some])
                    yield pa.RecordBatch.from_arrays(
                        [b.column(c).take(rows) for c in ("doc_id", "source", "text_hash", "number")]
                        + [pa.array(v[some]) for v in (draw, a - start[doc], z - a)],
                        ["doc_id", "source", "text_hash", "number", "draw", "first_word", "n_words"])
    return run


@dataclass(frozen=True)
class Mixture:
    """``documents``: one row each with its source's size and target. ``pieces``: the taken runs of
    words with their shard and place in it; a document and draw appear at most once."""

    documents: DataFrame
    pieces: DataFrame


def mix(docs: DataFrame, settings: Settings = DEFAULTS) -> Mixture:
    """The mixture of ``docs`` (``doc_id``, ``text``, ``source``); see the module."""
    sized = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                    F.xxhash64("text").alias("text_hash")).distinct(), "sized")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan_ddl = "source string, source_size long, number long, target double, blocks long, quota long, last_words long"
    plan = materialize(by_source.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        lambda s: source_plan(s, settings), plan_ddl), "plan")

    # Places on the lines: sums within hashed groups of bounded size, and over the groups of a source.
    grouped = (sized.withColumnRenamed("source", "s").join(plan, F.col("s").eqNullSafe(plan.source)).drop("s")
               .withColumn("rank", F.xxhash64(F.lit(settings.seed), "doc_id", "text_hash"))
               .withColumn("group", F.pmod(F.xxhash64("rank"), F.floor(F.col("source_size") / settings.group_words) + 1)))
    groups = (grouped.groupBy("number", "group").agg(F.sum("size").alias("held"))
              .withColumn("offset", F.sum("held").over(Window.partitionBy("number").orderBy("group")) - F.col("held"))
              .select(F.col("number").alias("of"), F.col("group").alias("g"), "offset"))
    line = Window.partitionBy("number", "group").orderBy("rank", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = materialize(
        grouped.withColumn("before", F.coalesce(F.sum("size").over(line), F.lit(0)))
        .join(groups, (F.col("number") == F.col("of")) & (F.col("group") == F.col("g")))
        .withColumn("start", F.col("before") + F.col("offset"))
        .select("doc_id", "source", "text_hash", "size", "source_size", "target", "number", "blocks", "quota", "last_words", "start"),
        "placed")

    words, draws = plan.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("quota"), F.lit(0))).first()
    shards = max(1, -(-words // settings.shard_words))
    quotas = materialize(shard_quotas(plan, shards, draws, settings), "quotas")
    # A draw meets its shard by an equal key: the run of draws it lies in, as long as a shard's usual share.
    per_run = plan.select(F.col("number").alias("n"), F.greatest(F.lit(1), F.ceil(F.col("quota") / shards)).alias("run"))
    ranges = (quotas.join(per_run, F.col("number") == F.col("n"))
              .select(F.col("number").alias("of"), "shard", F.col("first").alias("low"),
                      (F.col("first") + F.col("quota")).alias("high"),
                      F.explode(F.sequence(F.floor(F.col("first") / F.col("run")),
                                           F.floor((F.col("first") + F.col("quota") - 1) / F.col("run")))).alias("stretch")))
    drawn = placed.mapInArrow(_draws(settings), "doc_id long, source string, text_hash long, number long, draw long, "
                                                "first_word long, n_words long")
    pieces = (drawn.join(per_run, F.col("number") == F.col("n"))
              .withColumn("in_run", F.floor(F.col("draw") / F.col("run")))
              .join(ranges, (F.col("number") == F.col("of")) & (F.col("in_run") == F.col("stretch"))
                    & (F.col("draw") >= F.col("low")) & (F.col("draw") < F.col("high")))
              .select("shard", F.xxhash64(F.lit(settings.seed + 1), "number", "draw", "doc_id", "text_hash").alias("place"),
                      "doc_id", "source", "text_hash", "draw", "first_word", "n_words"))
    return Mixture(placed.select("doc_id", "source", "text_hash", "size", "source_size", "target"), pieces)


def mixed_texts(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """``shard, place, doc_id, source, text``: the pieces as texts, words as they stand with the white
    space between them, each shard in its shuffled order."""
    key = ("doc_id", "source", "text_hash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text",
                        F.xxhash64("text").alias("text_hash")).dropDuplicates(key)
    same = None
    left, right = mixture.pieces.alias("p"), texts.alias("t")
    for c in key:
        term = F.col(f"p.{c}").eqNullSafe(F.col(f"t.{c}"))
        same = term if same is None else same & term
    rows = left.join(right, same).select("shard", "place", "p.doc_id", "p.source", "first_word", "n_words", "text")
    ddl = "shard long, place long, doc_id long, source string, text string"
    return (rows.mapInPandas(_cut_texts, ddl).repartition("shard").sortWithinPartitions("shard", "place"))


def _cut_texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    word = re.compile(WORD)
    for f in frames:
        cut = []
        for text, first, n in zip(f["text"], f["first_word"], f["n_words"], strict=True):
            spans = [m.span() for m in word.finditer(text)][first:first + n]
            cut.append(text[spans[0][0]:spans[-1][1]])
        yield f.assign(text=cut)[["shard", "place", "doc_id", "source", "text"]]


def taken_words(docs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every document."""
    mixture = mix(docs, settings)
    taken = mixture.pieces.groupBy("doc_id", "source", "text_hash").agg(F.sum("n_words").alias("taken"))
    key = ("doc_id", "source", "text_hash")
    d, t = mixture.documents.alias("d"), taken.alias("t")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in key]
    return (d.join(t, same[0] & same[1] & same[2], "left")
            .select("d.doc_id", "d.source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))
