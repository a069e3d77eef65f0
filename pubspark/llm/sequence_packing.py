"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Documents are tokenized, ended by id 0, and cut only where longer than a sequence. The instance
that is packed is the histogram of piece lengths: at most ``capacity`` counts, whatever the
corpus. On it

1. Martello-Toth dominance reduction fixes sets for good, largest length first: a piece that
   nothing fits beside is alone; with the largest other piece that fits it is fixed when the
   two fill the sequence, or when no two pieces fit beside it (then that piece dominates every
   alternative). Each fix shrinks the instance and may allow more.
2. The remainder is packed best-fit decreasing, all pieces of a length and all sequences of
   equal content at a time.

The plan's rows (length, run of ranks, sequences, offset) are joined to the pieces by length and
rank among the pieces of that length. Ranks come from salted runs, so a length held by a third
of all pieces is spread over many tasks.

Defined results: a null text reads as empty and is the single id 0; repeated rows are packed
each on its own; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pubspark.llm.chunk_cache import slices
from pubspark.llm.common import as_batch, materialize, released, small_batches, texts
from pubspark.llm.library_tokens import encoder, split_words

#: A set of pieces that share a sequence: runs of (length, how many), in order of placement.
Content = tuple[tuple[int, int], ...]

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0, chunks: int = 500_000) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids_crc32``. A worker remembers the ids
    of about ``chunks`` words: more take memory, fewer time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path, split_words, chunks)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            ids = [i + end for part in slices(texts(b)) for i in own.encode_all(part)]
            rows = [(d, k, at // 4, min(len(i) - at, 4 * capacity) // 4,
                     zlib.crc32(i[at:at + 4 * capacity]))
                    for d, i in zip(b.column("doc_id").to_pylist(), ids, strict=True)
                    for k, at in enumerate(range(0, len(i), 4 * capacity))]
            if rows:
                yield as_batch(zip(*rows, strict=True), PIECES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        released(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Content, int]], dict[int, int]]:
    """Sets fixed for good, with multiplicities, and the counts that remain."""
    left = {n: c for n, c in counts.items() if c}
    fixed: list[tuple[Content, int]] = []

    def fix(lengths: tuple[int, ...], times: int) -> None:
        runs = ((lengths[0], 2),) if len(lengths) == 2 and lengths[0] == lengths[1] else tuple((n, 1) for n in lengths)
        fixed.append((runs, times))
        for n in lengths:
            left[n] -= times
            if not left[n]:
                del left[n]

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while j in left:
                room = capacity - j
                others = sorted(n for n in left if n <= room and (n != j or left[j] > 1))
                if not others:
                    fix((j,), left[j])
                else:
                    k = others[-1]
                    small = others[0]
                    second = small if left[small] - (small == j) > 1 else next((n for n in others[1:]), capacity + 1)
                    if k != room and small + second <= room:
                        break  # two pieces may fit beside it: nothing is proved
                    fix((j, k), left[j] // 2 if j == k else min(left[j], left[k]))
                changed = True
    return fixed, left


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[Content, int]]:
    """Best-fit decreasing; pieces of a length and sequences of equal content go together."""
    room: dict[int, list[tuple[Content, int]]] = {}
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            best = min((r for r in room if r >= length), default=None)
            if best is None:
                content, times = (), n  # new sequences, as many as are needed
                best = capacity
            else:
                content, times = room[best].pop()
                if not room[best]:
                    del room[best]
            each = best // length
            used = min(times, n // each)
            if used:
                room.setdefault(best - each * length, []).append((content + ((length, each),), used))
                n -= used * each
                rest = times - used
            else:
                room.setdefault(best - n * length, []).append((content + ((length, n),), 1))
                n, rest = 0, times - 1
            if rest and content:
                room.setdefault(best, []).append((content, rest))
    return [p for own in room.values() for p in own]


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Plan rows ``(length, first_rank, end_rank, each, first_sequence, first_offset)``.

    The pieces of ``length`` with ranks from ``first_rank`` to before ``end_rank`` lie ``each``
    to a sequence, side by side from ``first_offset``, in sequences from ``first_sequence``.
    """
    fixed, left = reduce_by_dominance(counts, capacity)
    used = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    for content, times in fixed + best_fit_decreasing(left, capacity):
        offset = 0
        for length, each in content:
            rows.append((length, used[length], used[length] + times * each, each, sequence, offset))
            used[length] += times * each
            offset += each * length
        sequence += times
    assert used == counts, "every piece has one place"
    return rows


def ranked(pieces: DataFrame, total: int, rows_per_run: int = 200_000) -> DataFrame:
    """``rank`` of each piece (from 0) among those of its length; salted runs, then a running
    count over (length, salt)."""
    salts = 64 + total // rows_per_run
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
             .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    run = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (salted.withColumn("rank", F.row_number().over(run) - 1).join(bases, ["length", "salt"])
            .withColumn("rank", F.col("rank") + F.col("base")).drop("salt", "base"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, chunks: int = 500_000) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    with small_batches(spark):
        pieces = materialize(cut_documents(docs, tokenizer_path, capacity, chunks=chunks), "pieces")
    counts = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_packing(counts, capacity),
        "length long, first_rank long, end_rank long, each long, first_sequence long, first_offset long")
    placed = ranked(pieces, sum(counts.values())).alias("p").join(
        F.broadcast(plan).alias("q"),  # its rows are bounded by ``capacity``, not by the corpus
        (F.col("p.length") == F.col("q.length")) & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("end_rank")))
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id", "piece", "start", "p.length", "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("each")).cast("long")).alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("each") * F.col("p.length")).alias("offset"))
