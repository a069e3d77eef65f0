"""Vector code compression: four code bytes for a vector, one for each quarter of its components.

Components become integers, a vector is cut into equal parts, and each part position has a codebook
of at most 256 entries that some rounds of assigning and averaging improve; all arithmetic is exact.

Method (lexicographic trie over distinct parts): the distinct parts of a position, sorted component
by component and spread over tasks by ranges, are the leaves of a trie whose inner nodes are common
prefixes. A task walks its part of the trie depth first. A node holds the squared distances from its
prefix to all entries, added up over the components so far; its children start from that vector and
add one component's distances, so a prefix that many parts share is computed once. Subtrees of one
leaf are finished together, their remaining components in one step. At a leaf the smallest distance
(ties: lowest index) gives the entry, to which the part adds its components times its count.

What travels: the integers of a vector once to group its distinct parts, sums of at most 256 entries
a position from each task in each round, and the vectors' parts once more at the end, sorted with
their row number so that a part that very many rows share is dealt over several tasks. Codebooks pass
through the driver: 256 entries at most for each length of vectors.

Defined results: vectors that are null or hold a null or non-finite component are dropped; vectors of
different lengths are coded apart, each length with its own codebooks; if parts cannot be equal the
first ones are longer by one, and parts without components have code 00 and distance 0; fewer than
256 vectors give fewer entries; equal ``vec_id`` are taken in the order of their vectors, a null
``vec_id`` comes last; repeated rows count and return each time; no vectors give no rows; other
columns are not read. A component of 2**17 or more in size raises an error, because the sums might
leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubspark.llm.common import as_batch, materialize

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LARGEST = SCALE * 2**17

#: Codebooks of one length of vectors: an integer matrix (entries, components) for each part.
Books = dict[int, list[np.ndarray]]


def integers(vector: Column) -> Column:
    """The components times ``SCALE``, rounded down; null if the vector is null or has a component
    that is null or not finite."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    large = F.exists(whole, lambda x: F.abs(x) >= LARGEST / SCALE)
    return (F.when(vector.isNull() | odd, None)
            .when(large, F.raise_error(F.lit("a component is too large for exact 64-bit distances")))
            .otherwise(F.transform(whole, lambda x: F.floor(x * SCALE).cast("int"))))


def bounds(length: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin, and its length."""
    sizes = [length // parts + (p < length % parts) for p in range(parts)]
    return [sum(sizes[:p]) for p in range(parts + 1)]


def cut(vector: str = "vector", parts: int = PARTS) -> Column:
    """Structs ``position, part`` of a vector."""
    n = F.size(vector)
    size = [F.floor(n / parts) + F.when(n % parts > p, 1).otherwise(0) for p in range(parts)]
    start = [sum(size[:p], F.lit(1)) for p in range(parts)]
    return F.array(*[F.struct(F.lit(p).alias("position"), F.slice(vector, start[p].cast("int"), size[p].cast("int")).alias("part"))
                     for p in range(parts)])


def walk(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each leaf and its squared distance, by a depth-first walk of the trie of the
    sorted ``leaves`` (integer rows). Equal neighbours are one leaf."""
    count, depth = leaves.shape
    entry, distance = np.zeros(count, np.int64), np.zeros(count, np.int64)
    if not depth:
        return entry, distance
    most = max(int(np.abs(leaves).max(initial=0)), int(np.abs(book).max(initial=0)))
    # Doubles hold these integers exactly and multiply fast; beyond their range 64-bit integers do.
    kind = np.float64 if depth * 4 * (most + 1) ** 2 < 2**52 else np.int64
    x, e = leaves.astype(kind), book.astype(kind)
    tail_squares = np.cumsum((e * e)[:, ::-1], axis=1)[:, ::-1]
    stack = [(0, count, 0, np.zeros(len(e), kind))]
    while stack:
        low, high, at, reached = stack.pop()
        if at == depth:  # equal rows
            entry[low:high] = best = int(reached.argmin())
            distance[low:high] = int(reached[best])
            continue
        cuts = np.flatnonzero(x[low + 1:high, at] != x[low:high - 1, at]) + low + 1
        first, last = np.r_[low, cuts], np.r_[cuts, high]
        single = first[last - first == 1]
        for some in np.array_split(single, max(1, -(-len(single) // 1024))):
            if len(some):
                rest = x[some, at:]
                all_of = reached + (rest * rest).sum(axis=1)[:, None] - 2 * (rest @ e[:, at:].T) + tail_squares[:, at]
                entry[some] = best = all_of.argmin(axis=1)
                distance[some] = all_of[np.arange(len(some)), best]
        for a, b in zip(first[last - first > 1], last[last - first > 1], strict=True):
            step = x[a, at] - e[:, at]
            stack.append((int(a), int(b), at + 1, reached + step * step))
    return entry, distance


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, slice, np.ndarray]]:
    """Runs of one length and position in a sorted batch, with their parts as a matrix."""
    length, position = (batch.column(c).to_numpy() for c in ("length", "position"))
    edges = np.flatnonzero(np.diff(length) | np.diff(position)) + 1
    for low, high in zip(np.r_[0, edges], np.r_[edges, len(length)], strict=True):
        if high > low:
            part = batch.column("part").slice(low, high - low)
            yield (int(length[low]), int(position[low]), slice(int(low), int(high)),
                   part.flatten().to_numpy().astype(np.int64).reshape(high - low, -1))


def _sums(books: Books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            n = b.column("n").to_numpy()
            for length, position, rows, leaves in _groups(b):
                book = books[length][position]
                entry, _ = walk(leaves, book)
                add = np.c_[leaves * n[rows, None], n[rows]]
                held = total.setdefault((length, position), np.zeros((len(book), leaves.shape[1] + 1), np.int64))
                np.add.at(held, entry, add)
        for (length, position), held in total.items():
            used = np.flatnonzero(held[:, -1])
            entry, component = np.repeat(used, held.shape[1]), np.tile(np.arange(held.shape[1]), len(used))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(entry), v), t) for v, t in ((length, pa.int32()), (position, pa.int32()))]
                + [pa.array(entry, pa.int32()), pa.array(component, pa.int32()), pa.array(held[used].ravel())],
                ["length", "position", "entry", "component", "total"])
    return run


def _improved(books: Books, parts: DataFrame) -> Books:
    """The books after one round: each used entry becomes the mean of its parts, rounded down."""
    rows = (parts.mapInArrow(_sums(books), "length int, position int, entry int, component int, total long")
            .groupBy("length", "position", "entry", "component").agg(F.sum("total").alias("total")).collect())
    new = {length: [b.copy() for b in bs] for length, bs in books.items()}
    counts = {r[:3]: r.total for r in rows if r.component == books[r.length][r.position].shape[1]}
    for r in rows:
        if r.component < new[r.length][r.position].shape[1]:
            new[r.length][r.position][r.entry, r.component] = r.total // counts[r[:3]]
    return new


def _codes(books: Books):
    schema = pa.schema([("row", pa.int64()), ("position", pa.int32()), ("entry", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for length, position, rows, leaves in _groups(b):
                entry, distance = walk(leaves, books[length][position])
                row, at = (b.column(c).slice(rows.start, rows.stop - rows.start) for c in ("row", "position"))
                yield as_batch([row, at, entry, distance], schema)
    return run


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, comma-joined decimals."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable row of ``vectors``
    (``vec_id``, ``embedding``, ``label``); see the module for the method."""
    spark = vectors.sparkSession
    kept = materialize(
        vectors.select("vec_id", "label", integers(F.col("embedding")).alias("vector"))
        .filter("vector IS NOT NULL")
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector", F.size("vector").alias("length")),
        "vectors")
    first = Window.partitionBy("length").orderBy(F.col("vec_id").asc_nulls_last(), "vector")
    chosen = (kept.select("length", "vec_id", "vector").withColumn("at", F.row_number().over(first))
              .filter(F.col("at") <= entries).orderBy("length", "at").collect())
    books: Books = {}
    for length in {r.length for r in chosen}:
        start = np.array([r.vector for r in chosen if r.length == length], np.int64)
        books[length] = [start[:, a:b] for a, b in zip(bounds(length), bounds(length)[1:], strict=False)]

    pieces = kept.select("row", "length", F.inline(cut()))
    order = ["length", "position", "part"]
    distinct = materialize(
        pieces.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
        .repartitionByRange(*order).sortWithinPartitions(*order), "parts")
    for _ in range(rounds):
        books = _improved(books, distinct)

    coded = (pieces.repartitionByRange(*order, "row").sortWithinPartitions(*order, "row")
             .mapInArrow(_codes(books), "row long, position int, entry int, distance long")
             .groupBy("row").agg(*[F.max(F.when(F.col("position") == p, F.lpad(F.lower(F.hex("entry")), 2, "0"))).alias(f"c{p}")
                                   for p in range(PARTS)], F.sum("distance").alias("error")))
    out = materialize(
        kept.select("row", "vec_id", "label", "length").join(coded, "row")
        .select("vec_id", "label", "length", F.concat(*[f"c{p}" for p in range(PARTS)]).alias("code"), "error"), "codes")
    by_label = out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    digests = spark.createDataFrame([(n, digest(b)) for n, b in books.items()], "length int, codebooks_sha256 string")
    return (out.join(by_label, out.label.eqNullSafe(by_label.of)).join(digests, "length")
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))


def codes_sql(rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB for vectors of one length that is a multiple of four: every part against
    every entry, round by round."""
    sums = "list_sum(list_transform(list_zip(p.part, b.book), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    nearest = f"""SELECT p.vec_id, p.k, p.position, p.part, min({{0}}::HUGEINT * {ENTRIES} + b.entry) AS best
    FROM pieces p JOIN book{{1}} b USING (position) GROUP BY ALL""".replace("{0}", sums)
    out = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS k,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS vector
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
  SELECT vec_id, k, position, vector[position * len(vector) // 4 + 1:(position + 1) * len(vector) // 4] AS part
  FROM kept, range(4) r(position)),
book0 AS (SELECT position, k AS entry, part AS book FROM pieces WHERE k < {ENTRIES})"""
    for r in range(rounds):
        out += f""",
near{r} AS MATERIALIZED ({nearest.replace("{1}", str(r))}),
mean{r} AS (
  SELECT position, entry, list(floor_mean ORDER BY place) AS book FROM (
    SELECT position, best % {ENTRIES} AS entry, place, CASE WHEN sum(x) < 0 AND sum(x) % count(*) <> 0
      THEN sum(x) // count(*) - 1 ELSE sum(x) // count(*) END::BIGINT AS floor_mean
    FROM (SELECT position, best, unnest(part) AS x, generate_subscripts(part, 1) AS place FROM near{r}) GROUP BY ALL)
  GROUP BY ALL),
book{r + 1} AS MATERIALIZED (
  SELECT position, b.entry, coalesce(m.book, b.book) AS book FROM book{r} b LEFT JOIN mean{r} m USING (position, entry))"""
    return out + f""",
last AS ({nearest.replace("{1}", str(rounds))}),
coded AS (
  SELECT k, string_agg(lpad(lower(to_hex((best % {ENTRIES})::BIGINT)), 2, '0'), '' ORDER BY position) AS code,
    sum(best // {ENTRIES})::BIGINT AS error FROM last GROUP BY k),
digest AS (
  SELECT sha256(string_agg(array_to_string(book, ','), ',' ORDER BY position, entry)) AS codebooks_sha256 FROM book{rounds}),
rows AS (SELECT vec_id, label, code, error FROM kept JOIN coded USING (k))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM rows, digest"""
