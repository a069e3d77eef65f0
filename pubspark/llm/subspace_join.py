"""Embedding near-de-duplication by a subspace pigeonhole join.

Vectors are normalised and rotated by a fixed random rotation, which spreads every difference
evenly, and cut into blocks of ``width`` dimensions. Two vectors of cosine at least c differ by
at most 2 - 2c in squared distance; of that each block gets a budget in proportion to its
dimensions. By the pigeonhole principle, linked vectors differ within the budget in some block.

Each block is range-joined by that budget. Its space is cut into Voronoi cells around
``cells`` pivots (vectors' blocks from a hash sample of about ``sample_rows`` rows; the result
does not depend on the choice). A vector is at home in its nearest pivot's cell and probes each
cell that can hold a point within the radius, by the cell's measured radius and by the
distance to the bisecting plane.

Vectors are written once, in files (runs) of at most ``run_rows``. A task has a part of them, a few
runs, at home by block and cell, and reads later parts past it; every two parts meet in one task.
So nothing but links is shuffled, and disk grows with the table, not with the pairs compared.

Candidates are verified exactly by cosine in double precision from the vectors as given. A link
counts in the first block whose budget it meets, so never twice. Tasks return link counts
and a spanning set of links, not pairs. Vectors that are equal in all components are one class.

Defined results: a vector that is null, zero, or has null or non-finite components links with nothing,
as does one of a length of its own; rows with null vec_id link with nothing and have null
component, kept; repeated rows count each other as links; an empty table gives no rows;
other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubspark.llm.common import as_batch, materialize, released, shared_folder
from pubspark.llm.components import connected_components
from pubspark.llm.record_files import file_system

#: Relative and absolute slack of distance bounds against rounding; verification is exact.
EASE, EDGE = 1 + 1e-9, 1e-9
#: The same for squared distances of blocks of unit vectors in single precision.
ROUGH = 1e-5
#: Runs in a part, and the most parts that one task reads past another; the sizes of what is compared at once.
PART_RUNS, PASSING_PARTS = 8, 8
BATCH_ROWS, SLICE, PORTION = 8192, 4_000_000, 200_000


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.9
    width: int = 8
    cells: int = 64
    sample_rows: int = 4096
    run_rows: int = 2000
    seed: int = 7


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthonormal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


@dataclass(frozen=True)
class Blocks:
    """The cut of rotated unit vectors into blocks, their budgets and pivots."""

    rotate: np.ndarray
    bounds: tuple[tuple[int, int], ...]
    budgets: tuple[float, ...]
    pivots: tuple[np.ndarray, ...] = ()

    def rotated(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ self.rotate

    def distances(self, rotated: np.ndarray, block: int) -> np.ndarray:
        """Distance of each vector's block to each pivot."""
        a, b = self.bounds[block]
        x, p = rotated[:, a:b], self.pivots[block]
        square = (x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)[None, :]
        return np.sqrt(np.maximum(square, 0))


def cut(dims: int, settings: Settings) -> Blocks:
    bounds = tuple((a, min(a + settings.width, dims)) for a in range(0, dims, settings.width))
    total = 2 - 2 * settings.cosine
    return Blocks(rotation(dims, settings.seed), bounds,
                  tuple(total * (b - a) / dims * EASE + EDGE for a, b in bounds))


def valid(vector: str = "embedding") -> F.Column:
    """Non-empty, no null or non-finite component, not zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The list column's values as given, a row each (they are valid and of one length)."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def choose_pivots(classes: DataFrame, blocks: Blocks, settings: Settings) -> Blocks:
    """Pivots from a hash sample, thinned so that none lies close to another."""
    n = classes.count()
    share = min(1.0, settings.sample_rows / max(n, 1))
    sample = classes.filter(F.pmod(F.xxhash64("set_id", F.lit("pivot")), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    rows = sample.orderBy("set_id").select("vector").limit(2 * settings.sample_rows).toPandas()["vector"]
    if not len(rows):
        rows = classes.orderBy("set_id").select("vector").limit(1).toPandas()["vector"]
    x = blocks.rotated(np.array(rows.tolist(), np.float64))
    pivots = []
    for a, b in blocks.bounds:
        own = x[:, a:b]
        chosen = [0]
        far = ((own - own[0]) ** 2).sum(1)
        rng = np.random.default_rng(settings.seed)
        while len(chosen) < min(settings.cells, len(own)) and far.max() > 0:
            # far points are likelier, but not only the farthest, so pivots follow the data
            k = int(rng.choice(len(own), p=far / far.sum()))
            chosen.append(k)
            far = np.minimum(far, ((own - own[k]) ** 2).sum(1))
        pivots.append(own[chosen])
    return Blocks(blocks.rotate, blocks.bounds, blocks.budgets, tuple(pivots))


def read_run(uri: str, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``set_id, copies, vector`` of a run's file, in batches."""
    source, name = file_system(uri)
    with source.open_input_file(name) as f:
        for batch in pq.ParquetFile(f).iter_batches(BATCH_ROWS, columns=["set_id", "copies", "vector"]):
            if batch.num_rows:
                yield (batch.column("set_id").to_numpy(), batch.column("copies").to_numpy(),
                       matrix(batch.column("vector"), dims).astype(np.float64))


@dataclass(frozen=True)
class Part:
    """Vectors as given, their lengths, and rotated unit vectors."""

    ids: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    lengths: np.ndarray
    rotated: np.ndarray

    @classmethod
    def of(cls, blocks: Blocks, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> Part:
        return cls(ids, copies, vectors, np.sqrt((vectors * vectors).sum(1)), blocks.rotated(vectors))


class Home:
    """The vectors at home in a task by block and cell, and what is found for them and those that pass."""

    def __init__(self, part: Part, blocks: Blocks, cosine: float):
        self.part, self.blocks, self.cosine = part, blocks, cosine
        n = len(part.ids)
        self.counts = np.zeros(n, np.int64)
        self.group = np.arange(n)  # the least vector known to be linked with each, by way of others
        self.cells: list[tuple[list, np.ndarray, np.ndarray]] = []
        for k, (a, b) in enumerate(blocks.bounds):
            d = blocks.distances(part.rotated, k)
            home = d.argmin(1)
            near = d[np.arange(n), home]
            radii = np.full(d.shape[1], -np.inf)  # of a cell without vectors: nothing comes near it
            members = []
            for c in np.unique(home):
                own = np.flatnonzero(home == c)
                radii[c] = near[own].max() * EASE + EDGE
                x = part.rotated[own, a:b]
                members.append((int(c), own, np.c_[x, np.ones(len(x)), (x * x).sum(1)].astype(np.float32)))
            pivots = blocks.pivots[k]
            gap = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2))
            self.cells.append((members, radii, gap))

    def near(self, other: Part, k: int, inside: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (home, other) that may be within the budget of block ``k``; each at most once."""
        members, radii, gap = self.cells[k]
        a, b = self.blocks.bounds[k]
        budget = self.blocks.budgets[k]
        reach = np.sqrt(budget)
        d = self.blocks.distances(other.rotated, k)
        home = d.argmin(1)
        near = d[np.arange(len(d)), home]
        # within reach of the cell's ball, and of the far side of the bisecting plane
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d ** 2 - near[:, None] ** 2) / (2 * gap[home])
        probe = (d <= radii[None, :] + reach) & ~(plane > reach * EASE + EDGE)
        x = other.rotated[:, a:b]
        y = np.c_[-2 * x, (x * x).sum(1), np.ones(len(x))].astype(np.float32)
        for c, own, z in members:
            probes = np.flatnonzero(probe[:, c])
            step = max(1, SLICE // len(own))
            for s in range(0, len(probes), step):
                some = probes[s:s + step]
                i, j = np.divmod(np.flatnonzero(z @ y[some].T <= budget + ROUGH), len(some))
                i, j = own[i], some[j]
                if inside:
                    i, j = i[i < j], j[i < j]
                yield i, j

    def meet(self, other: Part, inside: bool = False) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Count the links with ``other`` (``inside``: the home vectors themselves); ``a, b, n`` as
        in :func:`joined_parts` of the other's counts and of links that span what is found."""
        n = len(self.part.ids)
        counts = self.counts if inside else np.zeros(len(other.ids), np.int64)
        group = self.group if inside else np.r_[self.group, n + np.arange(len(other.ids))]
        ids = self.part.ids if inside else np.r_[self.part.ids, other.ids]
        found = []
        for k in range(len(self.blocks.bounds)):
            for i, j in gathered(self.near(other, k, inside)):
                i, j = self._linked(i, j, other, k)
                if not len(i):
                    continue
                np.add.at(self.counts, i, other.copies[j])
                np.add.at(counts, j, self.part.copies[i])
                found += spanning(group, ids, i, j if inside else n + j)
        self.group = group[:n]
        if not inside and counts.any():
            some = np.flatnonzero(counts)
            found.append((other.ids[some], other.ids[some], counts[some]))
        return found

    def _linked(self, i: np.ndarray, j: np.ndarray, other: Part, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Of these pairs the links that count in this block: the first whose budget they meet."""
        home = self.part
        cosine = (home.vectors[i] * other.vectors[j]).sum(1) / (home.lengths[i] * other.lengths[j])
        i, j = i[cosine >= self.cosine], j[cosine >= self.cosine]
        gap = (home.rotated[i] - other.rotated[j]) ** 2
        first = np.ones(len(i), bool)
        for k, (a, b) in enumerate(self.blocks.bounds[:block + 1]):
            met = gap[:, a:b].sum(1) <= self.blocks.budgets[k]
            first &= met if k == block else ~met
        return i[first], j[first]


def gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in portions of about ``PORTION``."""
    held, size = [], 0
    for i, j in pairs:
        for s in range(0, len(i), PORTION):
            held.append((i[s:s + PORTION], j[s:s + PORTION]))
            size += len(held[-1][0])
            if size >= PORTION:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def spanning(group: np.ndarray, ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Those of the links (i, j) that join groups; ``group`` (the least index of each) is brought up to date."""
    out = []
    while True:
        a, b = group[i], group[j]
        apart = a != b
        if not apart.any():
            return out
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        high, at = np.unique(np.maximum(a, b), return_index=True)
        up = np.arange(len(group))
        up[high] = np.minimum(a, b)[at]
        while not np.array_equal(further := up[up], up):
            up = further
        group[:] = up[group]
        out.append((ids[i[at]], ids[j[at]], np.zeros(len(at), np.int64)))


def parts_of(runs: list[tuple[str, int]], rows: int) -> list[list[str]]:
    """Runs (file, rows) in order, in parts of about ``rows`` rows."""
    parts, size = [], rows
    for uri, n in runs:
        if size >= rows:
            parts.append([])
            size = 0
        parts[-1].append(uri)
        size += n
    return parts


def joined_parts(spark: SparkSession, runs: list[tuple[str, int]], blocks: Blocks, dims: int, settings: Settings) -> DataFrame:
    """``a, b, n``: for b = a the links (with copies) counted for class a in one task; otherwise one of
    the links that span a task's. A task has one part at home and reads some of the later parts past it,
    so that every two parts meet in one task. Vectors are only read from where they were written."""
    parts = parts_of(runs, PART_RUNS * settings.run_rows)
    n = len(parts)
    span = max(1, min(PASSING_PARTS, n * n // 512))
    tasks = [(home, first, min(first + span, n)) for home in range(n) for first in range(home, n, span)]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k in [k for batch in batches for k in batch.column("id").to_pylist()]:
            at, first, last = tasks[k]
            rows = [r for uri in parts[at] for r in read_run(uri, dims)]
            home = Home(Part.of(blocks, *(np.concatenate(c) for c in zip(*rows, strict=True))), blocks, settings.cosine)
            if first == at:
                for found in home.meet(home.part, inside=True):
                    yield as_batch(found, schema)
            for uri in [uri for part in parts[max(first, at + 1):last] for uri in part]:
                for batch in read_run(uri, dims):
                    for found in home.meet(Part.of(blocks, *batch)):
                        yield as_batch(found, schema)
            some = np.flatnonzero(home.counts)
            yield as_batch((home.part.ids[some], home.part.ids[some], home.counts[some]), schema)

    return spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(released(run), "a long, b long, n long")


def write_classes(classes: DataFrame, settings: Settings) -> DataFrame:
    """Classes in files of one length of vectors and at most a run each."""
    path = shared_folder(classes.sparkSession, "vector-classes")
    sized = classes.withColumn("dims", F.size("vector"))
    sized.write.partitionBy("dims").option("maxRecordsPerFile", settings.run_rows).parquet(path)
    return classes.sparkSession.read.schema(sized.schema).parquet(path)


def near_vectors(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    spark = table.sparkSession
    rows = table.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector"))
    rows = rows.withColumn("usable", valid("vector") & F.col("vec_id").isNotNull())
    rows = rows.withColumn("set_id", F.when(F.col("usable"), F.xxhash64("vector", F.lit("class")))
                           .otherwise(F.lit(None)).cast("long"))
    good = rows.filter("usable")
    classes = write_classes(good.groupBy("set_id", "vector").agg(F.count(F.lit(1)).alias("copies"),
                                                                 F.min("vec_id").alias("low")), settings)
    # a row per run; a file holds a bounded number of vectors
    files = classes.groupBy("dims", F.col("_metadata.file_path").alias("uri")).agg(F.count(F.lit(1)).alias("n")).collect()
    links, counts = None, None
    for dims in sorted({f["dims"] for f in files}):  # one, as a rule
        blocks = choose_pivots(classes.filter(F.col("dims") == dims), cut(dims, settings), settings)
        runs = sorted((f["uri"], f["n"]) for f in files if f["dims"] == dims)
        found = materialize(joined_parts(spark, runs, blocks, dims, settings), "vector-links")
        n = found.filter("a = b").groupBy(F.col("a").alias("set_id")).agg(F.sum("n").alias("linked"))
        pairs = found.filter("a <> b").select("a", "b")
        links = pairs if links is None else links.unionByName(pairs)
        counts = n if counts is None else counts.unionByName(n)
    if links is None:  # no usable vector
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    parts = connected_components(links).withColumnRenamed("id", "set_id")
    known = classes.select("set_id", "copies", "low").join(parts, "set_id", "left").join(counts, "set_id", "left")
    known = materialize(known.withColumn("component", F.coalesce("component", "set_id")), "vector-parts")
    least = known.groupBy("component").agg(F.min("low").alias("least"))
    known = known.join(least, "component").select(
        "set_id", "least", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("linked"))
    out = rows.select("vec_id", "set_id").join(known, "set_id", "left")
    component = F.coalesce("least", "vec_id")
    return out.select("vec_id", F.coalesce("linked", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
