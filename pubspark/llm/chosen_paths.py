r"""MinHash near-de-duplication by chosen-path set-similarity join.

A text's set: its distinct 5-word shingles (words ``[^\x20\x09-\x0D]+``, A-Z lower-cased; fewer
words: the whole sequence as one; none: empty), as 64-bit hashes. Texts with equal sets
are one class, linked from the start. Classes carry ``COORDINATES`` minwise values of 16 bits; the
first ``WIDE`` of them also have 16 more bits, kept behind the others. Each tree's root branches by its
own two of these, so that unrelated classes hardly meet however many there are.

*Trees.* In each of ``trees`` independent trees the classes start at the root. A node of more
than ``node_size`` classes, or of more than ``FEW`` whose sets have over ``LEAF_SHINGLES`` shingles in all, branches:
one or two coordinates, below the root picked by the node's own hash, send each class to the child named by its minwise value there. Similar sets stay together with the
probability of their similarity per chosen coordinate, unrelated ones part. Nodes of one class
are dropped, small ones become leaves: a group of texts alike, most of whose children would hold nearly all of it
again at every level, is mostly compared in full at once. So does a large one that is one component but for at most
``PART`` classes: these meet every part of the component (``deal_all``), which takes rows in proportion to
the node, and it branches no further. A node still large after ``depth`` levels is compared with its
head first, the class with the most links so far; what is then not one component is dealt into parts of
``PART`` classes, and every two parts meet (``deal_all``), so that no pair of the node is left out and
no node meets in one task. That work grows with the square of such a node's classes.

*Leaves* are compared exhaustively: size bound and minwise estimate (from half the values, then all)
first, then full sets, each class with all others by one count over the holders of its shingles; classes already
connected to the most typical one are passed over. Between these steps a leaf is cut into the parts that candidate pairs connect, and equal parts of different
leaves become one. A leaf yields a spanning set of its
links, at most one less than its classes. The first ``FIRST_TREES`` trees' links (their large nodes
only meet in part) are made into components; in the other trees, nodes inside one component are dropped too, and leaves only test
pairs across components, so a dense group is not compared over and over. Sets are made anew from
the texts of classes that are in such a pair.

*Recall.* A pair at similarity 0.85 meets in a leaf of one tree with probability over 0.6 even
after eight levels (``meeting_probability``), so in ten trees with over 0.999; of large nodes only the
eight trees count whose nodes are compared in full. The two minwise estimates that go before full
sets lose less than 0.0001 of the pairs at the threshold, and fewer above it. All trees branch by
one signature of 96 values, so these figures hold per pair on average, not independently.

Defined results: null text reads as empty; an empty set links with nothing; a null doc_id links
with nothing, its component is null and it is kept; rows with one doc_id and different texts are
judged each by its text, repeated rows alike; an empty table gives no rows; other columns play no
part. Every link is confirmed on full sets, so none is reported below the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubspark.llm.chunk_cache import slices
from pubspark.llm.common import as_batch, discard, fresh_name, materialize, released, small_batches, texts
from pubspark.llm.components import connected_components

SHINGLE = 5
#: Minwise values of a signature, all of which the trees branch by, and those of the first estimate.
COORDINATES, BRIEF = 96, 48
#: Coordinates with 32 bits, for the roots.
WIDE = 32
FIRST_TREES, FIRST_DEPTH = 2, 6
#: Classes that make a leaf whatever the size of their sets, and the shingles of the sets of larger leaves, which
#: come into one task's memory together.
FEW, LEAF_SHINGLES = 48, 1 << 20
#: Classes of a part of a large node whose parts all meet.
PART = 128
#: Chance of a second child by level; deeper levels hold groups of similar sets and need less.
SECOND_CHILD = (0.43, 0.43, 0.3)
#: Documents are looked up by a broadcast list of ids up to this many, else by a shuffle.
MOST_BROADCAST = 1_000_000

_RANDOM = np.random.default_rng(20240501)
_FACTORS = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_PLACES = _RANDOM.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def meeting_probability(similarity: float, levels: int) -> float:
    """Chance that a pair is together in some node of one tree after ``levels`` levels."""
    apart = 0.0
    for level in reversed(range(levels)):
        p = SECOND_CHILD[min(level, len(SECOND_CHILD) - 1)]
        one = 1 - similarity * (1 - apart)
        apart = (1 - p) * one + p * one * one
    return 1 - apart


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode().lower().split()  # bytes: A-Z and the six white-space characters only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(h) < SHINGLE:
        x = np.array([(h * _PLACES[:len(h)]).sum() + np.uint64(len(h))])
    else:
        n = len(h) - SHINGLE + 1
        x = h[:n] * _PLACES[0]
        for i in range(1, SHINGLE):
            x += h[i:i + n] * _PLACES[i]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return np.unique(x)


def signature(shingles: np.ndarray) -> bytes:
    """For each coordinate the low 16 bits of the smallest hashed shingle, then for the first ``WIDE``
    ones the 16 bits above."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 4096):
        np.minimum(low, (shingles[i:i + 4096, None] * _FACTORS + _OFFSETS).min(axis=0), out=low)
    return low.astype("<u2").tobytes() + (low[:WIDE] >> np.uint64(16)).astype("<u2").tobytes()


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, own`` (hash of the text), ``n`` (set size), ``set_id`` (hash of the set) and
    ``sig`` of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("own", pa.int64()), ("n", pa.int64()), ("set_id", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ids, sigs = [], [], []
            for t in texts(b):
                s = shingle_set(t)
                n.append(len(s))
                ids.append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True))
                sigs.append(signature(s))
            yield as_batch([b.column("doc_id"), b.column("own"), n, ids, sigs], schema)

    return docs.withColumn("own", F.xxhash64("text")).mapInArrow(
        released(run), "doc_id long, own long, n long, set_id long, sig binary")


def branch(rows: DataFrame, level: int, keep: tuple[str, ...]) -> DataFrame:
    """``node`` and ``keep`` of the nodes' children; rows have ``node``, ``sig`` and ``keep``, those of
    the roots (level 0) also ``tree``."""
    second = int(1000 * SECOND_CHILD[min(level, len(SECOND_CHILD) - 1)])
    node = F.col("node")

    def child(at: Column) -> Column:
        # the 16 bits above, empty beyond the wide coordinates
        above = F.substr(F.col("sig"), 2 * at + 2 * COORDINATES + 1, F.lit(2))
        return F.xxhash64(node, at, F.substr(F.col("sig"), 2 * at + 1, F.lit(2)), above)

    if level == 0:
        first, other = (F.pmod(2 * F.col("tree") + i, F.lit(WIDE)).cast("int") for i in (0, 1))
    else:
        first = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(COORDINATES)).cast("int")
        other = F.pmod(first + 1 + F.pmod(F.xxhash64(node, F.lit(2)), F.lit(COORDINATES - 1)).cast("int"),
                       F.lit(COORDINATES)).cast("int")
    two = F.pmod(F.xxhash64(node, F.lit(3)), F.lit(1000)) < second
    children = F.when(two, F.array(child(first), child(other))).otherwise(F.array(child(first)))
    return rows.select(F.explode(children).alias("node"), *keep)


def nearly_one(nodes: DataFrame) -> DataFrame:
    """``node`` of those that are one component but for fewer other classes, at most ``PART``; ``nodes``
    has ``node, component``."""
    counts = nodes.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"))
    rest = F.sum("n") - F.max("n")
    return (counts.groupBy("node").agg(rest.alias("rest"), F.max("n").alias("main"))
            .filter((F.col("rest") <= PART) & (F.col("rest") < F.col("main"))).select("node"))


def leaves(classes: DataFrame, trees: range, node_size: int, depth: int,
           joined: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """``leaf, set_id`` of the trees' leaves that hold classes of two components or more, and
    ``node, set_id`` of the nodes still large after ``depth`` levels, if any; ``classes`` has
    ``set_id, component, sig`` and, for the bound on a leaf's shingles, ``n``; ``joined`` tells that there are
    components of more than one class. Most
    classes are alone after one level; those of nodes that branch again have their signatures
    written once, and each level's rows look them up instead of carrying them."""
    size = F.col("n") if "n" in classes.columns else F.lit(1)
    rows = (classes.withColumn("tree", F.explode(F.lit(list(trees)))).withColumn("n", size)
            .withColumn("node", F.xxhash64("tree", F.lit("root"))))
    fits = (F.col("size") <= node_size) & ((F.col("size") <= FEW) | (F.col("shingles") <= LEAF_SHINGLES))
    done = above_kids = sigs = None
    for level in range(depth):
        kids = branch(rows, level, ("set_id", "component", "n"))
        sizes = (kids.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"),
                                          F.min("component").alias("low"), F.max("component").alias("high"))
                 .filter("low <> high").select("node", fits.alias("fits")))
        above, kids = above_kids, materialize(kids.join(sizes, "node"), f"nodes-{level}")
        above_kids = kids
        discard(above)
        small = kids.filter("fits").select(F.col("node").alias("leaf"), "set_id")
        large = kids.filter(~F.col("fits"))
        if joined:
            even = materialize(nearly_one(large), "nearly-one")
            small = small.unionByName(deal_all(large.join(even, "node").select("node", "set_id", "component")))
            large = large.join(even, "node", "left_anti")
        small = materialize(small, "leaves")
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            discard(kids, sigs)
            return done, None
        if sigs is None:
            sigs = materialize(classes.select("set_id", "sig").join(large.select("set_id").distinct(), "set_id", "left_semi"),
                               "branching")
        rows = large.join(sigs, "set_id")
    discard(sigs)
    return done, large.select("node", "set_id")


def deal_once(nodes: DataFrame, classes: DataFrame, node_size: int) -> DataFrame:
    """Leaves that find the first links of large nodes: each part of a node makes one leaf with one
    other part, picked by hash, and the node's most copied class. Not all pairs meet."""
    sizes = nodes.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / (node_size // 2)).alias("parts"))
    own = nodes.join(sizes, "node").withColumn("part", F.pmod(F.xxhash64("set_id", "node"), F.col("parts")))
    # parts p and q meet when (p + q) mod parts is the node's own number
    other = F.pmod(F.pmod(F.xxhash64("node"), F.col("parts")) - F.col("part") + F.col("parts"), F.col("parts"))
    pair = F.xxhash64("node", F.least("part", other), F.greatest("part", other))
    dealt = own.select("node", pair.alias("leaf"), "set_id")
    first = (nodes.join(classes.select("set_id", "copies"), "set_id").groupBy("node")
             .agg(F.max(F.struct("copies", "set_id")).alias("first")))
    heads = dealt.select("node", "leaf").distinct().join(first, "node")
    return dealt.select("leaf", "set_id").unionByName(heads.select("leaf", F.col("first.set_id").alias("set_id"))).distinct()


def deal_heads(nodes: DataFrame, classes: DataFrame, links: DataFrame, node_size: int) -> DataFrame:
    """Leaves that test each class of a large node against the node's head, the class with the most
    links so far (then copies), likely the others' source; those linked to it already stay away.
    ``classes`` has ``set_id, component, copies``."""
    ends = links.select(F.col("a").alias("set_id")).unionByName(links.select(F.col("b").alias("set_id")))
    degrees = ends.groupBy("set_id").agg(F.count(F.lit(1)).alias("degree"))
    known = nodes.join(classes.select("set_id", "component", "copies"), "set_id").join(degrees, "set_id", "left")
    rank = F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "copies", "set_id", "component")
    head = known.groupBy("node").agg(F.max(rank).alias("head"), F.count(F.lit(1)).alias("size"))
    part = F.pmod(F.xxhash64("set_id", "node"), F.ceil(F.col("size") / node_size))
    dealt = (known.join(head, "node").filter(F.col("component") != F.col("head.component"))
             .select("set_id", F.xxhash64("node", F.lit("head"), part).alias("leaf"), F.col("head.set_id").alias("head")))
    heads = dealt.select("leaf", F.col("head").alias("set_id")).distinct()
    return dealt.select("leaf", "set_id").unionByName(heads)


def deal_all(nodes: DataFrame, classes: DataFrame | None = None, size: int = PART) -> DataFrame:
    """Leaves of large nodes in which every two classes of different components meet. The node's
    most frequent component is the main one, all other classes the rest; both are dealt
    into parts of about ``size`` classes, and every two parts of the rest, and every part of the
    rest and of the main one, make a leaf. Pairs are compared inside the leaves, never shuffled; the
    rows made are classes times parts. ``classes`` has ``set_id, component``; without it ``nodes``
    has the component."""
    known = nodes if classes is None else nodes.join(classes.select("set_id", "component"), "set_id")
    counts = known.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = (counts.groupBy("node").agg(F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("main"))
             .filter(F.col("size") > F.col("main.n"))
             .select("node", F.col("main.component").alias("main"), F.ceil(F.col("main.n") / size).alias("mains"),
                     F.ceil((F.col("size") - F.col("main.n")) / size).alias("rests")))
    own = known.join(sizes, "node").withColumn("hash", F.xxhash64("set_id", "node"))

    def to(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    rest = own.filter("component <> main").withColumn("part", F.pmod("hash", "rests"))
    # in the steps 0 to rests - 1, parts p and q of the rest meet when (p + q) mod rests is the step
    rest = rest.withColumn("step", to(F.col("rests") + F.col("mains")))
    other = F.pmod(F.col("step") - F.col("part") + F.col("rests"), F.col("rests"))
    among = F.xxhash64("node", F.lit("rest"), F.least("part", other), F.greatest("part", other))
    across = F.xxhash64("node", F.lit("main"), "part", F.col("step") - F.col("rests"))
    rest = rest.select(F.when(F.col("step") < F.col("rests"), among).otherwise(across).alias("leaf"), "set_id")
    main = (own.filter("component = main").withColumn("part", F.pmod("hash", "mains")).withColumn("step", to(F.col("rests")))
            .select(F.xxhash64("node", F.lit("main"), "step", "part").alias("leaf"), "set_id"))
    return rest.unionByName(main)


def candidate_pairs(n: np.ndarray, sig: np.ndarray, group: np.ndarray, percent: int,
                    slack: float) -> Iterator[tuple[int, np.ndarray]]:
    """Positions ``i`` with those ``j > i``, in different groups, that the sizes and the minwise estimate
    allow; some rows are examined at a time."""
    values = np.ascontiguousarray(sig.T)
    for k in range(0, len(n), 32):
        if len(n) <= 64:
            same = (sig[k:k + 32, None, :] == sig[None, k:, :]).sum(axis=2)
        else:
            same = np.zeros((min(32, len(n) - k), len(n) - k), np.uint8)
            for v in values:
                same += v[k:k + 32, None] == v[None, k:]
        low, high = np.minimum(n[k:k + 32, None], n[None, k:]), np.maximum(n[k:k + 32, None], n[None, k:])
        may = ((100 * low >= percent * high) & (same >= (percent / 100 - slack) * len(values))
               & (group[k:k + 32, None] != group[None, k:]))
        may = np.triu(may, 1)
        for i in np.flatnonzero(may.any(axis=1)).tolist():
            yield k + i, k + np.flatnonzero(may[i])


def involved(leaf_rows: DataFrame, classes: DataFrame, percent: int, slack: float) -> DataFrame:
    """``leaf, set_id``: the leaves' classes that candidate pairs connect, each connected part as a
    leaf of its own, named by its classes. So a part that several trees' leaves hold, as most
    small ones do, is one leaf. ``classes`` has ``set_id, n, sig, component``."""
    schema = pa.schema([("leaf", pa.int64()), ("members", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [p for rows in b.column("rows") for p in connected_parts(rows.as_py(), percent, slack)]
            if parts:
                names = [xxhash.xxh64_intdigest(np.array(p, np.int64).tobytes()) - (1 << 63) for p in parts]
                yield as_batch([names, parts], schema)

    grouped = (leaf_rows.join(classes, "set_id").groupBy("leaf")  # leaves are small by construction
               .agg(F.collect_list(F.struct("set_id", "n", "sig", "component")).alias("rows"))
               .filter(F.size("rows") > 1))
    parts = grouped.mapInArrow(released(run), "leaf long, members array<long>").dropDuplicates(["leaf"])
    return parts.select("leaf", F.explode("members").alias("set_id"))


def connected_parts(rows: list[dict], percent: int, slack: float) -> list[list[int]]:
    """Sorted ids of each part of two classes or more that the candidate pairs connect."""
    sig = np.frombuffer(b"".join(r["sig"] for r in rows), "<u2").reshape(len(rows), -1)
    n, component = (np.array([r[c] for r in rows]) for c in ("n", "component"))
    group = np.arange(len(rows))
    for i, near in candidate_pairs(n, sig, component, percent, slack):
        met = np.unique(group[np.append(near, i)])
        if len(met) > 1:
            group[np.isin(group, met)] = met[0]
    ids = np.array([r["set_id"] for r in rows])
    return [sorted(ids[group == g].tolist()) for g in np.unique(group) if (group == g).sum() > 1]


def full_sets(docs: DataFrame, firsts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``set_id, shingles`` of the wanted classes, from the text of each one's first document."""
    keys = firsts.join(wanted.select("set_id").distinct(), "set_id").select("doc_id").distinct()
    keys = materialize(keys, "wanted")
    # beyond the bound both sides are shuffled
    keys = F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys
    schema = pa.schema([("set_id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in slices(texts(b)):
                raw = [shingle_set(t).tobytes() for t in some]
                ids = [int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little", signed=True) for r in raw]
                yield as_batch([ids, raw], schema)

    made = docs.join(keys, "doc_id", "left_semi").mapInArrow(released(run), "set_id long, shingles binary")
    return materialize(made.dropDuplicates(["set_id"]), "sets")


def confirmed(leaf_rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links of full sets that span each leaf's connected classes."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[int, int]] = []
            for rows in b.column("rows"):
                out += spanning_links(rows.as_py(), percent)
            if out:
                yield as_batch(zip(*out, strict=True), schema)

    grouped = leaf_rows.join(sets, "set_id").groupBy("leaf").agg(
        F.collect_list(F.struct("set_id", "shingles")).alias("rows"))
    return grouped.mapInArrow(released(run), "a long, b long").distinct()


def spanning_links(rows: list[dict], percent: int) -> list[tuple[int, int]]:
    """Links that span the connected classes of a leaf. Each class is compared with all others by counting the
    holders of its shingles, unless it is connected to the most typical class: of two classes that end
    apart, one at least is never connected to that one."""
    ids, sets = [r["set_id"] for r in rows], [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    size = np.array(list(map(len, sets)))
    owner = np.repeat(np.arange(len(sets)), size)
    _, shingle, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders, ends = owner[np.argsort(shingle, kind="stable")], np.cumsum(times)
    begin = np.cumsum(size) - size
    order = np.argsort(-np.bincount(owner, times[shingle]) / size, kind="stable").tolist()
    group = np.arange(len(sets))
    out = []
    for i in order:
        if i != order[0] and group[i] == group[order[0]]:
            continue
        both = np.zeros(len(sets), np.int64)
        for k in range(begin[i], begin[i] + size[i], 1024):
            own = shingle[k:min(k + 1024, begin[i] + size[i])]
            at = np.arange(times[own].sum()) + np.repeat(ends[own] - np.cumsum(times[own]), times[own])
            both += np.bincount(holders[at], minlength=len(sets))
        linked = np.flatnonzero(100 * both >= percent * (size + size[i] - both))
        met, first = np.unique(group[linked], return_index=True)  # its own group among them
        out += [(ids[i], ids[j]) for j in linked[first[met != group[i]]].tolist()]
        if len(met) > 1:
            group[np.isin(group, met)] = met[0]
    return out


def near_duplicates(docs: DataFrame, percent: int = 85, trees: int = 10, node_size: int = 2048, depth: int = 14,
                    slack: float = 0.16) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``, and ``own``, a hash of
    the text."""
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, percent, trees, node_size, depth, slack)


def _near_duplicates(docs: DataFrame, percent: int, trees: int, node_size: int, depth: int, slack: float) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sigs = materialize(signatures(docs), "signatures")
    # one row a class; the minimum is found per task before the shuffle
    classes = materialize(
        sigs.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("set_id")
        .agg(F.min(F.struct("doc_id", "n", "sig")).alias("x"), F.count(F.lit(1)).alias("copies"))
        .select("set_id", "copies", "x.*"), "classes")
    before, sigs = sigs, materialize(sigs.drop("sig"), "rows")  # the classes have the signatures
    discard(before)
    links, parts, seen = None, None, None

    def components() -> DataFrame:
        if parts is None:
            return classes.withColumn("component", F.col("set_id"))
        return materialize(classes.join(parts.withColumnRenamed("id", "set_id"), "set_id", "left")
                           .withColumn("component", F.coalesce("component", "set_id")), "known")

    def compare(rows: DataFrame, known: DataFrame) -> None:
        nonlocal links, parts, seen
        # by the short signatures first, so that the long ones are joined to few rows
        brief = known.select("set_id", "n", F.substr("sig", F.lit(1), F.lit(2 * BRIEF)).alias("sig"), "component")
        close = materialize(involved(rows, brief, percent, 1.5 * slack), "pairs-brief")
        low = F.substr("sig", F.lit(1), F.lit(2 * COORDINATES)).alias("sig")
        rows = involved(close, known.select("set_id", "n", low, "component"), percent, slack)
        if seen is not None:
            rows = rows.join(seen.select("leaf").distinct(), "leaf", "left_anti")
        rows = materialize(rows, "pairs")
        discard(close)
        seen = rows if seen is None else seen.unionByName(rows)
        sets = full_sets(docs, classes.select("set_id", "doc_id"), rows)
        own = materialize(confirmed(rows, sets, percent), "confirmed")
        links = own if links is None else links.unionByName(own)
        before, parts = parts, connected_components(links)
        discard(before)

    def renewed(known: DataFrame) -> DataFrame:
        """The components as they are now; the table of those before goes."""
        now = components()
        discard(known)
        return now

    few = min(node_size, FEW)  # classes of a leaf of dealt nodes, whose sets may be large
    known = components()
    rows, large = leaves(known, range(FIRST_TREES), node_size, FIRST_DEPTH)
    compare(rows if large is None else rows.unionByName(deal_once(large, known, few)), known)
    known = renewed(known)
    if large is not None:
        compare(deal_heads(large, known, links, few), known)
        known = renewed(known)
    rows, large = leaves(known, range(FIRST_TREES, trees), node_size, depth, joined=True)
    compare(rows if large is None else rows.unionByName(deal_heads(large, known, links, few)), known)
    if large is not None:  # what is not one component yet, all against all
        known = renewed(known)
        compare(deal_all(large, known), known)
    members = classes.join(parts.withColumnRenamed("id", "set_id"), "set_id").select("set_id", "component", "doc_id")
    low = members.groupBy("component").agg(F.min("doc_id").alias("low"))
    first = (classes.select("set_id", "doc_id")
             .join(members.join(low, "component").select("set_id", "low"), "set_id", "left")
             .select("set_id", F.coalesce("low", "doc_id").alias("low")))
    own = sigs.select("doc_id", "own", F.col("n").alias("n_shingles"), "set_id")
    joined = own.join(first, "set_id", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("low")))
        .otherwise(F.col("doc_id")))
    return joined.select("doc_id", "n_shingles", "component_id",
                         F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "own")


def keep_firsts(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, of the first document of each group; of rows
    that repeat both doc_id and text, one."""
    report = materialize(near_duplicates(docs, **settings), "near-duplicates")
    own, key, found, found_id = (fresh_name(docs, n) for n in ("own_hash", "own_id", "copy_hash", "copy_hash_id"))
    marked = docs.withColumn(own, F.xxhash64("text")).withColumn(key, F.col("doc_id").cast("long"))
    gone = materialize(report.filter(~F.col("kept")).select(F.col("doc_id").alias(key), F.col("own").alias(own))
                       .distinct(), "gone")
    # beyond the bound the texts are shuffled
    gone = F.broadcast(gone) if gone.count() <= MOST_BROADCAST else gone
    kept = marked.join(gone, [key, own], "left_anti")
    again = report.filter(F.col("kept")).groupBy("doc_id", "own").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    if not again.isEmpty():
        again = again.select(F.col("doc_id").alias(found_id), F.col("own").alias(found))
        same = (F.col(own) == F.col(found)) & F.col(key).eqNullSafe(F.col(found_id))
        kept = kept.join(again, same, "left_anti").unionByName(
            kept.join(again, same, "left_semi").dropDuplicates([key, own]))
    return kept.drop(own, key)
