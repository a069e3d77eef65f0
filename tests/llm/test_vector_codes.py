import hashlib
import math

import duckdb
import numpy as np
import pytest

from pubspark.llm import vector_codes as V
from tests.llm.edge import SF, by_id


def brute(rows, rounds=4, entries=256):
    """The definition in integers, part by part and entry by entry."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and None not in v and all(math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    size = len(kept[0][1]) // 4
    books = [[r[1][p * size:(p + 1) * size] for r in kept[:entries]] for p in range(4)]

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            of = [(assign(r[1][p * size:(p + 1) * size], books[p])[1], r[1][p * size:(p + 1) * size]) for r in kept]
            for k in {k for k, _ in of}:
                own = [x for j, x in of if j == k]
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], {}
    for i, v, label in kept:
        got = [assign(v[p * size:(p + 1) * size], books[p]) for p in range(4)]
        sums[label] = sums.get(label, 0) + sum(d for d, _ in got)
        out.append((i, "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got), label))
    return sorted([(i, code, error, sums[label], digest) for i, code, error, label in out], key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows],
                                 "vec_id long, embedding array<float>, label int, row int, code string, position int")


def test_against_brute_force(spark):
    r = np.random.default_rng(4)
    grid = [(int(i), [float(x) for x in r.integers(-3, 3, 12) / 8], int(i) % 3) for i in r.permutation(400)]
    rows = grid + [(1000 + i, grid[0][1], None) for i in range(300)] + [grid[5], (2, [0.001, -0.001] * 6, None), (None, [0.5] * 12, 1)]
    rows += [(3, None, 1), (4, [None] + [0.0] * 11, 1), (5, [float("nan")] * 12, 1), (6, [float("inf")] + [0.0] * 11, 2)]
    assert by_id(V.compress(frame(spark, rows))) == brute(rows)


def test_walk_of_the_trie():
    r = np.random.default_rng(1)
    for most, depth in ((3, 5), (2**26, 7), (10, 1)):
        leaves = r.integers(-most, most, (700, depth))
        leaves = np.concatenate([leaves, leaves[:50], np.repeat(leaves[:1], 100, axis=0)])
        leaves = leaves[np.lexsort(leaves.T[::-1])]
        book = np.concatenate([leaves[::37], leaves[::37]])
        entry, distance = V.walk(leaves, book)
        all_of = ((leaves[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (entry == all_of.argmin(axis=1)).all() and (distance == all_of.min(axis=1)).all()


def test_edges(spark):
    ddl = "vec_id long, embedding array<double>, label int"
    assert V.compress(spark.createDataFrame([], ddl)).count() == 0
    assert V.compress(spark.createDataFrame([(1, None, 1)], ddl)).count() == 0
    few = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, [1.0, 2.0, 3.0, 5.0], 1), (3, [], 1), (4, [7.0] * 6, 2), (5, [7.5] * 6, 2)]
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in V.compress(spark.createDataFrame(few, ddl)).collect()}
    # Equal parts take the lowest index; a vector without components and other lengths are coded apart.
    assert got == {1: ("00000000", 0, 0), 2: ("00000001", 0, 0), 3: ("00000000", 0, 0), 4: ("00000000", 0, 0), 5: ("01010101", 0, 0)}
    with pytest.raises(Exception, match="too large"):
        V.compress(spark.createDataFrame([(1, [1e30] * 4, 1)], ddl)).collect()


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert by_id(V.compress(spark.read.parquet(f"{SF}/embeddings.parquet"))) == sorted(con.execute(V.codes_sql()).fetchall(), key=repr)
