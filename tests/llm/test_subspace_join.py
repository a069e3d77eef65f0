import numpy as np

from pubspark.llm import subspace_join as S
from tests.llm.edge import SF


def brute(rows):
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and any(v)]
    n, up = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for p in good:
        for q in good:
            if p != q and len(rows[p][1]) == len(rows[q][1]):
                a, b = np.array(rows[p][1], float), np.array(rows[q][1], float)
                if (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum()) >= 0.9:
                    n[p] += 1
                    up[find(p)] = find(q)
    low = {}
    for k in good:
        low[find(k)] = min(low.get(find(k), rows[k][0]), rows[k][0])
    out = []
    for k, (i, _) in enumerate(rows):
        part = low[find(k)] if k in set(good) else i
        out.append((i, n[k], part, i == part))
    return sorted(out, key=repr)


def check(df, settings=S.Settings()):
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted((tuple(r) for r in S.near_vectors(df, settings).collect()), key=repr) == brute(rows)


def test_embeddings(spark):
    check(spark.read.parquet(f"{SF}/embeddings.parquet"))


def test_hot_group_in_many_runs_and_edges(spark):
    r = np.random.default_rng(3)
    c = r.standard_normal(20)
    rows = [(i, (c + r.standard_normal(20) * 0.3).tolist()) for i in range(80)]
    rows += [(100 + i, c.tolist()) for i in range(60)] + [(100, c.tolist())]
    rows += [(200, None), (201, [0.0] * 20), (202, [None] + [1.0] * 19), (203, [float("nan")] + [1.0] * 19),
             (204, [float("inf")] * 20), (205, []), (206, [1.0, 2.0]), (207, [2.0, 4.0]), (208, (3 * c).tolist()), (None, c.tolist())]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, set_id long, copies long, vector string")
    check(df.select("vec_id", "embedding", "set_id", "copies", "vector"), S.Settings(width=6, cells=8, run_rows=16))


def test_no_usable_vectors(spark):
    ddl = "vec_id long, embedding array<float>"
    assert S.near_vectors(spark.createDataFrame([], ddl)).count() == 0
    check(spark.createDataFrame([(1, None), (2, [0.0])], ddl))


def test_parts_meet_and_vectors_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_RUNS", 1)
    monkeypatch.setattr(S, "PASSING_PARTS", 2)
    kept, plans = S.materialize, {}

    def spied(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(S, "materialize", spied)
    r = np.random.default_rng(5)
    centres = r.standard_normal((6, 12))
    rows = [(i, (centres[i % 6] + r.standard_normal(12) * 0.2 * (i % 3)).tolist()) for i in range(120)]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), S.Settings(width=4, cells=4, run_rows=5))
    assert "Exchange" not in plans["vector-links"]


def test_spanning_links():
    group = np.arange(6)
    found = S.spanning(group, np.arange(6) * 10, np.array([0, 1, 2, 4, 0]), np.array([1, 2, 0, 5, 1]))
    assert group.tolist() == [0, 0, 0, 3, 4, 4]
    assert sum(len(a) for a, _, _ in found) == 3
