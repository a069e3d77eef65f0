import random

from pubspark.llm import toxic_passages as X
from tests.llm.edge import DOCS, SF, documents, edge_docs

TRAIN = "/root/testdata/sf0.1"


def maximal(v):
    """All maximal scoring segments by their definition: the best one, then left and right of it."""
    sums = [0.0]
    for x in v:
        sums.append(sums[-1] + x)
    best = max(((sums[j] - sums[i], i - j, i, j) for i in range(len(v)) for j in range(i + 1, len(v) + 1)), default=(0,))
    if best[0] <= 1e-12:
        return []
    s, _, i, j = best
    return maximal(v[:i]) + [(i, j - 1, round(s, 6))] + [(a + j, b + j, c) for a, b, c in maximal(v[j:])]


def test_segments_equal_their_definition():
    r = random.Random(5)
    for _ in range(800):
        n, drift = r.randint(1, 22), 0.61
        hits = [(i, r.random() * 3 + 0.2) for i in range(n) if r.random() < 0.4]
        v = [-drift] * n
        for i, s in hits:
            v[i] = s
        assert [(a, b, round(c, 6)) for a, b, c in X.segments(hits, drift)] == maximal(v)


def test_scan_is_linear():
    assert len(X.segments([(i, 1.0) for i in range(0, 400_000, 2)], 3.0)) == 200_000
    assert len(X.segments([(i, 1.0) for i in range(0, 400_000, 2)], 0.1)) == 1


def test_held_out_accuracy(spark):
    docs, labels = documents(spark, TRAIN), spark.read.parquet(f"{TRAIN}/labels.parquet")
    model = X.fit(docs, labels)
    rows = X.toxicity_report(docs, model).join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r.toxic and r.predicted for r in rows)
    assert hit >= 0.7 * sum(r.toxic for r in rows)
    assert hit >= 0.9 * sum(r.predicted for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", X.F.when(X.is_held_out(X.F.col("doc_id")), 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    assert X.fit(docs, labels) == X.fit(docs, flipped)


def test_edges(spark):
    labels = spark.createDataFrame([(1, 0, 0), (4, None, 1), (None, 1, 1), (5, 1, None), (5, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = X.fit(edge_docs(spark), known)
        got = X.toxicity_report(edge_docs(spark), model).collect()
        assert sorted((r.doc_id for r in got), key=repr) == sorted((i for i, _ in DOCS), key=repr)
        assert all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 5}) == 1
        assert X.toxicity_report(edge_docs(spark, []), model).count() == 0
        assert X.keep_clean(edge_docs(spark), model).columns == edge_docs(spark).columns
    assert X.fit(edge_docs(spark, []), labels).scores == {}
