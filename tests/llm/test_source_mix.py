import re
from collections import Counter, defaultdict

import numpy as np

from pubspark.llm import source_mix as M
from tests.llm.edge import DDL, documents, edge_docs

SMALL = M.Settings(block_words=8, shard_words=300, group_words=200, fan_out=3)


def brute_targets(sizes):
    """The same shares by raising a common level step by step."""
    weight = [i % 3 + 1 for i in range(len(sizes))]
    low, high = 0.0, 4.0 * sum(sizes) + 1
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(3 * s, level * w) for s, w in zip(sizes, weight)) < sum(sizes):
            low = level
        else:
            high = level
    return [min(3 * s, high * w) for s, w in zip(sizes, weight)]


def test_targets():
    r = np.random.default_rng(2)
    for sizes in ([10], [0, 5], [100, 1, 1], [1, 1000, 2, 0, 3], *r.integers(0, 1000, (20, 9)).tolist()):
        got = M.targets(np.array(sizes))
        assert np.allclose(got, brute_targets(sizes), atol=1e-6) and abs(got.sum() - sum(sizes)) < 1e-6


def test_permutation():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        p = M.Permutation(np.full(n, n), np.full(n, 99))
        place = p.place(np.arange(n))
        assert sorted(place) == list(range(n)) and (p.block(place) == np.arange(n)).all()


def check(spark, docs, settings):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    rows = {(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()}
    size, sources = Counter(), defaultdict(int)
    for i, s, t in rows:
        sources[s] += len(words(t))
    order = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    target = dict(zip(order, brute_targets([sources[s] for s in order])))

    mixture = M.mix(docs, settings)
    pieces, out = mixture.pieces.collect(), M.taken_words(docs, settings).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in out) == Counter((i, s, len(words(t))) for i, s, t in rows)
    for s in order:
        own = [r for r in out if r.source == s]
        assert {r.source_size for r in own} == {sources[s]} and all(abs(r.target - target[s]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= 0.5 + 1e-6  # exact but for rounding
        assert all(r.taken <= 3 * r.size for r in own)
    # A word is taken the same number of times as any other of its source, or once more.
    times, block = defaultdict(Counter), defaultdict(int)
    for p in pieces:
        block[p.source, p.draw] += p.n_words
        for k in range(p.first_word, p.first_word + p.n_words):
            times[p.source][p.doc_id, p.text_hash, k] += 1
    for s, of in times.items():
        every = list(of.values()) + [0] * (sources[s] - len(of))
        assert max(every) - min(every) <= 1
    assert max(block.values()) <= settings.block_words
    # Every shard gets its exact share of the draws, each draw goes to one shard.
    shard = defaultdict(set)
    for p in pieces:
        shard[p.source, p.draw].add(p.shard)
    assert all(len(v) == 1 for v in shard.values())
    draws = Counter(next(iter(v)) for v in shard.values())
    assert max(draws.values()) - min(draws.values()) <= 1
    # Reruns agree, also over other partitions.
    again = M.mix(docs.repartition(7), settings).pieces
    assert Counter(map(tuple, pieces)) == Counter(map(tuple, again.collect()))
    texts = M.mixed_texts(docs, mixture).collect()
    assert Counter(w for r in texts for w in words(r.text)) == Counter(
        w for p in pieces for w in words(next(t for i, s, t in rows if (i, s) == (p.doc_id, p.source) and len(words(t)) >= p.first_word + p.n_words))[p.first_word:p.first_word + p.n_words])
    return draws


def test_documents(spark):
    docs = documents(spark)
    draws = check(spark, docs, M.Settings(block_words=32, shard_words=3000, group_words=1500, fan_out=4))
    assert len(draws) > 20


def test_few_sources_hot_one_and_null(spark):
    rows = [(i, "w " * (i % 13), "hot" if i % 3 else None) for i in range(300)] + [(900, "one two three", "tiny"), (901, None, "none")]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), SMALL)


def test_edges(spark):
    assert M.taken_words(spark.createDataFrame([], DDL.replace("lang", "source"))).count() == 0
    odd = edge_docs(spark).withColumnRenamed("lang", "source")
    got = sorted((tuple(r) for r in M.taken_words(odd).collect()), key=repr)
    assert len(got) == 9 and sum(r[5] for r in got) == got[0][3] == sum(r[2] for r in got)  # repeated rows are one
    empty = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted(tuple(r)[2:] for r in M.taken_words(empty).collect()) == [(0, 0, 0.0, 0)] * 2


def test_tree_splits_as_blind_draws():
    quota = np.array([400, 100, 0, 500])
    leaves = [list(M.split_node(np.arange(4), np.zeros(4, int), quota, 0, 10, 10, 1000, 1, seed)) for seed in range(300)]
    first = np.array([sum(q[n == 0].sum() for low, _, n, _, q in l if low == 0) for l in leaves])
    assert abs(first.mean() - 40) < 1.5 and abs(first.std() - np.sqrt(100 * .4 * .6 * 900 / 999)) < 0.8
    for l in leaves:
        for source in range(4):
            ends = sorted((int(f[n == source][0]), int(q[n == source][0])) for _, _, n, f, q in l if (n == source).any())
            assert sum(q for _, q in ends) == quota[source]
            assert all(a[0] + a[1] == b[0] for a, b in zip(ends, ends[1:]))  # disjoint, without gaps
        assert {int(q.sum()) for _, _, _, _, q in l} == {100}
    assert M._hypergeometric(np.random.default_rng(1), 10**10, 10**10, 10**9) in range(4 * 10**8, 6 * 10**8)
