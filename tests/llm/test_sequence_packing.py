import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from pubspark.llm import sequence_packing as S
from tests.llm.edge import DOCS, documents, edge_docs

PATH = P.path("word_bpe_49k.json")


def fewest(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        tried = set()
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in tried:
                tried.add(bins[k])
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def sequences(plan, capacity):
    out = defaultdict(list)
    for length, first, end, each, sequence, offset in plan:
        for r in range(end - first):
            out[sequence + r // each].append((offset + r % each * length, length))
    for own in out.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(out)


def test_reduction_keeps_the_optimum_and_plans_are_sound():
    r = random.Random(1)
    for _ in range(150):
        items = [r.randint(1, 20) for _ in range(r.randint(1, 11))]
        counts = dict(Counter(items))
        fixed, left = S.reduce_by_dominance(counts, 20)
        rest = [k for k, v in left.items() for _ in range(v)]
        best = fewest(items, 20)
        assert sum(t for _, t in fixed) + (fewest(rest, 20) if rest else 0) == best
        assert best <= sequences(S.plan_packing(counts, 20), 20) <= best + 1


def test_plan_size_is_bounded_by_the_capacity():
    r = random.Random(2)
    small = {k: r.randint(0, 50) for k in range(1, 301)}
    large = {k: 100_000 * v for k, v in small.items()}
    assert len(S.plan_packing(large, 300)) <= 4 * 300
    assert len(S.plan_packing({k: v for k, v in small.items() if v}, 300)) <= 4 * 300


def check(df):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    expected = []
    for r in df.select("doc_id", "text").collect():
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        expected += [(r.doc_id, k, at, len(ids[at:at + 2048]), zlib.crc32(ids[at:at + 2048].tobytes()))
                     for k, at in enumerate(range(0, len(ids), 2048))]
    rows = S.pack_documents(df, PATH).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(expected, key=repr)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(held), sum(r.length for r in rows)


def test_documents(spark):
    n, tokens = check(documents(spark))
    assert n <= -(-tokens // 2048) + 2


def test_edges(spark):
    n, _ = check(edge_docs(spark, DOCS + [(20 + i, "same text") for i in range(40)]))
    assert S.pack_documents(edge_docs(spark, []), PATH).count() == 0
