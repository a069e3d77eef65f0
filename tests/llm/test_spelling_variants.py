import random
import re
import zlib
from collections import Counter

import duckdb

from pubspark.llm import spelling_variants as S
from tests.llm.edge import DDL, SF, by_id, documents, edge_docs


def brute(rows):
    """The definition, word pair by word pair."""
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            words[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    links = {a: [b for b in words if near(a, b)] for a in words}
    form = {}
    for a, around in links.items():
        best = min(around, key=lambda b: (-words[b], b), default=None)
        form[a] = best if best is not None and words[best] >= 10 * words[a] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(links[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def planted(seed=5):
    """Words with variants of falling counts, chains of forms, anagrams and repeated letters."""
    r, texts = random.Random(seed), []
    for base in ("kingdomes", "aaaaaaaaa", "ÀÉîøñßÿx", "statements", "Übergrößen"):
        level = [base]
        for n in (1100, 100, 9, 2):
            for w in level:
                texts += [w] * n
            level = [w[:k] + r.choice("abcxyzéß") + w[k + r.randint(0, 1):] for w in level for k in r.sample(range(len(w)), 2)]
        texts += ["".join(r.sample(base, len(base)))] * 3
    r.shuffle(texts)
    return [(i, " ".join(texts[i::40])) for i in range(40)]


def test_against_brute_force(spark):
    rows = planted() + [(None, "kingdomes kingdomez kingdomez"), (7, None), (8, ""), (9, "STATEMENTS_statements0statements×÷")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    for parts in (3, 5):
        assert by_id(S.spelling_variants(df, parts)) == want
    assert any(r[1] and r[1] != r[2] for r in want) and sum(r[4] for r in want) > 100


def test_each_pair_once(spark):
    words = spark.createDataFrame([(w, 2) for w in {"ab" * 4, "ba" * 4, "abababac", "abababcb", "abababa", "abababaa", "aaaaaaa", "aaaaaaaa"}],
                                  "word string, n long")
    pairs = [tuple(sorted((r.a, r.b))) for r in S.near_words(words, 4).collect()]
    assert len(pairs) == len(set(pairs)) > 3


def test_edges_and_sql(spark):
    assert by_id(S.spelling_variants(edge_docs(spark))) == []
    assert S.spelling_variants(spark.createDataFrame([], DDL)).count() == 0
    assert by_id(S.spelling_variants(edge_docs(spark, [(1, "letters " * 40_000), (1, "letters"), (1, "letters")]))) == [
        (w, None, w, 40_002, 0, None) for w in S.document_words(1, "letters", 1)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert by_id(S.spelling_variants(documents(spark))) == sorted(con.execute(S.variants_sql()).fetchall(), key=repr)
