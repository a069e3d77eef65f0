import re
from collections import Counter

import duckdb

from pubspark.llm import quality_rules as Q
from tests.llm.edge import DOCS, SF, documents, edge_docs


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {p for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = (text or "").split("\n")
    dups = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dups, len(hit), failed


def base(rows):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in rows), key=repr)


def test_base_counts_equal_their_definition(spark):
    rows = documents(spark).collect()
    assert base(Q.quality_report(documents(spark)).collect()) == sorted(((r.doc_id, *brute(r.text)) for r in rows), key=repr)


def test_report_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = Q.quality_report(documents(spark))
    expected = con.execute(f"SELECT {', '.join(got.columns)} FROM ({Q.report_sql()})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_edges(spark):
    got = Q.quality_report(edge_docs(spark), with_text=True).collect()
    assert base(got) == sorted(((i, *brute(t)) for i, t in DOCS), key=repr)
    assert all(not r.kept for r in got if not r.n_words)
    assert Q.quality_report(edge_docs(spark, [])).count() == 0
    kept = Q.keep_good(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns and kept.count() == 0


def test_line_rules():
    lines = [" ".join(f"Word{chr(97 + i)}{chr(97 + j)}" for j in range(10)) + "." for i in range(8)]
    text = "\n".join(lines)
    assert Q.judge(text).kept
    menu = "Home | News | About | Contact | Help"
    assert Q.judge(text + "\n" + menu).clean_text == text
    assert not Q.judge("\n".join(f"{menu} | {i} | more | of | it" for i in range(20))).kept
    assert not Q.judge("\n".join(f"word{i}### of$$$ this*** text&&& here%%% now" for i in range(20))).kept
    assert Q.judge(text + "\nCopyright, all rights reserved.").clean_text == text
    assert Q.judge(text + "\nNext page").clean_text == text
    assert Q.judge("\n".join([text, lines[3]])).n_dup_lines == 1
    assert Q.judge("Слово другое третье, и ещё одно.\n" * 1 + text).kept
