import hashlib
import random
import re
import time

import pytest

from pubspark.llm import personal_data as D
from tests.llm.edge import DOCS, documents, edge_docs


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(t):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return D.sort_spans(out)


@pytest.mark.parametrize("alphabet", ["1.2 -3+()45@ab", "a.@b-c1 ", "0123456789 -", "+12 ().-"])
def test_base_spans_equal_their_patterns(alphabet):
    r = random.Random(2)
    for _ in range(5000):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
        assert brute(t) == D.sort_spans(D.detect(t))


@pytest.mark.parametrize("text, found", [
    ("mail john [at] example (dot) com now", ["john [at] example (dot) com"]),
    ("john at example dot com", ["john at example dot com"]),
    ("jоhn@exаmple.com", ["jоhn@exаmple.com"]),
    ("call plus one four eight seven five five five seven two zero nine", ["plus one four eight seven five five five seven two zero nine"]),
    ("card four five three two 0151 1283 0366 x", ["four five three two 0151 1283 0366"]),
    ("４５３２０１５１１２８３０３６６", None),
    ("call +1 (487) 555–7209", ["+1 (487) 555–7209"]),
    ("ip 10[.]2[.]3[.]4", ["10[.]2[.]3[.]4"]),
    ("x​@y.com and a@b.co", ["x​@y.com", "a@b.co"]),
    ("see us at example.com or dot the i", []), ("one two three", []), ("he is at home dot", []),
    ("Привет, мир", [])])
def test_disguises_map_back_to_the_source(text, found):
    base, spans = D.all_spans(text)
    assert set(base) <= set(spans)
    assert [text[a:b] for _, a, b in spans] == ([text] if found is None else found)


def test_long_texts_take_linear_time():
    began = time.time()
    for t in ("1" * 200_000 + "." * 5, "a." * 100_000 + "@", "1.2.3" * 50_000, "(" + " " * 100_000, "( " * 50_000 + " dot ",
              "+1" + "(" * 100_000, "@" * 100_000, "at dot " * 30_000, "one " * 50_000):
        D.all_spans(t)
    assert time.time() - began < 30


def row(i, t):
    base, spans = brute(t or ""), D.all_spans(t or "")[1]
    return (i, *(sum(s[0] == k for s in base) for k in D.KINDS), hashlib.sha256(D.joined(base).encode()).hexdigest(), D.joined(spans))


def test_query_rows_and_edges(spark):
    docs = documents(spark)
    assert sorted(map(tuple, D.personal_data_report(docs).collect())) == sorted(row(r.doc_id, r.text) for r in docs.collect())
    got = sorted(map(tuple, D.personal_data_report(edge_docs(spark)).collect()), key=repr)
    assert got == sorted((row(i, t) for i, t in DOCS), key=repr)
    assert D.personal_data_report(edge_docs(spark, [])).count() == 0


def test_mask(spark):
    assert D.mask("a b@c.de, 10.0.0.1!") == "a <email>, <ip>!"
    rows = [(1, "x +1 (487) 555-7209 y"), (2, None), (3, "")]
    got = D.mask_documents(edge_docs(spark, rows))
    assert got.columns == edge_docs(spark, rows).columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect()) == [(1, "x <phone> y", 11), (2, None, None), (3, "", 0)]
