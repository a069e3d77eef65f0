import base64
import hashlib
import random

import public_tokenizers as P
import pytest
from tiktoken import Encoding

from pubspark.llm import byte_pair as B
from tests.llm.edge import DOCS, documents, edge_docs

PATH = P.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  ", "   a", "a   ", "a \n b", "a\n\n  b  \t x　 y", "x\x1c y", "a\0 b", "日本語 １２३ é", "a" * 5000,
       "ab" * 3000 + "  ", "é" * 300, "😀 😀😀", "don't we'll 'S", "!!!  ???", "x" * 64 + " " + "y" * 65]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_ids_equal_the_library_and_decode_back(library):
    own = B.codec(PATH, P.PATTERN)
    r = random.Random(3)
    texts = ODD + ["".join(r.choice(" \n\tab1'é.\x1c 　_") for _ in range(r.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        ids = own.encode(t)
        assert ids == library.encode_ordinary(t)
        assert own.decode(ids) == t.encode()


def test_both_merges_agree(library):
    own = B.codec(PATH, P.PATTERN)
    r = random.Random(4)
    for _ in range(300):
        piece = "".join(r.choice("abcdethé") for _ in range(r.randint(2, 31))).encode()
        size = 1 << (len(piece) - 1).bit_length()
        assert own._merge_rows([piece], size) == [own._merge_alone(piece)]


def test_query_rows(spark, library):
    got = B.round_trip(documents(spark), PATH, P.PATTERN).collect()
    text = {r.doc_id: r.text for r in documents(spark).collect()}
    assert len(got) == len(text)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digests(library, text[r.doc_id])


def test_edges(spark, library):
    got = sorted((tuple(r) for r in B.round_trip(edge_docs(spark), PATH, P.PATTERN).collect()), key=repr)
    assert got == sorted(((i, *digests(library, t)) for i, t in DOCS), key=repr)
    assert B.round_trip(edge_docs(spark, []), PATH, P.PATTERN).count() == 0
    encoded = B.encode_documents(edge_docs(spark), PATH, P.PATTERN)
    decoded = B.decode_documents(encoded, PATH, P.PATTERN).collect()
    assert sorted(((r.doc_id, bytes(r.bytes)) for r in decoded), key=repr) == sorted(((i, (t or "").encode()) for i, t in DOCS), key=repr)
