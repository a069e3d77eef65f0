import tempfile
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from pubspark.llm import record_files as R
from tests.llm.edge import DOCS, documents, edge_docs

PATH = P.path("byte_bpe_50k.json")


def ids_of(df):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [(r.doc_id, t.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in df.select("doc_id", "text").collect()]


def test_frames():
    for doc_id, ids in ((5, [1, 2, 70000]), (None, []), (-3, [65535])):
        record = R.frame(R.pack_sequence(doc_id, np.array(ids, "<u4")))
        got, back = R.unpack_sequence(R.unframe(record))
        assert (got, back.tolist()) == (doc_id, ids)
        for bad in (record[:-1], record[:9], b"\1" + record[1:], record[:14] + bytes([record[14] ^ 1]) + record[15:]):
            with pytest.raises(ValueError):
                R.unframe(bad)


def test_documents(spark):
    expected, at = [], 0
    for i, ids in sorted(ids_of(documents(spark))):
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, R.round_trip(documents(spark), PATH, 2).collect())) == expected


def test_small_shards_and_reads_by_index(spark):
    folder = tempfile.mkdtemp(prefix="records-")
    index = R.write_records(documents(spark), folder, PATH, 2, shard_bytes=4096)
    assert index.select("shard").distinct().count() > 8
    some = index.filter("doc_id % 7 = 3")
    got = {r.doc_id: r.ids for r in R.read_records(some, folder).collect()}
    assert got == {i: ids for i, ids in ids_of(documents(spark)) if i % 7 == 3}


def test_edges(spark):
    got = R.round_trip(edge_docs(spark), PATH, 2).orderBy("start").collect()
    expected = {(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in ids_of(edge_docs(spark))}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == expected and len(got) == len(DOCS)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert R.round_trip(edge_docs(spark, []), PATH, 2).count() == 0
