"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A text is split by the tokenizer's pattern; each piece is merged on its own. Leaf ``i`` of the
piece's segment tree holds the rank of the pair that starts at byte ``i`` and the inner nodes
the leftmost minimum below them. A merge reads the root, joins the pair with its right
neighbour, and updates the leaves of the merged token, of its right part (now dead) and of the
live token to its left: three walks of logarithmic length. Short pieces of equal tree size are
merged side by side in numpy rows, one merge per row and round; long pieces run alone.

Defined results: null text reads as empty and gives no ids; rows are encoded one by one, so
repeated rows give equal results; other columns play no part. There is no limit on length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubspark.llm.chunk_cache import ChunkEncoder, slices
from pubspark.llm.common import as_batch, texts

#: No pair.
NONE = np.int64(1) << 62
#: Pieces up to this many bytes are merged in numpy rows.
SIDE_BY_SIDE = 64
#: A space here does not surely begin a new piece: white space on both sides of it.
UNSAFE = re.compile(r"\s \s|\s \Z")


class BytePairCodec:
    """Ranks of a ``.tiktoken`` file (base64 token and rank per line) and a split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.n = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.n
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a * self.n + b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.chunks = ChunkEncoder(self._encode_chunks)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of token ids, NONE where the two do not merge."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def _merge_rows(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Merge pieces of 2 to ``size`` bytes (a power of two), a numpy row each."""
        m = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, m)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8)
        ids = self.byte_ids[raw].reshape(m, size)
        place = np.arange(size)
        live = place < lengths[:, None]
        after = np.broadcast_to(place + 1, (m, size)).copy()   # next live position
        before = np.broadcast_to(place - 1, (m, size)).copy()  # previous one, -1: none
        tree = np.full((m, 2 * size), NONE)
        rank = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        rank = np.where(live[:, 1:] & (rank != NONE), rank * size + place[:-1], NONE)
        tree[:, size:2 * size - 1] = rank
        for node in range(size - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        rows = np.arange(m)
        while True:
            root = tree[rows, 1]
            rows = rows[root != NONE]
            if not len(rows):
                break
            root = root[root != NONE]
            at = root % size
            right = after[rows, at]
            live[rows, right] = False
            ids[rows, at] = root // size
            nxt = after[rows, right]
            after[rows, at] = nxt
            has = nxt < lengths[rows]
            before[rows[has], nxt[has]] = at[has]
            own = np.full(len(rows), NONE)
            own[has] = self._keyed(ids[rows[has], at[has]], ids[rows[has], nxt[has]], at[has], size)
            prev = before[rows, at]
            some = prev >= 0
            r, p = rows[some], prev[some]
            left = self._keyed(ids[r, p], ids[r, at[some]], p, size)
            for who, leaf, value in ((rows, right, NONE), (rows, at, own), (r, p, left)):
                node = leaf + size
                tree[who, node] = value
                while size > 1 and len(node) and node[0] > 1:
                    node = node >> 1
                    tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
        out = ids.astype("<u4")
        return [row[keep].tobytes() for row, keep in zip(out, live, strict=True)]

    def _keyed(self, left, right, at, size):
        rank = self._pair_ranks(left, right)
        return np.where(rank == NONE, NONE, rank * size + at)

    def _merge_alone(self, piece: bytes) -> bytes:
        """Merge one long piece over plain lists."""
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        none = int(NONE)
        ids = [int(self.byte_ids[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        live = bytearray(b"\1") * n

        def key(a: int, b: int) -> int:
            rank = self.pairs.get(ids[a] * self.n + ids[b])
            return none if rank is None else rank * size + a

        tree = [none] * (2 * size)
        for i in range(n - 1):
            tree[size + i] = key(i, i + 1)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, value: int) -> None:
            node = leaf + size
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low

        while tree[1] != none:
            rank, at = divmod(tree[1], size)
            right = after[at]
            nxt = after[right]
            ids[at], live[right], after[at] = rank, 0, nxt
            put(right, none)
            if nxt < n:
                before[nxt] = at
            put(at, key(at, nxt) if nxt < n else none)
            if before[at] >= 0:
                put(before[at], key(before[at], at))
        return np.array([x for x, on in zip(ids, live, strict=True) if on], "<u4").tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids (little-endian unsigned 32-bit) of distinct pieces."""
        out, by_size = {}, {}
        for p in pieces:
            whole = self.ranks.get(p)
            if whole is not None:
                out[p] = whole.to_bytes(4, "little")
            elif len(p) > SIDE_BY_SIDE:
                out[p] = self._merge_alone(p)
            else:
                by_size.setdefault(1 << (len(p) - 1).bit_length(), []).append(p)
        for size, own in by_size.items():
            for i in range(0, len(own), 4096):
                out.update(zip(own[i:i + 4096], self._merge_rows(own[i:i + 4096], size), strict=True))
        return out

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        split = [[p.encode() for p in self.pattern.findall(c)] for c in chunks]
        ids = self.encode_pieces(list(set().union(*split)))
        return [b"".join(map(ids.__getitem__, s)) for s in split]

    def encode_all(self, docs: list[str]) -> list[bytes]:
        return self.chunks.encode([self._split(t) for t in docs])

    def _split(self, text: str) -> list[str]:
        """Chunks of the text, cut before spaces that begin a new piece for sure."""
        if "\0" in text or UNSAFE.search(text):
            return self.pattern.findall(text)
        return text.replace(" ", "\0 ").split("\0")

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[tuple[str, str], BytePairCodec] = {}


def codec(path: str, pattern: str) -> BytePairCodec:
    """One codec per file and worker process."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = BytePairCodec(path, pattern)
    return _codecs[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the text's ``ids`` (array<int>), one row per row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            ids = [np.frombuffer(i, "<u4").astype(np.int32)
                   for part in slices(texts(b)) for i in own.encode_all(part)]
            yield as_batch([b.column("doc_id"), ids], schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the ``bytes`` that the ``ids`` stand for (null ids: empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            yield as_batch([b.column("doc_id"),
                            [own.decode(i or ()) for i in b.column("ids").to_pylist()]], schema)

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(
        run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every text, decode its ids, and digest both, in one narrow stage.

    ``doc_id, n_tokens, ids_sha256`` (of the decimal ids joined by spaces), ``decoded_sha256``.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        decimal = list(map(str, range(own.n)))
        for b in batches:
            n, of_ids, of_bytes = [], [], []
            for part in slices(texts(b)):
                for raw in own.encode_all(part):
                    ids = np.frombuffer(raw, "<u4").tolist()
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(
                        " ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield as_batch([b.column("doc_id"), n, of_ids, of_bytes], schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
