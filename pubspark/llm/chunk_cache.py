"""Encode texts chunk by chunk, remembering the ids of recent chunks in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence


class ChunkEncoder:
    """Ids of texts that are given as lists of chunks whose encodings simply join.

    ``encode_many`` maps distinct chunks to their ids as little-endian unsigned 32-bit bytes.
    At most two generations of ``capacity`` chunks are remembered (about 200 bytes each); chunks
    longer than ``longest`` characters are encoded each time. Neither affects the result.
    """

    def __init__(self, encode_many: Callable[[list[str]], Iterable[bytes]],
                 capacity: int = 500_000, longest: int = 200):
        self.encode_many, self.capacity, self.longest = encode_many, capacity, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, docs: Sequence[list[str]]) -> list[bytes]:
        if len(self.young) > self.capacity:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        # Two passes over the chunks, both without Python code per chunk: most are known.
        new, passing = [], {}
        for c in set().union(*docs).difference(young):
            if c in old:
                young[c] = old[c]
            else:
                new.append(c)
        for c, ids in zip(new, self.encode_many(new), strict=True):
            (young if len(c) <= self.longest else passing)[c] = ids
        ids_of = (lambda c: passing[c] if c in passing else young[c]) if passing else young.__getitem__
        return [b"".join(map(ids_of, d)) for d in docs]


def slices(items: list[str], most_chars: int = 1_000_000) -> Iterable[list[str]]:
    """``items`` in order, in runs of about ``most_chars`` characters (a single longer item is
    a run of its own)."""
    run: list[str] = []
    size = 0
    for t in items:
        if run and size + len(t) > most_chars:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run
