"""Token ids by the ``tokenizers`` library, chunk by chunk, for operators that need them."""

from __future__ import annotations

import gc
import os
import re
import sys
from array import array

from pubspark.llm.chunk_cache import ChunkEncoder

# Both begin with the character looked for, to which a search can skip, and look behind from there.
#: A space here does not surely begin a new piece: white space on both sides of it.
_UNSAFE = re.compile(r" (?<=\s )(?=\s|\Z)")


#: A sign between a letter and a space is a piece of its own.
_SIGN = re.compile(r"[.,](?<=[A-Za-z][.,])(?= )")


def split_words(text: str) -> list[str]:
    """For tokenizers that lower-case and drop white space: chunks between spaces and line feeds,
    and single closing signs. ASCII texts are lower-cased first, so that words at the head
    of a sentence are no chunks of their own."""
    text = text.replace("\n", " ")
    return _SIGN.sub(r" \g<0>", text.lower() if text.isascii() else text).split(" ")


def split_spaced(text: str) -> list[str]:
    """For byte-level tokenizers whose pieces may begin with one space: chunks cut before
    spaces and single closing signs; a text whose runs of white space would be cut is one
    chunk."""
    if "\0" in text or _UNSAFE.search(text):
        return [text]
    return _SIGN.sub("\0\\g<0>", text).replace(" ", "\0 ").split("\0")


def little_endian(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit bytes."""
    raw = array("I", ids)
    if sys.byteorder == "big":
        raw.byteswap()
    return raw.tobytes()


class LibraryEncoder:
    """The tokenizer of a ``.json`` file; special tokens' strings are ordinary text.

    ``split`` cuts a text into chunks whose encodings join to the text's own.
    """

    def __init__(self, path: str, split, capacity: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.split = split
        self.chunks = ChunkEncoder(self._encode_chunks, capacity)

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(chunks), 10_000):
            found = self.tokenizer.encode_batch_fast(chunks[i:i + 10_000], add_special_tokens=False)
            out += [little_endian(e.ids) for e in found]
        return out

    def encode_all(self, docs: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        # Millions of short strings and no cycles: the collector's passes would be in vain.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self.chunks.encode([self.split(t) for t in docs])
        finally:
            if collects:
                gc.enable()


_encoders: dict[tuple, LibraryEncoder] = {}


def encoder(path: str, split, capacity: int = 500_000) -> LibraryEncoder:
    """One encoder per file, capacity and worker process."""
    key = (path, split.__name__, capacity)
    if key not in _encoders:
        _encoders[key] = LibraryEncoder(path, split, capacity)
    return _encoders[key]
