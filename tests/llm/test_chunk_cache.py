import random
import re

from pubspark.llm import library_tokens as L
from pubspark.llm.chunk_cache import ChunkEncoder


class Counted(list):
    passes = 0

    def __iter__(self):
        self.passes += 1
        return super().__iter__()


def test_chunks_are_passed_over_twice():
    own = ChunkEncoder(lambda chunks: [c.encode() for c in chunks], capacity=3, longest=4)
    for words in (["ab", "c", "ab"], [], ["c", "longer one", "d"], ["e", "f", "ab"], ["longer one", "d"]):
        docs = [Counted(words), Counted(words[:1])]
        assert own.encode(docs) == ["".join(d).encode() for d in docs]
        for d in docs:
            d.passes = 0
        own.encode(docs)
        assert max(d.passes for d in docs) <= 2
    fresh = Counted(["g", "h"])
    own.encode([fresh])
    assert fresh.passes <= 2  # also with chunks not met before
    assert all(len(c) <= 4 for c in own.young)


def test_patterns_find_what_is_meant():
    r = random.Random(1)
    for _ in range(20_000):
        t = "".join(r.choice("  \n\t .,aZé1") for _ in range(r.randrange(9)))
        assert bool(L._UNSAFE.search(t)) == bool(re.search(r"\s \s|\s \Z", t))
        assert [m.start() for m in L._SIGN.finditer(t)] == [
            k for k in range(1, len(t) - 1) if re.fullmatch(r"[A-Za-z][.,] ", t[k - 1:k + 2])]
    assert L.little_endian([1, 258, 70_000]) == b"\1\0\0\0\2\1\0\0\x70\x11\1\0"
