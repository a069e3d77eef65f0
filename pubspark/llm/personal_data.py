r"""Personal data: offset-preserving deobfuscation in front of the detectors.

Base spans are found in the text itself, leftmost and non-overlapping per kind:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)``, parts at most 255
* card ``[0-9]([\x20-]?[0-9])+``, 12 to 19 digits that pass Luhn
* phone ``\+[0-9][\x20().0-9-]+[0-9]``, 9 to 15 digits

Then transducers rewrite the text: look-alike letters, digits and signs become ASCII and invisible
characters go, spelled digits in a row become digits, and ``[at]``, ``(dot)`` or spelled ``at`` and
``dot`` between name parts become ``@`` and ``.``. Each carries, for every output character, the
source range that it stands for. Detectors run on the output where it differs, and their spans
are mapped back to source characters. They are added unless they overlap a base span.

Offsets are code points, end exclusive. Defined results: null text reads as empty and has no
spans; rows are judged one by one, so repeated rows give equal results; other columns play no
part; no limit on length: every scan is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubspark.llm.common import as_batch, texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The leftmost match starts where a run of digits does; possessive runs fail without retries.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

#: FIXED VALUES: look-alikes beyond Unicode's own compatibility forms (full-width, styled and
#: circled characters, other scripts' digits), by the ASCII character that they imitate.
LOOK_ALIKES = {
    "a": "аα", "B": "ВΒ", "A": "АΑ", "c": "сϲ", "C": "СϹ", "d": "ԁ", "e": "еҽ", "E": "ЕΕ", "g": "ɡ",
    "H": "НΗ", "h": "һ", "i": "іι", "I": "ІΙ", "j": "ј", "J": "Ј", "k": "κк", "K": "КΚ", "l": "ӏ",
    "M": "МΜ", "N": "Ν", "n": "ո", "o": "оοօ", "O": "ОΟ", "p": "рρ", "P": "РΡ", "q": "ԛ", "s": "ѕ",
    "S": "Ѕ", "T": "ТΤ", "u": "υս", "v": "ν", "w": "ԝ", "x": "хχ", "X": "ХΧ", "y": "у", "Y": "ҮΥ",
    "Z": "Ζ", "-": "‐‑‒–—−", ".": "․·", "0": "߀", "3": "З", "@": "﹫",
}
#: FIXED VALUES: characters that print nothing.
INVISIBLE = "­​‌‍⁠﻿"
#: FIXED VALUES: digits as spelled in English.
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
           "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_IMITATES = {c: ascii_ for ascii_, cs in LOOK_ALIKES.items() for c in cs}
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")
_SPELLED = re.compile(r"(?<![a-z])(?:" + "|".join(SPELLED) + r")(?![a-z])", re.I)
# White space before the bracket is taken from where it begins, so a long run is read once.
_BRACKET = re.compile(r"(?:(?<!\s)\s++|)[\[({<]\s*+(at|dot|@|\.)\s*+[\])}>]\s*+", re.I)
_AT_DOT = re.compile(r"(?<=[A-Za-z0-9._%+-])\s++at\s++(?=[A-Za-z0-9-]++\s++dot\s)|"
                     r"(?<=[A-Za-z0-9-])\s++dot\s++(?=[A-Za-z0-9])", re.I)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The name part is the run before the sign, as far back as the last match's end."""
    end, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                yield start, end
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _digits(text: str, m: re.Match) -> str:
    return "".join(_DIGIT.findall(text, m.start(), m.end()))


def detect(text: str) -> list[Span]:
    """Spans of the four kinds, by kind, then start."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 12 <= len(d := _digits(text, m)) <= 19 and _luhn(d):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(text, m)) <= 15:
                spans.append(("phone", *m.span()))
    return spans


class Traced:
    """A rewritten text; character ``i`` stands for source characters ``start[i]:end[i]``."""

    def __init__(self, text: str):
        self.text, self.changed = text, False
        self.start: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace each ``from:to`` (in order, apart) by its string; all its characters stand for
        the whole source range."""
        if not edits:
            return
        parts, starts, ends, last = [], [], [], 0
        for a, b, new in edits:
            parts += (self.text[last:a], new)
            starts += self.start[last:a]
            ends += self.end[last:a]
            starts += [self.start[a]] * len(new)
            ends += [self.end[b - 1]] * len(new)
            last = b
        self.text = "".join(parts) + self.text[last:]
        self.start = starts + list(self.start[last:])
        self.end = ends + list(self.end[last:])
        self.changed = True

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.start[a], self.end[b - 1]


@cache
def plain(c: str) -> str:
    """The ASCII character that ``c`` imitates, "" if it prints nothing, else itself."""
    if c in INVISIBLE:
        return ""
    if c in _IMITATES:
        return _IMITATES[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and " " < form < "\x7f" else c


def _unspelled(text: str) -> list[tuple[int, int, str]]:
    """Edits for runs of digits of which some are spelled: the words become digits, and the
    spaces and hyphens between spelled ones go."""
    edits: list[tuple[int, int, str]] = []
    for m in _SPELLED.finditer(text):
        start = m.start()
        if edits and start - edits[-1][1] <= 3 and not text[edits[-1][1]:start].strip(" -"):
            start = edits[-1][1]  # join to the word before
        edits.append((start, m.end(), SPELLED[m[0].lower()]))
    if re.search(r"(?i)(?<![a-z])plus\s", text) and edits:
        signs = [(m.start(), m.end(), "+") for m in re.finditer(r"(?i)(?<![a-z])plus\s+(?=[0-9]|" + "|".join(SPELLED) + ")", text)]
        edits = sorted(edits + signs)
    return edits


def deobfuscate(text: str) -> Traced:
    """The text through all transducers."""
    out = Traced(text)
    if not text.isascii():
        out.rewrite([(m.start(), m.end(), p) for m in _NOT_ASCII.finditer(text)
                     if (p := plain(m[0])) != m[0]])
    if _SPELLED.search(out.text):
        out.rewrite(_unspelled(out.text))
    signs = {"at": "@", "@": "@", "dot": ".", ".": "."}
    if any(c in out.text for c in "[({<"):
        out.rewrite([(m.start(), m.end(), signs[m[1].lower()]) for m in _BRACKET.finditer(out.text)])
    if "dot" in out.text.lower():
        out.rewrite([(m.start(), m.end(), signs[m[0].strip().lower()]) for m in _AT_DOT.finditer(out.text)])
    return out


def sort_spans(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, each by start, then kind."""
    base = sort_spans(detect(text))
    traced = deobfuscate(text)
    if not traced.changed:
        return base, base
    taken = sorted((a, b) for _, a, b in base)
    added, k = [], 0
    for kind, a, b in sorted(((kind, *traced.source(a, b)) for kind, a, b in detect(traced.text)),
                             key=lambda s: s[1]):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k == len(taken) or taken[k][0] >= b:
            added.append((kind, a, b))
    return base, sort_spans(base + added)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


REPORT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS),
                    ("base_sha256", pa.string()), ("spans", pa.string())])


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Per document: base counts by kind, digest of the base spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [all_spans(t) for t in texts(b)]
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
            yield as_batch([b.column("doc_id"), *counts,
                            [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                            [joined(spans) for _, spans in found]], REPORT)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
        + ", base_sha256 string, spans string")


def mask(text: str) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans are
    replaced together, by the first one's kind."""
    parts, last = [], 0
    for kind, a, b in all_spans(text)[1]:
        if a >= last:
            parts += (text[last:a], f"<{kind}>")
        last = max(last, b)
    return "".join(parts) + text[last:] if last else text


def mask_documents(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, personal data masked in ``text`` (null stays null) and
    ``n_chars``, where there is such a column, counted anew."""

    @F.pandas_udf("string")
    def masked(text):
        return text.map(lambda t: None if t is None else mask(t))

    out = docs.withColumn("text", masked(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out
