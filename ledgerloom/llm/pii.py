"""Personal data, with offset-preserving deobfuscation.

Four kinds of identifiers are found in the text as it stands. Then a chain of small transducers rewrites the text:
look-alike characters become ASCII, invisible ones vanish, spelled digits become digits and at/dot disguises become
the signs. Every character written keeps the source range it came from, so identifiers found in the rewritten text
map back to characters of the source. They are added to the plain findings, which always stay.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.units import free_encoders

# Kinds in their order, and the patterns of the contract.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters and signs that look like ASCII ones (Cyrillic, Greek, punctuation).
_LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁһкмтвнАЕОРСУХІЈЅКМТВНαονιρκτυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ․‧∙·‐‑‒–—−﹫﹒",
        "aeopcyxijsdhkmtbhAEOPCYXIJSKMTBHaovipktuABEZHIKMNOPTYX....------@.",
        strict=True,
    )
)
_INVISIBLE = "­​‌‍⁠﻿"
_VANISHING = re.compile(f"[{_INVISIBLE}]")

# Digits in words (English, German, French, Spanish).
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_DIGIT = "(?:" + "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True)) + ")"
_AT = r"(?:at|arroba|arobase|chez|ät)"
_DOT = r"(?:dot|punkt|punto|point)"
_DIGIT_RUN = re.compile(rf"(?<!\w)(?:plus[ ])?(?:{_DIGIT}|[0-9])(?:(?:[ \-,]{{1,2}}|\.|[ ]{_DOT}[ ])(?:{_DIGIT}|[0-9]))+(?!\w)", re.IGNORECASE)
_DIGIT_PART = re.compile(rf"{_DIGIT}|[0-9.]|{_DOT}|plus", re.IGNORECASE)
_SIGNS = re.compile(rf"[ ]?[\[({{<][ ]?(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))[ ]?[\])}}>][ ]?", re.IGNORECASE)
_SPOKEN = re.compile(rf"(?P<at>@|[ ](?:{_AT}|@)[ ])(?P<domain>[A-Za-z0-9-]++(?:(?:\.|[ ]{_DOT}[ ])[A-Za-z0-9-]++)++)", re.IGNORECASE)
_SPOKEN_DOT = re.compile(rf"[ ]{_DOT}[ ]", re.IGNORECASE)
_SPOKEN_DOT_BEFORE = re.compile(rf"[ ]{_DOT}[ ]\Z", re.IGNORECASE)
_DOTTED = re.compile(rf"(?<![0-9])[0-9]++(?:(?:\.|[ ]{_DOT}[ ])[0-9]++){{3,}}", re.IGNORECASE)
_BRACKET_HINT = re.compile(r"[\[({<][ ]?(?:at|arroba|arobase|chez|ät|@|dot|punkt|punto|point|\.)[ ]?[\])}>]", re.IGNORECASE)
_SPOKEN_HINTS = (" dot ", " punkt ", " punto ", " point ")


@lru_cache(maxsize=4096)
def _folded(ch: str) -> str:
    """ASCII character that `ch` stands for, "" for an invisible one, else `ch`."""
    if ch in _INVISIBLE:
        return ""
    if ch in _LOOKALIKES:
        return _LOOKALIKES[ch]
    if (digit := unicodedata.digit(ch, None)) is not None and unicodedata.category(ch) == "Nd":
        return str(digit)
    plain = unicodedata.normalize("NFKC", ch)
    return plain if len(plain) == 1 and plain.isascii() and plain.isprintable() and plain != " " else ch


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def find_plain(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the identifiers in a text as it stands, by kind and start. A match that fails its
    check is dropped and not tried again from a later character."""
    spans, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            spans.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return spans


class Traced:
    """A text with the source range of each character, kept as runs: characters of a run either stand one by one for
    the source characters from its start on, or each for its whole range."""

    def __init__(self, text: str, starts: list[int] | None = None, runs: list[tuple[int, int, bool]] | None = None):
        self.text, self.starts, self.runs = text, starts or [0], runs or [(0, len(text), True)]

    def source(self, i: int) -> tuple[int, int]:
        """Source range of a character."""
        k = bisect_right(self.starts, i) - 1
        a, b, even = self.runs[k]
        return (a + i - self.starts[k], a + i - self.starts[k] + 1) if even else (a, b)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Traced:
        """Replace (start, end, new) ranges, in order. Each new character spans its whole range."""
        if not edits:
            return self
        text, starts, runs, size = [], [], [], 0

        def keep(a: int, b: int) -> None:
            nonlocal size
            text.append(self.text[a:b])
            k = bisect_right(self.starts, a) - 1
            while a < b:
                x, y, even = self.runs[k]
                end = min(b, self.starts[k + 1]) if k + 1 < len(self.starts) else b
                if even:
                    x, y = x + a - self.starts[k], x + end - self.starts[k]
                starts.append(size)
                runs.append((x, y, even))
                size, a, k = size + end - a, end, k + 1

        done = 0
        for a, b, new in edits:
            keep(done, a)
            if new:
                text.append(new)
                starts.append(size)
                runs.append((self.source(a)[0], self.source(b - 1)[1], False))
                size += len(new)
            done = b
        keep(done, len(self.text))
        return Traced("".join(text), starts, runs)


def _fold(t: Traced) -> Traced:
    """Characters that stand for one other change in place; those that stand for none vanish."""
    if t.text.isascii():
        return t
    new = {ord(c): _folded(c) for c in set(t.text) if c > "\x7f"}
    folded = Traced(t.text.translate({c: n for c, n in new.items() if n}), t.starts, t.runs)
    return folded.rewrite([(*m.span(), "") for m in _VANISHING.finditer(folded.text)])


def _digit_runs(text: str) -> Iterator[tuple[int, list[re.Match]]]:
    """(start, parts) of each run of digits of which two at least are spelled."""
    for run in _DIGIT_RUN.finditer(text):
        parts = list(_DIGIT_PART.finditer(text, *run.span()))
        if sum(p[0].lower() in _DIGIT_WORDS for p in parts) >= 2:
            yield run.start(), parts


def _spelled(t: Traced) -> Traced:
    """Runs of spelled digits; each word becomes one digit, "dot" between digits a dot, and other separators vanish."""
    edits = []
    for at, parts in _digit_runs(t.text):
        for p in parts:
            word = p[0].lower()
            if p.start() > at:
                edits.append((at, p.start(), ""))
            edits.append((*p.span(), "+" if word == "plus" else _DIGIT_WORDS.get(word, word if word.isdigit() else ".")))
            at = p.end()
    return t.rewrite(edits)


def _bracketed(t: Traced) -> Traced:
    return t.rewrite([(*m.span(), "@" if m["at"] else ".") for m in _SIGNS.finditer(t.text)])


def _local_start(text: str, at: int, end: int) -> int:
    """Start of the local part that ends at `at`, not before `end`; spoken dots join its pieces."""
    start = at
    while True:
        piece = start
        while piece > end and text[piece - 1] in _LOCAL:
            piece -= 1
        if piece == start:
            return start if start == at else start + len(_SPOKEN_DOT.match(text, start)[0])
        dot = _SPOKEN_DOT_BEFORE.search(text[max(end, piece - 8) : piece])
        if dot is None:
            return piece
        start = piece - len(dot[0])


def _signs(t: Traced) -> Traced:
    """At and dot in words, also beside signs and former brackets. A spoken at counts only if a dot of the domain is
    spoken or was bracketed; four groups of digits need one spoken dot."""
    edits, end, text = [], 0, t.text
    for m in _SPOKEN.finditer(text):
        (at, after), (first, last) = m.span("at"), m.span("domain")
        dots = [d.span() for d in _SPOKEN_DOT.finditer(text, first, last)]
        hidden = dots or any(text[i] == "." and t.source(i)[1] - t.source(i)[0] > 1 for i in range(first, last))
        start = _local_start(text, at, end) if m["at"] == "@" or hidden else at
        if start < at:
            edits += [(*d.span(), ".") for d in _SPOKEN_DOT.finditer(text, start, at)]
            edits += [(at, after, "@")] * (m["at"] != "@") + [(a, b, ".") for a, b in dots]
            end = last
    t = t.rewrite(edits)
    return t.rewrite([(*d.span(), ".") for m in _DOTTED.finditer(t.text) for d in _SPOKEN_DOT.finditer(t.text, *m.span())])


def find_spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(plain findings, all findings), each by kind and start; positions count code points, ends are exclusive. A text
    is searched whole, however long; beside copies of it, memory grows with the number of rewritten places only."""
    if not text:
        return [], []
    plain = find_plain(text)
    low = text.lower()
    strange = not text.isascii() and any(_folded(c) != c for c in set(text) if c > "\x7f")
    signs = _BRACKET_HINT.search(text) is not None or any(h in low for h in _SPOKEN_HINTS)
    spelled = next(_digit_runs(text), None) is not None
    if not (strange or signs or spelled):
        return plain, plain
    t = Traced(text)
    for step in (_fold, _bracketed, _spelled, _signs):
        t = step(t)
    taken = {kind: [(a, b) for k, a, b in plain if k == kind] for kind in KINDS}
    found = list(plain)
    if t.text != text:
        for kind, a, b in find_plain(t.text):
            a, b = t.source(a)[0], t.source(b - 1)[1]
            # An address that was found in part is found again as a whole.
            if all(b <= x or a >= y or (kind == "email" and a <= x and y <= b and b - a > y - x) for x, y in taken[kind]):
                found.append((kind, a, b))
    return plain, sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first counts, the
    longest among those that start together, and the rest of the others is removed with it."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of `docs` (doc_id, text): counts and
    digest of the plain findings, and all findings. Null and empty texts have none. Rows with null or repeated
    doc_id are judged like any other; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[0] == kind for s in plain) for plain, _ in found], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *counts,
                    pa.array([sha256(_listed(plain).encode()).hexdigest() for plain, _ in found], pa.string()),
                    pa.array([_listed(all_) for _, all_ in found], pa.string()),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked_documents(docs: DataFrame) -> DataFrame:
    """`docs` with every finding in `text` replaced by its kind, and n_chars (if there is one) counted anew. All
    rows and columns stay; a null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_encoders()
        for batch in batches:
            texts = [None if t is None else masked(t, find_spans(t)[1]) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    done = row.mapInArrow(run, row.schema)
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return done.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])
