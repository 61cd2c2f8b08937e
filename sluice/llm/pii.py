"""Personal data behind disguises, reported at the characters of the source text.

Plain patterns are found in the text as it is.  Then transducers rewrite it: homoglyphs and
other forms of letters and digits become ASCII, invisible characters go, spelled digits become
digits, and words or brackets for ``@`` and ``.`` become these.  Each rewritten character
knows where it came from, so the same patterns run again on the rewritten text, and what they find is mapped
back.  Plain finds stay; a find that touches a plain one of its kind is that one again.

Offsets are code points, ends exclusive.

Defined results: null counts as empty; a null id stays null; repeated rows are reported each;
the empty table gives no rows; very long texts are read whole, in time proportional to their length.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import prepare

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Looking back keeps the search from starting again at each digit of a run; no match can start there.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
DECIMAL = re.compile(r"[0-9]\.[0-9]")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each ``@``."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1  # nothing before this sign can be part of a later match
        at = text.find("@", max(done, at + 1))


def ips(text: str) -> Iterator[Span]:
    if not DECIMAL.search(text):
        return
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


FINDERS: tuple[Callable[[str], Iterator[Span]], ...] = (emails, ips, cards, phones)


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the plain patterns, sorted."""
    found = [(start, kind, end) for kind, find in enumerate(FINDERS) for start, end in find(text)]
    return sorted(found)


# --- transducers -----------------------------------------------------------------------------

#: Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТХаеорсухіѕјԁԛԝһАΒΕΖΗΙΚΜΝΟΡΤΥΧοντικ",
        "ABEKMHOPCTXaeopcyxisjdqwhABEZHIKMNOPTYXovtik",
        strict=True,
    )
)
INVISIBLE = "­​‌‍⁠﻿"
DIGIT_WORDS = {
    word: str(digit)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for digit, word in enumerate(words.split())
}
#: Spelled digits that a run must have, so that a lone number word stays a word.
LEAST_SPELLED = 3

_digit = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_at, _dot = "at|arobase|arroba", "dot|punkt|point|punto"
SPELLED = re.compile(rf"\b(?:plus\s+)?(?:{_digit})(?:[\s,.-]+(?:{_digit}|{_dot}))*\b", re.I)
SPELLED_WORD = re.compile(rf"(?P<digit>{_digit})|(?P<dot>{_dot})|(?P<plus>plus)", re.I)
BRACKETED = re.compile(rf"\s*[\[({{<]\s*(?:(?P<at>{_at}|@)|(?P<dot>{_dot}|\.))\s*[\])}}>]\s*", re.I)
_label = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
#: ``at`` is an ordinary word in several languages and ``point`` too, so they do not go together.
_worded = rf"(?:at\s+(?={_label}\s+dot\s+[A-Za-z0-9-])|(?:arobase|arroba)\s+(?={_label}\s+(?:{_dot})\s+[A-Za-z0-9-]))"
WORDED = re.compile(rf"(?<=[A-Za-z0-9._%+-])\s+{_worded}", re.I)
WORDED_DOT = re.compile(rf"\s+(?:{_dot})\s+", re.I)
LABELS = re.compile(rf"(?:[A-Za-z0-9.-]|\s+(?:{_dot})\s+(?=[A-Za-z0-9]))+", re.I)
#: Words that can be part of a run of spelled digits.
SPELLING = frozenset((*DIGIT_WORDS, *_dot.split("|")))
WORD = re.compile(r"\w+")


@cache
def glyphs() -> dict[int, str | None]:
    """What each disguised character stands for: forms of ASCII, digits of other scripts, lookalikes."""
    table: dict[int, str | None] = {}
    for point in (*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x2100, 0x2150), *range(0x2460, 0x24EA)):
        form = unicodedata.normalize("NFKC", chr(point))
        if len(form) == 1 and form.isascii():
            table[point] = form
    for point in range(0x80, 0x1FBFA):
        if unicodedata.category(chr(point)) == "Nd":
            table[point] = str(unicodedata.digit(chr(point)))
    table.update((ord(c), latin) for c, latin in LOOKALIKES.items())
    table.update((ord(c), None) for c in INVISIBLE)
    return table


@cache
def _glyph_hint() -> re.Pattern:
    """Glyphs of the first plane, and all of the others, where single characters would make the search slow."""
    own = [chr(point) for point in sorted(glyphs()) if point < 0x10000]
    return re.compile("[" + "".join(map(re.escape, own)) + "\U00010000-\U0010ffff]")


def _has_glyphs(text: str) -> bool:
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return bool(_glyph_hint().search(text))
    return "\xad" in text


def _folded(text: str) -> str:
    """Lower case, with the letters that patterns without case take for ``s`` and ``i`` as these."""
    if not text.isascii():
        text = text.replace("ſ", "s").replace("ı", "i").replace("İ", "i")
    return text.lower()


# The hints pass every text that their transducer would change, and some more.


def _spells(folded: str) -> bool:
    """Whether enough words in a row can be spelled digits, whatever stands between or around them."""
    return b"\1" * LEAST_SPELLED in bytes(map(SPELLING.__contains__, WORD.findall(folded)))


def _disguises(folded: str) -> bool:
    if any(c in folded for c in "[({<") or any(word in folded for word in ("dot", "arobase", "arroba")):
        return True
    return "@" in folded and any(word in folded for word in _dot.split("|"))


class Mapped:
    """A rewritten text; character i came from source characters starts[i] to ends[i]."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Put each text in the place of its characters, sorted and disjoint."""
        if not edits:
            return
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += (self.text[at:a], new)
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            starts += [self.starts[a]] * len(new)
            ends += [self.ends[b - 1]] * len(new)
            at = b
        text.append(self.text[at:])
        starts += self.starts[at:]
        ends += self.ends[at:]
        self.text, self.starts, self.ends = "".join(text), starts, ends

    def source(self, start: int, end: int) -> Span:
        return self.starts[start], self.ends[end - 1]


def unglyph(m: Mapped) -> None:
    table = glyphs()
    found = ((f.start(), ord(f[0])) for f in _glyph_hint().finditer(m.text))
    m.rewrite([(at, at + 1, table[point] or "") for at, point in found if point in table])


def unspell(m: Mapped) -> None:
    """Runs of spelled digits; what stands between them goes, dots in words stay as dots."""
    edits = []
    for run in SPELLED.finditer(m.text):
        words = [*SPELLED_WORD.finditer(m.text, run.start(), run.end())]
        while words and words[-1]["dot"]:
            words.pop()
        if sum(1 for w in words if w["digit"]) < LEAST_SPELLED:
            continue
        for i, w in enumerate(words):
            after = words[i + 1].start() if i + 1 < len(words) else w.end()
            new = DIGIT_WORDS[_folded(w[0])] if w["digit"] else "." if w["dot"] else "+"
            edits.append((w.start(), w.end(), new))
            if after > w.end():
                edits.append((w.end(), after, ""))
    m.rewrite(edits)


def undisguise(m: Mapped) -> None:
    """Words and brackets that stand for @ and dots."""
    m.rewrite([(f.start(), f.end(), "@" if f["at"] else ".") for f in BRACKETED.finditer(m.text)])
    m.rewrite([(f.start(), f.end(), "@") for f in WORDED.finditer(m.text)])
    edits = []
    at = m.text.find("@")
    while at >= 0:
        labels = LABELS.match(m.text, at + 1)
        if labels:
            edits += [(f.start(), f.end(), ".") for f in WORDED_DOT.finditer(m.text, labels.start(), labels.end())]
        at = m.text.find("@", at + 1)
    m.rewrite(edits)


def disguised(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """What is found only in the rewritten text, at its place in the source."""
    m = Mapped(text)
    if _has_glyphs(text):
        unglyph(m)
    if _spells(_folded(m.text)):
        unspell(m)
    if _disguises(_folded(m.text)):
        undisguise(m)
    if m.text is text:
        return []
    taken: list[list[Span]] = [[] for _ in KINDS]
    for start, kind, end in plain:
        taken[kind].append((start, end))
    out, at = [], [0] * len(KINDS)
    for start, kind, end in detect(m.text):
        a, b = m.source(start, end)
        own = taken[kind]
        while at[kind] < len(own) and own[at[kind]][1] <= a:
            at[kind] += 1
        if at[kind] == len(own) or own[at[kind]][0] >= b:
            out.append((a, kind, b))
    return out


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


NAMES = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            plain = detect(text)
            added = disguised(text, plain)
            counts = [sum(1 for _, kind, _ in plain if kind == k) for k in range(len(KINDS))]
            digest = hashlib.sha256(_joined(plain).encode()).hexdigest()
            rows.append((doc_id, *counts, digest, _joined(sorted(plain + added)), len(added)))
        columns = zip(*rows) if rows else [[]] * len(NAMES)
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(NAMES))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digest of the plain finds, all finds, and how many the transducers added."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(
        _find,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long",
    )
