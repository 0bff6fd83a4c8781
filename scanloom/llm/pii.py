"""Personal data in texts, plain and disguised, with source offsets.

Plain identifiers are found in the text as it stands. For disguised ones the text
runs through transducers that keep, for each character they write, the source
characters it came from: look-alike letters and digits become ASCII and invisible
characters go, spelled digits become digits, and "at" and "dot" disguises become
``@`` and ``.``, in English, Spanish, German and French. Identifiers of the result
are mapped back to source offsets.

Spans are (kind, start, end) in code points, end exclusive. Plain spans always
stay; a disguised one is added unless a plain one of its kind covers it.

Not seen: identifiers split over lines, numbers spelled as tens or hundreds, other
languages' words, and "at" before a plain domain after a bare word such as a name.

Defined cases. A null or empty text has no spans. Texts are read whole, in time in
proportion to their length.
Extra columns are not read by ``find`` and kept by ``mask``.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scanloom.llm.common import slices

# --- fixed values ---------------------------------------------------------------
KINDS = ("email", "ip", "card", "phone")
#: Digits in the languages of the corpus: English, Spanish, German and French.
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
}
#: Of these, words that mean other things where they stand alone.
OFTEN_NO_DIGIT = frozenset(("un", "null", "neuf"))
AT_WORDS, DOT_WORDS, PLUS_WORDS = ("at", "arroba", "arobase", "klammeraffe"), ("dot", "punto", "punkt", "point"), ("plus", "más", "mas")
#: What follows a bare "at" that names no domain.
ARTICLES = ("the", "a", "an", "el", "la", "los", "las", "un", "una", "der", "die", "das", "dem", "den", "ein", "eine", "le", "les", "une")
#: Words before the name of a mailbox.
CUES = ("mail", "email", "e-mail", "correo", "courriel", "contact", "contacto", "kontakt", "write", "reach", "escribe", "schreib", "écrire")
#: Cyrillic and Greek letters that look like ASCII ones.
LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝАВЕКМНОРСТХІЈЅαονικρυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhqwABEKMHOPCTXIJSaovikpuxABEZHIKMNOPTYX"))
INVISIBLE = "­​‌‍⁠﻿"
# --------------------------------------------------------------------------------

#: Blocks whose characters have ASCII counterparts: forms, digits of other scripts, letter-like symbols.
COMPATIBLE = "٠-٩۰-۹०-९‐-―․⁰-ₜ①-⑳Ⓐ-ⓩ！-～\U0001d400-\U0001d7ff﹒﹫"

BATCH_BYTES = 8 << 20

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHAR = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL_CHAR:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Identifiers of the text as it stands, by start and kind."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return ordered(out)


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class Traced:
    """A text with, for each character, the source range that it stands for."""

    def __init__(self, text: str):
        self.text, self.start = text, np.arange(len(text), dtype=np.int64)
        self.last = self.start

    def rewrite(self, pattern: re.Pattern, by: Callable[[re.Match], str], blanks: bool = False) -> Traced:
        """One transducer: each match becomes ``by(match)``, traced to the whole match; ``blanks`` before it go too."""
        pieces, spans, at = [], [], 0
        for m in pattern.finditer(self.text):
            new = by(m)
            if m.start() == m.end() or new == m[0]:
                continue
            a, b = m.span()
            while blanks and a > at and self.text[a - 1].isspace():
                a -= 1
            pieces += [self.text[at:a], new]
            # What stays is a run of its own characters; what is new stands for the match as a whole.
            spans += [(at, at, a - at, 1), (a, b - 1, len(new), 0)]
            at = b
        if at:
            spans.append((at, at, len(self.text) - at, 1))
            first, last, size, step = np.array(spans, np.int64).T
            inside = (np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)) * np.repeat(step, size)
            self.start, self.last = self.start[np.repeat(first, size) + inside], self.last[np.repeat(last, size) + inside]
            self.text = "".join([*pieces, self.text[at:]])
        return self

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.last[b - 1]) + 1


def _ascii(m: re.Match) -> str:
    c = m[0]
    if c in INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if "‐" <= c <= "―":
        return "-"
    plain = unicodedata.normalize("NFKC", c)
    if len(plain) == 1 and plain in LOOKALIKES:
        return LOOKALIKES[plain]
    return str(unicodedata.decimal(plain)) if len(plain) == 1 and plain.isdecimal() else plain if plain.isascii() else c


_FOREIGN = re.compile(f"[{''.join(LOOKALIKES)}{INVISIBLE}{COMPATIBLE}]")
def _any(words) -> str:
    return f"(?:{'|'.join(sorted(map(re.escape, words), key=len, reverse=True))})"


_SPELLED = _any(DIGIT_WORDS)
_SPELLED_RUN = re.compile(rf"\b{_SPELLED}(?:[\x20-]{_SPELLED})*+\b", re.I)
#: For lowered texts: a digit word that is one where it stands alone. A first look, for most texts have none.
_HAS_SPELLED = re.compile(rf"\b{_any(w for w in DIGIT_WORDS if w not in OFTEN_NO_DIGIT)}\b")
_WORD = re.compile(r"[^\W\d_]+")
_PLUS = re.compile(rf"\b{_any(PLUS_WORDS)}[\x20-]+(?=[0-9])", re.I)
_BRACKET_AT = re.compile(rf"[\[({{<]\s*+{_any(AT_WORDS)}\s*+[\])}}>]\s*+", re.I)
_BRACKET_DOT = re.compile(rf"[\[({{<]\s*+{_any(DOT_WORDS)}\s*+[\])}}>]\s*+", re.I)
_BARE_DOT = re.compile(rf"(?<=[A-Za-z0-9])\x20++{_any(DOT_WORDS)}\x20++(?=[A-Za-z0-9])", re.I)
_NO_ARTICLE = rf"(?!{_any(ARTICLES)}\b)"
_HIDDEN_DOT = rf"[A-Za-z0-9-]++(?:\x20++{_any(DOT_WORDS)}\x20|\s*+[\[({{<]\s*+{_any(DOT_WORDS)}\b)"
#: A bare "at" counts where a disguised dot follows its next label ...
_BARE_AT = re.compile(rf"(?<=[A-Za-z0-9])\x20++{_any(AT_WORDS)}\x20++(?={_NO_ARTICLE}{_HIDDEN_DOT})", re.I)
#: ... or a plain domain does, and what is before it looks like a mailbox or follows a word like "mail".
_MAILBOX_AT = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?:(?P<cue>{_any(CUES)}:?\x20)?+(?P<box>[A-Za-z0-9._%+-]++))(?P<at>\x20{_any(AT_WORDS)}\x20)(?={_NO_ARTICLE}[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{{2,}})", re.I
)


_BOX = re.compile("[0-9._]")


def _digits(m: re.Match) -> str:
    words = _WORD.findall(m[0])
    return m[0] if len(words) == 1 and words[0].lower() in OFTEN_NO_DIGIT else "".join(DIGIT_WORDS[w.lower()] for w in words)


def disguised_spans(text: str) -> list[tuple[str, int, int]]:
    """Identifiers that show after normalisation, in source offsets."""
    low = text.lower()
    foreign = not text.isascii() and _FOREIGN.search(text)
    dotted = any(w in low for w in DOT_WORDS)
    hidden = " at " in low or any(w in low for w in AT_WORDS[1:]) or _BRACKET_AT.search(text)
    spelled = _HAS_SPELLED.search(low)
    if not (foreign or dotted or hidden or spelled):
        return []
    t = Traced(text)
    if foreign:
        t.rewrite(_FOREIGN, _ascii)
    if spelled or foreign:
        t.rewrite(_SPELLED_RUN, _digits)
        t.rewrite(_PLUS, lambda m: "+")
    if hidden or foreign:
        t.rewrite(_BARE_AT, lambda m: "@").rewrite(_BRACKET_AT, lambda m: "@", blanks=True)
    if dotted or foreign:
        t.rewrite(_BRACKET_DOT, lambda m: ".", blanks=True)
        t.rewrite(_BARE_DOT, lambda m: ".")
    out = [(k, *t.source(a, b)) for k, a, b in plain_spans(t.text)]
    if hidden or foreign:
        for m in _MAILBOX_AT.finditer(t.text):
            if (m["cue"] or _BOX.search(m["box"].strip("."))) and (domain := _DOMAIN.match(t.text, m.end())):
                out.append(("email", *t.source(m.start("box"), domain.end())))
    return ordered(out)


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Plain spans, and these with the disguised ones that none of them covers."""
    plain = plain_spans(text)
    found = disguised_spans(text)
    if not found:
        return plain, plain
    # Plain spans of a kind don't overlap, so the last one that begins before is the only one that can cover.
    of = {k: [(a, b) for kind, a, b in plain if kind == k] for k in KINDS}
    more = []
    for k, a, b in dict.fromkeys(found):
        at = bisect_right(of[k], (a, math.inf)) - 1
        if at < 0 or of[k][at][1] < b:
            more.append((k, a, b))
    return plain, ordered([*plain, *more]) if more else plain


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or union of spans that overlap, replaced by its first kind."""
    out, at = [], 0
    for k, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every text.

    Counts and ``base_sha256`` are of plain spans, ``spans`` lists all.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            rows: dict[str, list] = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for text in batch.column("text").to_pylist():
                plain, spans = all_spans(text) if text else ([], [])
                for kind in KINDS:
                    rows[f"n_{kind}"].append(sum(k == kind for k, _, _ in plain))
                rows["base_sha256"].append(hashlib.sha256(_listed(plain).encode()).hexdigest())
                rows["spans"].append(_listed(spans))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | rows)

    return docs.select("doc_id", "text").mapInArrow(found, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all spans of its text column replaced by their kinds; other columns stay."""

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, BATCH_BYTES):
            new = [masked(t, all_spans(t)[1]) if t else t for t in batch.column(text).to_pylist()]
            k = batch.schema.get_field_index(text)
            yield pa.RecordBatch.from_arrays([pa.array(new, batch.column(k).type) if n == k else batch.column(n) for n in range(batch.num_columns)], schema=batch.schema)

    return docs.mapInArrow(done, docs.schema)
