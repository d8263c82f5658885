"""Personal data in texts, also where it is disguised, with spans in the source's own characters."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fathomline.llm.common import small_batches

#: Fixed order of the kinds in results.
KINDS = ("email", "ip", "card", "phone")

# Patterns that find the same leftmost matches as the plain ones in linear time: a match can start only at the
# start of a run, so the runs are possessive and a look-behind stops every later start in the same run.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def detect(text: str) -> list[Span]:
    """The plain identifiers, by kind and then start; matches of a kind don't overlap."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if "." in text:
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p.lstrip("0")[:4] or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


#: Letters and marks that look like an ASCII one, in pairs (look-alike, ASCII).
LOOK_ALIKES = dict(
    zip(
        "аеорсухіјѕԁһԛԝкмтвнАВЕКМНОРСТУХІЈЅαοερνικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ،․。。‚‐‑‒–—−٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹०१२३४५६७८९",
        "aeopcyxijsdhqwkmtbhABEKMHOPCTYXIJSaoepvikABEZHIKMNOPTYX,...,------012345678901234567890123456789",
        strict=True,
    )
)
#: Full-width forms stand in the same order as ASCII, 0xFEE0 further on.
LOOK_ALIKES |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
#: Characters that show nothing and only split an identifier.
INVISIBLE = "­​‌‍⁠﻿"
#: Spelled digits in the four languages of the corpus, by value.
SPELLED = {
    **dict.fromkeys(("zero", "null", "cero", "zéro"), "0"), **dict.fromkeys(("one", "eins", "uno", "un"), "1"), **dict.fromkeys(("two", "zwei", "dos", "deux"), "2"),
    **dict.fromkeys(("three", "drei", "tres", "trois"), "3"), **dict.fromkeys(("four", "vier", "cuatro", "quatre"), "4"), **dict.fromkeys(("five", "fünf", "cinco", "cinq"), "5"),
    **dict.fromkeys(("six", "sechs", "seis"), "6"), **dict.fromkeys(("seven", "sieben", "siete", "sept"), "7"), **dict.fromkeys(("eight", "acht", "ocho", "huit"), "8"),
    **dict.fromkeys(("nine", "neun", "nueve", "neuf"), "9"),
}

_ODD = re.compile("[" + "".join(map(re.escape, [*LOOK_ALIKES, *INVISIBLE])) + "]")
_DIGIT_WORD = "(?:" + "|".join(sorted(SPELLED, key=len, reverse=True)) + ")"
_SEPARATOR = r"(?:[ \-,.]{1,3}|[ \-,.]{0,3}(?:dot|point)[ \-,.]{1,3})"
_SPELLED_RUN = re.compile(rf"(?<!\w)(?:(plus)[ \-]+)?{_DIGIT_WORD}(?:{_SEPARATOR}{_DIGIT_WORD}){{3,}}(?!\w)", re.I)
_SPELLED_PART = re.compile(rf"(plus|dot|point|{_DIGIT_WORD})(?!\w)", re.I)
_BRACKETED = re.compile(r"\s{0,3}[\[({<]\s{0,2}(at|dot|arroba|punkt|point|punto)\s{0,2}[\])}>]\s{0,3}", re.I)
_BLANK_AT = re.compile(r"(?<=[A-Za-z0-9]) (at|arroba) (?=[A-Za-z0-9-]{1,63}(?: (?:dot|punto|punkt|point) |\.)[A-Za-z]{2})", re.I)
_BLANK_DOT = re.compile(r"(?<=[A-Za-z0-9]) (dot|punto|punkt|point) (?=[A-Za-z0-9])", re.I)
_DOTTED_LOCAL = re.compile(r"(?: (?:dot|punto|punkt|point) [A-Za-z0-9_%+-]{1,30})+", re.I)
_HOST = re.compile(r"[A-Za-z0-9.-]+")
#: Any text without odd characters that a transducer changes has one of these; the bare dot also needs an at.
_HINTS = re.compile("|".join([_BRACKETED.pattern[len(r"\s{0,3}"):], _BLANK_AT.pattern, " (?:dot|punto|punkt|point) ", rf"(?<!\w){_DIGIT_WORD}{_SEPARATOR}{_DIGIT_WORD}"]), re.I)


class Mapped:
    """A text with, for each of its characters, the source span [start, end) that it stands for."""

    __slots__ = ("end", "start", "text")

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        self.start = np.arange(len(text)) if start is None else start
        self.end = self.start + 1 if end is None else end

    def replaced(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """With each [a, b) replaced by a string; every character of the string stands for all of [a, b)."""
        if not edits:
            return self
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a])]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        return Mapped("".join([*text, self.text[at:]]), np.concatenate([*starts, self.start[at:]]), np.concatenate([*ends, self.end[at:]]))


def look_alikes(m: Mapped) -> Mapped:
    """First transducer: look-alike characters become ASCII, invisible ones vanish."""
    return m.replaced([(x.start(), x.end(), LOOK_ALIKES.get(x.group(), "")) for x in _ODD.finditer(m.text)])


def spelled_digits(m: Mapped) -> Mapped:
    """Second transducer: runs of four or more spelled digits become digits ("plus" before them becomes +)."""
    edits = []
    for run in _SPELLED_RUN.finditer(m.text):
        parts = [*_SPELLED_PART.finditer(m.text, run.start(), run.end())]
        for i, p in enumerate(parts):
            word = p.group().lower()
            end = parts[i + 1].start() if i + 1 < len(parts) else p.end()
            edits.append((p.start(), p.end(), "+" if word == "plus" else "." if word in ("dot", "point") else SPELLED[word]))
            if p.end() < end:
                edits.append((p.end(), end, ""))
    return m.replaced(edits)


def at_and_dot(m: Mapped) -> Mapped:
    """Third transducer: "(at)", "[dot]" and the like; bare " at " only before a host name, bare " dot " after it."""
    m = m.replaced([(x.start(), x.end(), "@" if x.group(1).lower() in ("at", "arroba") else ".") for x in _BRACKETED.finditer(m.text)])
    edits = [(x.start(), x.end(), "@") for x in _BLANK_AT.finditer(m.text)]
    for a in [e[1] for e in edits] + [i + 1 for i, c in enumerate(m.text) if c == "@"]:
        at = a
        while (host := _HOST.match(m.text, at)) and (dot := _BLANK_DOT.match(m.text, host.end())):
            edits.append((dot.start(), dot.end(), "."))
            at = dot.end()
    ats = [a for a, _, new in edits if new == "@"]  # ascending
    for dot in [*_BLANK_DOT.finditer(m.text)] if ats else []:  # dots in the local part
        x = dot.start()
        if any(_DOTTED_LOCAL.fullmatch(m.text, x, a) for a in ats[bisect_right(ats, x) : bisect_right(ats, x + 40)]):
            edits.append((x, dot.end(), "."))
    return m.replaced(sorted(set(edits)))


def disguised(text: str, plain: list[Span]) -> list[Span]:
    """What shows only after the transducers; source spans that lie within a plain span of the same kind are left out."""
    odd = not text.isascii() and _ODD.search(text)
    if not odd and not _HINTS.search(text):
        return []
    m = look_alikes(Mapped(text))
    m = at_and_dot(spelled_digits(m))
    if m.text == text:
        return []
    own: dict[str, tuple[list[int], list[int]]] = {kind: ([], []) for kind in KINDS}
    for kind, a, b in plain:  # ascending, and apart from each other
        own[kind][0].append(a)
        own[kind][1].append(b)
    found = []
    for kind, a, b in detect(m.text):
        start, end = int(m.start[a]), int(m.end[b - 1])
        starts, ends = own[kind]
        at = bisect_right(starts, start) - 1
        if at < 0 or ends[at] < end:
            found.append((kind, start, end))
    return found


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find(text: str) -> tuple[list[Span], list[Span]]:
    """The plain spans, and all spans, of a whole text."""
    plain = detect(text)
    return plain, ordered(plain + disguised(text, plain))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans, the first one's kind holds for all."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row for each document: counts of plain identifiers, digest of their spans, all spans, how many were disguised.

    Spans count code points of the source text, end exclusive.  A null text counts as empty.  Repeated rows give
    repeated rows, an empty table an empty one, other columns aren't read.  with_text=True adds `text`, in which all
    spans are masked (null stays null).  A row depends on its own text only: no shuffle.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, texts = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                plain, spans = find(text)
                n = [sum(k == kind for k, _, _ in plain) for kind in KINDS]
                out.append((*n, hashlib.sha256(joined(plain).encode()).hexdigest(), joined(spans), len(spans) - len(plain)))
                if with_text:
                    texts.append(masked(text, spans) if value.is_valid else None)
            columns = [*zip(*out)] or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))] + [pa.array(texts, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, *names, *["text"] * with_text])

    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_disguised"]
    df = small_batches(docs).select(id_col, text_col)
    kind = df.schema[0].dataType.simpleString()
    return df.mapInArrow(rows, f"`{id_col}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_disguised bigint" + ", text string" * with_text)


def masked_documents(docs: DataFrame, *, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents with all spans of their texts masked; chars_col, where there is one, counts the new text."""
    at = docs.columns.index(text_col)
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [None if t is None else masked(t, find(t)[1]) for t in old]
            columns = [*batch.columns]
            columns[at] = pa.array(new, batch.schema[at].type)
            if chars is not None:
                sizes = [was if a == b else len(b) for was, a, b in zip(columns[chars].to_pylist(), old, new)]
                columns[chars] = pa.array(sizes, batch.schema[chars].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return small_batches(docs).mapInArrow(rows, docs.schema)
