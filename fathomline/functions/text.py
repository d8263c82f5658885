"""Text expressions.  All of them stay in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: control characters that are dropped.
_CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
#: Latin letters that decompose into an ASCII letter and marks, from U+00C0 on: (letters, their base letters).
_ACCENTED = [(chr(c), d[0]) for c in range(0xC0, 0x250) if len(d := unicodedata.normalize("NFD", chr(c))) > 1 and d[0].isascii()]
_FROM, _TO = "".join(a for a, _ in _ACCENTED), "".join(b for _, b in _ACCENTED)


def strip_controls(text: Column) -> Column:
    """Without control characters other than tab, line feed and carriage return."""
    return F.regexp_replace(text, _CONTROLS, "")


def collapse_blanks(text: Column) -> Column:
    """Runs of blanks and tabs become one blank, none before a line feed, and at most two line feeds in a row."""
    out = F.regexp_replace(text, r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(out, r" +\n", "\n"), r"\n{3,}", "\n\n")


def boilerplate_candidate(line: Column) -> Column:
    """A short line that could be a header or footer: not empty, at most 80 characters, not only numbering or
    punctuation, not `key: value` with a key of up to 30 characters."""
    trimmed = F.trim(line)
    return (F.length(trimmed) > 0) & (F.length(trimmed) <= 80) & ~trimmed.rlike(r"^[0-9\W_]+$") & ~trimmed.rlike(r"^[^:\n]{1,30}: ")


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def stable_id(key: Column) -> Column:
    """60-bit id: the first 15 hexadecimal digits of SHA-1."""
    return F.conv(F.substring(F.sha1(key.cast("binary")), 1, 15), 16, 10).cast("long")


#: Fixed value: what a slug may not hold.
_NO_SLUG = r"[^a-z0-9áéíóúñü]+"


def slug(text: Column) -> Column:
    """Lower case; runs of anything but a-z, digits and Spanish letters become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), _NO_SLUG, "_"), r"^_+|_+$", "")


def fold(text: Column) -> Column:
    """Without accents (Latin letters)."""
    return F.translate(text, _FROM, _TO)


def entity_key(text: Column) -> Column:
    """Canonical id of a name: no accents, no punctuation, lower case, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(fold(text)), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def truncated(text: Column, n: int) -> Column:
    """The first n words; the text itself if it has no more."""
    w = words(text)
    return F.when(F.size(w) <= n, text).otherwise(F.array_join(F.slice(w, 1, n), " "))


def hard_split(text: Column, n: int) -> Column:
    """Pieces of at most n words; a text that fits is one unchanged piece."""
    w = words(text)
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / n).cast("int")), lambda i: F.array_join(F.slice(w, i * n + 1, F.lit(n)), " "))
    return F.when(F.size(w) <= n, F.array(text)).otherwise(pieces)


def sentences(text: Column) -> Column:
    """Cut after . ! ? (also full-width) and blanks; no list of abbreviations."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?。！？])\s+"), lambda x: F.trim(x)), lambda s: s != "")


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines, trimmed, not empty."""
    unix = F.regexp_replace(text, r"\r\n?", "\n")
    return F.filter(F.transform(F.split(unix, r"\n\s*\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")


def parsed_date(text: Column) -> Column:
    """ISO date or time (also with Z), then y/m/d, d/m/y on the first ten characters; else null."""
    ten = F.substring(F.trim(text), 1, 10)
    return F.coalesce(*(F.try_to_timestamp(ten, F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy")))


def file_name(path: Column) -> Column:
    """Last component of a path with either kind of slash."""
    return F.element_at(F.split(path, r"[\\/]"), -1)


def folder(path: Column) -> Column:
    """First two components; backslashes win where both kinds occur; all of it if there is no separator."""
    return F.when(path.contains("\\"), F.substring_index(path, "\\", 2)).otherwise(F.substring_index(path, "/", 2))


def chunk_id(doc_id: Column, position: Column) -> Column:
    return F.concat(doc_id.cast("string"), F.lit("__chunk_"), F.lpad(position.cast("string"), 5, "0"))


def html_text(html: Column) -> Column:
    """Markup removed by patterns: script and style blocks, comments, tags; five entities; blanks collapsed."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"(?s)<!--.*?-->", " "), r"<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def normalised_paragraph(text: Column) -> Column:
    """Text that ends as sentences do: lists of NNN-NN codes become a sentence a code, semicolon lists a sentence an
    item, and anything without a closing mark gets a full stop."""
    stop = lambda x: F.when(x.rlike(r"[.!?:»›]$") | (x == ""), x).otherwise(F.concat(x, F.lit(".")))
    t = F.trim(text)
    codes = F.concat(F.regexp_replace(t, r"\s+", ". "), F.lit("."))
    items = F.filter(F.transform(F.split(t, ";"), lambda x: F.trim(x)), lambda x: x != "")
    listed = F.array_join(F.transform(items, stop), " ")
    many = (F.length(t) - F.length(F.replace(t, F.lit(";"), F.lit("")))) >= 2
    return F.when(t.rlike(r"^(\d{2,3}-\d{2}\s+){2,}\d{2,3}-\d{2}$"), codes).when(many & ~t.rlike(r"[.!?:»›]$"), listed).otherwise(stop(t))
