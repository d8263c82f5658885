"""Bytes of one file to sections (title, text, atomic).  Each extractor is a plain function, registered by extension."""

from __future__ import annotations

import csv
import html.entities
import html.parser
import io
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

from fathomline.registry import Registry
from fathomline.sources import osm, pdf

Section = tuple[str | None, str, bool]  # title, text, splittable
Extracted = tuple[str | None, str | None, str | None, list[Section]]  # title, language, date, sections
EXTRACTORS: Registry[Callable[[bytes], Extracted]] = Registry("file format")


def decoded(raw: bytes) -> str:
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _key_values(pairs) -> str:
    return "\n".join(f"{k}: {v}" for k, v in pairs if v is not None and str(v).strip())


def _headers(cells: list[str]) -> list[str]:
    """Names of columns; a blank one is named by its number."""
    return [c.strip() or f"col_{i}" for i, c in enumerate(cells)]


@EXTRACTORS.register("csv")
def from_csv(raw: bytes) -> Extracted:
    """An atomic section a row, `column: value` lines without blank values; short rows have fewer lines, rows that are
    longer than the header are left out."""
    text = decoded(raw)
    rows = [r for r in csv.reader(io.StringIO(text)) if r]
    if rows and len(rows[0]) == 1:  # no comma: another separator?
        try:
            rows = [r for r in csv.reader(io.StringIO(text), csv.Sniffer().sniff(text.split("\n", 1)[0], ";\t|")) if r]
        except csv.Error:
            pass
    head = _headers(rows[0]) if rows else []
    sections = [(None, body, False) for r in rows[1:] if len(r) <= len(head) and (body := _key_values(zip(head, map(str.strip, r))))]
    if not sections:
        raise ValueError("no rows")
    return None, None, None, sections


@EXTRACTORS.register("xlsx")
def from_xlsx(raw: bytes) -> Extracted:
    """The sheet with most rows (the first of equals), as from_csv; read from the package's XML."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
        best: list[dict[str, str]] = []
        for name in sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
            rows = []
            for row in ElementTree.fromstring(z.read(name)).iter(f"{ns}row"):
                own = {}
                for c in row.iter(f"{ns}c"):
                    v = c.find(f"{ns}v")
                    value = "".join(t.text or "" for t in c.iter(f"{ns}t")) if c.get("t") == "inlineStr" else v.text if v is not None else ""
                    own[re.sub(r"\d", "", c.get("r", ""))] = shared[int(value)] if c.get("t") == "s" and value else value or ""
                rows.append(own)
            best = rows if len(rows) > len(best) else best
    if len(best) < 2:
        raise ValueError("no rows")
    head = dict(zip(best[0], _headers([*best[0].values()])))
    return None, None, None, [(None, body, False) for r in best[1:] if (body := _key_values((h, r.get(c)) for c, h in head.items()))]


@EXTRACTORS.register("xls")
def from_xls(raw: bytes) -> Extracted:
    """The old binary format needs a reader of its own; a package under that name is taken as .xlsx."""
    if raw[:2] == b"PK":
        return from_xlsx(raw)
    raise ValueError("old Excel files need a reader of their own; register one")


#: Keys of titles, bodies and dates in JSON records, of text within records, and of what only describes them.
TITLE_KEYS = ("title", "titulo", "título", "headline", "name", "nombre")
BODY_KEYS = ("body", "cuerpo", "body_paragraphs", "body_text", "content", "contenido", "text", "texto", "description", "descripcion", "abstract", "resumen", "excerpt", "summary", "intro")
NESTED_KEYS = ("sections", "paragraphs", "heading", "items")
DATE_KEYS = ("date", "fecha", "published", "publicado", "publication_date", "fecha_publicacion")
META_KEYS = ("author", "autor", "authors", "autores", *DATE_KEYS, "tags", "categoria", "category", "url", "link", "id", "source", "fuente", "pdf_url", "doi", "issue", "keywords")


def _first(record: dict, keys: tuple[str, ...]):
    return next((record[k] for k in keys if record.get(k)), None)


def normal_paragraph(text: str) -> str:
    """See functions.text.normalised_paragraph; the same for one string."""
    t = text.strip()
    if re.fullmatch(r"(\d{2,3}-\d{2}\s+){2,}\d{2,3}-\d{2}", t):
        return re.sub(r"\s+", ". ", t) + "."
    if not t or re.search(r"[.!?:»›]$", t):
        return t
    if t.count(";") >= 2:
        return " ".join(normal_paragraph(x) for x in t.split(";") if x.strip())
    return t + "."


def _is_record(value) -> bool:
    return isinstance(value, dict) and _first(value, TITLE_KEYS + BODY_KEYS + NESTED_KEYS) is not None


def _parts(value) -> Iterator[str]:
    """Texts of a content value: strings, and the bodies of records, in their order."""
    if isinstance(value, str):
        if value.strip():
            yield normal_paragraph(value)
    elif isinstance(value, list):
        for v in value:
            yield from _parts(v)
    elif isinstance(value, dict):
        if text := record_body(value):
            yield text
        else:
            for v in value.values():  # no known key within a content value: all of it
                yield from _parts(v)


def record_body(record: dict) -> str:
    """Text of a record: the values of content keys, and of other keys that hold records, in the record's order, blank
    lines between them; without any the texts of its links, and else its `key: value` pairs."""
    rest = [(k, v) for k, v in record.items() if k not in META_KEYS + TITLE_KEYS]
    content = lambda k, v: k in BODY_KEYS + NESTED_KEYS or _is_record(v) or isinstance(v, list) and bool(v) and all(isinstance(x, dict) for x in v) and any(map(_is_record, v))
    parts = [p for k, v in rest if content(k, v) for p in _parts(v)]
    if not parts and isinstance(record.get("links"), list):
        parts = [*_parts(record["links"])]
    if not parts:
        parts = [f"{k}: {normal_paragraph(str(v))}" for k, v in rest if not isinstance(v, (dict, list)) and v is not None and str(v).strip()]
    return re.sub(r"\n{3,}", "\n\n", "\n\n".join(parts))


@EXTRACTORS.register("json")
def from_json(raw: bytes) -> Extracted:
    """A section a record, its title before its text: a root list; a root record with a title or body; else its first list of records."""
    root = json.loads(decoded(raw))
    if isinstance(root, dict) and _first(root, TITLE_KEYS + BODY_KEYS) is None:
        lists = [v for v in root.values() if isinstance(v, list) and v]
        root = next((v for v in lists if any(isinstance(x, dict) for x in v)), lists[0] if lists else [root])
    records = root if isinstance(root, list) else [root]
    sections: list[Section] = []
    title = date = None
    for r in records:
        if not isinstance(r, dict):
            sections += [(None, s, True) for s in _parts(r)]
            continue
        own = _first(r, TITLE_KEYS)
        own = str(own).strip() if own else None
        title, date = title or own, date or _first(r, DATE_KEYS)
        if text := record_body(r):
            sections.append((own, f"{own}.\n{text}" if own else text, True))
    return title, None, str(date) if date else None, sections


@EXTRACTORS.register("md", "markdown")
def from_markdown(raw: bytes) -> Extracted:
    """Blocks between blank lines; a heading titles what follows and is no body text."""
    sections: list[Section] = []
    title = first = None
    block: list[str] = []

    def close() -> None:
        if text := "\n".join(block).strip():
            sections.append((title, text, True))
        block.clear()

    for line in decoded(raw).splitlines():
        if m := re.match(r"\s{0,3}(#{1,6})\s+(.*?)\s*#*\s*$", line):
            close()
            title = m.group(2)
            first = first or title
        elif not line.strip():
            close()
        else:
            block.append(re.sub(r"^\s*(?:[-*+]|\d+[.)])\s+", "", line).rstrip())
    close()
    return first, None, None, sections


@EXTRACTORS.register("txt")
def from_text(raw: bytes) -> Extracted:
    return None, None, None, [(None, p.strip(), True) for p in re.split(r"\n\s*\n", decoded(raw).replace("\r\n", "\n")) if p.strip()]


class _Html(html.parser.HTMLParser):
    """Headings open sections, p and li are their paragraphs, article and section close them."""

    SKIP, HEAD, BLOCK = {"script", "style", "noscript", "template", "svg"}, {f"h{i}" for i in range(1, 7)}, {"p", "li"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title = self.language = self.date = None
        self.sections: list[Section] = []
        self._heading: str | None = None
        self._paragraphs: list[str] = []
        self._skip, self._open, self._text = 0, "", []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "html":
            self.language = (a.get("lang") or "").strip() or None
        elif tag == "meta" and (a.get("name") or a.get("property") or "").lower() in ("date", "article:published_time", "dc.date", "pubdate"):
            self.date = self.date or a.get("content")
        elif tag in self.SKIP:
            self._skip += 1
        elif tag in self.HEAD | self.BLOCK | {"title"}:
            self._end_block()
            self._open = tag
        elif tag in ("article", "section"):
            self._end_section()

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self._skip = max(0, self._skip - 1)
        elif tag == self._open:
            self._end_block()
        elif tag in ("article", "section"):
            self._end_section()

    def handle_data(self, data):
        if not self._skip and self._open:
            self._text.append(data)

    def _end_block(self):
        text, tag = " ".join("".join(self._text).split()), self._open
        self._open, self._text = "", []
        if not text:
            return
        if tag == "title":
            self.title = self.title or text
        elif tag in self.HEAD:
            self._end_section()
            self._heading = text
        else:
            self._paragraphs.append(text)

    def _end_section(self):
        self._end_block()
        if self._paragraphs:
            self.sections.append((self._heading, "\n\n".join(self._paragraphs), True))
        self._heading, self._paragraphs = None, []


#: An ampersand, and the character reference that it begins if a semicolon ends one.
_REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")


def _ended_references(m: re.Match) -> str:
    known = m[1] and (m[1][0] == "#" or m[1] in html.entities.html5)
    return m[0] if known else "&amp;" + (m[1] or "")


@EXTRACTORS.register("html", "htm")
def from_html(raw: bytes) -> Extracted:
    """Only references that end in a semicolon are resolved: a text that was cut within one (`&amp`) stays as it is."""
    p = _Html()
    p.feed(_REFERENCE.sub(_ended_references, decoded(raw)))
    p.close()
    p._end_section()
    return p.title, p.language, p.date, p.sections


@EXTRACTORS.register("pdf")
def from_pdf(raw: bytes) -> Extracted:
    """A section a page, by the layout of its text; a file whose layout can't be read gives the literal strings of eight
    characters or more that its raw bytes show.  Without text it goes to a registered OCR engine."""
    try:
        title, pages = pdf.sections(pdf.layout(raw))
    except (ValueError, zlib.error):
        if b"/Encrypt" in raw:
            raise
        title, pages = None, []
    if any(text for _, text, _ in pages):
        return title, None, None, pages
    found = [re.sub(r"\\([()\\])", r"\1", s) for s in re.findall(r"\(((?:[^()\\]|\\.){8,})\)", raw.decode("latin-1"))]
    return None, None, None, [(None, " ".join(found) or recognised(raw), True)]


def _fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(field, wire type, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, kind, varint()
        else:
            n = {1: 8, 5: 4}.get(kind)
            n = varint() if n is None else n
            yield tag >> 3, kind, data[at : at + n]
            at += n


def _value(data: bytes):
    for f, kind, v in _fields(data):
        if f == 1:
            return v.decode("utf-8", "replace")
        if f in (2, 3):
            return struct.unpack("<f" if f == 2 else "<d", v)[0]
        if f == 6:
            return (v >> 1) ^ -(v & 1)
        return bool(v) if f == 7 else v
    return None


def _packed(data: bytes) -> list[int]:
    out, now, shift = [], 0, 0
    for b in data:
        now |= (b & 127) << shift
        shift += 7
        if b < 128:
            out.append(now)
            now = shift = 0
    return out


#: Administrative attributes that say nothing about a feature.
ADMIN_KEYS = ("id", "osm_id", "version", "changeset", "timestamp", "uid", "user", "visible", "created_by", "source", "attribution")


@EXTRACTORS.register("pbf", "mvt")
def from_tile(raw: bytes) -> Extracted:
    """Vector tiles, or OpenStreetMap extracts, which their first bytes tell apart: an atomic section a feature or tagged
    element; those with an id once a layer or kind, those without one all."""
    sections: list[Section] = []
    if b"OSMHeader" in raw[:4096] or b"OSMData" in raw[:4096]:
        for kind, _, tags in osm.elements(raw, _fields, _packed):
            if body := _key_values((k, v) for k, v in tags if k not in ADMIN_KEYS):
                sections.append((kind, body, False))
        return None, None, None, sections
    for f, _, layer in _fields(raw):
        if f != 3:
            continue
        name, keys, values, features, seen = "", [], [], [], set()
        for g, _, v in _fields(layer):
            if g == 1:
                name = v.decode()
            elif g == 2:
                features.append(v)
            elif g == 3:
                keys.append(v.decode())
            elif g == 4:
                values.append(_value(v))
        for feature in features:
            fid, tags = None, []
            for g, _, v in _fields(feature):
                if g == 1:
                    fid = v
                elif g == 2:
                    tags = _packed(v)
            if fid is not None and fid in seen:
                continue
            seen.add(fid)
            if body := _key_values((keys[k], values[v]) for k, v in zip(tags[::2], tags[1::2]) if keys[k] not in ADMIN_KEYS):
                sections.append((name or None, body, False))
    return None, None, None, sections


@EXTRACTORS.register("png", "jpg", "jpeg", "tif", "tiff", "bmp", "gif", "webp")
def from_image(raw: bytes) -> Extracted:
    """The text that the first registered OCR engine reads, as one section; without an engine an error."""
    return None, None, None, [(None, recognised(raw), True)]


#: Fixed value: languages that an OCR engine is asked for, in order.
OCR_LANGUAGES = ("spa", "eng", "por")
#: OCR engines by name: functions of (bytes of an image or a scanned PDF, languages) that give a text.
OCR: Registry[Callable[[bytes, tuple[str, ...]], str]] = Registry("OCR engine")


def recognised(raw: bytes) -> str:
    """The first text that a registered engine finds; engines that fail are passed over."""
    if not OCR.names():
        raise ValueError("no OCR engine is registered")
    problem = "no text was recognised"
    for name in OCR.names():
        try:
            if text := OCR.get(name)(raw, OCR_LANGUAGES).strip():
                return text
        except Exception as e:  # another engine may do
            problem = f"{name}: {e}"
    raise ValueError(problem)
