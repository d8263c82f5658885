"""Layout of PDF files: pages of text blocks with places, sizes and weight, and sections made of them.

The reader covers what plain producers write: object and cross-reference streams, Flate compression, simple fonts and
fonts with a Unicode map.  Encrypted files are an error.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

Section = tuple[str | None, str, bool]

#: A heading has at most so many characters, no closing mark, and this size; a bold one may be smaller.
HEADING_CHARS, HEADING_SIZE, BOLD_SIZE = 120, 14, 11

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|/[^\s/<>\[\]()]+|\[|\]|[-+.\d]+|[A-Za-z'\"*]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


@dataclass
class Span:
    x: float
    y: float
    size: float
    bold: bool
    text: str


@dataclass
class Block:
    """Spans in reading order; y grows downwards."""

    spans: list[Span] = field(default_factory=list)

    @property
    def place(self) -> tuple[float, float]:
        return min(s.y for s in self.spans), min(s.x for s in self.spans)


def tidy(text: str) -> str:
    """Single blanks; nothing where only leftovers of sorted glyph names stand."""
    out = " ".join(text.split())
    return "" if re.fullmatch(r"[nrIlt ]{2,}", out) else out


def sections(pages: list[list[Block]]) -> tuple[str | None, list[Section]]:
    """(title, a section a page): blocks from top to bottom and left to right, a blank line between them; the first block
    that looks like a heading is the page's title, that of the first page the document's."""
    out: list[Section] = []
    for blocks in pages:
        texts, heading = [], None
        for block in sorted(blocks, key=lambda b: b.place):
            text = " ".join(filter(None, (tidy(s.text) for s in block.spans)))
            if not text:
                continue
            size, bold = max(s.size for s in block.spans), any(s.bold for s in block.spans)
            if heading is None and len(text) <= HEADING_CHARS and not text.endswith((".", "?", "!")) and (size >= HEADING_SIZE or bold and size >= BOLD_SIZE):
                heading = text
            texts.append(text)
        out.append((heading, "\n\n".join(texts), True))
    return (out[0][0] if out else None), out


def _literal(raw: bytes) -> bytes:
    def one(m: re.Match) -> bytes:
        c = m.group(1)
        return bytes([int(c, 8) & 255]) if c[:1].isdigit() else b"" if c in (b"\n", b"\r\n", b"\r") else _ESCAPES.get(c, c)

    return re.sub(rb"\\([0-7]{1,3}|\r\n|.)", one, raw[1:-1], flags=re.S)


def _hex(raw: bytes) -> bytes:
    digits = re.sub(rb"\s", b"", raw[1:-1])
    return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())


class Document:
    """The objects of a file, by number."""

    def __init__(self, raw: bytes):
        if re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", raw):
            raise ValueError("the file is encrypted")
        self.objects: dict[int, bytes] = {int(n): body for n, body in _OBJECT.findall(raw)}
        for body in [*self.objects.values()]:
            if b"/ObjStm" in body[:400]:
                data, first = self._data(body), int(self._number(body, b"First"))
                head = [int(x) for x in data[:first].split()]
                ends = [*head[3::2], len(data) - first]
                for n, at, end in zip(head[::2], head[1::2], ends):
                    self.objects.setdefault(n, data[first + at : first + end])

    @staticmethod
    def _number(body: bytes, key: bytes) -> float:
        m = re.search(rb"/" + key + rb"\s+(-?[\d.]+)", body)
        return float(m.group(1)) if m else 0.0

    @staticmethod
    def _data(body: bytes) -> bytes:
        m = _STREAM.search(body)
        if not m:
            return b""
        return zlib.decompressobj().decompress(m.group(1)) if b"/FlateDecode" in body[: m.start()] else m.group(1)

    def refs(self, body: bytes, key: bytes) -> list[int]:
        """Objects that a key refers to: one, or a list."""
        m = re.search(rb"/" + key + rb"\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
        return [int(x) for x in re.findall(rb"(\d+)\s+\d+\s+R", m.group(1))] if m else []

    def pages(self) -> list[bytes]:
        """Page objects in the order of the page tree."""
        out: list[bytes] = []
        roots = [n for n, b in self.objects.items() if re.search(rb"/Type\s*/Pages\b", b) and not re.search(rb"/Parent\b", b)]
        todo, seen = roots[:1], set()
        while todo:
            n = todo.pop(0)
            body = self.objects.get(n, b"")
            if n in seen:
                continue
            seen.add(n)
            if re.search(rb"/Type\s*/Pages\b", body):
                todo = self.refs(body, b"Kids") + todo
            elif body:
                out.append(body)
        return out or [b for b in self.objects.values() if re.search(rb"/Type\s*/Page\b", b)]

    def fonts(self, page: bytes) -> dict[bytes, tuple[bool, dict[int, str], int]]:
        """By name: bold, map of codes to text, bytes of a code."""
        resources = page + b"".join(self.objects.get(n, b"") for n in self.refs(page, b"Resources"))
        resources += b"".join(self.objects.get(n, b"") for n in self.refs(resources, b"Font"))
        out = {}
        for name, n in re.findall(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R", resources):
            body = self.objects.get(int(n), b"")
            if b"/Font" not in body:
                continue
            codes: dict[int, str] = {}
            for m in self.refs(body, b"ToUnicode"):
                codes |= self._codes(self._data(self.objects.get(m, b"")))
            bold = re.search(rb"/BaseFont\s*/\S*(Bold|Black|Heavy)", body) is not None
            out[name] = (bold, codes, 2 if b"/Type0" in body else 1)
        return out

    @staticmethod
    def _codes(cmap: bytes) -> dict[int, str]:
        text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
        out: dict[int, str] = {}
        for part in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
            out |= {int(a, 16): text(b) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", part)}
        for part in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
            for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", part):
                first = text(c)
                out |= {i: first[:-1] + chr(ord(first[-1]) + i - int(a, 16)) for i in range(int(a, 16), min(int(b, 16), int(a, 16) + 65_535) + 1)}
        return out

    def spans(self, page: bytes) -> Iterator[Span]:
        fonts = self.fonts(page)
        content = b"\n".join(self._data(self.objects.get(n, b"")) for n in self.refs(page, b"Contents"))
        bold, codes, width, size = False, {}, 1, 0.0
        line = [1.0, 0.0, 0.0, 1.0, 0.0, 0.0]
        leading, stack, here, shown = 0.0, [], list(line), []

        def decoded(raw: bytes) -> str:
            data = _hex(raw) if raw[:1] == b"<" else _literal(raw)
            if width == 2 or codes and raw[:1] == b"<" and len(data) % 2 == 0 and max(codes) > 255:
                return "".join(codes.get(int.from_bytes(data[i : i + 2], "big"), "") for i in range(0, len(data), 2))
            return "".join(codes.get(c, "") for c in data) if codes else data.decode("latin-1")

        def moved(x: float, y: float) -> None:
            nonlocal here
            line[4], line[5] = line[0] * x + line[2] * y + line[4], line[1] * x + line[3] * y + line[5]
            here = list(line)

        for m in _TOKEN.finditer(content):
            t = m.group()
            if t[:1] in b"(<" or t[:1] in b"-+.0123456789" or t[:1] == b"/" or t in (b"[", b"]"):
                stack.append(t)
                continue
            number = lambda i: float(stack[i])
            try:
                if t == b"BT":
                    line = [1.0, 0.0, 0.0, 1.0, 0.0, 0.0]
                    here = list(line)
                elif t == b"Tf":
                    bold, codes, width = fonts.get(stack[-2][1:], (False, {}, 1))
                    size = number(-1)
                elif t == b"Tm":
                    line = [float(x) for x in stack[-6:]]
                    here = list(line)
                elif t in (b"Td", b"TD"):
                    if t == b"TD":
                        leading = -number(-1)
                    moved(number(-2), number(-1))
                elif t == b"TL":
                    leading = number(-1)
                elif t == b"T*":
                    moved(0, -leading)
                elif t in (b"Tj", b"TJ", b"'", b'"'):
                    if t in (b"'", b'"'):
                        moved(0, -leading)
                    shown = []
                    for part in stack:
                        if part[:1] in b"(<":
                            shown.append(decoded(part))
                        elif t == b"TJ" and part[:1] in b"-+.0123456789" and float(part) < -200:
                            shown.append(" ")  # a wide step back is a blank
                    yield Span(here[4], -here[5], abs(size * (here[3] or here[1] or 1)), bold, "".join(shown))
            except (IndexError, ValueError):
                pass  # an operator without its operands shows nothing
            stack = []


def blocks(spans: Iterator[Span]) -> list[Block]:
    """Spans of neighbouring lines, in the order in which they are drawn, make a block; a gap, a jump upwards or another
    size begins a new one."""
    out: list[Block] = []
    for s in spans:
        if not s.text.strip():
            continue
        last = out[-1].spans[-1] if out else None
        if last is None or not -0.2 * s.size <= s.y - last.y <= 1.6 * max(s.size, 1) or abs(s.size - last.size) > 1:
            out.append(Block())
        out[-1].spans.append(s)
    return out


def layout(raw: bytes) -> list[list[Block]]:
    """Blocks of each page."""
    document = Document(raw)
    return [blocks(document.spans(page)) for page in document.pages()]
