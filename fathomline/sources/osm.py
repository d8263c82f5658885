"""OpenStreetMap extracts (PBF): tagged elements."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

#: Kinds of elements, by field of a primitive group.
NODE, DENSE, WAY, RELATION = 1, 2, 3, 4
KINDS = {NODE: "node", WAY: "way", RELATION: "relation"}


def blobs(raw: bytes, fields: Callable[[bytes], Iterator[tuple[int, int, int | bytes]]]) -> Iterator[tuple[bytes, bytes]]:
    """(type, data) of each block of a file."""
    at = 0
    while at + 4 <= len(raw):
        n = int.from_bytes(raw[at : at + 4], "big")
        head = {f: v for f, _, v in fields(raw[at + 4 : at + 4 + n])}
        at += 4 + n
        body = {f: v for f, _, v in fields(raw[at : at + head[3]])}
        at += head[3]
        if 3 in body:
            yield head[1], zlib.decompress(body[3])
        elif 1 in body:
            yield head[1], body[1]
        else:
            raise ValueError("a block is compressed in a way that isn't known")


def _signed(n: int) -> int:
    return (n >> 1) ^ -(n & 1)


def elements(raw: bytes, fields: Callable, packed: Callable[[bytes], list[int]]) -> Iterator[tuple[str, int, list[tuple[str, str]]]]:
    """(kind, id, tags) of the elements that have tags; each (kind, id) once."""
    seen = set()
    for kind, data in blobs(raw, fields):
        if kind != b"OSMData":
            continue
        block = [*fields(data)]
        strings = [s.decode("utf-8", "replace") for f, _, table in block if f == 1 for g, _, s in fields(table) if g == 1]
        for f, _, group in block:
            if f != 2:
                continue
            for g, _, body in fields(group):
                found = _dense(body, strings, fields, packed) if g == DENSE else [_plain(KINDS[g], body, strings, fields, packed)] if g in KINDS else []
                for name, number, tags in found:
                    if tags and (name, number) not in seen:
                        seen.add((name, number))
                        yield name, number, tags


def _plain(kind: str, body: bytes, strings: list[str], fields: Callable, packed: Callable) -> tuple[str, int, list[tuple[str, str]]]:
    number, keys, values = 0, [], []
    for f, wire, v in fields(body):
        if f == 1 and wire == 0:
            number = _signed(v) if kind == "node" else v
        elif f == 2:
            keys += packed(v) if wire == 2 else [v]
        elif f == 3:
            values += packed(v) if wire == 2 else [v]
    return kind, number, [(strings[k], strings[v]) for k, v in zip(keys, values)]


def _dense(body: bytes, strings: list[str], fields: Callable, packed: Callable) -> Iterator[tuple[str, int, list[tuple[str, str]]]]:
    """Nodes in columns: differences of ids, and for each node its keys and values up to a 0."""
    columns = {f: packed(v) for f, wire, v in fields(body) if wire == 2 and f in (1, 10)}
    number, tags = 0, iter(columns.get(10, []))
    for step in columns.get(1, []):
        number += _signed(step)
        own = []
        while k := next(tags, 0):
            own.append((strings[k], strings[next(tags)]))
        yield "node", number, own
