"""Sequential text kernels: one definition each in plain Python, wrapped once for Spark."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

_END = re.compile(r"[.!?»›。！？．｡]\s*")
#: Words after which a full stop ends no sentence.
ABBREVIATIONS = frozenset(
    "sr sra srta dr dra prof gral pág pag ej etc vs aprox p.ej s.n núm num art fig figs ed eds vol pp mt km kg ha cm mm hz khz no nos inc ltd co corp st mr mrs ms "
    "jan feb mar apr jun jul aug sep oct nov dec ene abr ago dic set al cap sec secc párr parr a.c d.c a.m p.m".split()
)
#: Marks that end a sentence, and those that are taken off its last word.
_TERMINAL, _MARKS = ".?!»›。！？．｡¡", ".,;:!?»›"


def _pieces(text: str) -> Iterator[str]:
    """What stands between closing marks, each mark with what it closes, stripped; blank pieces are left out."""
    at = 0
    for m in _END.finditer(text):
        if piece := text[at : m.start() + 1].strip():
            yield piece
        at = m.end()
    if piece := text[at:].strip():
        yield piece


def each_sentence(text: str) -> Iterator[str]:
    """Sentences of a text as they are asked for: cut after closing marks, joined again where the last word is an
    abbreviation."""
    buffer = ""
    for piece in _pieces(text):
        buffer = f"{buffer} {piece}" if buffer else piece
        word = buffer.rstrip(" \t\n.").rpartition(" ")[2].lower()
        if buffer[-1] in _TERMINAL and word.rstrip(_MARKS) not in ABBREVIATIONS:
            yield buffer
            buffer = ""
    if buffer:
        yield buffer


def sentences(text: str) -> list[str]:
    return [*each_sentence(text)]


def last_within(costs: list[int], budget: int) -> int:
    """Number of the last unit that still fits into a budget together with those before it; 0 if none does."""
    total = 0
    for i, cost in enumerate(costs):
        total += cost
        if total > budget:
            return max(i - 1, 0)
    return max(len(costs) - 1, 0)


def windows(costs: list[int], size: int, overlap: int) -> list[tuple[int, int]]:
    """Greedy windows (first, last) over units: as many units as fit into size, at least one; the next window begins
    with the longest tail of this one that costs at most overlap, but after this one's first unit."""
    out, start, n = [], 0, len(costs)
    while start < n:
        end, total = start, costs[start]
        while end + 1 < n and total + costs[end + 1] <= size:
            end += 1
            total += costs[end]
        out.append((start, end))
        if end == n - 1:
            break
        tail, after = 0, end + 1
        for k in range(end, start, -1):
            if tail >= overlap or tail + costs[k] > overlap:
                break
            tail += costs[k]
            after = k
        start = after
    return out


def tail_absorbed(found: list[tuple[int, int]], costs: list[int], least: int, most: int) -> list[tuple[int, int]]:
    """A last window of under least tokens becomes part of the one before, if both together have at most most."""
    if len(found) < 2:
        return found
    (a, b), (c, d) = found[-2:]
    tail, before = sum(costs[c : d + 1]), sum(costs[a : b + 1])
    if tail < least and d == len(costs) - 1 and before + tail <= most:
        return [*found[:-2], (a, d)]
    return found


Section = tuple[str | None, str, int, bool]


def merge_small(sections: list[Section], least: int, most: int) -> list[Section]:
    """Sections of under least words join the one before, else take in the next, as long as both may be split and
    together have at most most words; again until nothing changes.  The first one's title and order stay."""
    size = lambda s: len(s[1].split())
    now = list(sections)
    for _ in range(len(sections)):
        out: list[Section] = []
        i, changed = 0, False
        while i < len(now):
            own = now[i]
            if own[3] and size(own) < least:
                if out and out[-1][3] and size(out[-1]) + size(own) <= most:
                    t = out.pop()
                    out.append((t[0], t[1] + "\n" + own[1], t[2], True))
                    i, changed = i + 1, True
                    continue
                if i + 1 < len(now) and now[i + 1][3] and size(own) + size(now[i + 1]) <= most:
                    out.append((own[0], own[1] + "\n" + now[i + 1][1], own[2], True))
                    i, changed = i + 2, True
                    continue
            out.append(own)
            i += 1
        now = out
        if not changed:
            break
    return now


def fitted(text: str, limit: int, count: Callable[[str], int] | None = None, *, adds: bool = False) -> str | None:
    """What an encoder of limit tokens takes of a text: all, else the longest run of whole sentences from the start,
    else a hard cut by words, else null.  Without a counter, four characters count as a token.  adds says that the
    counter is one of words: joined sentences have the sum of their counts.  Sentences after the limit aren't made."""
    count = count or (lambda t: max(1, len(t) // 4))
    if not text.strip():
        return None
    if count(text) <= limit:
        return text
    taken: list[str] = []
    total = 0
    for s in each_sentence(text):
        total = total + count(s) if adds else count(" ".join([*taken, s]))
        if total > limit:
            break
        taken.append(s)
    if taken:
        return " ".join(taken)
    words = text.split()
    low, high = 0, len(words)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if count(" ".join(words[:mid])) <= limit else (low, mid - 1)
    return " ".join(words[:low]) or None


def split_words(text: str, n: int) -> Iterator[str]:
    """Pieces of at most n words; a text that fits stays as it is."""
    w = text.split()
    if len(w) <= n:
        yield text
    else:
        for i in range(0, len(w), n):
            yield " ".join(w[i : i + n])


def packed_sentences(text: str, most: int = 250) -> list[str]:
    """Fragments of whole sentences of at most most words together; a longer sentence stands alone."""
    parts = [*_pieces(text)]
    costs = [len(p.split()) for p in parts]
    return [" ".join(parts[a : b + 1]) for a, b in windows(costs, most, 0)]
