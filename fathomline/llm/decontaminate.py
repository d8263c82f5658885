"""Benchmark decontamination: texts that hold a benchmark item within an edit budget.

Pigeonhole: an item cut into budget + 1 pieces keeps at least one piece intact under any budget edits.  Exact piece
hits come from one automaton over each text; each hit is verified with Myers' bit-parallel edit distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import arrow_kind, small_batches

_GAP = re.compile(r"[^\w]+|_+")

#: Items in one block: what a worker holds at a time has this bound, whatever the size of the benchmark.
BLOCK_ITEMS = 5000
#: Bytes of texts that meet a block's automaton before the next block's is built, where there are several.
GROUP_BYTES = 64 << 20


def normalised(text: str) -> str:
    """Lower case; every run of characters other than letters and digits becomes one blank."""
    return _GAP.sub(" ", text.lower()).strip()


def budget(length: int, percent: int) -> int:
    """Edits that an item of this many normalised characters may have suffered."""
    return length * percent // 100


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 pieces (offset, piece) that together are the item; lengths differ by one at most."""
    n = edits + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def best_match(item: str, text: str, masks: dict[str, int]) -> tuple[int, int]:
    """Smallest edit distance between the item and any substring of text, and where the first such one ends.

    masks has the bit set of the item's positions for each character.
    """
    m = len(item)
    top, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score = full, 0, m
    best, end = m, 0
    get = masks.get
    for i, c in enumerate(text):
        eq = get(c, 0)
        x = eq | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        hp, hn = minus | (full & ~(d0 | plus)), d0 & plus
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = (hp << 1) & full  # no carry into row 0: a match may start anywhere
        hn = (hn << 1) & full
        plus, minus = hn | (full & ~(d0 | hp)), d0 & hp
        if score < best:
            best, end = score, i + 1
    return best, end


class Matcher:
    """The automaton of the pieces of one block of items."""

    def __init__(self, items: list[tuple[int, str]], percent: int, shortest: int):
        self.items: dict[int, tuple[list, str, int, dict[str, int]]] = {}
        self.shortest = shortest
        by_text: dict[str, list] = {}
        for item_id, text in items:
            norm = normalised(text or "")
            if norm:
                by_text.setdefault(norm, []).append(item_id)
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (norm, ids) in enumerate(sorted(by_text.items())):
            edits = budget(len(norm), percent) if len(norm) >= shortest else 0
            masks: dict[str, int] = {}
            for at, c in enumerate(norm):
                masks[c] = masks.get(c, 0) | 1 << at
            self.items[i] = (sorted(ids, key=lambda x: (x is None, x)), norm, edits, masks)
            for offset, piece in pieces(norm, edits):
                found.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        if found:
            self.automaton.make_automaton()

    def match(self, text: str) -> list[tuple[int, int]]:
        """(item id, smallest distance) of every item within its budget, by id."""
        if not self.items:
            return []
        norm = normalised(text)
        windows: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.automaton.iter(norm):
            for i, offset in where:
                _, item, edits, _ = self.items[i]
                start = end + 1 - length - offset
                if len(item) < self.shortest and (i in windows or norm[max(0, start - 1) : start].strip() or norm[end + 1 : end + 2].strip()):
                    continue  # a short item is found already, or begins or ends within a word
                a, b = max(0, start - edits), min(len(norm), start + len(item) + edits)
                own = windows.setdefault(i, [])
                if own and a <= own[-1][1] and own[-1][0] <= b:  # overlapping windows of an item are verified once
                    own[-1] = [min(a, own[-1][0]), max(b, own[-1][1])]
                else:
                    own.append([a, b])
        out = []
        for i, own in windows.items():
            ids, item, edits, masks = self.items[i]
            best = edits + 1
            for a, b in own:
                if best and b - a >= len(item) - edits:
                    # an exact copy needs no table
                    best = 0 if item in norm[a:b] else min(best, best_match(item, norm[a:b], masks)[0])
            if best <= edits:
                out += [(item_id, best) for item_id in ids]
        return sorted(out, key=lambda x: (x[0] is None, x))


@lru_cache(maxsize=4)
def _matcher(items: tuple[tuple[int, str], ...], percent: int, shortest: int) -> Matcher:
    return Matcher([*items], percent, shortest)


class _Blocks:
    """The benchmark's blocks in a worker.  One block has its automaton for good; of several, one at a time is built."""

    def __init__(self, shared: list, percent: int, shortest: int):
        self.shared, self.options = shared, (percent, shortest)

    def found(self, texts: list[str]) -> list[list[tuple]]:
        """For each text, its (item id, distance)."""
        out: list[list[tuple]] = [[] for _ in texts]
        for block in self.shared:
            make = _matcher if len(self.shared) == 1 else Matcher
            matcher = make(block.value, *self.options)
            for own, text in zip(out, texts):
                own += matcher.match(text)
        return out


def _groups(batches: Iterator[pa.RecordBatch], at: int, several: bool) -> Iterator[pa.Table]:
    """Batches one by one; where each group costs several automata, together up to GROUP_BYTES of texts."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(at).nbytes
        if not several or size >= GROUP_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def matches(docs: DataFrame, benchmark: DataFrame, *, percent: int = 5, shortest: int = 40, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc id, item_id, distance): each benchmark item that a whole text holds within percent % edits.

    Both sides are compared in normalised form; items of under shortest normalised characters have no edits and must
    stand as whole words, since chance finds their like in clean texts.  The benchmark is the stated query set: all
    texts are read once; a worker gets the items in blocks of block_items and builds one block's automaton at a time,
    for some 64 MB of texts.  Ids may be of any type.  Texts that are null or empty match nothing; repeated rows and
    repeated items give repeated matches; a null item text matches nothing, a null id is an id like others; an empty
    table on either side gives an empty result; other columns aren't read.
    """
    df = small_batches(docs).select(id_col, text_col)
    kind, item_kind = df.schema[0].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    shared, item_arrow = _shared(benchmark, block_items, item_col, item_text_col), arrow_kind(item_kind)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Blocks(shared, percent, shortest)
        for group in _groups(batches, 1, len(shared) > 1):
            found = own.found([t or "" for t in group.column(1).to_pylist()])
            at = pa.array([i for i, x in enumerate(found) for _ in x], pa.int64())
            ids = group.column(0).take(at).combine_chunks()
            items, distances = ([y[k] for x in found for y in x] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([ids, pa.array(items, item_arrow), pa.array(distances, pa.int32())], names=[id_col, "item_id", "distance"])

    return df.mapInArrow(rows, f"`{id_col}` {kind}, item_id {item_kind}, distance int")


def _shared(benchmark: DataFrame, size: int, item_col: str, item_text_col: str) -> list:
    """The blocks as broadcasts: the query set, which the caller states, is all that is sent to workers."""
    spark = benchmark.sparkSession
    return [spark.sparkContext.broadcast(x) for x in blocks(benchmark, size, item_col=item_col, item_text_col=item_text_col)]


def blocks(benchmark: DataFrame, size: int = BLOCK_ITEMS, *, item_col: str = "item_id", item_text_col: str = "text") -> Iterator[tuple]:
    """The benchmark in blocks of (id, text)."""
    block = []
    for row in benchmark.select(item_col, item_text_col).filter(F.col(item_text_col).isNotNull()).toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == size:
            yield tuple(block)
            block = []
    if block:
        yield tuple(block)


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, percent: int = 5, shortest: int = 40, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they are.  No shuffle.

    A null or empty text holds none and stays, as do repeated rows of clean texts; an empty benchmark lets all stay.
    """
    at = docs.columns.index(text_col)
    df, shared = small_batches(docs), _shared(benchmark, block_items, item_col, item_text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Blocks(shared, percent, shortest)
        for group in _groups(batches, at, len(shared) > 1):
            clean = [not x for x in own.found([t or "" for t in group.column(at).to_pylist()])]
            yield from group.filter(pa.array(clean, pa.bool_())).to_batches()

    return df.mapInArrow(rows, docs.schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each text that holds an item: its id, item_ids (sorted, comma-joined), n_items, distance (the smallest).

    Rows that repeat an id, and rows without one, count as one document; so do items of one id.
    """
    id_col = options.get("id_col", "doc_id")
    found = matches(docs, benchmark, **options).groupBy(id_col, "item_id").agg(F.min("distance").alias("distance"))
    return found.groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_list("item_id")).cast("array<string>"), ",").alias("item_ids"), F.count("*").alias("n_items"), F.min("distance").alias("distance"))
