"""Removal of repeated 100-byte strings from a corpus, by column-wise construction of collection BWTs.

A string of `length` bytes is anchored at the smallest of its 16-byte hashes (leftmost of equals), so equal strings
have equal anchors at equal offsets, wherever they occur.  An anchor's span is all that the strings anchored at it
cover: `length` to 2 * length - 16 bytes.

1. A scan counts, for each anchor hash, its occurrences and whether their spans differ.  Two bitmaps of bounded size
   say which hashes may repeat and which may repeat with different spans.
2. A second scan sends on the spans whose anchor may repeat; a span that the task has seen at an earlier place is a
   repeat already and goes no further.  So equal spans cost a row a task, however many there are.
3. Spans of one anchor hash meet in one task.  Of equal spans all but the first are repeats.  Different spans with a
   core in common become a collection: the Burrows-Wheeler transform of all their suffixes is built column by column
   from the right, one symbol of each span inserted a round, and the common prefixes of neighbours are carried on from
   round to round.  Neighbours that share `length` symbols are equal strings; all but the first are repeats.
   Columns above ram_rows (7 MB for the three of them) are files, read and written from front to back each round.
4. Repeated runs are merged by document and cut out.

Anchors with over `hot` occurrences skip the collections: each string of theirs is sent by itself, under its own hash,
so that none of the tasks gets an unbounded group.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import bitmap, dropped, id_kind, numbered, opened, perhaps, scratch, small_batches, written

GRAM = 16
#: Documents whose runs are merged at once.
BUCKET_DOCS = 50_000
#: Texts are searched in pieces of so many bytes (plus the overlap), so memory does not grow with a text.
PIECE = 1 << 22
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POSITION = np.uint64((1 << 24) - 1)


@dataclass(frozen=True)
class Params:
    """length: bytes of a repeat.  hot: see above.  seen: spans that a task remembers.  collection: spans in one
    collection (a whole anchor group always fits, as it has at most hot).  ram_rows: columns longer than this are
    files.  sketch_bits: most bits of a bitmap, as a power of two; beyond, bitmaps only prune less."""

    length: int = 100
    hot: int = 10_000
    seen: int = 400_000
    collection: int = 600
    ram_rows: int = 1 << 20
    sketch_bits: int = 28


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first, last): each anchor, and the range of starts of the strings anchored there."""
    found = [_anchors(data[at : at + PIECE + length - 1], length, at) for at in range(0, max(1, len(data) - length + 1), PIECE)]
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors(data: np.ndarray, length: int, base: int) -> tuple[np.ndarray, ...]:
    if len(data) < length:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    h = _TABLE[data]
    for step in (1, 2, 4, 8):
        h = h[:-step] * (_ODD + np.uint64(2 * step)) + h[step:]
        h ^= h >> np.uint64(31)
    low = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
    width, reach = length - GRAM + 1, 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    n = len(data) - length + 1
    at = (np.minimum(low[:n], low[width - reach : width - reach + n]) & _POSITION).astype(np.int64)
    cut = np.flatnonzero(np.diff(at)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [n - 1]])
    return h[at[first]], at[first] + base, first + base, last + base


class Folder:
    """Where the columns of one task's collections lie once they are files: a folder below the shared one, made when it
    is first needed and deleted with the collection.  Files are read and written from front to back."""

    def __init__(self, root: str | None):
        self.root, self.fs, self.path = root, None, ""

    def file(self, name: str) -> str:
        if self.fs is None:
            # no root: a local session without tasks, as in tests
            self.fs, self.path = opened(f"{self.root or tempfile.gettempdir()}/columns-{uuid.uuid4().hex}")
            self.fs.create_dir(self.path, recursive=True)
        return f"{self.path}/{name}"

    def cleanup(self) -> None:
        if self.fs is not None:
            self.fs.delete_dir(self.path)
            self.fs = None


class Column:
    """A column of a collection: an array, or beyond ram_rows a file that is read and written in order."""

    STEP = 1 << 18

    def __init__(self, kind: type, ram_rows: int, folder: Folder):
        self.kind, self.ram_rows, self.folder = np.dtype(kind), ram_rows, folder
        self.rows: np.ndarray | None = None
        self.path, self.n, self._turn = "", 0, 0

    def set(self, rows: np.ndarray) -> None:
        self.rows, self.n = rows.astype(self.kind), len(rows)

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        if self.rows is not None:
            yield 0, self.rows
            return
        with self.folder.fs.open_input_stream(self.path) as f:
            for at in range(0, self.n, self.STEP):
                yield at, np.frombuffer(f.read(min(self.STEP, self.n - at) * self.kind.itemsize), self.kind)

    def _written(self, parts: Iterator[np.ndarray], n: int) -> None:
        self._turn ^= 1
        target = self.folder.file(f"{id(self)}-{self._turn}")
        with self.folder.fs.open_output_stream(target) as f:
            for part in parts:
                f.write(part.tobytes())
        self.rows, self.path, self.n = None, target, n

    def insert(self, where: np.ndarray, values: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray | None:
        """where: final row numbers of the values, ascending.  Gives the numbers of the old rows, for another column
        of the same length; none if the column is a file."""
        n = self.n + len(where)
        if n <= self.ram_rows:
            if keep is None:
                keep = np.ones(n, bool)
                keep[where] = False
                keep = np.flatnonzero(keep)
            out = np.empty(n, self.kind)
            out[keep], out[where] = self.rows, values
            self.rows, self.n = out, n
            return keep

        def merged_parts() -> Iterator[np.ndarray]:
            done = 0
            for at, old in self.parts():
                # row i of the old column becomes row i + the number of values that stand before it
                upto = int(np.searchsorted(where - np.arange(len(where)), at + len(old), "left")) if at + len(old) < self.n else len(where)
                mine = where[done:upto] - (at + done)
                out = np.empty(len(old) + len(mine), self.kind)
                keep = np.ones(len(out), bool)
                keep[mine] = False
                out[keep], out[mine] = old, values[done:upto]
                yield out
                done = upto

        self._written(merged_parts(), n)
        return None

    def take(self, at: np.ndarray) -> np.ndarray:
        """Rows by ascending number."""
        if self.rows is not None:
            return self.rows[at]
        out = []
        for start, part in self.parts():
            a, b = np.searchsorted(at, (start, start + len(part)))
            out.append(part[at[a:b] - start])
        return np.concatenate(out)

    def put(self, at: np.ndarray, values: np.ndarray) -> None:
        """Sets rows by ascending number; a file is written anew, in order."""
        if self.rows is not None:
            self.rows[at] = values
            return

        def changed() -> Iterator[np.ndarray]:
            for start, part in self.parts():
                a, b = np.searchsorted(at, (start, start + len(part)))
                out = part.copy()
                out[at[a:b] - start] = values[a:b]
                yield out

        self._written(changed(), self.n)


@dataclass
class _Part:
    """What the neighbours of rows of one part say about those of the parts around it, by symbol."""

    low: np.ndarray  # the least common prefix since the symbol's last row, of all rows if it had none yet
    seen: np.ndarray  # whether the symbol has had a row
    count: np.ndarray  # how many
    waiting: np.ndarray  # the asked row whose next row of its symbol is yet to come, or -1


def neighbours(bwt: Column, lcp: Column, at: np.ndarray, symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows (ascending) and their symbols: how often the symbol stands before the row; the least common prefix between
    the row and the last one before it, and the next one after it, with that symbol (-1 if there is none); and how often
    each symbol stands in all.

    Both columns are read once, from front to back.
    """
    rank, before, after = (np.full(len(at), fill, np.int64) for fill in (0, -1, -1))
    most = np.iinfo(lcp.kind).max
    state = _Part(np.full(size, most, np.int64), np.zeros(size, bool), np.zeros(size, np.int64), np.full(size, -1))
    for (start, part), (_, shared) in zip(bwt.parts(), lcp.parts()):
        n = len(part)
        order = np.argsort(part, kind="stable")  # rows by symbol
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        counts = np.bincount(part, minlength=size)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        a, b = np.searchsorted(at, (start, start + n))
        row, symbol = at[a:b] - start, symbols[a:b]
        own = place[row] - first[symbol]
        rank[a:b] = state.count[symbol] + own
        has = own > 0
        before[a:b][has] = _least(shared, order[place[row[has]] - 1] + 1, row[has] + 1)
        early = ~has & state.seen[symbol]
        has = own + 1 < counts[symbol]
        after[a:b][has] = _least(shared, row[has] + 1, order[place[row[has]] + 1] + 1)
        if n == bwt.n:
            return own, before, after, counts
        # rows of earlier parts that are the last one before, or that wait for the next one
        down = np.minimum.accumulate(shared)  # least from the part's beginning
        before[a:b][early] = np.minimum(state.low[symbol[early]], down[row[early]])
        here = counts > 0
        ready = np.flatnonzero(here & (state.waiting >= 0))
        after[state.waiting[ready]] = np.minimum(state.low[ready], down[order[first[ready]]])
        state.waiting[here] = -1
        up = np.append(np.minimum.accumulate(shared[::-1])[::-1], most)  # least up to the part's end
        state.low[~here] = np.minimum(state.low[~here], down[-1] if n else most)
        state.low[here] = up[order[first[here] + counts[here] - 1] + 1]
        state.waiting[symbol[~has]] = np.flatnonzero(~has) + a
        state.seen |= here
        state.count += counts
    return rank, before, after, state.count


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low:high] for each pair, where low < high."""
    if not len(low):
        return np.zeros(0, np.int64)
    # reduceat takes every second stretch between bounds; the last bound may be the end, which needs a row of its own
    bounds = np.stack([low, high], axis=1).ravel()
    return np.minimum.reduceat(np.append(values, values[-1:]), bounds)[::2].astype(np.int64)


def collection(spans: list[bytes], length: int, ram_rows: int, root: str | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of two or more equal strings of length bytes within the spans, many at once: where each group begins,
    and the span number and offset of each string.

    Round r inserts, for every span of more than r bytes, its suffix of r + 1 bytes into the transform and into the
    common prefixes.  The suffix starts with the symbol c that the transform holds for the suffix of r bytes; among
    suffixes with that first symbol it stands where the shorter one stands among them.  What it shares with the one
    before it is c and what their shorter suffixes share: the least common prefix between the rows of the two, which are
    neighbours among the rows of c; likewise for the one after it.  Common prefixes are kept up to length.
    Suffixes of under length bytes have no part in a result, so the column of where suffixes start begins with the round
    that inserts the first longer ones.
    """
    order = sorted(range(len(spans)), key=lambda i: -len(spans[i]))
    sizes = np.array([len(spans[i]) for i in order])
    m, longest = len(spans), int(sizes[0])
    if longest < length:
        return
    raw = np.frombuffer(b"".join(spans[i] for i in order), np.uint8)
    used = np.unique(raw)
    code = np.zeros(256, np.uint8)
    code[used] = np.arange(len(used))
    end = len(used)  # stands before a whole span; never counted.  UTF-8 leaves some bytes unused, so it fits
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    text = code[raw]
    active = np.searchsorted(-sizes, -np.arange(longest + 1), "left")
    columns = np.full((longest + 1, m), end, np.uint8)
    for r in range(longest):
        k = active[r]
        columns[r, :k] = text[starts[:k] + sizes[:k] - 1 - r]
    folder = Folder(root)
    bwt, lcp, suffix = (Column(kind, ram_rows, folder) for kind in (np.uint8, np.uint16 if length > 254 else np.uint8, np.uint32))
    bwt.set(columns[0])
    lcp.set(np.zeros(m))
    at = np.arange(m)
    for r in range(longest):
        k = active[r]
        by_row = np.argsort(at[:k])
        symbols = columns[r, :k][by_row].astype(np.int64)
        rank, before, after, total = neighbours(bwt, lcp, at[:k][by_row], symbols, end + 1)
        first = m + np.concatenate([[0], np.cumsum(total[:end])[:-1]])
        where = first[symbols] + rank
        at[by_row] = where
        up = np.argsort(where)
        where, owner = where[up], by_row[up]
        before, after = (np.minimum(x[up] + 1, length) for x in (before, after))  # -1, no such row, becomes 0
        if r + 1 == length:
            suffix.set(np.full(bwt.n, len(raw)))  # all of them short: the end of the text stands for them
        keep = bwt.insert(where, columns[r + 1][owner])
        lcp.insert(where, before, keep)
        follow = np.flatnonzero(where + 1 < lcp.n)
        lcp.put(where[follow] + 1, after[follow])
        if r + 1 >= length:
            suffix.insert(where, (starts + sizes)[owner] - 1 - r, keep)
    ids = np.array(order)
    held = np.zeros(0, np.uint32)  # the last row so far, or the run that is still open
    for (at_row, part), (_, shared) in zip(suffix.parts(), lcp.parts()):
        flags = np.concatenate([np.arange(len(held)) > 0, shared >= length])
        places = np.concatenate([held, part])
        # the last row, and what is shared with it, waits for the next part
        last = len(places)
        if at_row + len(part) < suffix.n:
            last = int(np.flatnonzero(~flags)[-1])
            held = places[last:]
        member = flags[:last].copy()
        member[:-1] |= flags[1:last]
        begin = np.flatnonzero(~flags[:last][member])
        if len(begin):
            found = places[:last][member].astype(np.int64)
            span = np.searchsorted(starts, found, "right") - 1
            yield begin, ids[span], found - starts[span]
    folder.cleanup()


Interval = tuple[int, int]


def merged(intervals: list[Interval]) -> list[Interval]:
    """Sorted maximal runs of intervals that overlap or touch."""
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _packed(intervals: list[Interval]) -> bytes:
    return np.array(merged(intervals), np.int64).tobytes()


def _unpacked(parts: list[bytes]) -> list[Interval]:
    return [tuple(x) for part in parts for x in np.frombuffer(part, np.int64).reshape(-1, 2).tolist()]


_ROW = "key bigint, digest binary, span binary, doc bigint, mark bigint, first bigint, n int, anchor int"
_ROW_KINDS = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
_PACK = "bucket bigint, runs binary"
_CUT = "doc bigint, mark bigint, runs binary"


def _batch(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


@dataclass
class Sketch:
    """What the second scan knows of anchor hashes: bits (a power of two), and bitmaps of those that repeat, that repeat
    with different spans, and that do so over hot times.  A hash that only shares its bit with another goes the same way
    wherever it occurs, so results stay exact."""

    bits: int
    repeats: bytes
    differ: bytes
    hot: bytes

    def test(self, bitmap: bytes, h: np.ndarray) -> np.ndarray:
        slot = (h & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        return (np.frombuffer(bitmap, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(doc, mark, text): the mark tells rows apart that share an id but not the text.  Ids that aren't whole numbers are
    numbered in their order; then the numbers come back as well."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    if id_kind(docs, id_col) == "bigint":
        number, names = F.col("id").cast("long"), None
    else:
        names = numbered(own, "id")
        own, number = own.join(names, "id", "left"), F.col("n")
    return small_batches(own).select(F.coalesce(number, F.lit(-(1 << 63))).alias("doc"), "mark", "text"), names


def sketch(texts: DataFrame, p: Params) -> Sketch:
    """Step 1.  At most 2 ** sketch_bits bits of each bitmap reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            hashes, spans = [], []
            for text in batch.column(0):
                raw = text.as_py().encode()
                h, _, first, last = anchors(np.frombuffer(raw, np.uint8), p.length)
                hashes.append(h)
                spans += [digest(raw[a : b + p.length]) for a, b in zip(first.tolist(), last.tolist())]
            h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.array(spans, np.uint64).view(np.int64))], names=["h", "s"])

    found = texts.select("text").mapInArrow(count, "h bigint, s bigint").groupBy("h").agg(F.count("*").alias("n"), (F.min("s") < F.max("s")).alias("differ")).filter("n > 1")
    found = written(found, "repeat-anchors")
    n = found.count()
    bits = min(p.sketch_bits, max(15, (16 * n).bit_length()))
    slot = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))

    def bitmap(rows: DataFrame) -> bytes:
        out = bytearray(1 << bits - 3)
        own = rows.select(F.shiftright(slot, 15).alias("line"), slot.bitwiseAND(F.lit(32_767)).alias("bit")).groupBy("line").agg(F.expr("bitmap_construct_agg(bit)").alias("map"))
        for row in own.toLocalIterator():
            out[row.line << 12 : (row.line << 12) + 4096] = row["map"]
        return bytes(out)

    made = Sketch(bits, bitmap(found), bitmap(found.filter("differ")), bitmap(found.filter(F.col("n") > p.hot)))
    dropped(found)
    return made


def _sent(texts: DataFrame, known: Sketch, p: Params) -> DataFrame:
    """Step 2: spans whose anchor may repeat, and (digest empty) the runs that the task knows to be repeats."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, seen, rows = shared.value, {}, []
        names = [x.split(" ")[0] for x in _ROW.split(", ")]
        digest_of, key_of = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
        for batch in batches:
            for doc, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = text.as_py().encode()
                h, at, first, last = anchors(np.frombuffer(raw, np.uint8), p.length)
                keep = np.flatnonzero(s.test(s.repeats, h))
                if not len(keep):
                    continue
                h, at, first, last = h[keep], at[keep], first[keep], last[keep]
                differ, signed = s.test(s.differ, h).tolist(), h.view(np.int64)
                alone = s.test(s.hot, h).tolist()
                runs: list[Interval] = []
                for key, a, b, pos, many, single in zip(signed.tolist(), first.tolist(), last.tolist(), at.tolist(), differ, alone):
                    span = raw[a : b + p.length]
                    digest = digest_of(span)
                    here = (doc, mark, a)
                    was = seen.get(digest)
                    if was is not None and was < here:
                        if runs and a <= runs[-1][1]:
                            runs[-1] = (runs[-1][0], b + p.length)
                        else:
                            runs.append((a, b + p.length))
                        continue
                    if len(seen) >= p.seen:
                        seen.clear()
                    seen[digest] = here
                    if not single:
                        rows.append((key, digest, span if many else None, doc, mark, a, b - a + 1, pos - a))
                        continue
                    for i in range(a, b + 1):
                        digest = digest_of(raw[i : i + p.length])
                        was = seen.get(digest)
                        if was is not None and was < (doc, mark, i):
                            runs.append((i, i + p.length))
                        else:
                            seen[digest] = (doc, mark, i)
                            rows.append((int.from_bytes(digest[:8], "little", signed=True), digest, None, doc, mark, i, 1, 0))
                if runs:
                    rows.append((key_of(doc.to_bytes(8, "little", signed=True)) - (1 << 63), b"", _packed(runs), doc, mark, 0, 0, 0))
                if len(rows) >= 2000:
                    yield _batch(rows, _ROW_KINDS, names)
                    rows = []
        if rows:
            yield _batch(rows, _ROW_KINDS, names)

    return texts.mapInArrow(send, _ROW)


class _Meeting:
    """Step 3 for the spans of one task, which come sorted by anchor hash, digest and place."""

    def __init__(self, p: Params, buckets: int = 1, root: str | None = None):
        self.p, self.buckets, self.root = p, buckets, root
        reach = p.length - GRAM  # an anchor is at most so far from a string's start
        cuts = [reach * i // 6 for i in range(6)] + [reach + 1]
        self.ranges = [(a, b - 1) for a, b in zip(cuts, cuts[1:]) if a < b]
        self.classes: list[tuple] = []
        self.spans: list[bytes] = []
        self.places: list[tuple[int, int, int]] = []
        self.runs: dict[tuple[int, int], list[Interval]] = {}

    def repeat(self, doc: int, mark: int, start: int, end: int) -> None:
        own = self.runs.setdefault((doc, mark), [])
        if own and own[-1][0] <= start <= own[-1][1]:
            own[-1] = (own[-1][0], max(own[-1][1], end))
        else:
            own.append((start, end))

    def end_of_key(self) -> None:
        """Classes that share a core with another go into the collection, cut to the strings that hold such a core.

        Strings that start between low and high bytes before their anchor all hold the core from low bytes before it
        to length - high after it; so strings that are equal have equal cores.
        """
        length = self.p.length
        if len(self.classes) > 1:
            count: dict[tuple[int, bytes], int] = {}
            for span, _, _, _, at in self.classes:
                for low, high in self.ranges:
                    if at >= low and at + length - high <= len(span):
                        core = (low, span[at - low : at + length - high])
                        count[core] = count.get(core, 0) + 1
            for span, doc, mark, first, at in self.classes:
                shared = [(low, high) for low, high in self.ranges if at >= low and at + length - high <= len(span) and count[low, span[at - low : at + length - high]] > 1]
                if shared:
                    skip = max(0, at - max(high for _, high in shared))
                    stop = min(len(span), at + length - min(low for low, _ in shared))
                    self.spans.append(span[skip:stop])
                    self.places.append((doc, mark, first + skip))
        self.classes.clear()
        if len(self.spans) >= self.p.collection:
            self.end_of_collection()

    def end_of_collection(self) -> None:
        if self.spans:
            texts = sorted({(doc, mark) for doc, mark, _ in self.places})
            number = {x: i for i, x in enumerate(texts)}
            owner = np.array([number[doc, mark] for doc, mark, _ in self.places])
            begin = np.array([first for _, _, first in self.places])
            for groups, span, offset in collection(self.spans, self.p.length, self.p.ram_rows, self.root):
                text, start = owner[span], begin[span] + offset
                # the first string of each group stays
                rank = np.empty(len(text), np.int64)
                order = np.lexsort((start, text))
                rank[order] = np.cumsum(np.concatenate([[0], (np.diff(text[order]) != 0) | (np.diff(start[order]) != 0)]))
                sizes = np.diff(np.concatenate([groups, [len(text)]]))
                later = order[(rank != np.repeat(np.minimum.reduceat(rank, groups), sizes))[order]]
                text, start = text[later], start[later]
                cut = np.flatnonzero((np.diff(text) != 0) | (np.diff(start) > self.p.length)) + 1
                edges = [0, *cut.tolist(), len(text)] if len(text) else []
                for a, b in zip(edges, edges[1:]):
                    self.repeat(*texts[text[a]], int(start[a]), int(start[b - 1]) + self.p.length)
        self.spans.clear()
        self.places.clear()

    def taken(self) -> Iterator[pa.RecordBatch]:
        """The runs so far, a row for each bucket of documents: int64 quadruples (doc, mark, start, end)."""
        rows = np.array([(doc, mark, a, b) for (doc, mark), runs in self.runs.items() for a, b in runs], np.int64).reshape(-1, 4)
        self.runs.clear()
        if len(rows):
            with np.errstate(over="ignore"):
                bucket = ((rows[:, 0].astype(np.uint64) * _ODD) >> np.uint64(33)).astype(np.int64) % self.buckets
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order])) + 1
            parts = np.split(order, cut)
            yield _batch([(int(bucket[x[0]]), rows[x].tobytes()) for x in parts], (pa.int64(), pa.binary()), ["bucket", "runs"])


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed runs, sorted by bucket, to a row for each document with its merged runs."""

    def documents(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = np.frombuffer(b"".join(parts), np.int64).reshape(-1, 4)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        cut = np.flatnonzero((np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)) + 1
        out = [(int(x[0, 0]), int(x[0, 1]), _packed(x[:, 2:].tolist())) for x in np.split(rows, cut)]
        yield _batch(out, (pa.int64(), pa.int64(), pa.binary()), ["doc", "mark", "runs"])

    bucket, parts = None, []
    for batch in batches:
        for own, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != bucket and parts:
                yield from documents(parts)
                parts = []
            bucket = own
            parts.append(runs)
    if parts:
        yield from documents(parts)


def repeats(texts: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc, mark, runs): the merged repeated runs of each text that has one; runs are pairs of int64.

    Tasks send runs on by bucket of documents; a bucket is held at once, so their number grows with the documents.
    """
    buckets = max(2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-texts.select("doc").count() // BUCKET_DOCS))
    root = scratch(texts.sparkSession, "repeat-columns")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, key, digest, place = _Meeting(p, buckets, root), None, None, None
        for batch in batches:
            for k, d, span, doc, mark, first, n, at in zip(*(c.to_pylist() for c in batch.columns)):
                if not d:
                    for a, b in _unpacked([span]):
                        m.repeat(doc, mark, a, b)
                    continue
                if k != key:
                    m.end_of_key()
                    key, digest = k, None
                if d == digest:
                    if place != (doc, mark, first):  # else the same row once more
                        m.repeat(doc, mark, first, first + n - 1 + p.length)
                else:
                    digest, place = d, (doc, mark, first)
                    if span is not None:
                        m.classes.append((span, doc, mark, first, at))
            if len(m.runs) >= 60_000:
                yield from m.taken()
        m.end_of_key()
        m.end_of_collection()
        yield from m.taken()

    sent = _sent(texts, sketch(texts, p), p)
    return sent.repartition("key").sortWithinPartitions("key", "digest", "doc", "mark", "first").mapInArrow(meet, _PACK).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_by_document, _CUT)


def deduplicate(docs: DataFrame, p: Params = Params(), *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row for each document: n_bytes, n_removed, n_spans, kept_sha256[, kept].

    A text counts in UTF-8 bytes (null: none).  Each byte goes that is covered by a string of p.length bytes that
    also starts earlier: in a document of smaller id, or earlier in the same document; strings may overlap, never
    cross documents, and are judged on the input.  n_spans counts maximal removed runs; kept are the bytes that stay,
    joined (binary, since a cut may fall within a character).  Ids may be whole numbers, or strings and the like, which
    then are in their own order.  A null id comes before all others.  Rows that repeat id and text are one document, of which each row
    gets the result; rows that share only the id are documents of their own, in the order of a hash.  An empty table gives an empty result; other columns
    aren't read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept = [], []
            for text, part in zip(batch.column(1), batch.column(2)):
                raw = text.as_py().encode()
                runs = _unpacked([part.as_py()]) if part.is_valid else []
                at, stay = 0, []
                for a, b in runs:
                    stay.append(raw[at:a])
                    at = b
                left = b"".join([*stay, raw[at:]])
                rows.append((len(raw), len(raw) - len(left), len(runs), hashlib.sha256(left).hexdigest()))
                if with_text:
                    kept.append(left)
            columns = [*zip(*rows)] or [()] * 4
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string())))]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.binary())] * with_text, names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text])

    texts, names = _texts(docs, id_col, text_col)
    own = written(repeats(texts, p), "repeat-runs")
    kind = docs.schema[id_col].dataType.simpleString() if names is None else "bigint"
    back = F.when(F.col("doc") == -(1 << 63), F.lit(None)).otherwise(F.col("doc")).cast(kind)
    # only texts that perhaps have a run are shuffled to meet it
    marked = perhaps(texts, "doc", written(bitmap(own.select("doc"), "doc"), "bitmap"), "_perhaps")
    sure = marked.filter(~F.col("_perhaps")).select("doc", "text", F.lit(None).cast("binary").alias("runs"))
    whole = sure.unionAll(marked.filter("_perhaps").join(own, ["doc", "mark"], "left").select("doc", "text", "runs")).select(back.alias(id_col), "text", "runs")
    out = whole.mapInArrow(cut, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text)
    if names is None:
        return out
    return out.withColumnRenamed(id_col, "n").join(names, "n", "left").select(F.col("id").alias(id_col), *out.columns[1:])
