"""Byte-level BPE encoding and decoding with a published vocabulary file."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fathomline.llm.common import small_batches

#: Fixed value: the pre-tokenisation pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words of more parts than this are merged with a heap; below, scanning an array is faster.
SHORT = 48
#: Words kept with their ids by each worker, and the longest word that is kept.
CACHE_WORDS, CACHE_CHARS = 300_000, 64

_NONE, _ID = 1 << 62, (1 << 32) - 1


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in such vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes for U+0100 onwards in order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """One vocabulary.  Ids and merges come from the file; nothing is trained."""

    def __init__(self, path: str, content: bytes | None = None):
        """From a file, or from its content where that is at hand."""
        if content is None:
            content = read(path)
        spec = json.loads(content)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()}
        self.byte_id = [0] * 256
        for char, b in alphabet.items():
            self.byte_id[b] = vocab[char]
        #: (left id, right id) -> rank and merged id in one number
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((vocab[left], vocab[right]), rank << 32 | vocab[left + right])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self._name_of = [str(i) for i in range(max(self.bytes_of) + 1)]
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._words = regex.compile(PATTERN)
        self._cache: dict[str, tuple[int, ...]] = {}

    def merged(self, ids: list[int]) -> list[int]:
        return self._scan(ids) if len(ids) <= SHORT else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        """The contiguous rank array: parts, and beside them the rank of each adjacent pair.

        The smallest rank (leftmost of equals) is looked up again and again, its boundary deleted and
        the two ranks beside it refreshed.
        """
        get = self.merges.get
        ranks = [get(pair, _NONE) for pair in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            i = ranks.index(low)
            ids[i] = low & _ID
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), _NONE)
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), _NONE)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        """The same merges for long words: O(n log n), so a text without blanks doesn't stall."""
        n, get = len(ids), self.merges.get
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(hit, i, ids[i], ids[i + 1]) for i in range(n - 1) if (hit := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            low, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], alive[j], after[i] = low & _ID, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (hit := get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (hit, a, ids[a], ids[b]))
        return [x for x, keep in zip(ids, alive) if keep]

    def word(self, word: str) -> tuple[int, ...]:
        byte_id = self.byte_id
        return tuple(self.merged([byte_id[b] for b in word.encode()]))

    def _plain(self, text: str) -> list[int]:
        """Ids of a text without special tokens; each distinct word is merged once and kept for later texts."""
        words, cache = self._words.findall(text), self._cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        new = {w for w in words if w not in cache}
        for w in new:
            cache[w] = self.word(w)
        ids = list(chain.from_iterable(map(cache.__getitem__, words)))
        for w in new:
            if len(w) > CACHE_CHARS:
                del cache[w]
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text.  The string of a special token in it becomes that token."""
        if self._special is None or not (found := list(self._special.finditer(text))):
            return self._plain(text)
        out, at = [], 0
        for m in found:
            out += self._plain(text[at : m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self._plain(text[at:])

    def joined(self, ids: Iterable[int]) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self._name_of.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_loaded: dict[str, Bpe] = {}


def load(path: str, content: bytes | None = None) -> Bpe:
    """One copy for each worker and file."""
    content = read(path) if content is None else content
    key = hashlib.sha256(content).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(path, content)
    return _loaded[key]


def bpe(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """Encodes every whole text and decodes it again: (id, n_tokens, ids_sha256, decoded_sha256[, ids][, decoded]).

    The digests are of the decimal ids joined by commas, and of the decoded text in UTF-8.  A null text counts as
    empty: no token, an empty decoded text.  Repeated rows give repeated rows, an empty table an empty one; columns
    other than the two named aren't read.  A row depends on its own text only: no shuffle.  The driver reads the file
    and sends it to the workers, who need not see its path; it is a vocabulary of some MB.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read(path))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, shared.value)
        for batch in batches:
            n, first, second, all_ids, texts = [], [], [], [], []
            for text in batch.column(1):
                ids = model.encode(text.as_py() or "")
                decoded = model.decode(ids)
                n.append(len(ids))
                first.append(hashlib.sha256(model.joined(ids).encode()).hexdigest())
                second.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids)
                if with_text:
                    texts.append(decoded)
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
            arrays += [pa.array(all_ids, pa.list_(pa.int32()))] * with_ids + [pa.array(texts, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids, *["decoded"] * with_text])

    df = small_batches(docs).select(id_col, text_col)
    kind = df.schema[0].dataType.simpleString()
    return df.mapInArrow(rows, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded string" * with_text)
