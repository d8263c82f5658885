"""Near-duplicates: MinHash bands, sequential Bayesian verification, exact confirmation, connected components.

1. One scan gives each text its set size, a fingerprint of its shingle set and a signature.  Equal sets become one
   class, represented by its smallest id: a group of copies costs one row from here on.
2. Each band of a signature puts a class into a bucket.  Members are first compared with one class of their bucket (a
   star), that which meets most others in all its buckets: copies of one text are nearer to it than to each other, and
   it meets them most often.  So most groups are joined at once; candidates grow with members, not with their square.
3. A candidate's signatures are compared batch by batch.  As soon as the posterior probability that its similarity
   reaches the threshold falls below `miss`, it is pruned.  Survivors are confirmed on full shingle sets.  The centre
   of a star meets its members in blocks of `salt`, each with its own copy of the centre, so no task gets a whole star.
4. Components of the links so far.  While a bucket with members of different components has more than `crowd` of them,
   further stars are drawn, each with another centre.  What is then still open is compared across components, in blocks
   of bounded size: pruned by batches and confirmed on full sets within the task, each pair in the first band that it
   shares, so only links leave a task, never a group's pairs.
   After that every candidate pair is linked, refuted, or within one component already, so components are whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import arrow_kind, bitmap, dropped, fresh, id_kind, perhaps, small_batches, written

_P = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hashes, and documents whose sets, a worker remembers.
_WORDS, _SEEN = 200_000, 50_000


@dataclass(frozen=True)
class Params:
    """words a shingle; links have 100 * intersection >= percent * union; bands x rows hashes; a pair is pruned when its
    posterior falls below miss, looked at after each batch of hashes; a star's members meet its centre in blocks of salt;
    block and block_shingles bound the classes, and the shingles of their sets, that a task holds of either side of a
    block; while a bucket has more than crowd members of several components, another star is drawn, up to stars of them,
    before the blocks decide what is open."""

    words: int = 5
    percent: int = 85
    bands: int = 32
    rows: int = 6
    batch: int = 24
    miss: float = 1e-7
    salt: int = 256
    stars: int = 3
    crowd: int = 4096
    block: int = 512
    block_shingles: int = 2_000_000

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=4)
def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and summands of n hash functions, from a fixed seed."""
    r = np.random.default_rng(20_240_501)
    return r.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, n, dtype=np.uint64)


_word_hash: dict[bytes, int] = {}


def shingles(text: str, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    found = text.encode().lower().split()  # lower() of bytes changes A-Z only
    if not found:
        return np.zeros(0, np.uint64)
    if len(_word_hash) > _WORDS:
        _word_hash.clear()
    get, digest = _word_hash.get, xxhash.xxh3_64_intdigest
    hashed = []
    for w in found:
        h = get(w)
        if h is None:
            h = digest(w)
            if len(w) <= 64:
                _word_hash[w] = h
        hashed.append(h)
    h = np.array(hashed, np.uint64)
    n = max(1, len(h) - words + 1)
    size = min(words, len(h))
    with np.errstate(over="ignore"):
        out = np.full(n, size, np.uint64)
        for j in range(size):
            out = out * _P + h[j : j + n]
            out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(sets: np.ndarray, n: int) -> np.ndarray:
    """n minima as 32-bit numbers; blocks bound the memory for long texts."""
    a, b = _coefficients(n)
    best = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(sets), 2048):
            part = sets[at : at + 2048]
            np.minimum(best, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=8)
def least_matches(p: Params) -> tuple[tuple[int, int], ...]:
    """(hashes compared, fewest matches with which a pair lives on), for each batch.

    With a uniform prior, the similarity after m of n matches follows Beta(m + 1, n - m + 1); the probability that it
    is t or more equals that of m or fewer successes in n + 1 trials of chance t.
    """
    t, out = p.percent / 100, []
    for n in range(p.batch, p.hashes + 1, p.batch):
        below, least = 0.0, 0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= p.miss:
                least = m
                break
        out.append((n, least))
    return tuple(out)


def alive(left: np.ndarray, right: np.ndarray, p: Params) -> np.ndarray:
    """Indices of the pairs (rows of two signature arrays) that no batch prunes."""
    index = np.arange(len(left))
    matches = np.zeros(len(left), np.int32)
    at = 0
    for n, least in least_matches(p):
        matches += (left[index, at:n] == right[index, at:n]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        index, matches, at = index[keep], matches[keep], n
    return index


def signatures(docs: DataFrame, p: Params, *, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, set_key, signature); key and signature are null for empty sets."""
    kind = id_kind(docs, id_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, signs = [], [], []
            for text in batch.column(1):
                sets = shingles(text.as_py() or "", p.words)
                n.append(len(sets))
                keys.append(xxhash.xxh3_128_digest(sets.tobytes()) if len(sets) else None)
                signs.append(signature(sets, p.hashes).tobytes() if len(sets) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())], names=["id", "n_shingles", "set_key", "signature"])

    return small_batches(docs).select(F.col(id_col).cast(kind).alias("id"), text_col).mapInArrow(rows, f"id {kind}, n_shingles bigint, set_key binary, signature binary")


def banded(classes: DataFrame, p: Params) -> DataFrame:
    """(rep, n_shingles, band, bucket): each class in one bucket a band.  Bucket hashes include the band's number."""
    width = 4 * p.rows
    buckets = F.transform(F.sequence(F.lit(0), F.lit(p.bands - 1)), lambda i: F.xxhash64(F.substring("signature", i * width + 1, F.lit(width)), i))
    return classes.select("rep", "n_shingles", F.posexplode(buckets).alias("band", "bucket"))


def _met(pairs: DataFrame, own: DataFrame, value: str) -> DataFrame:
    """(a, b, x, y): pairs (a, b, blocks) with the value of either side.

    own has one row an id.  b comes first: it stands in a pair a band at most.  a may be the centre of a third of all
    pairs, so its value is sent once to each block of them, and joined there; only then do both values stand in a row.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int"))
    right = salted.join(own.select(F.col("id").alias("b"), F.col(value).alias("y")), "b")
    left = salted.select("a", "blocks", "salt").distinct().join(own.select(F.col("id").alias("a"), F.col(value).alias("x")), "a")
    return right.join(left, ["a", "blocks", "salt"]).select("a", "b", "x", "y", "blocks")


def _pruned(pairs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """Pairs (a, b, blocks) that survive the comparison of signature batches."""
    kind = id_kind(pairs, "a")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, p.hashes) for i in (2, 3))
            keep = pa.array(alive(left, right, p))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(keep) for i in (0, 1, 4)], names=["a", "b", "blocks"])

    own = classes.select(F.col("rep").alias("id"), "signature")
    return _met(pairs, own, "signature").mapInArrow(rows, f"a {kind}, b {kind}, blocks bigint")


def linked(x: np.ndarray, y: np.ndarray, p: Params) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(x), len(y)) < p.percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= p.percent * (len(both) - common)


def _sets(ids: DataFrame, docs: DataFrame, p: Params, *, id_col: str, text_col: str) -> DataFrame:
    """(id, sets) of the documents in ids, made anew from their texts, and of few others that a bitmap lets pass.
    Texts aren't shuffled.  Of rows that repeat an id and its set, a task passes on one."""
    kind = id_kind(docs, id_col)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            at, made = [], []
            for i, (own, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                x = shingles(text.as_py() or "", p.words).tobytes()
                key = (own, xxhash.xxh3_128_digest(x))
                if key not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(key)
                    at.append(i)
                    made.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(made, pa.binary())], names=["id", "sets"])

    texts = small_batches(docs).select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).alias("text"))
    lines = written(bitmap(ids, "id"), "bitmap")
    made = written(perhaps(texts, "id", lines, "perhaps").filter("perhaps").select("id", "text").mapInArrow(sets, f"id {kind}, sets binary"), "near-sets")
    dropped(lines)
    return made


def _confirmed(pairs: DataFrame, docs: DataFrame, p: Params, *, id_col: str, text_col: str) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    kind = id_kind(pairs, "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column(i)] for i in (2, 3)]
            index = pa.array([i for i, (x, y) in enumerate(zip(*sides)) if linked(x, y, p)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index)], names=["a", "b"])

    own = _sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, p, id_col=id_col, text_col=text_col)
    out = written(_met(pairs, own, "sets").mapInArrow(check, f"a {kind}, b {kind}"), "near-links")
    dropped(own)
    return out


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that links reach, for each id in a link.

    Large-star and small-star rounds in turn, until a round changes nothing: each keeps components as they are and
    halves depths, so the rounds grow with the logarithm of the longest path.  Each round is a table in the shared
    folder.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    before, last = None, None
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: each larger neighbour points to the smallest of the neighbourhood
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: each smaller neighbour, and the node itself, points to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        last, edges = (edges if before is not None else None), written(small, "near-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if last is not None:
            dropped(last)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _open(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(bucket, band, rep, component, members, total) of the buckets whose classes are in different components."""
    own = shared.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("bucket", "band", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"))
    mixed = own.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("total"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return written(own.join(mixed.select("bucket", "members", "total"), "bucket"), "near-open")


def _stars(placed: DataFrame, turn: int, salt: int) -> DataFrame:
    """(a, b, blocks): the members of each bucket with one of them, which another turn draws anew, if they are in
    different components."""
    centres = placed.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("h"), "rep", "component")).alias("c"))
    pairs = placed.join(centres, "bucket").filter("component <> c.component").select(F.col("c.rep").alias("a"), F.col("rep").alias("b"), F.ceil(F.col("members") / salt).alias("blocks"))
    return pairs.groupBy("a", "b").agg(F.max("blocks").alias("blocks"))


def _across(members: DataFrame, p: Params) -> DataFrame:
    """Links (a, b) between classes of different components in one bucket.

    A bucket of more than p.block members, or p.block_shingles shingles, is dealt into blocks; each two blocks meet
    in a task of their own.
    """
    kind = id_kind(members, "rep")
    arrow = arrow_kind(kind)

    def rows(keys: tuple, table: pa.Table) -> pa.Table:
        ids, comp = (np.array(table.column(c).to_pylist()) for c in ("rep", "component"))
        block = table.column("block").to_numpy()
        signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, p.hashes)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("sets")]
        sizes = np.array([len(x) for x in sets])
        low, high, band = keys[1].as_py(), keys[2].as_py(), table.column("band")[0].as_py()
        two = np.flatnonzero(block == high)
        a, b = [], []
        for i in np.flatnonzero(block == low):
            other = two[(comp[two] != comp[i]) & (100 * np.minimum(sizes[two], sizes[i]) >= p.percent * np.maximum(sizes[two], sizes[i]))]
            if low == high:
                other = other[ids[other] > ids[i]]
            if len(other):
                other = other[alive(np.broadcast_to(signs[i], (len(other), p.hashes)), signs[other], p)]
                before = (signs[other, : band * p.rows] == signs[i, : band * p.rows]).reshape(len(other), band, p.rows).all(axis=2).any(axis=1)
                found = [j for j in other[~before] if linked(sets[i], sets[j], p)]
                a += [ids[i].item()] * len(found)
                b += ids[found].tolist()
        return pa.table({"a": pa.array(a, arrow), "b": pa.array(b, arrow)})

    blocks = F.greatest(F.ceil(F.col("members") / p.block), F.ceil(F.col("total") / p.block_shingles)).cast("int")
    own = members.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "rep", "component", "block", "band", "signature", "sets")
    return dealt.groupBy("bucket", "low", "high").applyInArrow(rows, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, p: Params = Params(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of docs.

    Words are what ASCII blanks separate, A-Z lower-cased.  A text of fewer words than a shingle has its whole
    sequence as its one shingle.  A null text, and one without words, has an empty set and is linked with nothing:
    its component is its own id.  kept is true for the smallest id of a component.  Rows with one id count as one
    document when linked and each get a row.  Ids may be whole numbers or, say, strings.  A row without an id gets the
    component of an equal text that has one, and otherwise none; it counts as kept if it has no component.  An empty
    table gives an empty result; other columns aren't read.  The result reads two tables of some forty bytes a
    document in the shared folder; all others are deleted before it is returned.
    """
    kind = id_kind(docs, id_col)
    signed = written(signatures(docs, p, id_col=id_col, text_col=text_col), "near-signatures")
    grouped = signed.filter("set_key is not null").groupBy("set_key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n_shingles", "signature")).alias("m"))
    classes = written(grouped.select("set_key", F.col("m.id").alias("rep"), F.col("m.n_shingles").alias("n_shingles"), F.col("m.signature").alias("signature")).filter("rep is not null"), "near-classes")
    members = written(signed.select("id", "n_shingles", "set_key"), "near-members")
    dropped(signed)

    placed = banded(classes, p)
    full = placed.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    met = written(placed.join(full, "bucket"), "near-met")
    shared = written(met.join(met.groupBy("rep").agg(F.sum("members").alias("degree")), "rep"), "near-shared")
    centres = shared.groupBy("bucket").agg(F.min(F.struct((-F.col("degree")).alias("d"), "rep"))["rep"].alias("centre"))
    star = shared.join(centres, "bucket").filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b"), F.ceil(F.col("members") / p.salt).alias("blocks")).groupBy("a", "b").agg(F.max("blocks").alias("blocks"))
    dropped_later, links, found = [shared], None, None
    dropped(met)
    shared = shared.drop("members", "degree")
    for turn in range(p.stars):
        star = written(star, "near-star")
        pairs = written(_pruned(star, classes, p), "near-pairs")
        new = _confirmed(pairs, docs, p, id_col=id_col, text_col=text_col)
        old = found
        links = new if old is None else old.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(new)
        rounds = components(links)
        found = written(rounds, "near-components")
        dropped(star, pairs, new, rounds, *([old] if old is not None else []))
        rest = _open(shared, found)
        if (rest.agg(F.max("members")).first()[0] or 0) <= p.crowd or turn == p.stars - 1:
            break
        star = _stars(rest, turn, p.salt)
        dropped_later.append(rest)

    sets = _sets(rest.select(F.col("rep").alias("id")).distinct(), docs, p, id_col=id_col, text_col=text_col)
    dealt = rest.join(classes.select("rep", "signature"), "rep").join(sets.withColumnRenamed("id", "rep"), "rep")
    late = written(_across(dealt, p), "near-links")

    joined = found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(late)
    whole = components(joined)
    by_set = written(classes.select("set_key", "rep").join(whole.withColumnRenamed("id", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id")), "near-sets")
    dropped(*dropped_later, found, rest, sets, late, whole, classes)
    # empty sets would all meet in one task of the join
    empty = members.filter("set_key is null").select("id", "n_shingles", F.lit(None).cast(kind).alias("component_id"))
    some = members.filter("set_key is not null").join(by_set, "set_key", "left").select("id", "n_shingles", "component_id")
    out = some.unionAll(empty).select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).cast(kind).eqNullSafe(F.col("component_id")))
