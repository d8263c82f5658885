"""Operators over whole corpora, against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_plain import plain_components

from fathomline.llm import neardup, repeats, shards, warc


def plain_repeats(rows, length=100):
    """Windows by brute force; rows that repeat id and text are one document."""
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t, *_ in rows}):
        raw = t.encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        left = bytes(x for x, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1])), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("p", [repeats.Params(), repeats.Params(hot=3, seen=20, collection=10, ram_rows=2000), repeats.Params(sketch_bits=15)])
def test_repeats(docs, rows, none, p):
    got = repeats.deduplicate(docs, p).collect()
    want = plain_repeats(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    assert repeats.deduplicate(none, p).count() == 0


def test_collection_groups_equal_strings():
    r = random.Random(1)
    for _ in range(120):
        n = r.choice([3, 5, 8])
        spans = [bytes(r.choice(b"abc") for _ in range(r.randint(1, 25))) for _ in range(r.randint(1, 30))]
        want = defaultdict(list)
        for i, s in enumerate(spans):
            for o in range(len(s) - n + 1):
                want[s[o : o + n]].append((i, o))
        want = sorted(sorted(v) for v in want.values() if len(v) > 1)
        for ram, step in ((10**6, 1 << 18), (20, 16)):  # in memory, and in files of small parts
            repeats.Column.STEP, old = step, repeats.Column.STEP
            try:
                got = sorted(sorted(zip(x.tolist(), y.tolist())) for g, a, b in repeats.collection(spans, n, ram) for x, y in zip(np.split(a, g[1:]), np.split(b, g[1:])))
            finally:
                repeats.Column.STEP = old
            assert got == want


@pytest.mark.parametrize("p", [neardup.Params(), neardup.Params(block=2), neardup.Params(block_shingles=50)])
def test_near_duplicates(docs, rows, none, p):
    got = neardup.near_duplicates(docs, p).collect()
    assert len(got) == len(rows) and {r.doc_id: tuple(r)[1:] for r in got} == plain_components(rows)
    assert neardup.near_duplicates(none, p).count() == 0


def test_near_duplicates_of_a_hot_group(spark):
    """Copies of one text with ever more words changed: chains, and many pairs near the threshold."""
    r, base = random.Random(8), [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i * 7, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for p in (neardup.Params(), neardup.Params(block=16)):
        assert {r.doc_id: tuple(r)[1:] for r in neardup.near_duplicates(df, p).collect()} == plain_components(rows)


def test_bounds_prune_few_true_links():
    p, r = neardup.Params(), np.random.default_rng(0)
    hit = r.random((20_000, p.hashes)) < 0.86
    left = np.zeros((20_000, p.hashes), np.uint32)
    assert len(neardup.alive(left, np.where(hit, 0, 1).astype(np.uint32), p)) >= 19_999
    assert len(neardup.alive(left, np.where(r.random((20_000, p.hashes)) < 0.4, 0, 1).astype(np.uint32), p)) == 0


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {x.id: x.component for x in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got.get(i, i) == root(i) for e in edges for i in e)


@pytest.mark.parametrize("n", [1, 5, 40])
def test_shards(docs, rows, none, n):
    out = shards.shards(docs, n_shards=n)
    got = out.collect()
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and len(got) == len(rows)
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]), "bytes", None)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    assert shards.shards(none, n_shards=n).count() == 0


def test_shards_are_even_with_a_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text of a hot group").otherwise(F.repeat(F.lit("x"), (F.col("id") % 90).cast("int"))).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    sizes = [r["b"] for r in shards.shards(df, n_shards=40).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 40 and max(sizes) - min(sizes) <= 2 * 106
    assert len({r.shard for r in shards.shards(df, target_bytes=20_000).collect()}) >= 7


PAGES = "page_id bigint, url string, html string, payload_bytes string"


def test_warc_round_trip(spark, tmp_path):
    big, small = "é" * 70_000 + "end", "tiny"
    rows = [(1, "http://a/\r\nX: y", big, ""), (2, None, big, ""), (9, "http://ü/ x", big, ""), (3, "u", small, ""), (4, "u", small, ""), (5, "u", None, ""), (6, "u", "", ""), (7, "u", "WARC/1.1\r\n\r\n" + "q" * 2000, ""), (None, "u", "x", ""), (8, "u", "z" * 1000, ""), (10, "u", "z" * 1000, "")]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    got = {r.page_id: tuple(r)[1:] for r in warc.warc(df, str(tmp_path / "w")).collect()}
    refer = {1: 9, 2: 9, 8: 10}
    for i, _, h, _ in rows:
        raw = (h or "").encode()
        assert got[i] == (len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if i in refer else "response", refer.get(i))
    assert len(got) == 11
    assert warc.warc(df.limit(0)).count() == 0


def test_warc_streams(tmp_path):
    import io

    payload = "".join(chr(97 + i % 26) for i in range(200_001))
    cut = [*warc.chunks(3, payload, 1000)]
    assert b"".join(c.data for c in cut) == payload.encode() and cut[-1].last and cut[-1].digest == hashlib.sha1(payload.encode()).hexdigest()
    assert [c.chunk_no for c in cut] == list(range(201)) and all(len(c.data) <= 1000 for c in cut)
    out = io.BytesIO()
    warc.write_record(out, 3, None, "response", None, len(payload), cut[-1].digest, (c.data for c in cut))
    warc.write_record(out, 4, None, "revisit", 3, len(payload), cut[-1].digest, iter(()))
    out.seek(0)
    kinds = []
    for head, block in warc.read_records(out, 4096):
        kinds.append(head["warc-type"])
        if head["warc-type"] == "response":
            parts = [*block]
            assert max(len(c.data) for c in parts) <= 4096 and parts[-1].digest == cut[-1].digest
    assert kinds == ["response", "revisit"]
    damaged = out.getvalue()[:-200]
    with pytest.raises(Exception):
        for _, block in warc.read_records(io.BytesIO(damaged[: len(damaged) // 2])):
            for _ in block:
                pass


def test_record_table(spark):
    df = spark.createDataFrame([(1, "u", "ab" * 50, ""), (2, "u", None, "")], PAGES)
    got = warc.record_table(df, chunk_bytes=30).orderBy("record_id", "chunk_no").collect()
    assert [r.chunk_no for r in got] == [0, 1, 2, 3, 0] and got[3].digest == hashlib.sha1(b"ab" * 50).hexdigest() and got[4].last


def test_near_duplicates_of_a_cluster_of_thousands(spark):
    """5,000 different members: their star is dealt into blocks, and no task gets more than a few of them."""
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(5000)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8))
    assert out.agg({"component_id": "max"}).first()[0] == 0 and out.filter("kept").count() == 1
    pairs = spark.createDataFrame([(0, i, -(-5000 // 256)) for i in range(1, 5000)], "a bigint, b bigint, blocks bigint")
    own = spark.createDataFrame([(i, b"x") for i in range(5000)], "id bigint, value binary")
    met = neardup._met(pairs, own, "value")
    assert met.count() == 4999
    assert met.withColumn("salt", F.pmod(F.xxhash64("b"), "blocks")).groupBy("a", "salt").count().agg({"count": "max"}).first()[0] < 2 * 256


@pytest.mark.parametrize("stars", [1, 3])
def test_near_duplicates_behind_a_dull_centre(spark, stars):
    """The smallest member of each bucket is like few others, so further stars and blocks have to find the rest."""
    base = [f"b{i}" for i in range(60)]
    rows = [(0, " ".join(base[:44] + [f"z{i}" for i in range(20)]))] + [(i, " ".join([*base, f"x{i}"])) for i in range(1, 60)]
    rows += [(100 + i, " ".join(base[10:] + [f"y{j}" for j in range(10)] + [f"w{i}"])) for i in range(40)]
    p = neardup.Params(stars=stars, crowd=8, block=8, salt=4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), p).collect()}
    assert got == plain_components(rows)


def test_near_duplicates_of_string_ids(spark, rows):
    named = [(None if i is None else f"d{i:04d}", t) for i, t, *_ in rows]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(named, "doc_id string, text string")).collect()}
    assert got == plain_components(named)


def test_warc_of_hot_payloads_and_odd_ids(spark, tmp_path):
    """One payload on a third of all pages, null and string ids; a payload of many chunks; chunks of a record stay in order."""
    hot, long = "h" * 1500, "".join(chr(97 + i % 26) for i in range(300_000))
    rows = [(f"p {i:04d}/é", "u", hot if i % 3 == 0 else f"{i}" * 400 if i % 3 == 1 else long if i % 100 == 2 else "s", "") for i in range(600)] + [(None, "u", hot, ""), (None, "u", long, ""), (None, None, "n" * 2000, "")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string, payload_bytes string").repartition(4)
    top = {}
    for i, _, h, _ in rows:
        if i is not None and len(h) >= 1000:
            top[h] = max(i, top.get(h, i))
    want = sorted((i or "", len(h), hashlib.sha1(h.encode()).hexdigest(), "revisit" if top.get(h, i) != i else "response", top[h] if top.get(h, i) != i else None) for i, _, h, _ in rows)
    folder = str(tmp_path / "w")
    got = [(r.page_id or "", *r[1:]) for r in warc.warc(df, folder).collect()]
    assert sorted(got, key=lambda x: x[:3]) == sorted(want, key=lambda x: x[:3])
    table = warc.record_table(df, chunk_bytes=1000).filter(f"size = {len(long)} and refers_to is null")
    assert table.count() == 300 and {len(r.data) for r in table.select("data").collect()} == {1000}


@pytest.mark.parametrize("kind", ["null", "one", "big", "string"])
def test_shards_of_odd_ids(spark, kind):
    """Rows without an id or of one id, identical rows among them, the largest whole numbers, and strings: all even."""
    own = {"null": lambda i: None, "one": lambda i: 7, "big": lambda i: (1 << 63) - 1 - i if i % 2 else i - (1 << 63), "string": lambda i: f"d{i}"}[kind]
    rows = [(own(i), f"text {i % 200}" if i % 3 else "the same") for i in range(1200)]
    out = shards.shards(spark.createDataFrame(rows, f"doc_id {'string' if kind == 'string' else 'bigint'}, text string").repartition(3), n_shards=5).collect()
    load = defaultdict(int)
    slots = defaultdict(list)
    for r in out:
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(out) == 1200 and sorted(load) == [0, 1, 2, 3, 4] and max(load.values()) - min(load.values()) <= 4 * 30
    assert all(sorted(x) == [*range(len(x))] for x in slots.values())


def test_shards_cut_like_a_plain_tree(spark):
    """The same recursion in plain Python: widest dimension, then the prefix of the sorted rows nearest to the target."""
    r = random.Random(11)
    rows = [(i, "x" * r.choice([3, 3, 50, 400, r.randint(1, 2000)]), r.choice("ab"), r.choice(["s", "t", "u"])) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").coalesce(1)
    code = lambda x: zlib.crc32(x.encode()) % 65_536
    points = [(i, {"size": len(t) + 16, "lang_code": code(a), "source_code": code(b), "arrival": i >> 16, "arrival_low": i & 65_535, "serial": n}) for n, (i, t, a, b) in enumerate(rows)]
    spread = {d: max(1, max(p[d] for _, p in points) - min(p[d] for _, p in points)) for d in shards.DIMENSIONS}
    want = {}

    def split(own, first, leaves):
        if leaves == 1:
            want.update((i, first) for i, _ in own)
            return
        width = lambda d: (max(p[d] for _, p in own) - min(p[d] for _, p in own)) / spread[d]
        dim = max(shards.DIMENSIONS, key=lambda d: (width(d), -shards.DIMENSIONS.index(d)))
        own = sorted(own, key=lambda x: (x[1][dim], *(x[1][k] for k in shards.TIES)))
        target, total, at = sum(p["size"] for _, p in own) * (leaves // 2) // leaves, 0, 0
        while total + own[at][1]["size"] < target:
            total += own[at][1]["size"]
            at += 1
        at += total + own[at][1]["size"] - target <= target - total
        split(own[:at], first, leaves // 2)
        split(own[at:], first + leaves // 2, leaves - leaves // 2)

    split(points, 0, 7)
    assert {r.doc_id: r.shard for r in shards.shards(docs, n_shards=7).collect()} == want


def test_repeats_of_string_ids(spark, rows):
    named = [(f"d{i:04d}", t) for i, t, *_ in rows]
    got = {r.doc_id: tuple(r)[1:] for r in repeats.deduplicate(spark.createDataFrame(named, "doc_id string, text string").repartition(3)).collect()}
    assert got == plain_repeats(named)
