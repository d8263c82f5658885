"""Operators that work document by document, against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.llm import bpe, decontaminate, language, licenses, pii, quality
from fathomline.llm.queries import vocabulary

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def by_id(df, *drop):
    return {r["doc_id"]: tuple(v for k, v in r.asDict().items() if k not in ("doc_id", *drop)) for r in df.collect()}


def plain_spans(t):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            odd = [int(x) for x in d[::-1]]
            luhn = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(odd)) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_pii_matches_plain_patterns():
    r = random.Random(2)
    parts = ["1", "4", "25", "0.", "..", "@", "a", "b.c", " ", "-", "+", "(", ")", "1.2.3.4", "x@y.z", "4111 1111 1111 1111", "é", "０"]
    for _ in range(5000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert pii.detect(t) == plain_spans(t)
        plain, spans = pii.find(t)
        assert set(plain) <= set(spans)


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("mail john.doe (at) example (dot) com now", "email", "john.doe (at) example (dot) com"),
        ("write john at mail dot example dot com please", "email", "john at mail dot example dot com"),
        ("call plus one five five five two three four five six seven eight now", "phone", "plus one five five five two three four five six seven eight"),
        ("jоhn@exаmple.com ok", "email", "jоhn@exаmple.com"),
        ("card ４１１１ １１１１ １１１１ １１１１ ok", "card", "４１１１ １１１１ １１１１ １１１１"),
    ],
)
def test_pii_disguises(text, kind, found):
    _, spans = pii.find(text)
    assert [(k, text[a:b]) for k, a, b in spans] == [(kind, found)]
    assert pii.masked(text, spans) == text.replace(found, f"[{kind.upper()}]")


def test_pii_disguise_around_a_plain_span():
    t = "jo​hn@example.com"
    plain, spans = pii.find(t)
    assert plain == [("email", 3, 17)] and spans == [("email", 0, 17), ("email", 3, 17)] and pii.masked(t, spans) == "[EMAIL]"


def test_pii_leaves_clean_text():
    assert pii.find("We met at the station. Two or three of us saw one dot on the map; at last we left.")[1] == []


def test_pii_table(docs, rows, none):
    got = by_id(pii.pii(docs))
    for i, t, *_ in rows:
        spans = plain_spans(t or "")
        assert got[i][4] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    assert pii.pii(docs).count() == len(rows) and pii.pii(none).count() == 0
    assert pii.masked_documents(docs).columns == docs.columns


def test_bpe_matches_library(docs, rows, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    model = bpe.load(vocabulary())
    r = random.Random(5)
    texts = [x or "" for _, x, *_ in rows] + ["a<|endoftext|>b", " <|endoftext|> ", "x" * 3000, " " * 99 + "a", "'s'S don't", "ab" * 900, "\x00\x01\x1c\x85\xa0", "🙂é" * 40]
    texts += ["".join(chr(r.choice([r.randrange(1, 128), r.randrange(128, 0x3000), r.randrange(0x10000, 0x11000)])) for _ in range(60)) for _ in range(200)]
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        assert model.encode(x) == ids
        assert model.decode(ids) == t.decode(ids, skip_special_tokens=False)
    got = by_id(bpe.bpe(docs, vocabulary()))
    for i, x, *_ in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest(), ids, x or "")
    assert bpe.bpe(none, vocabulary()).count() == 0


def test_bpe_scan_and_heap_agree():
    m, r = bpe.load(vocabulary()), random.Random(3)
    for _ in range(300):
        ids = [m.byte_id[b] for b in bytes(r.choice(b"abcdeinst") for _ in range(r.randint(1, 60)))]
        assert m._scan(ids.copy()) == m._heap(ids.copy())


def plain_quality(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    in_repeat = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(in_repeat)


def test_quality_counts(docs, rows, none, labels):
    got = by_id(quality.quality(docs, labels))
    for i, t, *_ in rows:
        want = plain_quality(t or "")
        assert got[i][:5] == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i][5] == failed and not (failed and got[i][6])
    assert quality.quality(none, labels).count() == 0
    assert quality.quality(docs, labels.limit(0)).count() == len(rows)
    kept = quality.kept_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, x in got.items() if x[6]}


def test_crf_learns_and_decodes():
    import itertools

    import numpy as np

    junk, good = ["WORD!! WORD!! WORD!!", "a*** b%%% c$$$ d###"], ["The quick brown fox jumps over the lazy dog again.", "It was a calm and quiet evening by the river side."]
    samples = [(quality.line_features(junk), 1), (quality.line_features(good), 0)] * 10
    crf = quality.fitted(samples, 60, 1.0)
    assert crf.viterbi(quality.line_features(junk)).tolist() == [1, 1] and crf.viterbi(quality.line_features(good)).tolist() == [0, 0]
    r = np.random.default_rng(1)
    for _ in range(50):
        c = quality.Crf(r.normal(size=(4, 2)), r.normal(size=(2, 2)))
        f = r.normal(size=(5, 4))
        e = f @ c.emit
        best = max(itertools.product((0, 1), repeat=5), key=lambda y: sum(e[t, y[t]] for t in range(5)) + sum(c.move[a, b] for a, b in zip(y, y[1:])))
        assert tuple(c.viterbi(f)) == best


def test_language_contract(docs, rows, none):
    got = by_id(language.language(docs))
    for i, t, *_ in rows:
        held, pred, score = got[i]
        assert held == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= score <= 1
        assert pred in ("en", "de", "und") and (pred == "und") == (not re.search(r"[^\W\d_]", t or ""))
    assert language.language(none).count() == 0
    assert {r.lang_pred for r in language.language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_held_out_accuracy_and_spans(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    both = language.language(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in both) >= 0.95 * len(both)
    m = language.fit(d)
    by = {r.lang: r.text[:300] for r in d.select("lang", "text").collect() if len(r.text) > 400}
    found = m.spans(by["en"] + " " + by["fr"] + " " + by["en"])
    assert [s[2] for s in found] == ["en", "fr", "en"] and abs(found[1][0] - 301) < 25
    import numpy as np

    r = np.random.default_rng(1)
    for _ in range(40):  # the shortcut agrees with the table
        s = r.normal(size=(12, 3)) * r.choice([1, 8])
        a, b = m.path(s), m.viterbi(s)
        cost = lambda y, s=s: s[np.arange(len(y)), y].sum() - m.penalty * (np.diff(y) != 0).sum()
        assert abs(cost(a) - cost(b)) < 1e-9


def edit_in(p, t):
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p, 1):
            new.append(min(row[i - 1] + (x != c), row[i] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_decontaminate_finds_every_match_within_budget(spark):
    r = random.Random(4)
    items = [(i, "".join(r.choice("abcd ") for _ in range(60)).strip() + "x" * 10) for i in range(6)] + [(90, None), (91, "short"), (0, None)]
    m = decontaminate.Matcher([x for x in items if x[1]], 10, 40)
    for _ in range(150):
        t = list(r.choice(items[:6])[1])
        for _ in range(r.randint(0, 9)):
            at = r.randrange(len(t))
            t[at : at + 1] = r.choice([[], ["z"], [t[at], "q"]])
        t = "".join(r.choice("abcd ") for _ in range(30)) + " " + "".join(t) + " " + "".join(r.choice("abcd ") for _ in range(30))
        norm = decontaminate.normalised(t)
        want = []
        for i, x in items[:6]:
            n = decontaminate.normalised(x)
            if (d := edit_in(n, norm)) <= decontaminate.budget(len(n), 10):
                want.append((i, d))
        assert m.match(t) == want


def test_decontaminate_table(spark, docs, none, rows):
    b = spark.createDataFrame([(1, rows[8][1][100:400]), (2, rows[8][1][100:400].upper()), (3, None), (4, ""), (5, "zz " * 40)], "item_id bigint, text string")
    got = by_id(decontaminate.contaminated(docs, b))
    assert got == {8: ("1,2", 2, 0)}
    assert by_id(decontaminate.contaminated(docs, b, block_items=1)) == got
    assert decontaminate.contaminated(docs, b.limit(0)).count() == 0 and decontaminate.contaminated(none, b).count() == 0
    kept = decontaminate.clean_documents(docs, b)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2


def test_licenses(spark, docs, rows, none):
    mit = licenses.SENTENCES
    texts = [
        (1, "Code.\nReleased under the MIT license!  More text."), (2, f"{mit['mit-grant']}\n\n{mit['mit-notice']}\n\n{mit['mit-warranty']}"), (3, f"{mit['bsd-grant']} {mit['bsd-source']} {mit['bsd-binary']} {mit['bsd-names']}"),
        (4, f"{mit['bsd-binary']} {mit['bsd-grant']} {mit['bsd-source']}"), (5, None), (6, ""), (7, "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY 4.0."), (8, "A license is a document. All rights reserved."),
    ]
    got = by_id(licenses.licenses(spark.createDataFrame(texts, "doc_id int, text string")))
    assert {i: x[3] for i, x in got.items()} == {1: "MIT", 2: "MIT", 3: "BSD-3-Clause", 4: "", 5: "", 6: "", 7: "Apache-2.0,CC-BY-4.0", 8: "all-rights-reserved"}
    assert licenses.licenses(docs).count() == len(rows) and licenses.licenses(none).count() == 0
    assert "Python" not in licenses.licenses(docs)._jdf.queryExecution().toString()


def test_licenses_every_rule_on_its_own_wording(spark):
    texts = [(i, "Some code.\n" + "\n".join(licenses.SENTENCES[x] for x in sequence) + "\nMore code.") for i, (_, sequence) in enumerate(licenses.RULES)]
    got = by_id(licenses.licenses(spark.createDataFrame(texts, "doc_id int, text string")))
    for i, (name, sequence) in enumerate(licenses.RULES):
        assert got[i][1] == ",".join(sequence) and got[i][3] == name, sequence


def test_licenses_wrapped_texts(spark):
    import textwrap

    wholes = {"Apache-2.0": ("apache-header", "apache-copy", "apache-warranty"), "MIT": ("mit-grant", "mit-notice", "mit-warranty"), "BSD-3-Clause": ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), "ISC": ("isc-grant",), "GPL-3.0-or-later": ("gpl-free", "gpl-warranty"), "Unlicense": ("unlicense",)}
    texts, want = [], {}
    for name, sequence in wholes.items():
        for width in (30, 76):
            for prefix in ("", " * ", "# ", "// "):
                lines = [prefix + x for s in sequence for x in [*textwrap.wrap(licenses.SENTENCES[s], width, break_long_words=False), ""]]
                want[len(texts)] = (",".join(sequence), name)
                texts.append((len(texts), "\r\n".join(lines) if width == 30 else "\n".join(lines)))
    got = by_id(licenses.licenses(spark.createDataFrame([*texts, (1000, "released into the public\ndomain"), (1001, "All rights\nreserved for us.")], "doc_id int, text string")))
    for i, (ids, name) in want.items():
        assert got[i][1] == ids and got[i][3] == name, texts[i]
    assert got[1000][2] == got[1001][2] == 0


def test_pii_prefilter_changes_nothing(monkeypatch):
    t = "Write to jane.doe at example.com today"
    assert pii.masked(t, pii.find(t)[1]) == "Write to [EMAIL] today"
    r = random.Random(6)
    parts = ["jane", "doe", "example", "com", "at", "arroba", "dot", "punkt", "(at)", "[dot]", "@", ".", " ", " ", " ", "-", ", ", "plus", "one", "un", "deux", "null", "onedot", "twelve", "١"]
    texts = [t, "un un un deux", "onedot twodot threedot four", "plus-" + "one-" * 11 + "one", "a arroba b.co"] + ["".join(r.choice(parts) for _ in range(r.randint(1, 25))) for _ in range(5000)]
    texts += [" ".join(r.choice(["un", "one", "two", "null", "dot", "acht"]) for _ in range(14)) for _ in range(500)]
    got = [pii.find(x) for x in texts]
    monkeypatch.setattr(pii, "_HINTS", re.compile(""))
    assert got == [pii.find(x) for x in texts]


def test_decontaminate_short_items(spark):
    b = spark.createDataFrame([(1, "What is Ångström?"), (2, "42"), (3, "..."), (4, "cat"), (5, "CAT!")], "item_id bigint, text string")
    texts = ["He asked: what is -- ångström", "what is ångströms", "It is 42.", "It is 421 or 142", "concatenate the cat", "catalogue", "what is angström", None, "", "cat"]
    d = spark.createDataFrame([*enumerate(texts)], "doc_id int, text string")
    assert by_id(decontaminate.contaminated(d, b)) == {0: ("1", 1, 0), 2: ("2", 1, 0), 4: ("4,5", 2, 0), 9: ("4,5", 2, 0)}
    assert {r.doc_id for r in decontaminate.clean_documents(d, b).collect()} == {1, 3, 5, 6, 7, 8}


def test_licenses_count_a_sentence_once(spark):
    """Written by hand: texts and the licences that a reader would name."""
    own = licenses.SENTENCES
    mit = " ".join(own[x] for x in ("mit-grant", "mit-notice", "mit-warranty"))
    bsd2 = " ".join(own[x] for x in ("bsd-grant", "bsd-source", "bsd-binary"))
    texts = [(1, f"{mit}\n\n{mit}", "MIT"), (2, f"{bsd2} {own['bsd-names']}\n{bsd2}", "BSD-3-Clause,BSD-2-Clause"), (3, f"{bsd2}\n{own['bsd-short']}", "BSD-3-Clause,BSD-2-Clause"), (4, f"{own['mit-notice']} {own['bsd-names']}", ""), (5, own["apache-copy"], "")]
    got = by_id(licenses.licenses(spark.createDataFrame(texts, "doc_id int, text string, want string")))
    assert {i: x[3] for i, x in got.items()} == {i: want for i, _, want in texts}
    with pytest.raises(ValueError):
        licenses.Rules(rules=(("A", ("mit-title",)), ("B", ("mit-title", "reserved"))))
    with pytest.raises(ValueError):
        licenses.Rules(rules=(("A", ("unheard-of",)),))
    plain = licenses.Rules((("hello", "Hello there, you may copy this."),), (("Hello", ("hello",)),))
    assert [r.licenses for r in licenses.licenses(spark.createDataFrame([(1, "Well.\nHello there,\nyou may copy this. Bye.")], "doc_id int, text string"), plain).collect()] == ["Hello"]


def test_licenses_sql_on_wrapped_texts(spark):
    import textwrap

    import duckdb
    import pandas as pd

    rows = [(i, "Some text. " + "\n".join(textwrap.wrap(text, 40)) + "\n\nOther text; here.") for i, (_, text) in enumerate(licenses.Rules().sentences)] + [(900, None), (901, "")]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = {r[0]: (r[1], r[2], r[3], r[4]) for r in con.execute(licenses.oracle_sql()).fetchall()}
    got = {r.doc_id: tuple(r)[1:] for r in licenses.licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got == want and all(got[i][2] == 1 for i in range(len(rows) - 2))


def test_pii_time_grows_with_the_text():
    import time

    def took(n):
        text = " ".join(f"user{i}@example{i}.org" for i in range(n)) + " and jane (at) example dot com" + " a dot b" * n
        began = time.perf_counter()
        assert len(pii.find(text)[1]) >= n + 1
        return time.perf_counter() - began

    took(500)
    assert took(16_000) < 12 * took(4_000) + 0.2


def test_decontaminate_blocks_and_odd_ids(spark):
    """Near copies, several blocks of items in one pass, string ids, a batch without a match, repeated ids."""
    r = random.Random(3)
    items = [(f"i{i}", " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(14))) for i in range(9)] + [(None, "an item of its own that has no id but has a text of some length"), ("x", None)]

    def edited(t, n):
        t = list(t)
        for at in sorted(r.sample(range(len(t)), n), reverse=True):
            t[at : at + 1] = r.choice((["q"], [], [t[at], "q"]))
        return "".join(t)

    texts = [(f"d{i}", f"before {edited(t, 3)} after") for i, (_, t) in enumerate(items[:9])] + [("far", edited(items[0][1], 14)), ("none", "nothing here"), (None, items[1][1]), ("null", None), ("own", items[9][1])]
    docs = spark.createDataFrame(texts, "doc_id string, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = sorted((i or "", m) for i, t in texts for m in [[(x or "", d) for x, d in decontaminate.Matcher([(a, b) for a, b in items if b], 5, 40).match(t or "")]] if m)
    for size in (5000, 2):
        got: dict = {}
        for row in decontaminate.matches(docs, bench, block_items=size).collect():
            got.setdefault(row.doc_id or "", []).append((row.item_id or "", row.distance))
        assert sorted((i, sorted(m)) for i, m in got.items()) == [(i, sorted(m)) for i, m in want]
        assert {x.doc_id for x in decontaminate.clean_documents(docs, bench, block_items=size).collect()} == {"far", "none", "null"}
    assert decontaminate.contaminated(docs, bench).count() == 11


def test_language_of_many_unequal_languages(spark):
    """60 languages, the rarest with three documents to learn from; one key has most rows."""
    r = random.Random(5)
    rows = []
    for k in range(60):
        letters = [chr(97 + (7 * k + j * (k % 5 + 1)) % 26) for j in range(6)] + [f"{chr(97 + k % 26)}{chr(97 + k // 26)}q"]
        for _ in range(400 if k == 0 else 6 + k % 9):
            rows.append((len(rows), " ".join("".join(r.choice(letters) for _ in range(r.randint(3, 7))) for _ in range(60)), f"l{k:02d}"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(df, language.Fit(docs=600, kept=6000))
    assert model.languages == [f"l{k:02d}" for k in range(60)] and len(model.row_of) <= 6000
    got = {x.doc_id: x for x in language.language(df, sample=language.Fit(docs=600, kept=6000)).collect()}
    test = [(i, lang) for i, _, lang in rows if got[i].held_out]
    assert sum(got[i].lang_pred == lang for i, lang in test) >= 0.95 * len(test)


def test_language_of_numbers_and_long_paths(spark, docs):
    odd = spark.createDataFrame([(1, "\u00bd \u00b2 \u2177 \u2460 12"), (2, None), (3, ""), (4, "_ - 7")], "doc_id bigint, text string").withColumn("lang", F.lit(None).cast("string"))
    assert {(x.lang_pred, x.score) for x in language.language(docs.select("doc_id", "text", "lang").unionAll(odd.withColumn("doc_id", F.col("doc_id") + 1000))).filter("doc_id > 1000").collect()} == {("und", 0.0)}
    import itertools

    import numpy as np

    m, r = language.Model(["a", "b", "c"], {}, np.zeros((1, 3), np.float32), {}, (3,), 2.0), np.random.default_rng(2)
    for _ in range(60):  # the decoded path against all paths
        s = r.normal(size=(6, 3)) * 3
        cost = lambda y, s=s: sum(s[t, x] for t, x in enumerate(y)) - m.penalty * sum(x != z for x, z in zip(y, y[1:]))
        best = max(itertools.product(range(3), repeat=6), key=cost)
        assert abs(cost(m.path(s)) - cost(best)) < 1e-9 and abs(cost(m.viterbi(s)) - cost(best)) < 1e-9


def test_quality_verdict_against_all_labelings():
    """The share of content by the best of all label sequences, for texts of a few lines."""
    import itertools

    r = random.Random(4)
    lines = ["The quick brown fox jumps over the lazy dog again and again.", "HOME | ABOUT | LOGIN", "a*** b%%% c$$$ d### e&&&", "It was a calm evening.", "WORD!! WORD!! WORD!!", "12 34 56 78 90", ""]
    crf = quality.UNFITTED
    for _ in range(200):
        text = "\n".join(r.choice(lines) for _ in range(r.randint(1, 6)))
        own = [x for x in text.split("\n") if x]
        share = 0.0
        if own:
            e = quality.line_features(own) @ crf.emit
            best = max(itertools.product((0, 1), repeat=len(own)), key=lambda y: (round(sum(e[t, x] for t, x in enumerate(y)) + sum(crf.move[a, b] for a, b in zip(y, y[1:])), 9), [-x for x in reversed(y)]))
            share = sum(len(x) for x, y in zip(own, best) if y == 0) / sum(map(len, own))
        got = quality.judged(text, crf, 0.5, 1, 100)
        assert abs(got[7] - share) < 1e-9 and got[6] == (not got[5] and share >= 0.5)


def test_quality_learns_lines_from_documents():
    """Good documents with a menu line and bad ones with a sentence: the lines' labels are learned, also changes within."""
    r = np.random.default_rng(0)
    good, bad, menu = "It was a calm and quiet evening by the river side, and the {} fox slept.", "BUY {} NOW!! ### $$$ %%%", "home {} | about | login"
    samples, n = [], 0
    for k in range(120):
        text = [good.format(k + j) for j in range(6)] if k % 2 else [bad.format(k + j) for j in range(6)]
        text.insert(int(r.integers(6)), menu.format(k) if k % 2 else good.format(k))
        samples.append((quality.line_features(text), 1 - k % 2, np.array([len(x) for x in text])))
    crf = quality.learned(samples, quality.Fit(rounds=60), 0.5)
    mixed = [good.format(1), good.format(2), bad.format(1), bad.format(2), bad.format(3), good.format(3), good.format(4)]
    assert crf.viterbi(quality.line_features(mixed)).tolist() == [0, 0, 1, 1, 1, 0, 0]
    assert quality.learned([], quality.Fit(), 0.5) is quality.UNFITTED
