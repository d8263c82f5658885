"""The pipeline's stages against the operators' plain versions, and the whole run."""

import corpus_pipeline
from tests_llm_plain import plain_components

from fathomline.llm import decontaminate, pii, quality


def test_stages(spark, docs, none, sf, rows):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert stage(spark, none, sf).count() == 0
    kept = corpus_pipeline.near_duplicates(spark, docs, sf)
    want = plain_components(rows)
    assert {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if x[2]}


def test_run(spark, sf):
    d = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    crf = quality.fit_crf(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    first = {i: t for i, t in d.items() if quality.judged(t, crf, 0.5, 50, 50)[6]}
    second = {i: first[i] for i, x in plain_components([(i, t) for i, t in first.items()], 80).items() if x[2]}
    m = decontaminate.Matcher([(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()], 5, 40)
    third = {i: t for i, t in second.items() if not m.match(t)}
    fourth = {i: pii.masked(t, pii.find(t)[1]) for i, t in third.items()}
    from tokenizers import Tokenizer

    from fathomline.llm.queries import vocabulary

    t = Tokenizer.from_file(vocabulary())
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {i: t.encode(x, add_special_tokens=False).ids for i, x in fourth.items()}
    assert 0 < len(got) < len(d)


def test_near_duplicates_at_80(spark, sf):
    words = [f"w{i}" for i in range(104)]
    texts = [" ".join(words), " ".join(words[:52] + ["x"] + words[53:93]), " ".join(words[:40] + ["y", "z"] + words[42:60]), " ".join([*words[:90], *"abcdefghij"])]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(10 * g + k, " ".join([f"g{g}-{i}" for i in range(84 - g % 3)] + ([f"t{g}-{i}" for i in range(8)] if k else []))) for g in range(1, 60) for k in (0, 1)]
    rows += [(1000 + 10 * g + k, " ".join(f"h{g}-{i}" for i in range(84 if k else 84 + 17 + g % 7))) for g in range(60) for k in (0, 1)]
    want = plain_components(rows, 80)
    assert want != plain_components(rows, 85)
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), sf)
    assert {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if x[2]}
    d = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    want = {i for i, x in plain_components(rows, 80).items() if x[2]}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, d, sf).collect()} == want
    assert want < {i for i, x in plain_components(rows, 85).items() if x[2]}


def test_run_leaves_no_tables_behind(spark, sf):
    from fathomline.llm import common

    before = set(common._made)
    corpus_pipeline.run(spark, sf).count()
    assert set(common._made) == before


def test_clashing_names(spark, docs, sf):
    """Columns of the caller's that are named like helper columns."""
    own = docs.withColumns({"_line": docs.text, "_MAP": docs.text, "_perhaps": docs.doc_id})
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, own, sf).columns == own.columns and stage(spark, own, sf).count() > 0, name
