"""Delivery, reports, relation models, the graph service and the command line."""

import json

import pytest

from fathomline import cli
from fathomline.operators import export, relations
from fathomline.plans.service import GraphService


def test_delivery(spark, tmp_path):
    chunks = spark.createDataFrame([("d", "c2", 1), ("d", "c1", 0), ("e", "c3", 0)], "doc_id string, chunk_id string, posicion int")
    emb = spark.createDataFrame([("c1", [1.0, 0.0]), ("c2", [0.0, 1.0]), ("c3", [1.0, 1.0])], "chunk_id string, vector array<float>")
    out = export.delivery(chunks, emb, str(tmp_path / "x"))
    assert out["n_vectors"] == 3 and out["dimension"] == 2 and out["chunks_omitted"] == 0
    assert [r.chunk_id for r in spark.read.parquet(str(tmp_path / "x/index")).orderBy("vec_ordinal").collect()] == ["c1", "c2", "c3"]
    assert export.delivery(chunks.repartition(3), emb, str(tmp_path / "y"))["checksum"] == out["checksum"]
    with pytest.raises(ValueError, match="c2"):
        export.delivery(chunks, emb.filter("chunk_id <> 'c2'"), str(tmp_path / "z"))
    assert export.delivery(chunks, emb.filter("chunk_id <> 'c2'"), str(tmp_path / "z"), partial=True)["chunks_omitted"] == 1
    with pytest.raises(ValueError, match="dimensions"):
        export.delivery(chunks, emb.unionAll(spark.createDataFrame([("c9", [1.0])], emb.schema)), str(tmp_path / "z"))


def test_reports(spark):
    v = spark.createDataFrame([("d", 0, "x", "obligatorio"), ("d", 1, "texto malo", "duplicado"), ("e", 0, "bien", None)], "doc_id string, posicion int, texto string, rule string")
    text = export.rejection_report(v)
    assert "obligatorio: 1" in text and "d: 2 rejected, ratio 1.00" in text and "texto malo" in text and "e:" not in text
    j, m = export.evaluation_report({"ndcg": 1.0}, [{"texto": "t", "relevancia": 2}])
    assert json.loads(j)["summary"] == {"ndcg": 1.0} and "| ndcg | 1.0 |" in m


def inputs(spark):
    s = spark.createDataFrame([("d", "c", 0, "La NASA coopera con la ESA."), ("d", "c", 1, "la nasa coopera con la esa")], "doc_id string, chunk_id string, n int, texto string")
    m = spark.createDataFrame([("c", 0, "nasa"), ("c", 0, "esa"), ("c", 1, "nasa"), ("c", 1, "esa")], "chunk_id string, n int, entity string")
    return s, m


def test_entailment(spark):
    s, m = inputs(spark)
    got = relations.by_entailment(s, m, lambda pairs: [0.8 if h == "nasa coopera con esa" else 0.3 for _, h in pairs]).collect()
    assert {(r.sujeto, r.relacion, r.objeto, r.confianza) for r in got} == {("nasa", "COOPERA_CON", "esa", 0.8), ("esa", "COOCURRENCIA", "nasa", 0.3)}


def test_generation(spark):
    s, m = inputs(spark)
    made = "<triplet> NASA <subj> ESA <obj> cooperates with <triplet> NASA <subj> Mars <obj> partner <triplet> ESA <subj> NASA <obj> odd"
    got = relations.by_generation(s, m, lambda texts: [made] * len(texts)).collect()
    assert {(r.sujeto, r.relacion, r.objeto, r.confianza) for r in got} == {("nasa", "COOPERA_CON", "esa", 0.9), ("esa", "RELACIONADO_CON", "nasa", 0.7)}


def test_graph_service(spark, tmp_path):
    with pytest.raises(ValueError):
        GraphService().triples
    chunks = spark.createDataFrame([("c1", "d1", "La NASA coopera con la ESA."), ("c2", "d1", "El clima es bueno."), ("c3", "d2", "SpaceX y la ESA.")], "chunk_id string, doc_id string, texto string")
    g = GraphService(proper_nouns=False).build(chunks)
    assert g.summary() == {"entities": 3, "triples": 4, "chunks": 2}
    q = spark.createDataFrame([("q", "¿Qué hace la NASA?"), ("r", "nada")], "query_id string, query_text string")
    found = g.search(q).orderBy("rank").collect()
    assert [(r.query_id, r.chunk_id, r.score) for r in found] == [("q", "c1", 3.0), ("q", "c3", 1.0)]
    assert g.explain(q, g.search(q)).count() == 4
    g.export(str(tmp_path / "g.graphml"))
    assert GraphService().load(spark, str(tmp_path / "g.graphml")).summary() == g.summary()


def test_command_line(spark, tmp_path):
    corpus = tmp_path / "corpus" / "agua"
    corpus.mkdir(parents=True)
    for i in range(12):
        (corpus / f"doc{i}.txt").write_text(f"El agua del pozo {i} es buena. Tema número {i}.")
    out = str(tmp_path / "out")
    assert cli.main(["ingest", str(tmp_path / "corpus"), out, "--topics", '{"agua": 2}']) == 0
    chunks = spark.read.parquet(f"{out}/chunks")
    assert chunks.count() == 12 and {r.fenomeno for r in chunks.collect()} == {2}
    for _ in range(2):
        assert cli.main(["encode", f"{out}/chunks", f"{out}/emb"]) == 0
    assert spark.read.parquet(f"{out}/emb").count() == 12
    (tmp_path / "q.jsonl").write_text('{"query_id": "q001", "query_text": "agua del pozo 7"}\n')
    assert cli.main(["search", str(tmp_path / "q.jsonl"), f"{out}/emb", f"{out}/chunks", f"{out}/res"]) == 0
    line = json.loads(spark.read.text(f"{out}/res").first()[0])
    assert len(line["documents"]) == 3 and len(line["fragments"]) == 10
