"""Hand-computed cases of the engine's operators."""

import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fathomline.config import ChunkingConfig, IndexConfig, batch_sizes
from fathomline.functions import segment, text
from fathomline.operators import audit, chunking, cleaning, encoding, entities, evaluation, filters, fragments, fusion, graph, search, store, validation
from fathomline.plans import catalogue, ingest, retrieval


def hits(spark, *rows):
    return spark.createDataFrame([(q, c, k, d, r, float(s)) for q, c, k, d, r, s in rows], "query_id string, channel string, chunk_id string, doc_id string, rank int, score double")


def test_rrf_over_three_channels(spark):
    h = hits(spark, ("q", "A", "c1", "d1", 1, 0.95), ("q", "A", "c2", "d1", 2, 0.9), ("q", "A", "c3", "d2", 3, 0.8), ("q", "B", "c2", "d1", 1, 0.7), ("q", "B", "c4", "d3", 2, 0.6), ("q", "C", "c1", "d1", 1, 0.5), ("q", "C", "c4", "d3", 2, 0.4))
    got = fusion.rrf(h).orderBy("rank").collect()
    assert [r.chunk_id for r in got] == ["c1", "c2", "c4", "c3"]
    assert [round(r.rrf_score, 9) for r in got] == [round(x, 9) for x in (2 / 61, 1 / 61 + 1 / 62, 2 / 62, 1 / 63)]
    assert got[0].cosine_score == 0.95 and got[0].channels == ["A", "C"]
    with pytest.raises(ValueError):
        fusion.rrf(h, 0)


def test_equal_ranks_go_by_cosine(spark):
    h = hits(spark, ("q", "A", "b", "d", 1, 0.5), ("q", "B", "a", "d", 1, 0.8))
    assert [r.chunk_id for r in fusion.rrf(h).orderBy("rank").collect()] == ["a", "b"]


def test_combsum_and_combmnz(spark):
    h = hits(spark, ("q", "v", "c1", "d", 1, 0.95), ("q", "v", "c3", "d", 2, 0.9), ("q", "g", "c2", "d", 1, 3), ("q", "g", "c3", "d", 2, 1))
    assert {r.chunk_id: r.score for r in fusion.combined(h, "combsum").collect()} == {"c1": 1.0, "c2": 1.0, "c3": 0.0}
    h = hits(spark, ("q", "v", "c1", "d", 1, 0.9), ("q", "v", "c2", "d", 2, 0.5), ("q", "g", "c1", "d", 1, 2))
    assert {r.chunk_id: r.score for r in fusion.combined(h, "combmnz").collect()} == {"c1": 4.0, "c2": 0.0}
    one = fusion.combined(h.filter("channel = 'v'"), "combmnz").collect()
    assert {(r.chunk_id, r.score, r.origin) for r in one} == {("c1", 0.9, "v"), ("c2", 0.5, "v")}
    with pytest.raises(ValueError):
        fusion.combined(h, "other")


def test_pooling(spark):
    f = spark.createDataFrame([("q", "d1", 0.8, 1), ("q", "d2", 0.9, 2), ("q", "d1", 0.4, 3)], "query_id string, doc_id string, score double, place int")
    rows = lambda kind: [(r.doc_id, round(r.score, 6)) for r in fragments.pooled(f, kind).orderBy("rank").collect()]
    assert rows("max") == [("d2", 0.9), ("d1", 0.8)] and rows("sum") == [("d1", 1.2), ("d2", 0.9)]
    assert rows("weighted_mean") == [("d2", 0.9), ("d1", 0.7)]
    with pytest.raises(ValueError):
        fragments.pooled(f, "median")


def test_filters(spark):
    f = spark.createDataFrame([("a", 0.85, 1, "pdf", "ES", "2024-05-01"), ("b", 0.4, 2, "txt", None, None), ("c", -0.1, None, "pdf", "en", "01/02/2023"), ("d", 0.6, 2, "pdf", "fr", "2024-12-31T10:00:00Z")], "id string, cosine_score double, fenomeno int, formato string, idioma string, fecha_publicacion string")
    ids = lambda x: {r.id for r in filters.filtered(f, x).collect()}
    assert ids(None) == {"a", "b", "c", "d"} and ids(filters.Filters()) == {"a", "b", "d"} and ids(filters.Filters(theta=0.5)) == {"a", "d"}
    assert ids(filters.Filters(topic=2, theta=None)) == {"b", "d"} and ids(filters.Filters(format="pdf", theta=None)) == {"a", "c", "d"}
    assert ids(filters.Filters(language="es", theta=None)) == {"a", "b"}
    assert ids(filters.Filters(dates=("2024-01-01", "2024-12-31"), theta=None)) == {"a", "b", "d"} and ids(filters.Filters(dates=(None, None), theta=None)) == {"a", "b", "c", "d"}


def test_exact_search(spark):
    v = spark.createDataFrame([("c1", [1.0, 0.0, 0.0, 0.0]), ("c2", [0.0, 1.0, 0.0, 0.0]), ("c3", [0.0, 0.0, 1.0, 0.0]), ("c0", None)], "chunk_id string, vector array<float>")
    n = (0.81 + 0.09 + 0.04) ** 0.5
    q = spark.createDataFrame([("q", [0.9 / n, 0.3 / n, 0.2 / n, 0.0])], "query_id string, vector array<double>")
    assert [(r.chunk_id, round(r.score, 6)) for r in search.exact_topk(v, q, 2).orderBy("rank").collect()] == [("c1", round(0.9 / n, 6)), ("c2", round(0.3 / n, 6))]
    assert search.exact_topk(v, q, 100).count() == 3 and search.exact_topk(v.limit(0), q, 5).count() == 0 and search.exact_topk(v, q.limit(0), 5).count() == 0
    with pytest.raises(Exception, match="dimensions"):
        search.exact_topk(v.select("chunk_id", F.array(F.lit(1.0), F.lit(2.0)).alias("vector")), q, 2).collect()
    assert IndexConfig().chosen(50_000) == "flat_ip" and IndexConfig().chosen(50_001) == "ivf_flat" and IndexConfig("hnsw").chosen(1) == "hnsw"


def test_k_means_index_finds_what_exact_search_finds(spark, sf):
    from fathomline.plans.registered import QUERIES
    import fathomline.plans.catalogue  # noqa: F401

    found = [r.recall for r in QUERIES["ivf_kmeans_recall"](spark, sf).collect()]
    assert sum(found) >= 0.9 * len(found)


def test_merge_and_split(spark):
    words = lambda n, w="w": " ".join([w] * n)
    c = spark.createDataFrame([("d", 0, words(50)), ("d", 1, words(100, "x")), ("d", 2, words(200, "y")), ("d", 4, words(10, "z"))], "doc_id string, posicion int, texto string")
    got = {r.posicion: r for r in fragments.merged_next(c, c).collect()}
    assert got[0].merged_with == "d::1" and got[0].texto == words(50) + " " + words(100, "x")
    assert got[1].merged_with is None and got[2].merged_with is None and got[4].merged_with is None
    long = " ".join(" ".join([f"a{i}"] * 14) + " end." for i in range(20))
    out = fragments.split_long(spark.createDataFrame([("d", 0, long), ("d", 1, "short.")], "doc_id string, posicion int, texto string")).orderBy("posicion", "sub_indice").collect()
    assert [r.sub_indice for r in out] == [1, 2, 0] and all(len(r.texto.split()) <= 250 for r in out)
    assert " ".join(r.texto for r in out[:2]).split() == long.split()


@given(st.lists(st.integers(1, 90), max_size=40), st.integers(1, 80), st.integers(0, 40))
def test_windows_cover_all_units(costs, size, overlap):
    found = segment.windows(costs, size, overlap)
    assert {i for a, b in found for i in range(a, b + 1)} == set(range(len(costs)))
    assert all(sum(costs[a : b + 1]) <= size or a == b for a, b in found)
    assert all(y[0] > x[0] and y[0] <= x[1] + 1 for x, y in zip(found, found[1:]))


def test_windows_by_hand():
    assert segment.windows([5] * 20, 60, 15) == [(0, 11), (9, 19)]
    assert segment.tail_absorbed([(0, 0), (1, 1)], [201, 2], 100, 512) == [(0, 1)]
    assert segment.tail_absorbed([(0, 0), (1, 1)], [521, 2], 100, 512) == [(0, 0), (1, 1)]


def test_sentences():
    assert segment.sentences("Hola a todos. Vive con la Sra. Central desde 1990! ¿Sí? Bien") == ["Hola a todos.", "Vive con la Sra. Central desde 1990!", "¿Sí?", "Bien"]
    # consequences of the rule: numbers and ellipses are cut, a listed word before a question mark is no end
    assert segment.sentences("Pi es 3.14 aquí. Hola... Fin") == ["Pi es 3.", "14 aquí.", "Hola.", ".", ".", "Fin"]
    assert segment.sentences("¿cierto, no? Sí.") == ["¿cierto, no? Sí."] and segment.sentences("Ver p.ej. uno.") == ["Ver p.", "ej. uno."]
    assert [segment.last_within([3, 4, 5], b) for b in (2, 3, 7, 11, 12, 99)] == [0, 0, 1, 1, 2, 2] and segment.last_within([], 5) == 0
    assert segment.sentences("") == []


def test_merge_small_sections():
    s = lambda t, n, o, split=True: (t, " ".join(["w"] * n), o, split)
    assert [len(x[1].split()) for x in segment.merge_small([s("a", 100, 0), s("b", 10, 1)], 50, 512)] == [110]
    assert [len(x[1].split()) for x in segment.merge_small([s("a", 10, 0), s("b", 500, 1)], 50, 512)] == [510]
    assert len(segment.merge_small([s("a", 10, 0), s("b", 510, 1)], 50, 512)) == 2
    assert len(segment.merge_small([s("a", 100, 0), s("b", 10, 1, False)], 50, 512)) == 2


def test_fitted():
    assert segment.fitted("One two. Three four.", 2, lambda t: len(t.split())) == "One two."
    assert segment.fitted("a b c d", 3, lambda t: len(t.split())) == "a b c" and segment.fitted("  ", 3) is None


def document(spark, *sections, doc_id="doc_test"):
    return spark.createDataFrame([(doc_id, "f", "txt", 1, [(None, t, i, s) for i, (t, s) in enumerate(sections)])], "doc_id string, fuente string, formato string, fenomeno int, secciones array<struct<titulo:string,texto:string,orden:int,splittable:boolean>>")


def chunks(spark, config, *sections):
    return chunking.chunk(document(spark, *sections), config).orderBy("posicion").collect()


SMALL = dict(chunk_size=60, overlap=15, min_tokens=25, max_tokens=512)


def test_chunking_strategies(spark):
    long = " ".join(f"frase numero {i} de prueba." for i in range(20))
    got = chunks(spark, ChunkingConfig(strategy="hybrid", **SMALL), (long, True))
    assert len(got) == 2 and got[0].chunk_id == "doc_test__chunk_00000" and got[0].overlap_con is None and got[1].overlap_con == got[0].chunk_id
    assert len(chunks(spark, ChunkingConfig(strategy="hybrid"), (long, True), ("corta.", True))) == 1
    got = chunks(spark, ChunkingConfig(strategy="paragraph"), ("uno.\n\ndos.\n\ntres.", True))
    assert [(r.posicion, r.texto) for r in got] == [(0, "uno."), (1, "dos."), (2, "tres.")]
    got = chunks(spark, ChunkingConfig(strategy="structural"), (" ".join(["w"] * 600), True), ("", True), ("k: v", False))
    assert [r.num_tokens for r in got] == [512, 88, 2]
    got = chunks(spark, ChunkingConfig(strategy="semantic", **SMALL), (long, True))
    assert len(got) == 2 and got[1].overlap_con == got[0].chunk_id
    atomic = chunks(spark, ChunkingConfig(strategy="paragraph_overlap", **SMALL), (" ".join(["w"] * 100), False))
    assert len(atomic) == 1 and atomic[0].num_tokens == 100
    with pytest.raises(ValueError, match="known"):
        chunking.chunk(document(spark, ("a", True)), ChunkingConfig(strategy="other"))
    with pytest.raises(ValueError):
        ChunkingConfig(overlap=400)


def test_validation(spark):
    row = lambda i, **k: {"doc_id": "d", "chunk_id": f"d{i}", "fuente": "f", "formato": "txt", "fenomeno": 1, "posicion": i, "num_tokens": 5, "texto": "Texto.", "input_ordinal": i} | k
    rules = lambda *rows: [r.rule for r in validation.validate(spark.createDataFrame(list(rows), "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string, input_ordinal int")).orderBy("input_ordinal").collect()]
    assert rules(row(0), row(1)) == [None, None]
    assert rules(row(0, fuente=" "), row(1, fenomeno=9), row(2, num_tokens=513), row(3)) == ["obligatorio", "fenomeno", "num_tokens", None]
    assert rules(row(0), row(2, input_ordinal=1), row(3, input_ordinal=2)) == [None, "secuencia", "secuencia"]
    assert rules(row(0), row(1, chunk_id="d0")) == [None, "duplicado"]
    assert rules(row(0), row(0, input_ordinal=1)) == [None, "secuencia"]
    w = spark.createDataFrame([("sin punto", "txt"), ("Bien.", "txt"), ("k: v", "csv")], "texto string, formato string").select(validation.warnings().alias("w")).collect()
    assert [r.w for r in w] == [["sin_cierre", "sin_apertura"], [], []]


def test_cleaning(spark):
    one = lambda t, c: spark.createDataFrame([(t,)], "t string").select(c.alias("x")).first().x
    assert one("a\x00b  c \n\n\n\nd", cleaning.cleaned(F.col("t"))) == "ab c\n\nd"
    assert one("La inteligencia de los datos que se usan para el bien del país y por una ley", cleaning.language_guess(F.col("t"))) == "es" and one("short", cleaning.language_guess(F.col("t"))) == "es"
    s = spark.createDataFrame([("d", 0, "Pie de página\nuno"), ("d", 1, "Pie de página\ndos"), ("e", 0, "k: v\nk: v"), ("e", 1, "k: v")], "doc_id string, orden int, texto string")
    assert [(r.doc_id, r.line) for r in cleaning.local_boilerplate(s).collect()] == [("d", "Pie de página")]
    d = spark.createDataFrame([("a", "Aviso legal\nx uno"), ("b", "Aviso legal\ny"), ("c", "z\nAviso legal"), ("e", None)], "doc_id string, texto string")
    found = cleaning.corpus_boilerplate(d)
    assert [(r.line, r.n_docs) for r in found.collect()] == [("Aviso legal", 3)]
    assert {r.doc_id: r.texto for r in cleaning.without_boilerplate(d, found).collect()} == {"a": "x uno", "b": "y", "c": "z", "e": ""}


def test_text_functions(spark):
    one = lambda t, c: spark.createDataFrame([(t,)], "t string").select(c(F.col("t")).alias("x")).first().x
    assert one("Ciudad de MÉXICO, (2024)!", text.entity_key) == "ciudad de mexico 2024" == entities.key("Ciudad de MÉXICO, (2024)!")
    assert one("¡Hola, Mundo!", text.slug) == "hola_mundo" and one("a\\b/c.txt", text.file_name) == "c.txt" and one("a/b/c", text.folder) == "a/b"
    assert str(one("2024/03/05", text.parsed_date)) == "2024-03-05" == str(one("05/03/2024 10:00", text.parsed_date)) and one("no", text.parsed_date) is None
    assert one("001-17 001-18 001-19", text.normalised_paragraph) == "001-17. 001-18. 001-19." and one("a; b; c", text.normalised_paragraph) == "a. b. c." and one("Ya.", text.normalised_paragraph) == "Ya." and one("sin punto", text.normalised_paragraph) == "sin punto."
    assert one("a b c d e", lambda c: text.hard_split(c, 2)) == ["a b", "c d", "e"] and one("a  b", lambda c: text.hard_split(c, 2)) == ["a  b"]


def graph_of(spark):
    return spark.createDataFrame([("nasa", "COOPERA_CON", "esa", "d1", "c1", "", 0.9), ("nasa", "PERTENECE_A", "programa artemisa", "d1", "c2", "", 0.9), ("esa", "COOPERA_CON", "spacex", "d2", "c3", "", 0.9)], "sujeto string, relacion string, objeto string, doc_id string, chunk_id string, evidencia string, confianza double")


def test_graph(spark, tmp_path):
    g = graph_of(spark)
    near = lambda x, d: {r.entity for r in graph.neighbours(g, spark.createDataFrame([(x,)], "start string"), d).collect()}
    assert near("nasa", 1) == {"esa", "programa artemisa"} and near("spacex", 2) == {"esa", "nasa"} and near("nobody", 3) == set()
    q = spark.createDataFrame([("q", "nasa")], "query_id string, entity string")
    assert [(r.chunk_id, r.score) for r in graph.evidence(g, q).orderBy("rank").collect()] == [("c1", 1.5), ("c2", 1.5), ("c3", 0.5)]
    assert {(r.chunk_id, r.sujeto) for r in graph.explanation(g, q, graph.evidence(g, q)).collect()} == {("c1", "nasa"), ("c2", "nasa"), ("c3", "esa")}
    e = spark.createDataFrame([("nasa", "NASA", "ORGANIZACION"), ("esa", "ESA", "ORGANIZACION"), ("spacex", "SpaceX", "OTRO"), ("programa artemisa", "Artemisa & Co", "PROGRAMA")], "id string, nombre string, tipo string")
    assert graph.orphans(g, e).count() == 0 and {r.entity for r in graph.orphans(g, e.filter("id <> 'esa'")).collect()} == {"esa"}
    assert graph.materialised(g, e.filter("id <> 'esa'")).count() == 1
    from fathomline.sources import graphml

    graphml.write(e, g, str(tmp_path / "g.graphml"))
    e2, g2 = graphml.read(spark, str(tmp_path / "g.graphml"))
    assert sorted(map(tuple, e2.collect())) == sorted(map(tuple, e.collect()))
    assert sorted((r.sujeto, r.relacion, r.objeto, r.chunk_id, r.confianza) for r in g2.collect()) == sorted((r.sujeto, r.relacion, r.objeto, r.chunk_id, r.confianza) for r in g.collect())


def test_entities_and_relations(spark):
    found = entities.Gazetteer().find("La NASA coopera con la European Space Agency. El Doctor Juan Pérez visitó América Latina.")
    assert [(x[1], x[2]) for x in found] == [("nasa", "ORGANIZACION"), ("agencia espacial europea", "ORGANIZACION"), ("doctor juan perez", "OTRO"), ("america latina", "REGION")]
    found = entities.Gazetteer().find("Space debris y basura espacial. La Fuerza Aérea, según El Niño Del Mar.")
    assert [x[1] for x in found] == ["fuerza aerea", "nino del mar"]  # no article at the beginning; "El Niño Del Mar" begins with one
    s = spark.createDataFrame([("d", "c", 0, "La NASA coopera con la ESA."), ("d", "c", 1, "NASA y China.")], "doc_id string, chunk_id string, n int, texto string")
    m = spark.createDataFrame([("c", 0, "nasa"), ("c", 0, "esa"), ("c", 1, "nasa"), ("c", 1, "china")], "chunk_id string, n int, entity string")
    got = {(r.sujeto, r.relacion, r.objeto, r.confianza) for r in graph.symbolic_triples(s, m).collect()}
    assert got == {("nasa", "COOPERA_CON", "esa", 0.9), ("esa", "COOPERA_CON", "nasa", 0.9), ("nasa", "COOCURRENCIA", "china", 0.6), ("china", "COOCURRENCIA", "nasa", 0.6)}
    assert entities.parse_triplets("<s><triplet> NASA <subj> ESA <obj> partner <triplet> ESA <org> SpaceX <org> supplier</s>") == [("NASA", "partner", "ESA"), ("ESA", "supplier", "SpaceX")]
    ms = spark.createDataFrame([("esa", "European Space Agency", "ORG", 5), ("esa", "ESA", "ORG", 1)], "id string, nombre string, tipo string, position int")
    assert [tuple(r) for r in graph.merged_entities(ms).collect()] == [("esa", "ESA", "ORG", ["ESA", "European Space Agency"])]


def test_evaluation(spark):
    h = spark.createDataFrame([("q1", "a", 1), ("q1", "b", 2), ("q1", "c", 3), ("q2", "x", 1)], "query_id string, chunk_id string, rank int")
    q = spark.createDataFrame([("q1", "b"), ("q1", "z"), ("q3", "y")], "query_id string, chunk_id string")
    got = {r.query_id: r for r in evaluation.binary(h, q, 2).collect()}
    import math

    assert set(got) == {"q1", "q3"} and got["q1"].precision == 0.5 and got["q1"].recall == 0.5 and got["q1"].mrr == 0.5
    assert abs(got["q1"].ndcg - (1 / math.log2(3)) / (1 + 1 / math.log2(3))) < 1e-12 and got["q3"].ndcg == 0
    s = evaluation.summary(evaluation.binary(h, q, 2)).first()
    assert s.n_queries == 2 and s.recall == 0.25
    assert evaluation.summary(evaluation.binary(h, q.limit(0))).first().mrr == 0.0
    g = spark.createDataFrame([("q1", "a", 3.0), ("q1", "b", 2.0), ("q1", "c", 3.0), ("q2", "x", 0.0)], "query_id string, chunk_id string, gain double")
    n = {r.query_id: r.ndcg for r in evaluation.graded_ndcg(h, g).collect()}
    dcg, ideal = 3 + 2 / math.log2(3) + 3 / 2, 3 + 3 / math.log2(3) + 2 / 2
    assert abs(n["q1"] - dcg / ideal) < 1e-12 and n["q2"] == 1.0
    d = spark.createDataFrame([("q", "x/one.pdf", 1), ("q", "b.pdf", 2)], "query_id string, doc_id string, rank int")
    f = evaluation.f1_at_3(d, spark.createDataFrame([("q", "y\\one.pdf")], "query_id string, doc_id string")).first()
    assert (round(f.precision, 6), f.recall, f.f1) == (0.333333, 1.0, 0.5)
    t = evaluation.text_relevance(spark.createDataFrame([("q", 1, "El gato, NEGRO"), ("q", 2, "otro")], "query_id string, rank int, texto string"), spark.createDataFrame([("q", "gato negro", 2.0)], "query_id string, texto string, relevancia double"))
    assert {r["rank"]: r.relevancia for r in t.collect()} == {1: 2.0, 2: 0.0}


def test_store(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], "k int, v string, created int")
    new = spark.createDataFrame([(2, "B", 20), (3, "c", 20)], "k int, v string, created int")
    out = store.upsert(old, new, ["k"], keep_from_old=("created",))
    assert sorted(map(tuple, out.collect())) == [(1, "a", 10), (2, "B", 10), (3, "c", 20)]
    p = str(tmp_path / "t")
    old.write.parquet(p)
    for _ in range(2):
        store.write_upserted(store.upsert(spark.read.parquet(p), new, ["k"]), p, staging=f"{p}.staging")
    assert sorted(map(tuple, spark.read.parquet(p).collect())) == [(1, "a", 10), (2, "B", 20), (3, "c", 20)]
    o = store.ordinals(spark.createDataFrame([(5, 1), (5, 0), (2, 9), (9, 0)], "d long, p int"), "d", ("p",), buckets=2)
    assert [(r.d, r.p) for r in o.orderBy("vec_ordinal").collect()] == [(2, 9), (5, 0), (5, 1), (9, 0)] and sorted(r.vec_ordinal for r in o.collect()) == [0, 1, 2, 3]
    a = store.pending(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "chunk_id string, hash_texto string"), spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None)], "chunk_id string, hash_texto string"))
    assert [r.chunk_id for r in a.collect()] == ["b"]


@pytest.mark.parametrize("limit, sizes, want", [(1000, (900, 900, 900), (334, 333, 333)), (100, (40, 40, 40), (34, 33, 33)), (3, (5, 5, 5), (1, 1, 1)), (1, (5, 5, 5), (1, 0, 0)), (0, (5, 5, 5), (0, 0, 0)), (100, (30, 20, 10), (30, 20, 10))])
def test_balanced_sample(spark, limit, sizes, want):
    df = spark.createDataFrame([(t + 1, i) for t, n in enumerate(sizes) for i in range(n)], "topic int, id int")
    got = {r.topic: r["count"] for r in store.balanced_sample(df, limit, ["topic"], ["id"]).groupBy("topic").count().collect()}
    assert tuple(got.get(t + 1, 0) for t in range(3)) == want


def test_audit(spark):
    r = spark.createDataFrame([("a", "ok", 5, 1), ("b", "error", 7, 1), ("c", "ok", 2, None)], "doc_id string, status string, num_guardados int, fenomeno int")
    assert {x.scope: (x.files, x.ok, x.errors, x.chunks) for x in audit.batch_summary(r).collect()} == {"total": (3, 2, 1, 7), "1": (2, 1, 1, 5)}


def test_encoders(spark):
    e = encoding.ENCODERS.create("HASHED-128 ")
    v = encoding.encoded(spark.createDataFrame([("hola mundo",), ("  ",), (None,), ("!!",)], "texto string"), e).collect()
    assert abs(sum(x * x for x in v[0].vector) - 1) < 1e-6 and v[1].vector is None and v[2].vector is None and sum(v[3].vector) == 0
    bad = encoding.Encoder("closed", 3, encoding.hashed_words(3), license="proprietary")
    r = encoding.Encoders("encoder")
    r.add(bad)
    with pytest.raises(ValueError):
        r.create("closed")
    assert r.create("closed", any_license=True) is bad
    with pytest.raises(ValueError):
        r.add(encoding.Encoder("fr", 3, encoding.hashed_words(3), languages=("fr",)))
    assert batch_sizes("a=8, b=16") == {"a": 8, "b": 16} and encoding.catalogue(spark).count() >= 2


def test_ingest_and_retrieve(spark):
    docs = document(spark, ("La NASA coopera con la ESA en el espacio. " * 3, True), doc_id="d1").unionAll(document(spark, ("El mercado de granos de Brasil crece. " * 3, True), doc_id="d2"))
    accepted, rejected = ingest.ingest(docs)
    assert accepted.count() == 2 and rejected.count() == 0
    todo = encoding.encode_pending(accepted, spark.createDataFrame([], "chunk_id string, encoder_name string, hash_texto string"), encoding.ENCODERS.available())
    emb = todo
    assert emb.count() == 2 * len(encoding.ENCODERS.available())
    assert encoding.encode_pending(accepted, emb, encoding.ENCODERS.available()).count() == 0
    q = spark.createDataFrame([("q001", "NASA y ESA en el espacio"), ("q002", "granos Brasil")], "query_id string, query_text string")
    found, frag = retrieval.retrieve(q, emb, accepted, theta=0.1)
    assert {r.query_id: r.doc_id for r in found.filter("rank = 1").collect()} == {"q001": "d1", "q002": "d2"}
    triples = spark.createDataFrame([("nasa", "COOPERA_CON", "esa", "d1", "d1__chunk_00000", "", 0.9)], "sujeto string, relacion string, objeto string, doc_id string, chunk_id string, evidencia string, confianza double")
    for kind in ("rrf", "combsum", "combmnz"):
        found, frag = retrieval.hybrid(q, emb, accepted, triples, fusion_kind=kind)
        assert found.filter("query_id = 'q001' and rank = 1").first().doc_id == "d1"
    res = {r.query_id: r for r in retrieval.results(found, frag, n_docs=1, n_fragments=1).collect()}
    assert res["q001"].problem is None and '"query_id":"q001"' in res["q001"].result
    assert {r.problem for r in retrieval.results(found, frag).collect()} == {"documents"}


def test_result_objects_from_the_thousandth_query_on(spark, tmp_path):
    """A query whose number has four digits or more has its own whole result, and leaves those of three digits alone."""
    asked = {"q100": 10_000, "q1000": 100_000, "q1001": 100_100, "q10000": 1_000_000}
    ids = [*asked.values(), *range(1, 21)]
    drawn = random.Random(5)
    table = [(i, [drawn.gauss(0, 1) for _ in range(64)], n % 10) for n, i in enumerate(ids)]
    spark.createDataFrame(table, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = {r.query_id: r for r in catalogue.QUERIES["result_objects"](spark, str(tmp_path)).collect()}
    assert found.keys() == asked.keys() and {r.problem for r in found.values()} == {None}
    for name, i in asked.items():
        out = json.loads(found[name].result)
        assert out["query_id"] == name and [d["rank"] for d in out["documents"]] == [1, 2]
        assert [f["rank"] for f in out["fragments"]] == list(range(1, 11)) and out["fragments"][0]["chunk_id"] == i
    # an evaluation's set keeps its ids of three digits
    docs = spark.createDataFrame([("q1000", "d", 1), ("q001", "d", 1)], "query_id string, doc_id string, rank int")
    frag = spark.createDataFrame([("q1000", "d", "c", "t", 1), ("q001", "d", "c", "t", 1)], "query_id string, doc_id string, chunk_id string, texto string, place int")
    assert {r.query_id: r.problem for r in retrieval.results(docs, frag, 1, 1).collect()} == {"q1000": "query_id", "q001": None}


def test_table_survives_a_lost_writer(spark, tmp_path):
    """A writer may be lost between any two steps; whoever comes next finds all rows."""
    from fathomline.streaming import streams

    rows = lambda *x: spark.createDataFrame([*x], "k int, v string, at int")
    for lost in ("before", "between", "after"):
        p = str(tmp_path / lost)
        t = store.Table(spark, p)
        t.upsert(rows((1, "a", 1), (2, "b", 1)), ["k"])
        if lost == "between":  # put aside, and not yet replaced
            t._rename(p, f"{p}.old")
        elif lost == "after":  # replaced, and what was aside not yet deleted
            t.read().write.parquet(f"{p}.old")
        elif lost == "before":
            rows((9, "x", 9)).write.parquet(f"{p}.staging-lost")
        for _ in range(2):
            store.Table(spark, p).upsert(rows((2, "B", 2), (3, "c", 2)), ["k"])
        assert sorted(map(tuple, t.read().collect())) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)], lost
    # the newest row wins, also if it comes first; repeating a stream changes nothing
    folder = str(tmp_path / "in")
    rows((1, "new", 5), (1, "old", 3), (2, "two", 1), (4, "none", None)).coalesce(1).write.parquet(folder)
    for turn in range(2):
        streams.upserting(spark.readStream.schema("k int, v string, at int").parquet(folder), str(tmp_path / "out"), ["k"], str(tmp_path / f"c{turn}"), order="at").awaitTermination()
    t = store.Table(spark, str(tmp_path / "out"))
    t.upsert(rows((1, "late", 4), (2, "2", 1), (4, "some", 0)), ["k"], order="at")
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "new"), (2, "2"), (4, "some")]
    t.delete(rows((2, "", 0)), ["k"])
    t.set_column("v", spark.createDataFrame([(4, "set")], "k int, v string"), ["k"])
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "new"), (4, "set")]
    with pytest.raises(Exception, match="nowhere"):
        t._rename(f"{t.path}.nowhere", f"{t.path}.else")


def test_retriever(spark, tmp_path):
    """One query with the public parameters over loaded deliveries; unknown chunks have an empty text."""
    import inspect

    from fathomline.operators import export

    assert [*inspect.signature(retrieval.Retriever.retrieve).parameters] == ["self", "query", "phenomenon_filter", "format_filter", "lang_filter", "date_range", "theta", "k_search", "k_chunk_out", "doc_agg"]
    docs = document(spark, ("La NASA coopera con la ESA en el espacio. " * 3, True), doc_id="d1").unionAll(document(spark, ("El mercado de granos de Brasil crece. " * 3, True), doc_id="d2"))
    accepted, _ = ingest.ingest(docs)
    names = ["hashed-128", "hashed-384"]
    emb = encoding.encode_pending(accepted, spark.createDataFrame([], "chunk_id string, encoder_name string, hash_texto string"), names)
    assert all(r.complete for r in encoding.checked(emb, accepted).collect())
    for name in names:
        export.delivery(accepted, emb.filter(F.col("encoder_name") == name), str(tmp_path / name))
    found = retrieval.Retriever.load(spark, {n: str(tmp_path / n) for n in [*names, "absent"]})
    out = found.retrieve("granos de Brasil", theta=0.1)
    assert out["documents"][0]["doc_id"] == "d2" and out["fragments"][0]["doc_id"] == "d2" and "granos" in out["fragments"][0]["texto"]
    assert found.retrieve("granos de Brasil", phenomenon_filter=3)["documents"] == []
    with pytest.raises(ValueError):
        found.retrieve("  ")
    with pytest.raises(ValueError):
        retrieval.Retriever.load(spark, {"x": str(tmp_path / "absent")})
    lone = retrieval.Retriever(emb, accepted.filter("doc_id = 'd1'")).retrieve("granos de Brasil", theta=None)
    assert lone["fragments"][0]["doc_id"] == "d2" and lone["fragments"][0]["texto"] == ""


def test_index_choice(spark):
    from fathomline.config import IndexConfig
    from fathomline.operators import search

    rows = [(i, [float(i == j) + 0.01 * j for j in range(4)]) for i in range(4)] + [(10 + i, [1.0, 0.1 * i, 0.0, 0.0]) for i in range(30)]
    v = spark.createDataFrame(rows, "chunk_id int, vector array<double>").withColumn("vector", search.normalised(F.col("vector"))).withColumn("doc_id", F.col("chunk_id") % 3)
    q = spark.createDataFrame([("q", [1.0, 0.0, 0.0, 0.0])], "query_id string, vector array<double>")
    want = [tuple(r) for r in search.search(v, q, 3, IndexConfig("flat_ip"), ("doc_id",)).orderBy("rank").collect()]
    assert len(want) == 3 and want[0][:3] == ("q", 10, 1)
    for config in (IndexConfig(), IndexConfig("hnsw"), IndexConfig("ivf_flat", nlist=3, nprobe=3), IndexConfig("ivf_flat", nlist=100), IndexConfig("auto", auto_threshold=5, nlist=2, nprobe=2)):
        assert [tuple(r) for r in search.search(v, q, 3, config, ("doc_id",)).orderBy("rank").collect()] == want, config
    with pytest.raises(ValueError, match="known"):
        search.search(v, q, 3, IndexConfig("annoy"))
    from fathomline.operators import fragments, fusion

    fusion.FUSIONS.register("best")(lambda k0: F.max("norm"))
    fragments.POOLINGS.register("least")(lambda score, place: F.min(score))
    h = hits(spark, ("q", "A", "c1", "d1", 1, 0.9), ("q", "B", "c1", "d1", 2, 0.1), ("q", "B", "c2", "d1", 1, 0.4))
    assert [(r.chunk_id, r.score) for r in fusion.combined(h, "best").orderBy("rank").collect()] == [("c1", 1.0), ("c2", 1.0)]
    f = spark.createDataFrame([("q", "d1", 0.8, 1), ("q", "d1", 0.4, 3)], "query_id string, doc_id string, score double, place int")
    assert [r.score for r in fragments.pooled(f, "least").collect()] == [0.4]
    assert [r.texto for r in fragments.split_long(spark.createDataFrame([("a b c",)], "texto string"), 2, lambda t, n: t.split()).orderBy("sub_indice").collect()] == ["a", "b", "c"]


def test_cleaning_of_documents(spark):
    """Boilerplate of a document and of the corpus goes from sections that may be split only; languages are guessed on raw texts."""
    def doc(i, *sections, **more):
        return (f"d{i}", [(None, t, n, s) for n, (t, s) in enumerate(sections)])

    rows = [doc(1, ("Pie de página\nHola  mundo\x00", True), ("Pie de página\nAdiós\n\n\n\nfin ", True), ("Pie de página\nclave: valor", False)), doc(2, ("Aviso legal\nuno", True)), doc(3, ("Aviso legal\ndos", True)), doc(4, ("Aviso  legal\ntres", True), ("Aviso legal", True)), doc(5, (None, True))]
    df = spark.createDataFrame(rows, "doc_id string, secciones array<struct<titulo:string,texto:string,orden:int,splittable:boolean>>")
    got = {r.doc_id: [s.texto for s in r.secciones] for r in cleaning.cleaned_documents(df).collect()}
    assert got == {"d1": ["Hola mundo", "Adiós\n\nfin", "Pie de página\nclave: valor"], "d2": ["uno"], "d3": ["dos"], "d4": ["tres", ""], "d5": [""]}
    made, _ = ingest.ingest(df.withColumns({"fuente": F.lit("f"), "formato": F.lit("txt"), "fenomeno": F.lit(1)}), doc_id=F.concat(F.lit("F1_"), "doc_id"))
    assert {r.doc_id for r in made.collect()} == {"F1_d1", "F1_d2", "F1_d3", "F1_d4"} and {r.idioma for r in made.collect()} == {"es"}


def test_cell_search_multiplies_blocks(spark):
    """Cells are searched by blocks, not by a join of pairs, and give what brute force gives, ties by key."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(3000, 4)), 1)  # coarse, so that scores tie
    rows = [(f"c{i % 1500:04d}{i // 1500}", int(i % 5) if i % 7 else None, [float(y) for y in v]) for i, v in enumerate(x)]
    v = spark.createDataFrame(rows, "chunk_id string, cell int, vector array<double>").repartition(3)
    asked = [(i, rows[i][2]) for i in range(0, 3000, 10)]
    q = spark.createDataFrame([*asked, (-1, None)], "query_id long, vector array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    try:
        all_cells = search.cell_topk(v, q, 3, nprobe=9)
        exact = search.exact_topk(v.filter("cell is not null"), q, 3)
        assert "Join" not in all_cells._jdf.queryExecution().optimizedPlan().toString()
        found = {(r.query_id, r["rank"]): (r.chunk_id, r.score) for r in all_cells.collect()}
        assert found == {(r.query_id, r["rank"]): (r.chunk_id, r.score) for r in exact.collect()}
        two = {(r.query_id, r["rank"]): r.chunk_id for r in search.cell_topk(v, q, 3, nprobe=2).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    kept = [(k, c, np.array(y)) for k, c, y in rows if c is not None]
    mean = {c: np.mean([np.array(y) for _, d, y in rows if d == c], axis=0) for c in range(5)}
    none = np.mean([np.array(y) for _, d, y in rows if d is None], axis=0)
    unit = {c: m / np.linalg.norm(m) for c, m in {**mean, None: none}.items()}
    for i, y in asked:
        order = sorted(((-round(float(np.dot(y, z)), 9), k) for k, c, z in kept))[:3]
        assert [found[i, r][0] for r in (1, 2, 3)] == [k for _, k in order]
        near = sorted(unit, key=lambda c: (-round(float(np.dot(y, unit[c])), 9), -1 if c is None else c))[:2]
        order = sorted((-round(float(np.dot(y, z)), 9), k) for k, c, z in kept if c in near)[:3]
        assert [two[i, r] for r in (1, 2, 3)] == [k for _, k in order]


def test_relevance_by_group(spark):
    """One measure by pairs and by groups."""
    hits = spark.createDataFrame([(q, c, r) for q in (0, 1, 2, 3) for r, c in enumerate("abcd"[q:] + "xyz"[:q], 1)], "query_id long, chunk_id string, rank int")
    asked = spark.createDataFrame([(0, 7), (1, 8), (2, 9), (3, None)], "query_id long, group int")
    members = spark.createDataFrame([("a", 7), ("c", 7), ("d", 8), ("b", 8), ("b", 8), ("x", None)], "chunk_id string, group int")
    gains = members.distinct().withColumn("gain", F.when(F.col("chunk_id") == "c", 2.0).when(F.col("chunk_id") == "b", 1.0).otherwise(0.0))
    rows = lambda df: sorted(map(tuple, df.collect()))
    for k in (1, 2, 10):
        assert rows(evaluation.binary_by_group(hits, asked, members, k)) == rows(evaluation.binary(hits, asked.join(members, "group"), k))
        assert rows(evaluation.graded_ndcg_by_group(hits, asked, gains, k)) == rows(evaluation.graded_ndcg(hits, asked.join(gains, "group"), k))


def test_relevant_chunks_are_dealt(spark, monkeypatch):
    """Blocks of queries and chunks; what is in the result twice is taken out before pairs are made, not after."""
    monkeypatch.setattr(evaluation, "QUERIES_MET", 3)
    monkeypatch.setattr(evaluation, "CHUNKS_MET", 4)
    docs = [(q, d) for q in range(20) for d in range(3) if (q + d) % 2] + [(1, 0), (30, 9), (31, None)]
    own = [(c % 3, c) for c in range(40)] + [(0, 1), (2, 1), (5, 50), (None, 60)]
    declared = [(q, q * 2) for q in range(20)] * 2 + [(40, 1), (41, 99), (None, 3)]
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    out = evaluation.relevant_chunks(df(declared, "query_id long, chunk_id long"), df(docs, "query_id long, doc_id long"), df(own, "doc_id long, chunk_id long"))
    expected = set(declared) | {(q, c) for q, d in docs for e, c in own if d is not None and d == e}
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(expected) and set(found) == expected
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "Aggregate" not in plan.split("Generate explode(ids")[0].split("Union")[1].split("Join LeftAnti")[0]


def test_evidence_is_dealt_by_its_rows(spark, monkeypatch):
    """The number of tasks that add up evidence goes by the rows, not by the session; results stay."""
    t = spark.createDataFrame([(f"p{i % 7}", "r", f"s{i % 3}", i % 5, i % 11, 0.5) for i in range(60)], "sujeto string, relacion string, objeto string, doc_id int, chunk_id int, confianza double")
    q = spark.createDataFrame([("a", "p1"), ("a", "s0"), ("b", "s2"), ("c", "none")], "query_id string, entity string")
    whole = sorted(map(tuple, graph.evidence(t, q, 3).collect()))
    n = graph.scored_rows(t, q)
    monkeypatch.setattr(graph, "TASK_ROWS", n // 5)
    dealt = graph.evidence(t, q, 3)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == whole


def moved(df):
    """Rows that the shuffles of df wrote when it was collected."""

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def star_of(spark):
    """(triples, starts, names of starts, ends by entity, chunks by entity): 40 starts around 2 nodes of 300 chunks and 300
    further ends each, every triple of those twice; loops, nulls and a start that isn't there."""
    rows = [(f"a{i}", f"h{i % 2}", f"c{i % 5}") for i in range(40)] + [(f"h{j}", f"z{i}", f"c{i * 2 + j}") for i in range(300) for j in range(2)] * 2
    rows += [("a1", "a1", "own"), ("a1", None, "c9"), (None, "a2", "c9"), ("z3", "y", None), ("h0", "y", None), ("y", "x", "c1")]
    names = [f"a{i}" for i in range(40)] + ["a0", "x", "nobody"]
    links, chunks = {}, {}
    for s, o, c in rows:
        for x, y in ((s, o), (o, s)):
            chunks.setdefault(x, set()).add(c)
            if s != o and None not in (s, o):
                links.setdefault(x, set()).add(y)
    t = spark.createDataFrame([(s, "r", o, c) for s, o, c in rows], "sujeto string, relacion string, objeto string, chunk_id string")
    return t, spark.createDataFrame([(x,) for x in names], "start string"), names, links, chunks


def with_small_lists(monkeypatch):
    """Once with the limits as they are, once with lists in many parts."""
    yield
    for k, v in {"LIST_ROWS": 7, "TASK_ROWS": 500, "FEW": 0}.items():
        monkeypatch.setattr(graph, k, v)
    yield
    monkeypatch.undo()


def test_chunks_around_are_moved_as_lists(spark, monkeypatch):
    """A node's chunks go to its starts as one list, not as 40 * 300 rows; they are those of a search in Python."""
    t, starts, names, links, chunks = star_of(spark)
    near = starts.select("start", F.col("start").alias("entity")).unionAll(graph.neighbours(t, starts, 1).select("start", "entity"))
    values = graph.touches(t).select("entity", F.col("chunk_id").alias("value"))
    for _ in with_small_lists(monkeypatch):
        got = [tuple(r) for r in graph.gathered(near, values).collect()]
        assert len(got) == len(set(got)) and set(got) == {(x, c) for x in names for y in [x, *links.get(x, ())] for c in chunks.get(y, ())}
    df = graph.gathered(near, values)
    assert len(df.collect()) > 40 * 300 > 2 * moved(df)


def test_further_neighbours_are_moved_as_lists(spark, monkeypatch):
    """From the second step on, a node's neighbours go to its starts as one list; each entity is at its smallest distance."""
    t, starts, names, links, _ = star_of(spark)
    found = {}
    for x in names:
        front, seen = {x}, {x}
        for d in (1, 2, 3):
            front = {z for y in front for z in links.get(y, ())} - seen
            seen |= front
            found |= {(x, y, d): d for y in front}
    for _ in with_small_lists(monkeypatch):
        for depth in (1, 2, 3):
            got = [tuple(r) for r in graph.neighbours(t, starts, depth, lambda df: df.localCheckpoint()).select("start", "entity", "distance").collect()]
            assert len(got) == len(set(got)) and set(got) == {k for k, d in found.items() if d <= depth}
    df = graph.neighbours(t, starts, 2)
    assert len(df.collect()) > 40 * 300 > 2 * moved(df)


def batch_rows(spark, *made):
    """The session's limit on rows of an Arrow batch after each of some operators was called with Spark's own limit."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was, out = spark.conf.get(key), []
    try:
        for make in made:
            spark.conf.set(key, "10000")
            make()
            out.append(int(spark.conf.get(key)))
    finally:
        spark.conf.set(key, was)
    return out


def test_documents_reach_chunking_in_small_batches(spark):
    assert batch_rows(spark, lambda: chunking.chunk(document(spark, ("uno. dos.", True)))) == [500]


def test_texts_reach_encoders_in_small_batches(spark):
    t, e = spark.createDataFrame([("a b",)], "texto string"), encoding.ENCODERS.get("hashed-128")
    assert batch_rows(spark, lambda: encoding.inputs(t, e), lambda: encoding.encoded(t, e)) == [500, 500]
    made: list = []
    assert segment.fitted("One two. Three four. " * 500, 3, lambda s: made.append(s) or len(s.split()), adds=True) == "One two." and len(made) == 3


def test_retrieval_reads_stored_chunks_and_hits(spark, sf):
    """Chunks, vectors and hits are made once; means of cells are added up as vectors, not a row a dimension."""
    from fathomline.plans.registered import QUERIES
    import fathomline.plans.catalogue  # noqa: F401

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan(QUERIES["retrieve_end_to_end"](spark, sf))
    v = spark.createDataFrame([(1, [3.0, 0.0]), (1, [0.0, 4.0]), (2, [0.0, 2.0]), (2, None)], "cell int, vector array<float>")
    c = search.centroids(v, "cell")
    assert "Generate" not in plan(c) and {r.cell: [round(x, 9) for x in r.centroid] for r in c.collect()} == {1: [0.6, 0.8], 2: [0.0, 1.0]}


def test_gazetteer_normalises_a_word_once(monkeypatch):
    g = entities.Gazetteer((("of the", "OTRO", "of the"), ("the", "OTRO", "the"), ("1 2", "OTRO", "half")), False)
    made, own = [], entities.key
    monkeypatch.setattr(entities, "key", lambda name: made.append(name) or own(name))
    assert [(at, form) for at, form, *_ in g.find("Of the the of. The x ½ a " * 200)][:5] == [(0, "of the"), (7, "the"), (15, "the"), (21, "half"), (25, "of the")]
    assert len(made) <= 1


def test_a_stream_without_news_leaves_its_table(spark, tmp_path):
    from fathomline.streaming import streams

    def turn(n, *rows):
        spark.createDataFrame([*rows], "chunk_id string, doc_id string, texto string, hash_texto string").write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("chunk_id string, doc_id string, texto string, hash_texto string").parquet(f"{tmp_path}/in")
        streams.encoding(stream, f"{tmp_path}/table", ["hashed-128"], f"{tmp_path}/c{n}").awaitTermination()
        t = store.Table(spark, f"{tmp_path}/table").read()
        return sorted(t.inputFiles()), sorted((r.chunk_id, r.hash_texto) for r in t.collect())

    first = turn(1, ("a", "d", "x y", "1"), ("b", "d", "z", "2"))
    assert first[1] == [("a", "1"), ("b", "2")] and turn(2) == first
    assert turn(3, ("c", "d", "w", "3"))[1] == [("a", "1"), ("b", "2"), ("c", "3")]
    assert not (tmp_path / "table.new").exists()
