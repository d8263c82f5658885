"""Registered queries on graphs: lineitem rows as triples part - supplier in the chunk of their order."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from fathomline.operators import entities, fusion, graph
from fathomline.plans.registered import query, stored

TRIPLES = "t AS (SELECT 'p' || l_partkey AS s, 's' || l_suppkey AS o, l_orderkey AS chunk_id, l_orderkey % 97 AS doc_id, l_quantity / 50.0 AS conf FROM lineitem)"
EDGES = f"{TRIPLES}, e AS (SELECT DISTINCT * FROM (SELECT s AS a, o AS b FROM t UNION ALL SELECT o, s FROM t))"


def triples_of(table):
    return table("lineitem").select(
        F.concat(F.lit("p"), "l_partkey").alias("sujeto"), F.lit("SUMINISTRA").alias("relacion"), F.concat(F.lit("s"), "l_suppkey").alias("objeto"), (F.col("l_orderkey") % 97).alias("doc_id"), F.col("l_orderkey").alias("chunk_id"), (F.col("l_quantity") / 50.0).alias("confianza")
    )


def starts_of(table):
    """(start): the parts and suppliers whose key is divisible by 100."""
    return table("part").filter("p_partkey % 100 = 0").select(F.concat(F.lit("p"), "p_partkey").alias("start")).unionAll(table("supplier").filter("s_suppkey % 100 = 0").select(F.concat(F.lit("s"), "s_suppkey")))


def asked_of(table):
    """A query for each of the starts, under its own name, and one for an entity that isn't there."""
    own = starts_of(table).select(F.col("start").alias("query_id"), F.col("start").alias("entity"))
    return own.unionAll(table("region").limit(1).select(F.lit("none").alias("query_id"), F.lit("absent").alias("entity")))


STARTS = "st AS (SELECT 'p' || p_partkey AS start FROM part WHERE p_partkey % 100 = 0 UNION ALL SELECT 's' || s_suppkey FROM supplier WHERE s_suppkey % 100 = 0)"
ASKED = f"{STARTS}, q AS (SELECT start AS query_id, start AS entity FROM st UNION ALL SELECT 'none', 'absent')"


@query(f"WITH {EDGES}, n AS (SELECT a, count(*) AS n_neighbours FROM e GROUP BY a), x AS (SELECT s AS entity FROM t UNION ALL SELECT o FROM t) SELECT entity, count(*) AS n_triples, min(n_neighbours) AS n_neighbours FROM x JOIN n ON n.a = entity GROUP BY entity")
def graph_degree(table, spark):
    return graph.degree(triples_of(table))


def _near(table, spark, depth):
    return graph.neighbours(triples_of(table), starts_of(table), depth, partial(stored, name="front")).select("start", "entity", F.col("distance").cast("long").alias("distance"))


query(f"WITH {EDGES}, {STARTS} SELECT start, b AS entity, 1::BIGINT AS distance FROM st JOIN e ON a = start", "graph_neighbors_1")(partial(_near, depth=1))
query(f"""WITH {EDGES}, {STARTS}, one AS (SELECT start, b AS x FROM st JOIN e ON a = start), two AS (SELECT DISTINCT start, b AS x FROM one JOIN e ON a = x WHERE b <> start)
SELECT start, x AS entity, 1::BIGINT AS distance FROM one UNION ALL SELECT start, x, 2 FROM two WHERE (start, x) NOT IN (SELECT start, x FROM one)""", "graph_neighbors_2")(partial(_near, depth=2))

EVIDENCE = f"""WITH {EDGES}, {ASKED}, w AS (SELECT query_id, entity, 1.0::DOUBLE AS w FROM q UNION ALL SELECT query_id, b, 0.5 FROM q JOIN e ON a = entity),
x AS (SELECT s AS entity, chunk_id, doc_id FROM t UNION ALL SELECT o, chunk_id, doc_id FROM t),
ev AS (SELECT query_id, chunk_id, max(doc_id) AS doc_id, sum(w) AS score FROM w JOIN x USING (entity) GROUP BY query_id, chunk_id)"""


@query(f"{EVIDENCE} SELECT query_id, chunk_id, doc_id, round(score, 6) AS score FROM ev")
def graph_evidence(table, spark):
    return graph.evidence(triples_of(table), asked_of(table)).select("query_id", "chunk_id", "doc_id", F.round("score", 6).alias("score"))


@query(f"""{EVIDENCE}, g AS (SELECT query_id, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS r FROM ev) WHERE r <= 5),
rel AS (SELECT DISTINCT query_id, entity FROM w), f AS (SELECT query_id, chunk_id, s, o, max(conf) AS conf FROM g JOIN t USING (chunk_id) WHERE (query_id, s) IN (SELECT query_id, entity FROM rel) OR (query_id, o) IN (SELECT query_id, entity FROM rel) GROUP BY query_id, chunk_id, s, o)
SELECT query_id, chunk_id, s AS sujeto, o AS objeto, place FROM (SELECT *, row_number() OVER (PARTITION BY query_id, chunk_id ORDER BY conf DESC, s, o) AS place FROM f) WHERE place <= 10""")
def graph_explain(table, spark):
    t = triples_of(table)
    targets = graph.evidence(t, asked_of(table), 5)
    return graph.explanation(t, asked_of(table), targets).select("query_id", "chunk_id", "sujeto", "objeto", F.col("place").cast("long").alias("place"))


@query("WITH m AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) SELECT a.l_orderkey, a.l_partkey AS sujeto, b.l_partkey AS objeto FROM m a JOIN m b ON a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey")
def cooccurrence_pairs(table, spark):
    return graph.cooccurrence(table("lineitem"), ["l_orderkey"], "l_partkey")


@query("SELECT DISTINCT 's' || l_suppkey AS entity FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0) UNION SELECT DISTINCT 'p' || l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)")
def graph_orphans(table, spark):
    """Referential integrity against all parts and the even suppliers."""
    known = table("part").select(F.concat(F.lit("p"), "p_partkey").alias("id")).unionAll(table("supplier").filter("s_suppkey % 2 = 0").select(F.concat(F.lit("s"), "s_suppkey")))
    return graph.orphans(triples_of(table), known)


@query("SELECT 'p' || l_partkey AS id, max_by(l_quantity, l_orderkey * 100 + l_linenumber) AS nombre FROM lineitem GROUP BY l_partkey")
def entity_last_write(table, spark):
    e = table("lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("id"), F.col("l_quantity").alias("nombre"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("n"))
    return graph.last_written(e, "n").select("id", "nombre")


@query(f"""{EVIDENCE}, gr AS (SELECT query_id, chunk_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM ev),
p AS (SELECT query_id, chunk_id, rank FROM gr WHERE rank <= 20 UNION ALL SELECT (SELECT min(start) FROM st), o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) FROM orders QUALIFY row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) <= 20)
SELECT query_id, chunk_id, round(CASE WHEN query_id = (SELECT min(start) FROM st) THEN sum(1.0::DOUBLE / (60 + rank)) ELSE max((SELECT score FROM gr g WHERE g.query_id = p.query_id AND g.chunk_id = p.chunk_id)) END, 9) AS score FROM p GROUP BY query_id, chunk_id""")
def hybrid_rrf(table, spark):
    """The graph channel, and for one query a second channel of orders by price; the other queries have one channel only."""
    g = graph.evidence(triples_of(table), asked_of(table), 20).select("query_id", F.lit("graph").alias("channel"), "chunk_id", "doc_id", "rank", "score")
    top = table("orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
    from pyspark.sql.window import Window

    ranked = top.crossJoin(starts_of(table).agg(F.min("start").alias("query_id"))).select("query_id", F.lit("vector").alias("channel"), F.col("o_orderkey").alias("chunk_id"), (F.col("o_orderkey") % 97).alias("doc_id"), F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("rank"), F.col("o_totalprice").cast("double").alias("score"))
    return fusion.combined(g.unionByName(ranked), "rrf").select("query_id", "chunk_id", F.round("score", 9).alias("score"))


WORDS = ("the", "and", "that", "reading", "token", "license", "idiot", "of the")


def _plain(t: str) -> str:
    """Lower case without accents, every other letter beyond ASCII as one z, so that word bounds are ASCII ones."""
    return rf"regexp_replace(lower(strip_accents({t})), '[À-ÖØ-öø-ɏ]', 'z', 'g')"


#: "of the" goes before "the"; masked, it holds no other form.
_OF_THE = r"\bof([^\w.!?\n]+)the\b"
_FORMS = ", ".join(f"('{w}')" for w in WORDS)


@query(rf"""WITH d AS (SELECT doc_id, {_plain('text')} AS t FROM documents), m AS (SELECT doc_id, t, regexp_replace(t, '{_OF_THE}', 'xx\1xxx', 'g') AS masked FROM d),
x AS (SELECT doc_id, w AS id, CASE WHEN w = 'of the' THEN t ELSE masked END AS t, CASE WHEN w = 'of the' THEN '\bof[^\w.!?\n]+the\b' ELSE '\b' || w || '\b' END AS p FROM m, (VALUES {_FORMS}) v(w))
SELECT doc_id, id, len(regexp_extract_all(t, p)) AS n, length(regexp_extract(t, '(?s)^(.*?)' || p, 1)) AS first FROM x WHERE regexp_matches(t, p)""")
def gazetteer_entities(table, spark):
    """Mentions of a small vocabulary in whole texts, counted by document."""
    found = entities.mentions(table("documents"), tuple((w, "OTRO", w) for w in WORDS), proper_nouns=False, id_col="doc_id", text_col="text")
    return found.groupBy("doc_id", "id").agg(F.count("*").alias("n"), F.min("position").alias("first"))


_TYPES = " ".join(f"WHEN regexp_matches(k, '{'|'.join(stems)}') THEN '{kind}'" for kind, stems in graph.VERBS)


@query(rf"""WITH s AS (SELECT conv_id AS doc_id, conv_id || '-' || turn AS chunk_id, trim(unnest(string_split(regexp_replace(text, '([.!?。！？])\s+', '\1' || chr(1), 'g'), chr(1)))) AS s FROM conversations),
n AS (SELECT doc_id, chunk_id, row_number() OVER () AS r, {_plain('s')} AS t, trim(regexp_replace(regexp_replace(lower(strip_accents(s)), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS k FROM s WHERE s <> ''),
m AS (SELECT n.*, w FROM (SELECT *, regexp_replace(t, '{_OF_THE}', 'xx\1xxx', 'g') AS masked FROM n) n, (VALUES {_FORMS}) v(w) WHERE CASE WHEN w = 'of the' THEN regexp_matches(t, '{_OF_THE}') ELSE regexp_matches(masked, '\b' || w || '\b') END),
p AS (SELECT a.doc_id, a.chunk_id, a.w AS sujeto, b.w AS objeto, CASE {_TYPES.replace('(k,', '(a.k,')} ELSE 'COOCURRENCIA' END AS relacion FROM m a JOIN m b ON a.r = b.r AND a.w <> b.w)
SELECT doc_id, chunk_id, sujeto, relacion, objeto, CASE WHEN relacion = 'COOCURRENCIA' THEN 0.6 ELSE 0.9 END::DOUBLE AS confianza FROM p GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY doc_id, chunk_id, sujeto, relacion, objeto"))
def symbolic_relations(table, spark):
    """Sentences of conversations, entities by vocabulary, relations by verb."""
    from fathomline.functions import text

    s = table("conversations").select(F.col("conv_id").alias("doc_id"), F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.posexplode(text.sentences(F.col("text"))).alias("n", "texto"))
    keyed = s.withColumn("key", F.concat_ws("#", "chunk_id", "n"))
    m = entities.mentions(keyed, tuple((w, "OTRO", w) for w in WORDS), proper_nouns=False, id_col="key").join(keyed.select("key", "chunk_id", "n"), "key").select("chunk_id", "n", F.col("id").alias("entity"))
    return graph.symbolic_triples(s, m)


@query(f"WITH {EDGES}, {STARTS}, one AS (SELECT start, b AS x FROM st JOIN e ON a = start UNION SELECT start, start FROM st), h AS (SELECT s AS x, chunk_id FROM t UNION ALL SELECT o, chunk_id FROM t) SELECT DISTINCT start, chunk_id FROM one JOIN h USING (x)")
def neighbourhood_chunks(table, spark):
    """Chunks of an entity and of its direct neighbours."""
    t = triples_of(table)
    starts = starts_of(table)
    near = stored(graph.neighbours(t, starts, 1).select("start", "entity").unionAll(starts.select("start", F.col("start").alias("entity"))), "near")
    return graph.gathered(near, graph.touches(t).select("entity", F.col("chunk_id").alias("value"))).select("start", F.col("value").alias("chunk_id"))


@query("SELECT 'o' || o_custkey AS id, arg_min(o_totalprice, o_orderkey)::DOUBLE AS nombre, count(DISTINCT o_totalprice) AS variantes FROM orders GROUP BY o_custkey")
def entity_merge(table, spark):
    """Mentions of one id: the first one's name, and how many names there are."""
    m = table("orders").select(F.concat(F.lit("o"), "o_custkey").alias("id"), F.col("o_totalprice").cast("string").alias("nombre"), F.lit("OTRO").alias("tipo"), F.col("o_orderkey").alias("position"))
    return graph.merged_entities(m).select("id", F.col("nombre").cast("double").alias("nombre"), F.size("variantes").cast("long").alias("variantes"))


@query("SELECT l_orderkey, 'p' || l_partkey AS h, 'ES_PARTE_DE' AS r, 's' || l_suppkey AS t FROM lineitem")
def triplet_parser(table, spark):
    """Generated triplet strings of order lines, parsed and mapped to relation types."""
    from pyspark.sql.functions import pandas_udf

    from fathomline.operators.relations import PHRASES

    made = F.concat(F.lit("<s><triplet> p"), "l_partkey", F.lit(" <subj> s"), "l_suppkey", F.lit(" <obj> part of</s>"))
    parse = pandas_udf(lambda t: t.map(lambda x: [{"h": a, "r": PHRASES.get(r, "RELACIONADO_CON"), "t": b} for a, r, b in entities.parse_triplets(x)]), "array<struct<h:string,r:string,t:string>>")
    return table("lineitem").select("l_orderkey", F.explode(parse(made)).alias("x")).select("l_orderkey", "x.*")
