"""Registered queries on stored tables: upserts, deletes, reads, deliveries, reports, incremental tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.functions import text
from fathomline.operators import evaluation, export, graph, store, validation
from fathomline.plans.graph_queries import EVIDENCE, asked_of, triples_of
from fathomline.plans.registered import query, shared_path
from fathomline.plans.stream_queries import events
from fathomline.streaming import streams


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 > 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def table_upsert_newest(table, spark):
    """A stored table of even keys; every third key comes again, newer unless divisible by four: the newest row stays."""
    o = table("orders").select("o_orderkey", "o_custkey", F.lit(5).alias("version"))
    t = store.Table(spark, shared_path(spark, "orders"))
    t.upsert(o.filter("o_orderkey % 2 = 0"), ["o_orderkey"], order="version")
    t.upsert(o.filter("o_orderkey % 3 = 0").withColumn("version", F.when(F.col("o_orderkey") % 4 == 0, F.when(F.col("o_orderkey") % 2 == 0, 4).otherwise(5)).otherwise(6)).withColumn("o_custkey", F.col("o_custkey") + 1), ["o_orderkey"], order="version")
    return t.read().select("o_orderkey", "o_custkey")


@query("SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN -vec_id ELSE vec_id END AS internal_id FROM embeddings WHERE vec_id % 4 > 0")
def table_delete_vectors(table, spark):
    """Vectors of some chunks deleted, internal ids of others set."""
    t = store.Table(spark, shared_path(spark, "vectors"))
    t.replace(table("embeddings").select("vec_id", F.col("vec_id").alias("internal_id"), "embedding"))
    t.delete(table("embeddings").filter("vec_id % 4 = 0").select("vec_id"), ["vec_id"])
    t.set_column("internal_id", table("embeddings").filter("vec_id % 5 = 0").select("vec_id", (-F.col("vec_id")).alias("internal_id")), ["vec_id"])
    return t.read().select("vec_id", "internal_id")


@query("SELECT vec_id AS chunk_id, label FROM embeddings WHERE vec_id IN (SELECT item_id FROM benchmark)")
def find_by_ids(table, spark):
    own = table("embeddings").select(F.col("vec_id").alias("chunk_id"), "label")
    return store.find_by_ids(own, table("benchmark").select(F.col("item_id").alias("chunk_id")))


@query("SELECT label AS encoder_name, count(*) AS n FROM embeddings GROUP BY label")
def count_by_encoder(table, spark):
    return store.count_by_encoder(table("embeddings").select(F.col("label").alias("encoder_name")))


@query("SELECT conv_id AS chunk_id, min(turn) AS first FROM conversations WHERE conv_id NOT IN (SELECT vec_id FROM embeddings WHERE vec_id % 2 = 0) GROUP BY conv_id")
def missing_in_order(table, spark):
    """Distinct ids without a vector, and where each first occurs."""
    ids = table("conversations").select(F.col("conv_id").alias("chunk_id"), "turn")
    return store.missing(ids, table("embeddings").filter("vec_id % 2 = 0").select(F.col("vec_id").alias("chunk_id")), order="turn")


@query("SELECT vec_id::VARCHAR AS chunk_id, label::VARCHAR AS doc_id, 64 AS dim, row_number() OVER (ORDER BY label::VARCHAR, vec_id, vec_id::VARCHAR) - 1 AS vec_ordinal FROM embeddings WHERE vec_id % 3 > 0")
def delivery_roundtrip(table, spark):
    """A delivery of the vectors that are there, written, checked and loaded again; ordinals say the order."""
    e = table("embeddings")
    chunks = e.select(F.col("vec_id").cast("string").alias("chunk_id"), F.col("label").cast("string").alias("doc_id"), F.lit("f").alias("fuente"), F.lit("txt").alias("formato"), F.lit(1).alias("fenomeno"), F.col("vec_id").alias("posicion"), F.lit(1).alias("num_tokens"), F.lit("t").alias("texto"))
    path = shared_path(spark, "delivery")
    export.delivery(chunks, e.filter("vec_id % 3 > 0").select(F.col("vec_id").cast("string").alias("chunk_id"), F.col("embedding").alias("vector")), path, partial=True)
    vectors, _ = export.load_delivery(spark, path)
    ordinals = spark.read.parquet(f"{path}/index").select("chunk_id", "vec_ordinal")
    return vectors.select("chunk_id", "doc_id", F.size("vector").alias("dim")).join(ordinals, "chunk_id")


@query("""WITH d AS (SELECT c_custkey AS query_id, c_nationkey AS doc_id FROM customer WHERE c_custkey % 10 = 0)
SELECT DISTINCT query_id, chunk_id FROM (SELECT c_custkey AS query_id, c_custkey * 3 AS chunk_id FROM customer UNION ALL SELECT query_id, s_suppkey FROM d JOIN supplier ON s_nationkey = doc_id)""")
def relevant_chunks(table, spark):
    """Declared chunks, and all chunks of relevant documents."""
    c = table("customer")
    declared = c.select(F.col("c_custkey").alias("query_id"), (F.col("c_custkey") * 3).alias("chunk_id"))
    docs = c.filter("c_custkey % 10 = 0").select(F.col("c_custkey").alias("query_id"), F.col("c_nationkey").alias("doc_id"))
    return evaluation.relevant_chunks(declared, docs, table("supplier").select(F.col("s_nationkey").alias("doc_id"), F.col("s_suppkey").alias("chunk_id")))


@query("""WITH f AS (SELECT item_id AS query_id, CASE item_id % 3 WHEN 0 THEN '¡' || text || '!!' WHEN 1 THEN 'before ' || text || ' after' ELSE 'something else' END AS texto FROM benchmark)
SELECT query_id, CASE WHEN query_id % 3 < 2 THEN 1 + query_id % 4 ELSE 0 END::DOUBLE AS relevancia FROM f""")
def text_relevance(table, spark):
    """Fragments that equal a relevant text, hold it, or have nothing to do with it."""
    b = table("benchmark")
    texto = F.when(F.col("item_id") % 3 == 0, F.concat(F.lit("¡"), "text", F.lit("!!"))).when(F.col("item_id") % 3 == 1, F.concat(F.lit("before "), "text", F.lit(" after"))).otherwise("something else")
    fragments = b.select(F.col("item_id").alias("query_id"), F.lit(1).alias("rank"), texto.alias("texto"))
    truth = b.select(F.col("item_id").alias("query_id"), F.col("text").alias("texto"), (1 + F.col("item_id") % 4).cast("double").alias("relevancia"))
    return evaluation.text_relevance(fragments, truth).select("query_id", "relevancia")


_TERMS = "list_distinct(list_filter(regexp_extract_all(lower({t}), '[a-záéíóúñü]{{4,}}'), lambda w: NOT list_contains([" + ", ".join(f"'{w}'" for w in sorted(evaluation.AUDIT_STOP)) + "], w)))"


@query(f"""WITH q AS (SELECT printf('q%03d', item_id) AS query_id, CASE WHEN item_id <= 16 THEN 1 WHEN item_id <= 32 THEN 2 ELSE 3 END AS expected, {_TERMS.format(t='text')} AS terms FROM benchmark),
f AS (SELECT printf('q%03d', doc_id) AS query_id, doc_id % 3 + 1 AS topic, {_TERMS.format(t='text')} AS seen FROM documents WHERE doc_id < 1000)
SELECT query_id, expected, topic AS top_topic, CASE WHEN topic = expected THEN 1.0 WHEN topic IS NOT NULL THEN 0.0 END::DOUBLE AS on_topic, round(CASE WHEN topic IS NULL THEN NULL WHEN len(terms) = 0 THEN 0 ELSE len(list_intersect(terms, seen)) / len(terms)::DOUBLE END, 6)::DOUBLE AS overlap,
  CASE WHEN topic IS NULL THEN 'none' WHEN topic = expected THEN 'on topic' WHEN len(terms) > 0 AND len(list_intersect(terms, seen)) / len(terms)::DOUBLE >= 0.5 THEN 'partial' ELSE 'weak' END AS verdict FROM q LEFT JOIN f USING (query_id)""")
def result_audit(table, spark):
    """Benchmark items as queries with one document each, that of the same number: topics, terms, verdict."""
    queries = table("benchmark").select(F.format_string("q%03d", "item_id").alias("query_id"), F.col("text").alias("query_text"))
    found = table("documents").filter("doc_id < 1000").select(F.format_string("q%03d", "doc_id").alias("query_id"), F.lit(1).alias("rank"), "doc_id", F.col("text").alias("texto"))
    out = evaluation.audit(queries, found, found, lambda d: (d % 3 + 1).cast("int"))
    return out.withColumn("overlap", F.round("overlap", 6))


@query(r"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat_ws(',', CASE WHEN NOT regexp_matches(trim(text, ' '), '[.!?»›]$') THEN 'sin_cierre' END, CASE WHEN NOT regexp_matches(trim(text, ' '), '^["''«“¡¿(\p{Lu}]') THEN 'sin_apertura' END) END AS avisos FROM documents""")
def chunk_warnings(table, spark):
    """Soft findings of validation; tables have none."""
    own = table("documents").select("doc_id", F.col("text").alias("texto"), F.when(F.col("doc_id") % 4 == 0, "csv").otherwise("txt").alias("formato"))
    return own.select("doc_id", F.array_join(validation.warnings(), ",").alias("avisos"))


@query(f"""{EVIDENCE}, g AS (SELECT query_id, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS r FROM ev) WHERE r <= 3),
nb AS (SELECT query_id, list_sort(list(DISTINCT b)) AS neighbours FROM q JOIN e ON a = entity GROUP BY query_id),
c AS (SELECT query_id, count(*) AS n_chunks FROM g GROUP BY query_id)
SELECT query_id, entity AS entities, sha256(array_to_string(neighbours, ',')) AS neighbours, n_chunks FROM q LEFT JOIN nb USING (query_id) LEFT JOIN c USING (query_id)""")
def graph_paths(table, spark):
    """The explanation of each query as one object: entities, neighbours, explained chunks."""
    t = triples_of(table)
    out = graph.paths(t, asked_of(table), graph.evidence(t, asked_of(table), 3))
    return out.select("query_id", F.array_join("entities", ",").alias("entities"), text.text_hash(F.array_join("neighbours", ",")).alias("neighbours"), F.size(F.filter("chunks", lambda c: c["aporto"])).cast("long").alias("n_chunks"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY user_id")
def stream_upsert(table, spark):
    """A stream of events kept as one row a user, the newest."""
    path = shared_path(spark, "stream")
    rows = events(table, spark).select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), F.struct("ts", "event_id").alias("at"))
    streams.upserting(rows, f"{path}/table", ["user_id"], f"{path}/checkpoint", order="at").awaitTermination()
    return store.Table(spark, f"{path}/table").read().select("user_id", "event_type", "ts")


@query("SELECT ('0x' || substr(sha1(user_id::VARCHAR), 1, 15))::BIGINT AS stable_id, user_id AS chunk_id, round(arg_max(value, (ts, event_id)), 4) AS value FROM events GROUP BY user_id HAVING arg_max(event_id, (ts, event_id)) % 5 > 0")
def stream_index(table, spark):
    """A stream of vectors kept as an index; keys whose last event is a deletion are out."""
    path = shared_path(spark, "index")
    rows = events(table, spark).select(F.col("user_id").alias("chunk_id"), F.array(F.round("value", 4)).alias("vector"), (F.col("event_id") % 5 == 0).alias("deleted"), F.struct("ts", "event_id").alias("at"))
    streams.indexing(rows, f"{path}/table", f"{path}/checkpoint", order="at").awaitTermination()
    return streams.indexed(spark, f"{path}/table").select("stable_id", "chunk_id", F.col("vector")[0].alias("value"))


@query("SELECT doc_id::VARCHAR AS chunk_id, 128 AS dim, sha256(text) AS hash_texto FROM documents WHERE regexp_matches(text, '\\S')")
def stream_encode(table, spark):
    """A stream of chunks, encoded where the table lacks their id and text; a second run has nothing to do."""
    path = shared_path(spark, "encoded")
    batch = table("documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("doc_id").cast("string").alias("doc_id"), F.col("text").alias("texto"), text.text_hash(F.col("text")).alias("hash_texto"))
    batch.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(batch.schema).parquet(f"{path}/in")
    for turn in ("first", "second"):
        streams.encoding(stream, f"{path}/table", ["hashed-128"], f"{path}/{turn}").awaitTermination()
    return store.Table(spark, f"{path}/table").read().select("chunk_id", F.size("vector").alias("dim"), "hash_texto")
