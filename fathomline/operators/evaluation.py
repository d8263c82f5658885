"""Ranking quality.  hits: (query_id, chunk_id, rank); qrels: (query_id, chunk_id), one row a relevant chunk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomline.functions.text import entity_key, file_name


def _log2(c: Column) -> Column:
    return F.log2(c.cast("double"))


def binary(hits: DataFrame, qrels: DataFrame, k: int = 10) -> DataFrame:
    """A row for each query with relevant chunks: precision, recall, mrr, ndcg at k (mrr over all ranks)."""
    relevant = qrels.select("query_id", "chunk_id").distinct()
    n = relevant.groupBy("query_id").agg(F.count("*").alias("n"))
    return _measured(hits.join(relevant.withColumn("rel", F.lit(1)), ["query_id", "chunk_id"], "left"), n, k)


def _measured(judged: DataFrame, n: DataFrame, k: int) -> DataFrame:
    """Measures of hits with `rel`, 1 or null, for the queries n (query_id, n)."""
    hit = judged.withColumn("rel", F.coalesce("rel", F.lit(0)))
    top = F.when(F.col("rank") <= k, F.col("rel")).otherwise(0)
    agg = hit.groupBy("query_id").agg(F.sum(top).alias("found"), F.coalesce(1.0 / F.min(F.when(F.col("rel") == 1, F.col("rank"))), F.lit(0.0)).alias("mrr"), F.sum(top / _log2(F.col("rank") + 1)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1.0 / _log2(i + 1))
    joined = n.join(agg, "query_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return joined.select("query_id", zero(F.col("found") / max(k, 1)).alias("precision"), zero(F.col("found") / F.col("n")).alias("recall"), zero(F.col("mrr")).alias("mrr"), zero(F.col("dcg") / ideal).alias("ndcg"))


def _of_group(hits: DataFrame, asked: DataFrame, members: DataFrame) -> DataFrame:
    """Hits whose chunk is a member of their query's group, with the members' columns."""
    return hits.join(asked.select("query_id", "group"), "query_id").join(members, ["chunk_id", "group"])


def binary_by_group(hits: DataFrame, asked: DataFrame, members: DataFrame, k: int = 10) -> DataFrame:
    """As binary, where all members (chunk_id, group) of a query's group (query_id, group; one a query) are relevant:
    pairs of query and relevant chunk are only made of hits, so groups may be large."""
    members = members.select("chunk_id", "group").distinct()
    n = asked.select("query_id", "group").join(members.groupBy("group").agg(F.count("*").alias("n")), "group").select("query_id", "n")
    relevant = _of_group(hits.select("query_id", "chunk_id").distinct(), asked, members).select("query_id", "chunk_id", F.lit(1).alias("rel"))
    return _measured(hits.join(relevant, ["query_id", "chunk_id"], "left"), n, k)


def summary(per_query: DataFrame) -> DataFrame:
    """One row: means over the evaluated queries and their number; 0 where there is none."""
    return per_query.agg(F.count("*").alias("n_queries"), *(F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in ("precision", "recall", "mrr", "ndcg")))


def graded_ndcg(hits: DataFrame, gains: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, ndcg) with linear gains (query_id, chunk_id, gain); 1 where no gain is positive."""
    best = _ideal(gains, "query_id", k)
    return _graded(hits.filter(F.col("rank") <= k).join(gains, ["query_id", "chunk_id"]), best)


def _ideal(gains: DataFrame, by: str, k: int) -> DataFrame:
    """(by, idcg): the gain of the best k."""
    order = gains.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("gain"), "chunk_id"))).filter(F.col("r") <= k)
    return order.groupBy(by).agg(F.sum(F.col("gain") / _log2(F.col("r") + 1)).alias("idcg"))


def _graded(judged: DataFrame, best: DataFrame) -> DataFrame:
    got = judged.groupBy("query_id").agg(F.sum(F.col("gain") / _log2(F.col("rank") + 1)).alias("dcg"))
    return best.join(got, "query_id", "left").select("query_id", F.when(F.col("idcg") <= 0, 1.0).otherwise(F.coalesce("dcg", F.lit(0.0)) / F.col("idcg")).alias("ndcg"))


def graded_ndcg_by_group(hits: DataFrame, asked: DataFrame, gains: DataFrame, k: int = 10) -> DataFrame:
    """As graded_ndcg, where a query (query_id, group; one a query) has the gains of its group (chunk_id, group, gain):
    the ideal order is found once a group."""
    best = asked.select("query_id", "group").join(_ideal(gains, "group", k), "group").select("query_id", "idcg")
    return _graded(_of_group(hits.filter(F.col("rank") <= k), asked, gains), best)


def text_relevance(fragments: DataFrame, truth: DataFrame) -> DataFrame:
    """fragments (query_id, rank, texto) with relevancia: the largest of the truth texts (query_id, texto, relevancia)
    that equal or hold the fragment or are held by it, all normalised; else 0."""
    t = truth.select("query_id", entity_key(F.col("texto")).alias("_t"), F.col("relevancia").alias("_r"))
    f = fragments.withColumn("_f", entity_key(F.col("texto")))
    matched = f.join(t, "query_id", "left").withColumn("_hit", F.when(F.col("_f").contains(F.col("_t")) | F.col("_t").contains(F.col("_f")), F.col("_r")))
    return matched.groupBy(*fragments.columns).agg(F.coalesce(F.max("_hit"), F.lit(0.0)).alias("relevancia"))


def f1_at_3(documents: DataFrame, truth: DataFrame) -> DataFrame:
    """(query_id, precision, recall, f1): the first three documents (query_id, doc_id, rank) against truth (query_id,
    doc_id), by file name."""
    gold = truth.select("query_id", file_name(F.col("doc_id").cast("string")).alias("name")).distinct()
    n = gold.groupBy("query_id").agg(F.count("*").alias("n"))
    hits = documents.filter("rank <= 3").select("query_id", file_name(F.col("doc_id").cast("string")).alias("name")).distinct().join(gold, ["query_id", "name"]).groupBy("query_id").agg(F.count("*").alias("hits"))
    out = n.join(hits, "query_id", "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    p, r = F.col("hits") / 3.0, F.col("hits") / F.least("n", F.lit(3))
    return out.select("query_id", p.alias("precision"), r.alias("recall"), F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r)).alias("f1"))


#: Queries and chunks of one document that meet in one task: 2,000 times 5,000 pairs at most or so.
QUERIES_MET, CHUNKS_MET = 2_000, 5_000


def relevant_chunks(declared: DataFrame, relevant_docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """(query_id, chunk_id): declared chunks (query_id, chunk_id), and all chunks of relevant documents (query_id, doc_id).

    The pairs are the result, queries times chunks of each document.  They are made where blocks of queries meet blocks of
    chunks, so a document of many of both is no one task's work, and they aren't shuffled: what could be twice is taken
    out of the inputs before.
    """
    docs = relevant_docs.select("query_id", "doc_id").filter("doc_id is not null").distinct()
    own = chunks.select("doc_id", "chunk_id").filter("doc_id is not null").distinct()
    several = own.groupBy("chunk_id").agg(F.count("*").alias("n")).filter("n > 1").select("chunk_id")  # of several documents
    same = F.col("chunk_id").eqNullSafe(F.col("_c"))
    several = several.withColumnRenamed("chunk_id", "_c")
    of_docs = _met(docs, own.join(several, same, "left_anti"))
    of_several = docs.join(own.join(several, same, "left_semi"), "doc_id").select("query_id", "chunk_id").distinct()
    pairs = declared.select("query_id", "chunk_id").distinct()
    known = pairs.join(own, "chunk_id").join(docs, ["query_id", "doc_id"], "left_semi").select(F.col("query_id").alias("_q"), F.col("chunk_id").alias("_c"))
    rest = pairs.join(known, (F.col("query_id") == F.col("_q")) & (F.col("chunk_id") == F.col("_c")), "left_anti")
    return rest.unionByName(of_docs).unionByName(of_several)


def _met(docs: DataFrame, own: DataFrame) -> DataFrame:
    """(query_id, chunk_id) of docs (query_id, doc_id) and own (doc_id, chunk_id), by blocks of both."""

    def blocks(df: DataFrame, most: int) -> DataFrame:
        return df.groupBy("doc_id").agg(F.count("*").alias("n")).select("doc_id", F.ceil(F.col("n") / most).cast("int").alias("n"))

    of_queries, of_chunks = blocks(docs, QUERIES_MET).withColumnRenamed("n", "nq"), blocks(own, CHUNKS_MET).withColumnRenamed("n", "nc")
    counts = of_queries.join(of_chunks, "doc_id")
    places = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    packed = own.join(counts, "doc_id").withColumn("c", F.pmod(F.xxhash64("chunk_id"), "nc").cast("int")).groupBy("doc_id", "nq", "c").agg(F.collect_list("chunk_id").alias("ids"))
    right = packed.select("doc_id", places("nq").alias("q"), "c", "ids")
    left = docs.join(counts, "doc_id").withColumn("q", F.pmod(F.xxhash64("query_id"), "nq").cast("int")).select("query_id", "doc_id", "q", places("nc").alias("c"))
    # dealt by all three, so that neither side is gathered by document
    return left.hint("shuffle_hash").join(right.hint("shuffle_hash"), ["doc_id", "q", "c"]).select("query_id", F.explode("ids").alias("chunk_id"))


#: Words that say nothing about a query's topic.
AUDIT_STOP = frozenset("cómo que de el la los las en y a al con por para qué cuáles cuál cuales su sus se un una del es son han esta este estas estos está están ha como más desde sobre entre cual o e i u no lo le".split())


def audit_terms(t: Column) -> Column:
    """The different words of four letters or more of a text that aren't stop words."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(t), F.lit("[a-záéíóúñü]{4,}"), F.lit(0)), lambda w: ~w.isin(*sorted(AUDIT_STOP))))


def audit(queries: DataFrame, documents: DataFrame, fragments: DataFrame, topic_of: Callable[[Column], Column], edges: tuple[int, int] = (16, 32)) -> DataFrame:
    """(query_id, expected, top_topic, on_topic, overlap, verdict) for each query (query_id, query_text).

    The expected topic goes by the query's number: 1 up to the first edge, 2 up to the second, else 3.  on_topic is the
    share of fragments (query_id, doc_id, texto) whose document has it, overlap the share of the query's terms that its
    fragments hold; topic_of makes a topic of a doc_id.  A query without results has the verdict `none`.
    """
    number = F.regexp_extract("query_id", r"(\d+)", 1).cast("int")
    asked = queries.select("query_id", F.when(number <= edges[0], 1).when(number <= edges[1], 2).otherwise(3).alias("expected"), audit_terms(F.col("query_text")).alias("_terms"))
    top = documents.filter("rank = 1").groupBy("query_id").agg(F.min(topic_of(F.col("doc_id"))).alias("top_topic"))
    own = fragments.join(asked.select("query_id", "expected"), "query_id")
    seen = own.groupBy("query_id").agg(F.avg((topic_of(F.col("doc_id")) == F.col("expected")).cast("double")).alias("on_topic"), F.array_distinct(F.flatten(F.collect_list(audit_terms(F.col("texto"))))).alias("_seen"))
    out = asked.join(top, "query_id", "left").join(seen, "query_id", "left")
    overlap = F.when(F.size("_terms") == 0, 0.0).otherwise(F.size(F.array_intersect("_terms", "_seen")) / F.size("_terms"))
    verdict = F.when(F.col("on_topic").isNull(), "none").when((F.col("top_topic") == F.col("expected")) & (F.col("on_topic") >= 0.5), "on topic").when((F.col("on_topic") >= 0.3) | (overlap >= 0.5), "partial").otherwise("weak")
    return out.select("query_id", "expected", "top_topic", "on_topic", F.when(F.col("_seen").isNotNull(), overlap).alias("overlap"), verdict.alias("verdict"))


def graded_report(fragments: DataFrame, documents: DataFrame, truth: DataFrame, truth_docs: DataFrame, k: int = 10, top: int = 3) -> tuple[dict, DataFrame]:
    """(means, top fragments): nDCG at k and F1 at 3 over the queries that have a ground truth, and their best fragments
    (query_id, rank, texto, relevancia).  Queries without a truth are left out; without any, all means are 0."""
    judged = text_relevance(fragments.join(truth.select("query_id").distinct(), "query_id", "left_semi"), truth)
    got = judged.filter(F.col("rank") <= k).groupBy("query_id").agg(F.sum(F.col("relevancia") / _log2(F.col("rank") + 1)).alias("dcg"))
    order = truth.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("relevancia"), "texto"))).filter(F.col("r") <= k)
    best = order.groupBy("query_id").agg(F.sum(F.col("relevancia") / _log2(F.col("r") + 1)).alias("idcg"))
    ndcg = best.join(got, "query_id", "left").select("query_id", F.when(F.col("idcg") <= 0, 1.0).otherwise(F.coalesce("dcg", F.lit(0.0)) / F.col("idcg")).alias("ndcg"))
    first = ndcg.agg(F.count("*").alias("n_queries"), F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg")).first()
    f1 = f1_at_3(documents, truth_docs).agg(F.coalesce(F.avg("f1"), F.lit(0.0)).alias("f1")).first()
    return {"n_queries": first.n_queries, "ndcg": round(first.ndcg, 6), "f1": round(f1.f1, 6)}, judged.filter(F.col("rank") <= top).select("query_id", "rank", "texto", "relevancia")
