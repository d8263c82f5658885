"""Retrieval as one batch over a table of queries: search by encoder, fusion, filters, fragments, documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.config import IndexConfig
from fathomline.operators import fragments as fr
from fathomline.operators import fusion, graph, search
from fathomline.operators.encoding import ENCODERS, encoded
from fathomline.operators.entities import VOCABULARY, mentions
from fathomline.operators.export import load_delivery
from fathomline.operators.filters import Filters, filtered


def vector_hits(queries: DataFrame, embeddings: DataFrame, k_search: int = 50, index: IndexConfig | None = None) -> DataFrame:
    """Hits of queries (query_id, query_text) in each encoder's embeddings (chunk_id, doc_id, encoder_name, vector), by
    the index that the configuration chooses.  An encoder that isn't registered, or can't run
    here, has no channel."""
    out = None
    for row in embeddings.select("encoder_name").distinct().orderBy("encoder_name").collect():
        try:
            encoder = ENCODERS.get(row[0])
        except ValueError:
            continue
        if not encoder.available:
            continue
        asked = encoded(queries, encoder, text_col="query_text", is_query=True).filter("vector is not null").select("query_id", "vector")
        own = embeddings.filter(F.col("encoder_name") == row[0])
        hits = search.search(own, asked, k_search, index, ("doc_id",)).withColumn("channel", F.lit(row[0])).select("query_id", "channel", "chunk_id", "doc_id", "rank", "score")
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        raise ValueError("no registered encoder has embeddings")
    return out


def graph_hits(queries: DataFrame, triples: DataFrame, k: int = 50, vocabulary=VOCABULARY) -> DataFrame:
    """Hits of the graph channel: evidence for the entities in each query's text."""
    asked = mentions(queries, vocabulary, id_col="query_id", text_col="query_text").select("query_id", F.col("id").alias("entity"))
    return graph.evidence(triples, asked, k).withColumn("channel", F.lit("graph")).select("query_id", "channel", "chunk_id", "doc_id", "rank", "score")


def answered(fused: DataFrame, chunks: DataFrame, *, filters: Filters | None = Filters(), k_chunk_out: int = 10, doc_agg: str = "max", n_docs: int = 3, is_stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, fragments) from fused hits (query_id, chunk_id, score, cosine_score, rank).

    A hit whose chunk is unknown stays, with an empty text.  Filters come after the top-k, then the first k_chunk_out
    chunks of each query are kept, split or merged, and pooled into n_docs documents.  Where the hits are a stored table,
    which can be read again at no cost, is_stored has only the texts of hits and of what follows them read and dealt out.
    """
    from pyspark.sql.window import Window

    known = [c for c in ("posicion", "texto", "fenomeno", "formato", "idioma", "fecha_publicacion") if c in chunks.columns]
    own = chunks.select("chunk_id", F.col("doc_id").alias("_doc"), *known)
    if is_stored:
        own = own.join(fused.select("chunk_id").distinct(), "chunk_id", "left_semi")
    full = fused.drop(*known).join(own, "chunk_id", "left").withColumn("doc_id", F.coalesce("_doc", "doc_id")).drop("_doc")
    full = full.withColumn("texto", F.coalesce("texto", F.lit("")))
    for c in ("fenomeno", "formato", "idioma", "fecha_publicacion"):
        if c not in known:
            full = full.withColumn(c, F.lit(None).cast("int" if c == "fenomeno" else "string"))
    kept = filtered(full, filters).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).filter(F.col("rank") <= k_chunk_out)
    around = chunks.select("doc_id", "posicion", "texto")
    if is_stored:
        around = around.join(kept.select("doc_id", (F.col("posicion") + 1).alias("posicion")).distinct(), ["doc_id", "posicion"], "left_semi")
    out = fr.split_or_merge(kept, around)
    return fr.pooled(out, doc_agg, n_docs), out


def fused_hits(queries: DataFrame, embeddings: DataFrame, k_search: int = 50, k0: int = 60, index: IndexConfig | None = None) -> DataFrame:
    """Hits of all encoders by reciprocal rank fusion, as answered() takes them."""
    return fusion.rrf(vector_hits(queries, embeddings, k_search, index), k0).withColumnRenamed("rrf_score", "score")


def retrieve(queries: DataFrame, embeddings: DataFrame, chunks: DataFrame, phenomenon_filter: int | None = None, format_filter: str | None = None, lang_filter: str | None = None, date_range: tuple[str | None, str | None] | None = None, theta: float = 0.0, k_search: int = 50, k_chunk_out: int = 10, doc_agg: str = "max", k0: int = 60, index: IndexConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, fragments) of each query by reciprocal rank fusion over encoders."""
    return answered(fused_hits(queries, embeddings, k_search, k0, index), chunks, filters=Filters(phenomenon_filter, format_filter, lang_filter, date_range, theta), k_chunk_out=k_chunk_out, doc_agg=doc_agg)


class Retriever:
    """Searches over loaded artefacts: embeddings and chunks, or the deliveries of several encoders."""

    def __init__(self, embeddings: DataFrame, chunks: DataFrame, index: IndexConfig | None = None):
        self.embeddings, self.chunks, self.index = embeddings, chunks, index

    @classmethod
    def load(cls, spark: SparkSession, paths: dict[str, str], chunks: DataFrame | None = None, index: IndexConfig | None = None) -> Retriever:
        """From deliveries by encoder name (see operators.export); one that can't be read is left out.  Without a table
        of chunks, the deliveries' metadata stands for it."""
        found, texts = None, None
        for name, path in paths.items():
            try:
                own, meta = load_delivery(spark, path)
            except AnalysisException:
                continue
            own = own.withColumn("encoder_name", F.lit(name))
            found = own if found is None else found.unionByName(own)
            texts = meta if texts is None else texts.unionByName(meta)
        if found is None:
            raise ValueError("no artefacts can be loaded")
        return cls(found, chunks if chunks is not None else texts.dropDuplicates(["chunk_id"]), index)

    def retrieve(self, query: str, phenomenon_filter: int | None = None, format_filter: str | None = None, lang_filter: str | None = None, date_range: tuple[str | None, str | None] | None = None, theta: float = 0.0, k_search: int = 50, k_chunk_out: int = 10, doc_agg: str = "max") -> dict[str, list]:
        """{"documents": [...], "fragments": [...]} of one query, best first; a blank query is an error."""
        if not query.strip():
            raise ValueError("the query is empty")
        asked = self.chunks.sparkSession.createDataFrame([("q001", query)], "query_id string, query_text string")
        documents, fragments = self.retrieve_all(asked, phenomenon_filter, format_filter, lang_filter, date_range, theta, k_search, k_chunk_out, doc_agg)
        rows = lambda df, by: [r.asDict() for r in df.drop("query_id").orderBy(by).collect()]
        return {"documents": rows(documents, "rank"), "fragments": rows(fragments, "place")}

    def retrieve_all(self, queries: DataFrame, *filters, **options) -> tuple[DataFrame, DataFrame]:
        return retrieve(queries, self.embeddings, self.chunks, *filters, index=self.index, **options)


def hybrid(queries: DataFrame, embeddings: DataFrame, chunks: DataFrame, triples: DataFrame, *, fusion_kind: str = "rrf", k: int = 50, k0: int = 60, filters: Filters | None = Filters(), k_chunk_out: int = 10, doc_agg: str = "max", vocabulary=VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """As retrieve, with one vector channel (itself fused over encoders) and the graph channel.  A channel without hits
    for a query is left out for it."""
    vector = fusion.rrf(vector_hits(queries, embeddings, k), k0, limit=k).select("query_id", F.lit("vector").alias("channel"), "chunk_id", "doc_id", "rank", F.col("rrf_score").alias("score"))
    fused = fusion.combined(vector.unionByName(graph_hits(queries, triples, k, vocabulary)), fusion_kind, k0)
    return answered(fused.withColumn("cosine_score", F.col("score")), chunks, filters=filters, k_chunk_out=k_chunk_out, doc_agg=doc_agg)


def results(documents: DataFrame, fragments: DataFrame, n_docs: int = 3, n_fragments: int = 10, fields: tuple[str, ...] = (), ids: str = r"^q\d{3}$") -> DataFrame:
    """(query_id, result, problem): a JSON object of n_docs documents and n_fragments fragments; where a query has fewer,
    or a fragment over 250 words, the result is null and problem says so.  One query's problem leaves others alone.
    fields names further columns of fragments, such as merged_with or fenomeno; a fragment without a value has no field.
    ids is the pattern of valid ids, those of an evaluation's set (q001..q050) unless a larger set says otherwise."""
    from fathomline.functions.text import word_count

    docs = documents.filter(F.col("rank") <= n_docs).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("documents"))
    frag = fragments.filter(F.col("place") <= n_fragments).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(F.col("place").alias("rank"), "chunk_id", "doc_id", F.col("texto").alias("text"), *fields))).alias("fragments"), F.max(word_count(F.col("texto"))).alias("_words"))
    out = docs.join(frag, "query_id", "full_outer")
    problem = F.when(~F.coalesce(F.col("query_id").rlike(ids), F.lit(False)), "query_id").when(F.coalesce(F.size("documents"), F.lit(0)) < n_docs, "documents").when(F.coalesce(F.size("fragments"), F.lit(0)) < n_fragments, "fragments").when(F.col("_words") > fr.MOST_WORDS, "words")
    return out.select("query_id", F.when(problem.isNull(), F.to_json(F.struct("query_id", "documents", "fragments"))).alias("result"), problem.alias("problem"))
