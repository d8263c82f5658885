"""The knowledge graph behind one object: build, ask, explain, export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions import text
from fathomline.operators import entities, graph
from fathomline.operators.relations import RELATIONS
from fathomline.sources import graphml


class GraphService:
    """Questions before build() or load() raise ValueError.  relations is an extractor, or its name in RELATIONS."""

    def __init__(self, vocabulary=entities.VOCABULARY, *, proper_nouns: bool = True, relations=graph.symbolic_triples):
        self.vocabulary, self.proper_nouns, self.relations = vocabulary, proper_nouns, RELATIONS.get(relations) if isinstance(relations, str) else relations
        self._entities: DataFrame | None = None
        self._triples: DataFrame | None = None

    def build(self, chunks: DataFrame) -> GraphService:
        """From chunks (chunk_id, doc_id, texto): entities, and triples by sentence with both ends among them."""
        found = entities.mentions(chunks, self.vocabulary, proper_nouns=self.proper_nouns)
        self._entities = graph.merged_entities(found)
        sentences = chunks.select("doc_id", "chunk_id", F.posexplode(text.sentences(F.col("texto"))).alias("n", "texto")).withColumn("_key", F.concat_ws("#", "chunk_id", "n"))
        inside = entities.mentions(sentences, self.vocabulary, proper_nouns=self.proper_nouns, id_col="_key").select("_key", F.col("id").alias("entity"))
        located = inside.join(sentences.select("_key", "chunk_id", "n"), "_key").select("chunk_id", "n", "entity")
        triples = graph.materialised(self.relations(sentences.drop("_key"), located), self._entities)
        self._triples = triples.join(chunks.select("chunk_id", F.col("texto").alias("evidencia")), "chunk_id")
        return self

    def load(self, spark, path: str) -> GraphService:
        self._entities, self._triples = graphml.read(spark, path)
        return self

    @property
    def triples(self) -> DataFrame:
        if self._triples is None:
            raise ValueError("the graph has not been built")
        return self._triples

    @property
    def entities(self) -> DataFrame:
        if self._entities is None:
            raise ValueError("the graph has not been built")
        return self._entities

    def asked(self, queries: DataFrame) -> DataFrame:
        """(query_id, entity) of the query texts' entities that are in the graph."""
        found = entities.mentions(queries, self.vocabulary, proper_nouns=self.proper_nouns, id_col="query_id", text_col="query_text").select("query_id", F.col("id").alias("entity"))
        return found.join(self.entities.select(F.col("id").alias("entity")), "entity", "left_semi").distinct()

    def search(self, queries: DataFrame, k: int = 50) -> DataFrame:
        return graph.evidence(self.triples, self.asked(queries), k)

    def explain(self, queries: DataFrame, targets: DataFrame, most: int = 10) -> DataFrame:
        return graph.explanation(self.triples, self.asked(queries), targets, most)

    def summary(self) -> dict[str, int]:
        return {"entities": self.entities.count(), "triples": self.triples.count(), "chunks": self.triples.select("chunk_id").distinct().count()}

    def paths(self, queries: DataFrame, targets: DataFrame, most: int = 10) -> DataFrame:
        """The whole explanation of each query (see graph.paths)."""
        return graph.paths(self.triples, self.asked(queries), targets, most=most)

    def views(self, prefix: str = "graph") -> None:
        """The graph as temporary views, for SQL: <prefix>_entities and <prefix>_triples."""
        self.entities.createOrReplaceTempView(f"{prefix}_entities")
        self.triples.createOrReplaceTempView(f"{prefix}_triples")

    def export(self, path: str) -> None:
        if graph.orphans(self.triples, self.entities).limit(1).count():
            raise ValueError("triples refer to unknown entities")
        graphml.write(self.entities, self.triples, path)
