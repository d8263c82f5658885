"""Ingestion: documents to clean, chunked, validated chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.config import ChunkingConfig
from fathomline.operators import chunking, cleaning, validation


def ingest(documents: DataFrame, config: ChunkingConfig = ChunkingConfig(), *, doc_id: Column | None = None, default_language: str = "es") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) chunks of documents (doc_id, fuente, formato, fenomeno, secciones).

    Texts are cleaned as cleaning.cleaned_documents says: language and boilerplate on raw texts, then the rest.  doc_id
    may be an expression on the documents' columns that makes ids of one's own.
    """
    own = documents if doc_id is None else documents.withColumn("doc_id", doc_id)
    ready = cleaning.cleaned_documents(own, default_language=default_language)
    chunks = chunking.enrich(chunking.chunk(ready, config), ready).withColumn("input_ordinal", F.col("posicion"))
    checked = validation.validate(chunks, config.max_tokens).withColumn("validation_warnings", validation.warnings())
    return checked.filter("rule is null").drop("rule", "input_ordinal"), checked.filter("rule is not null")
