"""Queries: loaders, extraction from running text, integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MARKED = r"(?s)\bq\d{3}\s+(?:(?!\bq\d{3}\s).)*"


def load(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, query_text) from JSON lines or CSV, whatever the keys are called.

    A query without an id gets qNNN, NNN being its number among the file's queries that have a text.  A query file has
    tens of lines, so its numbering is one small window.
    """
    df = spark.read.option("header", "true").csv(path) if path.lower().endswith(".csv") else spark.read.json(path)
    pick = lambda *names: F.coalesce(*([F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in df.columns] or [F.lit(None).cast("string")]))
    own = df.select(pick("query_id", "id").alias("query_id"), pick("query_text", "query", "texto", "text").alias("query_text")).filter("query_text is not null")
    if own.filter("query_id is null").isEmpty():
        return own
    numbered = own.withColumn("_n", F.monotonically_increasing_id()).withColumn("_n", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_n")))
    return numbered.select(F.coalesce("query_id", F.format_string("q%03d", "_n")).alias("query_id"), "query_text")


def results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, fragments) of a file of results: (query_id, rank, doc_id) and (query_id, rank, chunk_id, doc_id, text)."""
    schema = "query_id string, documents array<struct<rank:int,doc_id:string>>, fragments array<struct<rank:int,chunk_id:string,doc_id:string,text:string>>"
    df = spark.read.schema(schema).json(path)
    return df.select("query_id", F.inline("documents")), df.select("query_id", F.inline("fragments"))


def ground_truth(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(fragments, documents) of relevant texts: (query_id, texto, relevancia) and (query_id, doc_id).

    The file is one JSON object by query id, or JSON lines with a query_id.  A bare string counts as a text of relevance 1.
    """
    inner = "struct<query_id:string,fragmentos:array<string>,documentos:array<string>>"
    raw = spark.read.option("wholetext", "true").text(path)
    if path.lower().endswith(".jsonl"):
        rows = raw.select(F.explode(F.split("value", "\n")).alias("value")).filter(F.trim("value") != "").select(F.from_json("value", inner).alias("g")).select("g.*")
    else:
        rows = raw.select(F.explode(F.from_json("value", f"map<string,{inner}>")).alias("query_id", "g")).select("query_id", "g.fragmentos", "g.documentos")
    text = F.explode("fragmentos").alias("f")
    one = F.from_json("f", "struct<texto:string,relevancia:double>")
    fragments = rows.select("query_id", text).select("query_id", F.when(F.col("f").startswith("{"), one["texto"]).otherwise(F.col("f")).alias("texto"), F.when(F.col("f").startswith("{"), F.coalesce(one["relevancia"], F.lit(1.0))).otherwise(1.0).alias("relevancia"))
    return fragments, rows.select("query_id", F.explode("documentos").alias("doc_id"))


def marked(text: Column) -> Column:
    """Array of (query_id, query_text) of a text in which each query begins with its qNNN marker."""
    found = F.regexp_extract_all(text, F.lit(MARKED), F.lit(0))
    return F.transform(found, lambda x: F.struct(F.substring(x, 1, 4).alias("query_id"), F.trim(F.regexp_replace(F.substring(x, 5, 1 << 30), r"\s+", " ")).alias("query_text")))


def integrity(queries: DataFrame, first: int = 1, last: int = 50) -> DataFrame:
    """(query_id, problem): ids that are missing, repeated or outside q001..q050; whole query sets have none."""
    spark = queries.sparkSession
    expected = spark.range(first, last + 1).select(F.format_string("q%03d", F.col("id")).alias("query_id"))
    counted = queries.groupBy("query_id").agg(F.count("*").alias("n"))
    gone = expected.join(counted, "query_id", "left_anti").select("query_id", F.lit("missing").alias("problem"))
    twice = counted.filter("n > 1").select("query_id", F.lit("repeated").alias("problem"))
    other = counted.join(expected, "query_id", "left_anti").select("query_id", F.lit("unexpected").alias("problem"))
    return gone.unionAll(twice).unionAll(other)
