"""Sinks: delivery of an index, result files, reports."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators import audit
from fathomline.operators.store import missing
from fathomline.schemas import MANDATORY


def delivery(chunks: DataFrame, embeddings: DataFrame, path: str, *, partial: bool = False) -> dict:
    """Writes one encoder's vectors and the metadata of their chunks to path/index and path/metadata.jsonl.d, both in
    the order (doc_id, posicion), with vec_ordinal as the common key, and reads them again.

    Chunks without a vector are an error that names up to 20 of them; with partial they are left out.  Vectors of
    different dimensions are an error.  Order and ordinals come from ranges, so no task sees all rows.
    """
    spark = chunks.sparkSession
    gaps = missing(chunks, embeddings)
    n_gaps = gaps.count()
    if n_gaps and not partial:
        raise ValueError(f"{n_gaps} chunks have no vector: {', '.join(r[0] for r in gaps.orderBy('chunk_id').limit(20).collect())}")
    low, high = embeddings.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if low != high:
        raise ValueError(f"vectors have dimensions from {low} to {high}")
    columns = [c for c in MANDATORY if c in chunks.columns]
    joined = chunks.select(*columns).join(embeddings.select("chunk_id", "vector"), "chunk_id")
    ordered = joined.repartitionByRange("doc_id", "posicion").sortWithinPartitions("doc_id", "posicion", "chunk_id").withColumn("_p", F.spark_partition_id())
    ordered.write.mode("overwrite").parquet(f"{path}/.sorted")
    ordered = spark.read.parquet(f"{path}/.sorted")
    from pyspark.sql.window import Window

    sizes = ordered.groupBy("_p").agg(F.count("*").alias("_n"))  # a row a partition
    before = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_p").orderBy("doc_id", "posicion", "chunk_id")) - 1
    numbered = ordered.withColumn("_w", within).join(F.broadcast(before), "_p").withColumn("vec_ordinal", (F.col("_before") + F.col("_w")).cast("long")).drop("_p", "_w", "_before")
    numbered.select("vec_ordinal", "chunk_id", "vector").write.mode("overwrite").parquet(f"{path}/index")
    numbered.select("vec_ordinal", *columns).write.mode("overwrite").json(f"{path}/metadata.jsonl.d")
    index, meta = spark.read.parquet(f"{path}/index"), spark.read.json(f"{path}/metadata.jsonl.d")
    n = index.count()
    if meta.count() != n or index.join(meta, ["vec_ordinal", "chunk_id"]).count() != n:
        raise ValueError("index and metadata disagree after writing")
    found = {"n_vectors": n, "dimension": low or 0, "chunks_omitted": n_gaps, "checksum": checksum(index)}
    line = json.dumps({"time": datetime.now(timezone.utc).isoformat(timespec="seconds"), "path": path, **found})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{path}/build_log.d")
    deleted = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/.sorted")
    deleted.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(deleted, True)
    return found


def checksum(index: DataFrame, block: int = 100_000) -> str:
    """SHA-256 of the index (vec_ordinal, chunk_id, vector): rows are digested in their order by blocks of ordinals, and
    the blocks' digests in theirs, so no task sees more than a block of digests; the driver sees one a block."""
    row = F.sha2(F.concat_ws("|", F.col("vec_ordinal").cast("string"), F.col("chunk_id").cast("string"), F.concat_ws(",", F.transform("vector", lambda x: x.cast("string")))), 256)
    rows = index.select(F.floor(F.col("vec_ordinal") / block).alias("block"), "vec_ordinal", row.alias("d"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("vec_ordinal", "d"))), lambda x: x["d"]), "")
    digests = rows.groupBy("block").agg(F.sha2(listed, 256).alias("d")).orderBy("block")
    whole = hashlib.sha256()
    for r in digests.toLocalIterator():
        whole.update(r.d.encode())
    return whole.hexdigest()


def load_delivery(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(embeddings, metadata) of a delivery: (chunk_id, doc_id, vector) and the metadata columns, joined by ordinal."""
    index, meta = spark.read.parquet(f"{path}/index"), spark.read.json(f"{path}/metadata.jsonl.d")
    joined = index.drop("chunk_id").join(meta, "vec_ordinal")
    return joined.select("chunk_id", "doc_id", "vector"), meta.drop("vec_ordinal")


def queries_export(queries: DataFrame, path: str, *, force: bool = False) -> None:
    """Writes queries (query_id, query_text) as JSON lines by id; what is there stays unless force."""
    ready = queries.select("query_id", "query_text").repartitionByRange("query_id").sortWithinPartitions("query_id")
    ready.write.mode("overwrite" if force else "ignore").json(path)


def explanation_json(paths: DataFrame) -> DataFrame:
    """(query_id, explanation): a JSON object a query of graph.paths()."""
    return paths.select("query_id", F.to_json(F.struct(*(c for c in paths.columns if c != "query_id"))).alias("explanation"))


def benchmark_report(per_query: DataFrame, path: str | None = None) -> list[dict]:
    """A row an encoder: number of queries and mean metrics of per_query (encoder_name, query_id, precision, recall, mrr,
    ndcg), best nDCG first; with a path also written as JSON."""
    means = per_query.groupBy("encoder_name").agg(F.count("*").alias("n_queries"), *(F.round(F.avg(c), 6).alias(c) for c in ("precision", "recall", "mrr", "ndcg")))
    ready = means.orderBy(F.desc("ndcg"), "encoder_name")
    if path is not None:
        ready.coalesce(1).write.mode("overwrite").json(path)  # a row an encoder
    return [r.asDict() for r in ready.collect()]


def results_jsonl(results: DataFrame, path: str) -> int:
    """Writes the results (query_id, result, problem) without a problem as lines by query_id; reads them again and gives
    their number."""
    good = results.filter("problem is null")
    good.repartitionByRange("query_id").sortWithinPartitions("query_id").select(F.col("result").alias("value")).write.mode("overwrite").text(path)
    back = results.sparkSession.read.text(path)
    n = back.filter(F.try_parse_json("value").isNotNull()).count()
    if n != good.count():
        raise ValueError("results can't be read back")
    return n


def rejection_report(validated: DataFrame, *, shown: int = 400, from_ratio: float = 0.5, documents: int = 50) -> str:
    """A text report: counts by rule, then the documents (a report's limit) with the largest rejection ratio; where it is
    from_ratio or more, the beginning of their rejected texts."""
    rules = audit.rejections_by_rule(validated).collect()
    out = ["Rejected chunks by rule", *(f"  {r.rule}: {r.n}" for r in rules), "", "Documents by rejection ratio"]
    for d in audit.rejection_ratio(validated).orderBy(F.desc("ratio"), "doc_id").limit(documents).collect():
        out.append(f"  {d.doc_id}: {d.rejected} rejected, ratio {d.ratio:.2f}")
        if d.ratio >= from_ratio:
            for r in validated.filter((F.col("doc_id") == d.doc_id) & F.col("rule").isNotNull()).orderBy("posicion").limit(3).collect():
                out.append(f"    [{r.rule}] {(r.texto or '')[:shown]}")
    return "\n".join(out) + "\n"


def evaluation_report(summary: dict, top: list[dict]) -> tuple[str, str]:
    """A summary of metrics and top fragments as JSON and as Markdown."""
    lines = ["| metric | value |", "|-|-|", *(f"| {k} | {v} |" for k, v in summary.items()), ""]
    lines += [f"{i}. ({f['relevancia']}) {f['texto'][:200]}" for i, f in enumerate(top, 1)]
    return json.dumps({"summary": summary, "fragments": top}, ensure_ascii=False), "\n".join(lines) + "\n"
