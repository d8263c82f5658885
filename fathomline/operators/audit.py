"""Batch summaries and rejection reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_summary(results: DataFrame) -> DataFrame:
    """results (doc_id, status, num_guardados, fenomeno) summed overall (fenomeno null, scope `total`) and by topic;
    chunks count only where status is ok, and rows without a topic count only in the total."""
    agg = [F.count("*").alias("files"), F.sum((F.col("status") == "ok").cast("int")).alias("ok"), F.sum((F.col("status") != "ok").cast("int")).alias("errors"), F.sum(F.when(F.col("status") == "ok", F.col("num_guardados")).otherwise(0)).alias("chunks")]
    out = results.rollup("fenomeno").agg(F.grouping("fenomeno").alias("_total"), *agg)
    return out.filter((F.col("_total") == 1) | F.col("fenomeno").isNotNull()).select(F.when(F.col("_total") == 1, "total").otherwise(F.col("fenomeno").cast("string")).alias("scope"), "fenomeno", "files", "ok", "errors", "chunks")


def rejections_by_rule(validated: DataFrame) -> DataFrame:
    return validated.filter("rule is not null").groupBy("rule").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "rule")


def rejection_ratio(validated: DataFrame) -> DataFrame:
    """(doc_id, rejected, ratio): rejected chunks over the largest of (last position + 1) and rejected."""
    own = validated.groupBy("doc_id").agg(F.sum(F.col("rule").isNotNull().cast("int")).alias("rejected"), (F.max("posicion") + 1).alias("_n"))
    return own.filter("rejected > 0").select("doc_id", "rejected", (F.col("rejected") / F.greatest("_n", "rejected")).alias("ratio"))
