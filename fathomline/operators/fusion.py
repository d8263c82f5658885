"""Fusion of ranked channels.  Hits are rows (query_id, channel, chunk_id, doc_id, rank, score)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomline.registry import Registry

#: Places to which fused scores are rounded where they rank, so that equal sums tie in any order of adding.
PLACES = 12


def rrf(hits: DataFrame, k0: int = 60, *, limit: int | None = None) -> DataFrame:
    """(query_id, chunk_id, doc_id, rrf_score, cosine_score, channels, rank): the sum of 1 / (k0 + rank) over channels;
    order: score, then best single score, then chunk_id."""
    if k0 <= 0:
        raise ValueError("k0 must be positive")
    fused = hits.groupBy("query_id", "chunk_id").agg(
        F.min_by("doc_id", "channel").alias("doc_id"), F.round(F.sum(1.0 / (k0 + F.col("rank"))), PLACES).alias("rrf_score"), F.max("score").alias("cosine_score"), F.array_sort(F.collect_set("channel")).alias("channels")
    )
    w = Window.partitionBy("query_id").orderBy(F.desc("rrf_score"), F.desc("cosine_score"), "chunk_id")
    out = fused.withColumn("rank", F.row_number().over(w))
    return out if limit is None else out.filter(F.col("rank") <= limit)


def min_max(hits: DataFrame) -> DataFrame:
    """hits with `norm`: the score scaled to 0..1 within its query and channel; 1 where all are equal."""
    w = Window.partitionBy("query_id", "channel")
    low, high = F.min("score").over(w), F.max("score").over(w)
    return hits.withColumn("norm", F.when(high == low, 1.0).otherwise((F.col("score") - low) / (high - low)))


#: Fusions by name: functions of k0 that give the aggregate over a chunk's channels; `norm`, `rank`, `score` and `channel`
#: are the columns of a hit.
FUSIONS: Registry = Registry("fusion")
FUSIONS.register("combsum")(lambda k0: F.sum("norm"))
FUSIONS.register("combmnz")(lambda k0: F.sum("norm") * F.countDistinct("channel"))
FUSIONS.register("rrf")(lambda k0: F.sum(1.0 / (k0 + F.col("rank"))))


def combined(hits: DataFrame, kind: str = "combsum", k0: int = 60) -> DataFrame:
    """(query_id, chunk_id, doc_id, score, origin, rank) by a fusion of the registry (`combsum`, `combmnz`, `rrf`, or
    one of the caller's).  A query with one channel keeps that channel's scores and name."""
    total = FUSIONS.get(kind)
    if k0 <= 0:
        raise ValueError("k0 must be positive")
    ready = min_max(hits).withColumn("_channels", F.size(F.collect_set("channel").over(Window.partitionBy("query_id"))))
    fused = ready.groupBy("query_id", "chunk_id").agg(F.min_by("doc_id", "channel").alias("doc_id"), F.max("_channels").alias("_n"), total(k0).alias("_s"), F.max("score").alias("_raw"), F.min("channel").alias("_channel"))
    one = F.col("_n") == 1
    out = fused.select("query_id", "chunk_id", "doc_id", F.round(F.when(one, F.col("_raw")).otherwise(F.col("_s")), PLACES).alias("score"), F.when(one, F.col("_channel")).otherwise(F.lit(kind)).alias("origin"))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")))
