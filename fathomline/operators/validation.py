"""Chunk validation: hard rules, position sequence, duplicates, warnings.  Set-based, in one pass of windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathomline.schemas import TOPICS


def hard_rule(max_tokens: int = 512) -> Column:
    """Name of the first rule that a row breaks, else null."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c)) == "")
    missing = blank("doc_id") | blank("chunk_id") | blank("fuente") | blank("formato") | F.col("fenomeno").isNull() | F.col("posicion").isNull() | F.col("num_tokens").isNull() | blank("texto")
    return F.when(missing, "obligatorio").when(~F.col("fenomeno").isin(*TOPICS), "fenomeno").when(F.col("num_tokens") > max_tokens, "num_tokens").when(F.col("posicion") < 0, "posicion")


def validate(chunks: DataFrame, max_tokens: int = 512) -> DataFrame:
    """chunks with `rule` (null: accepted).

    Positions of a document must run from 0 without a gap; after a gap, all later rows go (`secuencia`); of rows at
    one place the first by input_ordinal counts.  A hard-rejected row still fills its place.  Of rows accepted so
    far, a chunk_id may occur once (`duplicado`).  Needs a column input_ordinal for the order of equal places.
    """
    ranked = chunks.withColumn("_hard", hard_rule(max_tokens)).withColumn("_ok", F.coalesce(F.col("posicion") >= 0, F.lit(False)))
    ranked = ranked.withColumn("_dense", F.dense_rank().over(Window.partitionBy("doc_id", "_ok").orderBy("posicion")) - 1)
    ranked = ranked.withColumn("_first", F.row_number().over(Window.partitionBy("doc_id", "posicion").orderBy("input_ordinal")) == 1)
    ruled = ranked.withColumn("rule", F.coalesce("_hard", F.when(~(F.col("_ok") & (F.col("_dense") == F.col("posicion")) & F.col("_first")), "secuencia")))
    again = F.row_number().over(Window.partitionBy("chunk_id", F.col("rule").isNull()).orderBy("doc_id", "posicion", "input_ordinal")) > 1
    return ruled.withColumn("rule", F.coalesce("rule", F.when(again, "duplicado"))).drop("_hard", "_ok", "_dense", "_first")


def warnings() -> Column:
    """Soft findings on texto: ending and beginning; none for table-like formats."""
    t = F.trim("texto")
    found = F.array_compact(F.array(F.when(~t.rlike(r"[.!?»›]$"), "sin_cierre"), F.when(~t.rlike(r"^[\"'«“¡¿(\p{Lu}]"), "sin_apertura")))
    return F.when(F.col("formato").isin("csv", "xlsx", "pbf"), F.array().cast("array<string>")).otherwise(found)
