"""Fragments of at most 250 words: long chunks are split at sentences, short ones take in the next chunk."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions import segment
from fathomline.functions.text import word_count
from fathomline.registry import Registry

MOST_WORDS = 250


def merged_next(fragments: DataFrame, chunks: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """fragments (doc_id, posicion, texto, ...) of at most most words, with the chunk at posicion + 1 of their document
    appended where both have at most most words together; merged_with names it as `doc::position`."""
    follow = chunks.groupBy("doc_id", "posicion").agg(F.min("texto").alias("_next")).select("doc_id", (F.col("posicion") - 1).alias("posicion"), "_next")
    out = fragments.join(follow, ["doc_id", "posicion"], "left")
    n, m = word_count(F.col("texto")), word_count(F.col("_next"))
    fits = F.coalesce((n <= most) & (n + m <= most), F.lit(False))
    return out.withColumn("merged_with", F.when(fits, F.concat(F.col("doc_id").cast("string"), F.lit("::"), (F.col("posicion") + 1).cast("string")))).withColumn("texto", F.when(fits, F.concat_ws(" ", "texto", "_next")).otherwise(F.col("texto"))).drop("_next")


def _pieces(most: int, splitter: Callable[[str, int], list[str]]):
    @F.pandas_udf("array<string>")
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield t.map(lambda x: splitter(x or "", most))

    return cut


def split_long(fragments: DataFrame, most: int = MOST_WORDS, splitter: Callable[[str, int], list[str]] = segment.packed_sentences) -> DataFrame:
    """Fragments of over most words as runs of whole sentences with sub_indice from 1; a longer sentence stays whole.
    Others stay with sub_indice 0, and never reach Python.  splitter may be a function of (text, most) of one's own."""
    n = word_count(F.col("texto"))
    long = fragments.filter(n > most)
    short = fragments.filter(F.coalesce(n <= most, F.lit(True))).withColumn("sub_indice", F.lit(0))
    others = [c for c in fragments.columns if c != "texto"]
    cut = long.select(*others, F.posexplode(_pieces(most, splitter)("texto")).alias("sub_indice", "texto")).withColumn("sub_indice", F.col("sub_indice") + 1)
    return short.unionByName(cut)


def split_or_merge(fragments: DataFrame, chunks: DataFrame, most: int = MOST_WORDS, splitter: Callable[[str, int], list[str]] = segment.packed_sentences) -> DataFrame:
    """Both, in the order (query_id, rank, sub_indice): `place` numbers fragments within a query from 1.  chunks
    (doc_id, posicion, texto) say which chunk is next to which."""
    from pyspark.sql.window import Window

    out = split_long(fragments, most, splitter)
    own = merged_next(out.filter("sub_indice = 0"), chunks, most).unionByName(out.filter("sub_indice > 0"), allowMissingColumns=True)
    return own.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("rank", "sub_indice")))


#: Pooling functions by name: from the columns of a fragment's score and place to an aggregate.
POOLINGS: Registry = Registry("pooling")
POOLINGS.register("max")(lambda score, place: F.max(score))
POOLINGS.register("sum")(lambda score, place: F.sum(score))
POOLINGS.register("weighted_mean")(lambda score, place: F.sum(score / place) / F.sum(1.0 / place))


def pooled(fragments: DataFrame, kind: str = "max", n_docs: int | None = 3, *, score: str = "score", place: str = "place") -> DataFrame:
    """(query_id, doc_id, score, rank): documents by the max, sum or rank-weighted mean of their fragments' scores, or by
    a pooling that the caller has registered."""
    from pyspark.sql.window import Window

    how = POOLINGS.get(kind)(F.col(score), F.col(place))
    out = fragments.groupBy("query_id", "doc_id").agg(F.round(how, 12).alias("score"))
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")))
    return out if n_docs is None else out.filter(F.col("rank") <= n_docs)
