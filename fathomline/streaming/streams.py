"""Incremental counterparts of batch operators on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathomline.functions.text import stable_id
from fathomline.operators.encoding import encode_pending
from fathomline.operators.store import Table, newest


def deduplicated(stream: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first row of each key; state older than the watermark goes."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, by: list[str], width: str = "1 hour", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Counts and sums of `value` by time window."""
    grouped = stream.withWatermark(ts, late).groupBy(F.window(ts, width), *by)
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *by, "n", "total")


def sessions(stream: DataFrame, by: list[str], gap: str = "30 minutes", ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Sessions of rows less than gap apart."""
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def upserting(stream: DataFrame, path: str, keys: list[str], checkpoint: str, *, order: str | None = None) -> StreamingQuery:
    """Upserts each micro-batch into the table at path; repeating a batch changes nothing.

    With order (an event time, say) the newest row of each key stays, also if it came before an older one.  Without, a
    batch's row replaces the table's, and of several in one batch the largest stays.
    """

    def each(batch: DataFrame, _: int) -> None:
        rows = batch if order else newest(batch, keys, *(c for c in batch.columns if c not in keys))
        Table(batch.sparkSession, path).upsert(rows, keys, **({"order": order} if order else {}))

    return _each(stream, each, checkpoint)


def _each(stream: DataFrame, each, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def encoding(chunks: DataFrame, path: str, encoders: list[str], checkpoint: str) -> StreamingQuery:
    """Keeps the embeddings at path up to date with a stream of chunks (chunk_id, doc_id, texto, hash_texto): a chunk is
    encoded if the table lacks its id and hash for an encoder, and its new vector replaces the old one.  New vectors are
    made once and put beside the table; it stays as it is where there are none."""

    def each(batch: DataFrame, _: int) -> None:
        table = Table(batch.sparkSession, path)
        rows = newest(batch, ["chunk_id"], *(c for c in batch.columns if c != "chunk_id"))
        cache = table.read() if table.exists() else batch.sparkSession.createDataFrame([], "chunk_id string, encoder_name string, hash_texto string")
        new = encode_pending(rows, cache, encoders)
        if not table.exists():
            return table.replace(new)
        beside = Table(batch.sparkSession, f"{table.path}.new")
        beside.replace(new)
        if not beside.read().isEmpty():
            table.upsert(beside.read(), ["chunk_id", "encoder_name"])
        beside.remove()

    return _each(chunks, each, checkpoint)


def indexing(vectors: DataFrame, path: str, checkpoint: str, *, key: str = "chunk_id", deleted: str = "deleted", order: str) -> StreamingQuery:
    """Keeps the index at path, (stable_id, key, vector, order), up to date with a stream of vectors: the newest row of a
    key by the order column counts, also over batches, under one stable id; where its `deleted` is true the key is out.

    A deletion stays as a row without a vector, since an older vector may still come.
    """

    def each(batch: DataFrame, _: int) -> None:
        own = batch.withColumn("vector", F.when(~F.coalesce(deleted, F.lit(False)), F.col("vector"))).drop(deleted)
        ready = newest(own, [key], order).withColumn("stable_id", stable_id(F.col(key).cast("string")))
        Table(batch.sparkSession, path).upsert(ready, ["stable_id"], order=order)

    return _each(vectors, each, checkpoint)


def indexed(spark, path: str) -> DataFrame:
    """The vectors of an index that indexing() keeps, without deleted ones."""
    return Table(spark, path).read().filter("vector is not null")


def finished(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs a stream over what is there now into a Parquet folder, and reads that."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
