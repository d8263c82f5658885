"""Idempotent tables of chunks and vectors: upserts, resuming, ordinals, integrity of an export."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def upsert(old: DataFrame, new: DataFrame, keys: list[str], *, keep_from_old: tuple[str, ...] = (), order: str | None = None) -> DataFrame:
    """Rows of new, and those of old whose key new lacks; of keep_from_old the old value stays where there is one.

    With order, the row with the largest value of that column stays, whichever table it is in; a null is the smallest,
    and of equals that of new stays.
    """
    if order is not None:
        return newest(new.withColumn("_new", F.lit(1)).unionByName(old.select(*new.columns).withColumn("_new", F.lit(0))), keys, order, "_new").drop("_new")
    rest = old.join(new.select(*keys).distinct(), keys, "left_anti")
    if keep_from_old:
        was = old.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in keep_from_old))
        new = new.join(was, keys, "left").select(*(F.coalesce(f"_old_{c}", c).alias(c) if c in keep_from_old else F.col(c) for c in new.columns))
    return new.unionByName(rest.select(*new.columns))


def newest(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """One row a key, that with the largest values of the order columns (nulls are the smallest)."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in order))
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


class Table:
    """A Parquet table that is replaced as a whole: the new one is written aside, then renamed in.

    A writer may be lost between any two steps.  Rows are never: at each moment the old table or the new one is
    complete at path or at path.old, and whoever comes next puts it back (see recover).  One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.spark, self.path, self.aside = spark, path.rstrip("/"), f"{path.rstrip('/')}.old"
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} can't be renamed to {target}")

    def recover(self) -> None:
        """Ends what a lost writer began: without a table at path, that put aside comes back; else the latter goes."""
        if self._exists(self.aside):
            if self._exists(self.path):
                self._fs.delete(self._path(self.aside), True)
            else:
                self._rename(self.aside, self.path)

    def exists(self) -> bool:
        self.recover()
        return self._exists(self.path)

    def read(self) -> DataFrame:
        self.recover()
        return self.spark.read.parquet(self.path)

    def replace(self, df: DataFrame, staging: str | None = None) -> None:
        """df may be computed from the table itself."""
        self.recover()
        staging = staging or f"{self.path}.staging-{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(staging)
        if self._exists(self.path):
            self._rename(self.path, self.aside)
        self._rename(staging, self.path)
        self._fs.delete(self._path(self.aside), True)

    def remove(self) -> None:
        """The table goes, and what a lost writer put aside."""
        for path in (self.aside, self.path):
            self._fs.delete(self._path(path), True)

    def upsert(self, rows: DataFrame, keys: list[str], **options) -> None:
        """rows of one key must be one, or order says which stays; repeating an upsert changes nothing."""
        self.replace(upsert(self.read(), rows, keys, **options) if self.exists() else newest(rows, keys, options["order"]) if options.get("order") else rows)

    def delete(self, rows: DataFrame, keys: list[str]) -> None:
        """Without the rows of the given keys, such as all vectors of a chunk."""
        self.replace(self.read().join(rows.select(*keys).distinct(), keys, "left_anti"))

    def set_column(self, name: str, values: DataFrame, keys: list[str]) -> None:
        """The column takes the value of values(keys, name) where there is one."""
        new = values.select(*keys, F.col(name).alias("_value"))
        self.replace(self.read().join(new, keys, "left").withColumn(name, F.coalesce("_value", name)).drop("_value"))


def write_upserted(df: DataFrame, path: str, *, staging: str) -> None:
    """Replaces the table at path by one that may be computed from it."""
    Table(df.sparkSession, path).replace(df, staging)


def find_all(rows: DataFrame, limit: int | None = None, order: str = "chunk_id") -> DataFrame:
    """All rows, or (a reader's own limit) the first ones in an order."""
    return rows if limit is None else rows.orderBy(order).limit(limit)


def find_by_doc_id(chunks: DataFrame, doc_id) -> DataFrame:
    """The chunks of a document by position."""
    return chunks.filter(F.col("doc_id") == F.lit(doc_id)).orderBy("posicion", "chunk_id")


def exists(rows: DataFrame, key, column: str = "chunk_id") -> bool:
    return not rows.filter(F.col(column) == F.lit(key)).isEmpty()


def find_by_encoder(embeddings: DataFrame, encoder: str) -> DataFrame:
    return embeddings.filter(F.col("encoder_name") == encoder)


def find_by_ids(embeddings: DataFrame, ids: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The rows of the given ids; Spark broadcasts the ids where their size allows."""
    return embeddings.join(ids.select(key).distinct(), key, "left_semi")


def count_by_encoder(embeddings: DataFrame) -> DataFrame:
    return embeddings.groupBy("encoder_name").agg(F.count("*").alias("n"))


def pending(chunks: DataFrame, cache: DataFrame, keys: tuple[str, ...] = ("chunk_id",), hash_col: str = "hash_texto") -> DataFrame:
    """chunks without a cache row of the same key and hash; a null hash counts as a value."""
    seen = cache.select(*keys, hash_col).distinct()
    on = [chunks[k] == seen[k] for k in keys] + [chunks[hash_col].eqNullSafe(seen[hash_col])]
    return chunks.join(seen, on, "left_anti")


def missing(ids: DataFrame, vectors: DataFrame, key: str = "chunk_id", order: str | None = None) -> DataFrame:
    """Distinct ids without a vector; with order, also `first`, the smallest value of that column, by which callers may
    sort them as they first came."""
    own = ids.select(key).distinct() if order is None else ids.groupBy(key).agg(F.min(order).alias("first"))
    return own.join(vectors.select(key), key, "left_anti")


def ordinals(df: DataFrame, key: str, then: tuple[str, ...] = (), buckets: int = 1024) -> DataFrame:
    """df with vec_ordinal, 0-based by (key, then), for an integer key.

    The key's range is cut into buckets; rows are numbered within their bucket, and a table of bucket sizes gives the
    offsets.  So no task sees all rows, unlike a window without partitions.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // buckets))
    placed = df.withColumn("_bucket", F.floor((F.col(key) - F.lit(low or 0)) / F.lit(width)).cast("int"))
    sizes = placed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before"))  # at most `buckets` rows
    within = placed.withColumn("_within", F.row_number().over(Window.partitionBy("_bucket").orderBy(key, *then)) - 1)
    return within.join(F.broadcast(offsets), "_bucket").withColumn("vec_ordinal", (F.col("_before") + F.col("_within")).cast("long")).drop("_bucket", "_before", "_within")


def export_check(chunks: DataFrame, vectors: DataFrame, key: str = "chunk_id", vector: str = "vector") -> DataFrame:
    """One row: chunks, vectors, chunks without a vector, smallest and largest dimension, complete."""
    gaps = missing(chunks, vectors, key).agg(F.count("*").alias("n_missing"))
    dims = vectors.agg(F.count("*").alias("n_vectors"), F.min(F.size(vector)).alias("min_dim"), F.max(F.size(vector)).alias("max_dim"))
    n = chunks.agg(F.count("*").alias("n_chunks"))
    out = n.join(dims, how="cross").join(gaps, how="cross")  # three single rows
    return out.withColumn("complete", (F.col("n_missing") == 0) & F.coalesce(F.col("min_dim") == F.col("max_dim"), F.lit(True)))


def add_to_set(column: Column, value: str) -> Column:
    return F.array_union(F.coalesce(column, F.array().cast("array<string>")), F.array(F.lit(value)))


def balanced_sample(df: DataFrame, limit: int, strata: list[str], order: list[str]) -> DataFrame:
    """About limit rows, dealt evenly over the values of strata[0], then of strata[1] within them and so on.  Each of n
    values gets limit // n rows, the first limit % n one more; what a value can't fill is not given to others."""
    out = df.withColumn("_quota", F.lit(max(0, limit)))
    for depth in range(len(strata)):
        outer, here = strata[:depth], strata[: depth + 1]
        values = out.select(*here, "_quota").distinct()
        w = Window.partitionBy(*outer) if outer else Window.partitionBy(F.lit(0))
        n = F.count("*").over(w)
        position = F.row_number().over(w.orderBy(strata[depth])) - 1
        share = values.select(*here, (F.floor(F.col("_quota") / n) + (position < F.col("_quota") % n).cast("int")).alias("_share"))
        out = out.join(share, here).withColumn("_quota", F.col("_share")).drop("_share")
    w = Window.partitionBy(*strata).orderBy(*order)
    return out.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.col("_quota")).drop("_r", "_quota")
