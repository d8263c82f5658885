"""Vector search: exact blocks, clustered cells, and the choice between them.

Vectors are unit arrays, so the inner product is the cosine.  Scores are rounded to nine places before they rank, so
equal vectors tie and ids decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.window import Window

from fathomline.config import IndexConfig
from fathomline.registry import Registry

#: Queries that are held at once beside a batch of vectors.
QUERY_BLOCK = 256


def arrow_kind(kind: str) -> pa.DataType:
    return to_arrow_type(_parse_datatype_string(kind))


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, in the JVM."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalised(v: Column) -> Column:
    """Unit length; a zero vector stays."""
    d = F.transform(v, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm == 0, d).otherwise(F.transform(d, lambda x: x / norm))


def ranked(scored: DataFrame, k: int, *, by: tuple[str, ...] = ("query_id",), key: str = "chunk_id") -> DataFrame:
    """The best k (at least 1) of each query by (score desc, key), with rank from 1.  Spark limits groups before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.desc("score"), key)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max(1, k))


def _best(rows: np.ndarray, place: np.ndarray, matrix: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, query, score) of the rows that may be among a query's k best, at most k a query.

    top holds the k best scores that a task has seen of each query, and takes in the new ones: rows below all of them
    are out, rows that equal the least one stay, as keys decide between them.
    """
    k = top.shape[1]
    raw = rows @ matrix.T
    least = top[:, 0].copy()
    wide = np.flatnonzero((raw >= least - 2e-9).sum(axis=0) > k)
    if len(wide):  # more than k: all rows as good as the k-th one of these
        least[wide] = np.maximum(least[wide], np.round(np.partition(raw[:, wide], len(raw) - k, axis=0)[len(raw) - k], 9))
    row, of = np.nonzero(raw >= least - 2e-9)
    score = np.round(raw[row, of], 9)
    kept = score >= least[of]
    row, of, score = row[kept], of[kept], score[kept]
    order = np.lexsort((place[row], -score, of))
    row, of, score = row[order], of[order], score[order]
    nth = np.arange(len(of)) - np.searchsorted(of, of)
    first = nth < k
    row, of, score, nth = row[first], of[first], score[first], nth[first]
    met = np.full(top.shape, -np.inf)
    met[of, nth] = score
    top[:] = np.sort(np.concatenate([top, met], axis=1), axis=1)[:, k:]
    return row, of, score


def _scan(vectors: DataFrame, asked: Iterator, qid: str, k: int, key: str, vector: str, carry: tuple[str, ...], cell: str | None = None) -> DataFrame:
    """(query_id, key, carry..., score, rank): the vectors, read once, against the queries asked: rows (query_id, vector)
    or, with a column that names a vector's cell, (query_id, vector, cells)."""
    spark = vectors.sparkSession
    columns = list(dict.fromkeys([key, *carry]))
    own = vectors.select(*columns, F.col(cell).alias("_cell") if cell else F.lit(None).cast("int").alias("_cell"), F.col(vector).alias("_vector"))
    kinds = {f.name: f.dataType.simpleString() for f in own.schema}
    schema = f"query_id {qid}, " + ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", score double"
    blocks = []
    while block := [r for _, r in zip(range(QUERY_BLOCK), asked)]:
        wanted: dict = {}
        for i, r in enumerate(block if cell else ()):
            for c in r[2]:
                wanted.setdefault(c, []).append(i)
        blocks.append(spark.sparkContext.broadcast(([r[0] for r in block], np.array([r[1] for r in block]), {c: np.array(i) for c, i in wanted.items()})))
    id_kind = arrow_kind(qid)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [np.full((len(b.value[0]), k), -np.inf) for b in blocks]
        for batch in batches:
            batch = batch.filter(pa.compute.is_valid(batch.column(len(columns) + 1)))
            n = batch.num_rows
            if not n:
                continue
            flat = np.asarray(batch.column(len(columns) + 1).flatten(), float)
            place = np.empty(n, np.int64)  # place of a row in the order of keys, by which equal scores go
            place[np.argsort(np.array(batch.column(0).to_pylist()), kind="stable")] = np.arange(n)
            places: dict = {}
            for i, c in enumerate(batch.column(len(columns)).to_pylist() if cell else ()):
                places.setdefault(c, []).append(i)
            for shared, top in zip(blocks, tops):
                ids, matrix, wanted = shared.value
                if len(flat) != n * matrix.shape[1]:
                    raise ValueError(f"vectors must have {matrix.shape[1]} dimensions")
                rows = flat.reshape(n, -1)
                found = []
                if cell:
                    for c in places.keys() & wanted.keys() - {None}:
                        at, to = np.array(places[c]), wanted[c]
                        own_top = top[to]
                        row, of, score = _best(rows[at], place[at], matrix[to], own_top)
                        top[to] = own_top
                        found.append((at[row], to[of], score))
                else:
                    found.append(_best(rows, place, matrix, top))
                if found:
                    row, of, score = (np.concatenate(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in of], id_kind), *(batch.column(i).take(pa.array(row)) for i in range(len(columns))), pa.array(score)], names=["query_id", *columns, "score"])

    return ranked(own.mapInArrow(search, schema) if blocks else spark.createDataFrame([], schema), k, key=key)


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int, *, key: str = "chunk_id", vector: str = "vector", carry: tuple[str, ...] = ()) -> DataFrame:
    """(query_id, key, carry..., score, rank): exact inner-product search; carry names columns that hits keep.

    The queries (query_id, vector) are the stated query set, and all that is broadcast.  The vectors are read once: a
    batch is multiplied with a block of QUERY_BLOCK queries at a time, and passes on at most k rows a query, and none
    below the k best that its task has seen.  Other dimensions than the queries' raise an error; no vectors or no queries
    give no rows.
    """
    rows = queries.select("query_id", F.transform("vector", lambda x: x.cast("double")).alias("v")).filter("v is not null").toLocalIterator()
    return _scan(vectors, rows, queries.schema["query_id"].dataType.simpleString(), max(1, k), key, vector, carry)


def centroids(vectors: DataFrame, cell: str, vector: str = "vector") -> DataFrame:
    """(cell, centroid): unit mean vector of each cell.  Tasks pass on one sum a cell."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    ready = vectors.filter(F.col(vector).isNotNull()).select(cell, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("_f"))
    grouped = ready.groupBy(cell).agg(Summarizer.mean(F.col("_f")).alias("c"))
    return grouped.select(F.col(cell).alias("cell"), normalised(vector_to_array("c")).alias("centroid"))


def clustered(vectors: DataFrame, nlist: int, *, key: str = "chunk_id", vector: str = "vector", sample: int = 100_000, seed: int = 17) -> DataFrame:
    """vectors with `cell`: k-means cells learned on at most sample vectors, every vector assigned."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    ready = vectors.withColumn("_f", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    # the sample is those of the smallest hashes: only hashes are sorted, and the vectors stay in their partitions
    last = vectors.select(F.xxhash64(key).alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    learned = ready.filter(F.xxhash64(key) <= F.lit(last))
    model = KMeans(k=nlist, seed=seed, featuresCol="_f", predictionCol="cell").fit(learned)
    return model.transform(ready).drop("_f")


def cell_topk(vectors: DataFrame, queries: DataFrame, k: int, *, nprobe: int, key: str = "chunk_id", vector: str = "vector", cell: str = "cell", carry: tuple[str, ...] = ()) -> DataFrame:
    """Search in the nprobe cells whose centroid is nearest: (query_id, key, carry..., score, rank).

    The queries are the stated query set and are broadcast with the cells that each probes, so a large cell is searched
    where its rows are, in as many tasks as it is read in; a batch's rows of a cell are multiplied with the queries that
    probe it, a block at a time.
    """
    near = queries.filter("vector is not null").select("query_id", F.col("vector").alias("q")).join(centroids(vectors, cell, vector), how="cross")  # queries x cells, both small by design
    near = near.withColumn("score", F.round(dot(F.col("q"), F.col("centroid")), 9))
    probes = ranked(near, nprobe, key="cell").groupBy("query_id").agg(F.first("q").alias("q"), F.collect_list("cell").alias("cells"))
    rows = probes.select("query_id", F.transform("q", lambda x: x.cast("double")), "cells").toLocalIterator()
    return _scan(vectors, rows, queries.schema["query_id"].dataType.simpleString(), max(1, k), key, vector, carry, cell)


#: Searches by name: functions of (vectors, queries, k, config, carry) that give hits.
INDEXES: Registry = Registry("index")


@INDEXES.register("flat_ip", "flat")
def flat_ip(vectors: DataFrame, queries: DataFrame, k: int, config: IndexConfig, carry: tuple[str, ...] = ()) -> DataFrame:
    return exact_topk(vectors, queries, k, carry=carry)


@INDEXES.register("ivf_flat", "ivf")
def ivf_flat(vectors: DataFrame, queries: DataFrame, k: int, config: IndexConfig, carry: tuple[str, ...] = ()) -> DataFrame:
    """k-means cells; a table that has a column `cell` keeps its own.  Fewer vectors than cells are searched exactly."""
    if "cell" not in vectors.columns:
        if vectors.limit(config.nlist).count() < config.nlist:
            return flat_ip(vectors, queries, k, config, carry)
        vectors = clustered(vectors, config.nlist)
    return cell_topk(vectors, queries, k, nprobe=config.nprobe, carry=carry)


#: Spark has no graph index; the exact search gives what such an index approximates.
INDEXES.register("hnsw")(flat_ip)


def search(vectors: DataFrame, queries: DataFrame, k: int, config: IndexConfig | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Hits by the index that config names; `auto` takes cells above its threshold of vectors."""
    config = config or IndexConfig()
    kind = config.chosen(vectors.count()) if config.kind == "auto" else config.kind
    return INDEXES.get(kind)(vectors, queries, k, config, carry)
