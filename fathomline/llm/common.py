"""Scratch tables and small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from fathomline.session import BATCH_ROWS, small_batches  # noqa: F401

#: What `[^\x20\x09-\x0D]+` leaves out; bytes.split() uses exactly these six.
BLANKS = " \t\n\r\x0b\x0c"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is the one that the cluster names in ``spark.checkpoint.dir``.  Where that is unset, a local session (as in
    tests) gets a temporary folder of its own; on a cluster that is an error, since no local folder would be shared.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fathomline-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    import pyarrow.fs  # not at the top: most workers need no file systems in their memory

    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/fathomline/{name}-{uuid.uuid4().hex}"


#: Paths of this driver's tables that are still there, oldest first.
_made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends here and a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, name)
    _made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared one, if it is there."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(own, True)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() made and that nothing reads any more."""
    for df in tables:
        for root in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/fathomline/" in root:
                deleted(df.sparkSession, root)
                _made[:] = [p for p in _made if p.rpartition("/")[2] != root.rpartition("/")[2]]


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end, all tables that written() made meanwhile: nothing that reads them may be used afterwards."""
    before = set(_made)
    try:
        yield
    finally:
        for path in [p for p in _made if p not in before]:
            deleted(spark, path)
            _made.remove(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name, a column name like it that df doesn't have; Spark compares names without case."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def id_kind(df: DataFrame, id_col: str) -> str:
    """The type in which operators compare ids: bigint for all whole numbers, otherwise the column's own."""
    kind = df.schema[id_col].dataType
    return "bigint" if isinstance(kind, IntegralType) else kind.simpleString()


def arrow_kind(kind: str) -> pa.DataType:
    """The Arrow type of a Spark type."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(kind))


def numbered(ids: DataFrame, column: str) -> DataFrame:
    """(column, n): each distinct value that isn't null, with a whole number in the values' order.

    Ranges of values are sorted apart, so no task sees all; the numbers have gaps.  A table in the shared folder, as
    numbers made anew could differ.
    """
    own = ids.select(column).filter(F.col(column).isNotNull()).distinct()
    return written(own.repartitionByRange(column).sortWithinPartitions(column).select(column, F.monotonically_increasing_id().alias("n")), "numbered")


def filtered(docs: DataFrame, text_col: str, made: Callable[[], Callable[[str | None], bool]]) -> DataFrame:
    """The rows of docs, all columns as they are, whose text passes; made() gives a worker its test.  No shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = None
        for batch in batches:
            test = test or made()
            yield batch.filter(pa.array([test(t.as_py()) for t in batch.column(at)], pa.bool_()))

    at = docs.columns.index(text_col)
    return small_batches(docs).mapInArrow(rows, docs.schema)


def bitmap(ids: DataFrame, column: str, most_bits: int = 28) -> DataFrame:
    """(line, map): a one-hash bitmap of the ids, 16 bits an id up to 2 ** most_bits bits, in lines of 4 KB.

    With the default it has at most 32 MB, so broadcasting it is safe at any size of ids; beyond 2 ** 24 ids it only
    sorts out fewer rows.
    """
    n = ids.count()
    bits = min(most_bits, max(15, (16 * n).bit_length()))
    slot = F.xxhash64(column).bitwiseAND(F.lit((1 << bits) - 1))
    lines = ids.select(F.shiftright(slot, 15).alias("line"), slot.bitwiseAND(F.lit(32_767)).alias("bit"))
    return lines.groupBy("line").agg(F.expr("bitmap_construct_agg(bit)").alias("map"), F.lit(bits).alias("bits"))


def perhaps(df: DataFrame, column: str, lines: DataFrame, mark: str) -> DataFrame:
    """df with the new column mark: false only where the column's value is surely not among the bitmap's ids.  No shuffle."""
    first = lines.select("bits").first()
    if first is None:
        return df.withColumn(mark, F.lit(False))
    line, own_map = fresh(df, "_line", "_map")
    slot = F.xxhash64(column).bitwiseAND(F.lit((1 << first[0]) - 1))
    own = lines.select(F.col("line").alias(line), F.col("map").alias(own_map))
    bit = slot.bitwiseAND(F.lit(32_767)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(own_map), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("getbit", byte, bit.bitwiseAND(F.lit(7))) == 1
    joined = df.withColumn(line, F.shiftright(slot, 15)).join(F.broadcast(own), line, "left")
    return joined.withColumn(mark, F.coalesce(hit, F.lit(False))).drop(line, own_map)


def without(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of df whose column isn't among ids(column).  Only rows that perhaps are go through a shuffle."""
    mark = fresh(df, "_perhaps")[0]
    marked = perhaps(df, column, written(bitmap(ids, column), "bitmap"), mark)
    sure = marked.filter(~F.col(mark)).select(df.columns)
    return sure.unionByName(marked.filter(F.col(mark)).join(ids.select(column), column, "left_anti").select(df.columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
