"""Scanning a corpus folder into documents."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.text import file_name
from fathomline.sources.kernels import EXTRACTORS

#: Files that operating systems leave behind.
IGNORED = ("Thumbs.db", "desktop.ini", ".DS_Store", "ehthumbs.db")


def scan(spark: SparkSession, root: str, extensions: list[str] | None = None) -> DataFrame:
    """(path, content, ext) of the files below root, without hidden and left-behind ones; a missing or empty folder gives
    no rows.  Callers sort by path where they need an order."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "path string, content binary, ext string")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = file_name(F.col("path"))
    df = df.select("path", "content", F.lower(F.element_at(F.split(name, r"\."), -1)).alias("ext"), name.alias("_name"))
    df = df.filter(~F.col("_name").startswith(".") & ~F.col("_name").isin(*IGNORED)).drop("_name")
    return df.filter(F.col("ext").isin(*[e.lstrip(".").lower() for e in extensions])) if extensions else df


_SCHEMA = "path string, titulo string, idioma string, fecha string, secciones array<struct<titulo:string,texto:string,orden:int,splittable:boolean>>, error string"


def extract(files: DataFrame) -> DataFrame:
    """(path, titulo, idioma, fecha, secciones, error): sections by the extractor of the file's extension; a file that
    can't be read has an error in place of sections and doesn't stop the others."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("titulo", pa.string()), ("texto", pa.string()), ("orden", pa.int32()), ("splittable", pa.bool_())]))
        for batch in batches:
            rows = []
            for path, content, ext in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                try:
                    title, language, date, sections = EXTRACTORS.get(ext)(content.as_py())
                    rows.append((path, title, language, date, [{"titulo": (t or "").strip() or None, "texto": x, "orden": i, "splittable": s} for i, (t, x, s) in enumerate(sections)], None))
                except Exception as e:
                    rows.append((path, None, None, None, None, f"{type(e).__name__}: {e}"))
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), kind, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*zip(*rows)] or [()] * 6, kinds)], names=["path", "titulo", "idioma", "fecha", "secciones", "error"])

    return files.select("path", "content", "ext").mapInArrow(read, _SCHEMA)


def topic_map(text: str) -> dict[str, int]:
    """`{"folder": 1}` with lower-case keys; entries that are no integers are left out."""
    return {str(k).lower(): int(v) for k, v in json.loads(text).items() if isinstance(v, int) and not isinstance(v, bool) or isinstance(v, str) and v.isdigit()}


def topic(path: Column, topics: dict[str, int], default: int | None = None) -> Column:
    """The topic of the nearest mapped folder; else of the first key contained in the file's stem; else the default."""
    parts = F.split(F.lower(path), r"[\\/]")
    folders = F.reverse(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))
    near = F.lit(None).cast("int")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    if topics:
        table = F.create_map(*[x for k, v in topics.items() for x in (F.lit(k), F.lit(v))])
        near = F.get(F.filter(F.transform(folders, lambda f: table[f]), lambda x: x.isNotNull()), 0)
        near = F.coalesce(near, *[F.when(stem.contains(k), v) for k, v in topics.items()])
    return F.coalesce(near, F.lit(default).cast("int"))


def documents(spark: SparkSession, root: str, topics: dict[str, int], default_topic: int = 1) -> DataFrame:
    """documents of a folder: doc_id is the path below root; files with errors have no sections and an error."""
    found = extract(scan(spark, root))
    doc_id = F.regexp_replace("path", "^.*?" + root.rstrip("/").replace("\\", "/").replace(".", "[.]") + "/", "")
    return found.select(doc_id.alias("doc_id"), file_name(F.col("path")).alias("fuente"), F.lower(F.element_at(F.split("path", r"\."), -1)).alias("formato"), topic(doc_id, topics, default_topic).alias("fenomeno"), "secciones", "idioma", "titulo", "fecha", "error")


#: Extensions whose files are plain text.
PLAIN = ("md", "markdown", "txt", "html", "htm", "json", "csv")


def plain_texts(spark: SparkSession, root: str, limit: int = 500) -> DataFrame:
    """(path, text) of the plain-text files among the first entries of the tree, folders counted, in the order of their
    paths: a quick look before a scan of everything, and limited as such."""
    files = scan(spark, root)
    parts = F.split("path", "/")
    # an entry is a file or any folder above it, below root
    depth = F.size(F.split(F.lit(root.rstrip("/").split("://")[-1].split(":")[-1]), "/"))
    folders = files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("path")).distinct()
    base = F.array_join(F.slice(F.split(F.regexp_replace("path", "^[a-z]+:/*", "/"), "/"), 1, depth), "/")
    below = folders.filter((F.size(F.split(F.regexp_replace("path", "^[a-z]+:/*", "/"), "/")) > depth) & (base != "")).select("path", F.lit(None).cast("binary").alias("content"), F.lit(None).cast("string").alias("ext"))
    # a path's components are compared one by one, as a tree is walked
    first = files.unionByName(below).orderBy(F.split("path", "/")).limit(limit)
    found = first.filter(F.col("ext").isin(*PLAIN))
    return found.select("path", F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1")).alias("text"))
