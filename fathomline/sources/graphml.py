"""GraphML in and out."""

from __future__ import annotations

from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _data(element: str, key: str) -> Column:
    return F.get(F.transform(F.filter(element, lambda d: d["_key"] == key), lambda d: d["_VALUE"]), 0)


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entities, triples); a node without a type is OTRO, an edge without one COOCURRENCIA, confidence defaults to 1."""
    data = "data array<struct<_key:string,_VALUE:string>>"
    nodes = spark.read.format("xml").option("rowTag", "node").schema(f"_id string, {data}").load(path)
    edges = spark.read.format("xml").option("rowTag", "edge").schema(f"_id string, _source string, _target string, {data}").load(path)
    entities = nodes.select(F.col("_id").alias("id"), F.coalesce(_data("data", "nombre"), "_id").alias("nombre"), F.coalesce(_data("data", "tipo"), F.lit("OTRO")).alias("tipo"))
    triples = edges.select(
        F.coalesce(_data("data", "sujeto"), "_source").alias("sujeto"), F.coalesce(_data("data", "relacion"), F.lit("COOCURRENCIA")).alias("relacion"), F.coalesce(_data("data", "objeto"), "_target").alias("objeto"),
        _data("data", "doc_id").alias("doc_id"), _data("data", "chunk_id").alias("chunk_id"), _data("data", "evidencia").alias("evidencia"), F.coalesce(_data("data", "confianza").cast("double"), F.lit(1.0)).alias("confianza"),
    )
    return entities, triples


def write(entities: DataFrame, triples: DataFrame, path: str) -> None:
    """One undirected GraphML file: nodes by id, an edge a triple.

    The format is a single file, so its lines pass the driver, one partition at a time and never all at once, to a
    stream in the path's own file system, whichever that is.
    """

    def data(key: str, value) -> str:
        return "" if value in (None, "") else f"<data key={quoteattr(key)}>{escape(str(value))}</data>"

    def lines() -> Iterator[str]:
        yield '<?xml version="1.0" encoding="UTF-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n'
        for k, of in (("nombre", "node"), ("tipo", "node"), *((k, "edge") for k in ("sujeto", "relacion", "objeto", "doc_id", "chunk_id", "evidencia", "confianza"))):
            yield f'<key id="{k}" for="{of}" attr.name="{k}" attr.type="{"double" if k == "confianza" else "string"}"/>\n'
        yield '<graph id="G" edgedefault="undirected">\n'
        for r in entities.orderBy("id").toLocalIterator():
            yield f"<node id={quoteattr(r.id)}>{data('nombre', r.nombre)}{data('tipo', r.tipo)}</node>\n"
        for i, r in enumerate(triples.orderBy("sujeto", "relacion", "objeto", "chunk_id").toLocalIterator()):
            parts = "".join(data(k, f"{r[k]:.6f}" if k == "confianza" else r[k]) for k in ("sujeto", "relacion", "objeto", "doc_id", "chunk_id", "evidencia", "confianza"))
            yield f'<edge id="e{i}" source={quoteattr(r.sujeto)} target={quoteattr(r.objeto)}>{parts}</edge>\n'
        yield "</graph>\n</graphml>\n"

    spark = entities.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        held: list[str] = []
        for line in lines():
            held.append(line)
            if len(held) == 5000:
                out.write(bytearray("".join(held).encode()))
                held = []
        out.write(bytearray("".join(held).encode()))
    finally:
        out.close()
