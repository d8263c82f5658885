"""Where registered queries are collected."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline.session import shipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors see: that of spark.checkpoint.dir.  Only a local
    session without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fathomline-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/fathomline/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in that folder: what several jobs read is computed once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of (table, spark), table(name) being a DataFrame; sql says the same for DuckDB."""

    def add(make):
        key = name or make.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shipped(spark)
            return make(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"), spark)

        run.__name__ = key
        QUERIES[key] = run
        if sql:
            ORACLE[key] = sql
        return make

    return add
