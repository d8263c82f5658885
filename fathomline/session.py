"""Session with the settings that the engine expects."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "fathomline", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; conf overrides, with dots written as double underscores."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return SparkSession.builder.appName(name).config(map=defaults | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


#: Rows in one Arrow batch.  Texts may be long, so batches hold few rows.  Spark's limit on a batch's bytes isn't used: with
#: it one run of op5_repeats in the check tool took 3,998 MB of an executor and another 2,240, without it 2,117.
BATCH_ROWS = 500

_shipped: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Sends this package to the workers, once a session, so that they find it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        target = f"{tempfile.mkdtemp(prefix='fathomline-code-')}/{package.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        sc.addPyFile(target)
        _shipped.add(sc.applicationId)
    return spark


def small_batches(df: DataFrame) -> DataFrame:
    """df, ready for Python workers: the package is there, and Arrow batches of texts are small.

    Spark reads the limit from the session when it plans a query, so it is lowered there; a session that asks for
    smaller batches keeps them.
    """
    shipped(df.sparkSession)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df
