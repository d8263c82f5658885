"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, BPE.

Each stage takes (spark, docs, sf_dir) and gets all that its predecessor kept.  Null and empty texts fail the quality
rules and go in the first stage; rows that repeat an id are one document to the second; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm import bpe, decontaminate, neardup, pii, quality
from fathomline.llm.common import dropped, scratch, table, tidied, without, written
from fathomline.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


#: The stage's own threshold is a similarity of 0.8; with 40 bands of 5 rows a pair at exactly 0.8 shares no band with a
#: chance of 1.3e-7.
NEAR = neardup.Params(percent=80, bands=40, rows=5, batch=25)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id; near is a similarity of 0.8 or more.

    A bitmap of the ids that go lets most other documents pass without a shuffle; a row without an id stays.
    """
    found = neardup.near_duplicates(docs, NEAR)
    gone = written(found.filter(~F.col("kept")).select("doc_id").distinct(), "near-gone")
    return without(docs, "doc_id", gone)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  A null or empty text holds none and stays; an empty benchmark lets all stay."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked.  A null text stays null; a text without personal data stays as it is."""
    return pii.masked_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and digests of the ids and of the decoded text.  A null text has no ids."""
    return bpe.bpe(docs, vocabulary(), with_text=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("bpe", tokens),
]

#: SQL can't express the stages; tests/llm compares each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each one's result written to the shared folder and read again for the next."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        with tidied(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if last is not None:
            dropped(last)
        docs = last = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
