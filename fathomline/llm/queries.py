"""The registered queries of the corpus operators, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline.llm import bpe, decontaminate, language, licenses, neardup, pii, quality, repeats, shards, warc
from fathomline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    """The default vocabulary file; every operator takes another path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False, with_text=False)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicate(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc(table(spark, sf_dir, "pages"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(table(spark, sf_dir, "documents"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shards(table(spark, sf_dir, "documents"), n_shards=40)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_pii, op2_bpe, op3_licenses, op4_quality, op5_repeats, op6_warc, op7_language, op8_shards, op9_decontaminate, op10_neardup)}
WARC_SQL = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM m"""

NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

ORACLE: dict[str, str] = {"op3_licenses": licenses.oracle_sql(), "op6_warc": WARC_SQL, "op10_neardup": NEAR_SQL}
