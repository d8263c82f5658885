"""Rows without an id get a result in every operator."""

import pytest

from fathomline.llm import bpe, language, licenses, neardup, pii, quality, repeats, shards
from fathomline.llm.common import without
from fathomline.llm.queries import vocabulary

OPERATORS = {
    "pii": lambda d, l: pii.pii(d),
    "bpe": lambda d, l: bpe.bpe(d, vocabulary()),
    "licenses": lambda d, l: licenses.licenses(d),
    "quality": lambda d, l: quality.quality(d, l),
    "repeats": lambda d, l: repeats.deduplicate(d),
    "language": lambda d, l: language.language(d),
    "shards": lambda d, l: shards.shards(d, n_shards=3),
    "neardup": lambda d, l: neardup.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_null_id(spark, labels, rows, name):
    some = [(*r,) for r in rows[4:8]] + [(None, rows[4][1], None, None, None, None, None, None), (None, None, "en", "s", 1, "x", 1, "y")]
    df = spark.createDataFrame(some, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, size int, component_id string")
    out = OPERATORS[name](df, labels)
    assert len({*out.columns}) == len(out.columns)
    got = sorted((r.doc_id is None, r.doc_id) for r in out.collect())
    assert [x for x in got if not x[0]] == [(False, i) for i in (4, 5, 6, 7)] and len(got) == 6


def test_without(spark):
    df = spark.createDataFrame([(i, "x") for i in range(1000)] + [(None, "n")], "doc_id bigint, v string")
    gone = spark.createDataFrame([(i,) for i in range(0, 1000, 3)], "doc_id bigint")
    assert sorted((r.doc_id or 0) for r in without(df, "doc_id", gone).collect()) == sorted([i for i in range(1000) if i % 3] + [0])
    assert without(df, "doc_id", gone.limit(0)).count() == 1001
