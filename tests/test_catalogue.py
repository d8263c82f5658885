"""Every registered query of the engine against its SQL, and the driver contract."""

import math
import os

import pytest

import __spark_entry__
from fathomline.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fix = lambda v: None if isinstance(v, float) and math.isnan(v) else v + 0.0 if isinstance(v, float) else v
    return sorted(columns), sorted(repr(tuple(fix(r[i]) for i in order)) for r in found)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_matches_sql(spark, sf, duck, name):
    df = catalogue.QUERIES[name](spark, sf)
    cur = duck.execute(catalogue.ORACLE[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_query_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_contract(spark):
    q, o = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(o) <= set(q) and set(catalogue.QUERIES) <= set(q)
    assert __spark_entry__.entry(spark).count() > 0


def test_symbolic_plans_are_lean(spark, sf):
    """Filters and columns reach the scan; ranks are limited before the shuffle; no Python where none is needed."""
    plan = lambda n: catalogue.QUERIES[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
    p = plan("metadata_filter")
    assert "text" not in p.split("ReadSchema")[1] and "PushedFilters" in p
    assert "WindowGroupLimit" in plan("graph_explain")
    for name in ("rejection_report", "graph_evidence", "merge_next_chunk", "chunk_structural", "batch_summary", "html_to_text"):
        assert "Python" not in plan(name) and "Arrow" not in plan(name), name
