"""Registered queries against their DuckDB twins on the smallest data set, and the
driver entry point."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from tidemark.sources.tables import TABLES  # noqa: E402

# every query with a twin, but those of the optional subpackage (tested beside it)
TWINS = [name for name in E.catalog.QUERIES if name in E.catalog.ORACLE]


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small_dir}/{t}.parquet'")
    return c


def test_every_query_has_a_twin_or_is_marked():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    if E.llm_queries:       # these are tested against brute force beside their subpackage
        q = {k: v for k, v in q.items() if k not in E.llm_queries.QUERIES}
    rows_only = set(q) - set(o)
    assert rows_only == {"logreg_fit_scores", "logreg_unscaled_scores", "forest_scores", "forest_rules_scores", "boosted_scores",
                         "boosted_penalty_scores", "cv_grid_results", "holdout_grid_best", "model_roundtrip"}


@pytest.mark.parametrize("name", TWINS)
def test_query_matches_sql_twin(spark, con, small_dir, name):
    df = E.queries()[name](spark, small_dir)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"model_name", "split", "f1"} <= set(df.columns)
