"""Every registered query beside its SQL twin on the smallest tables, and its physical plan."""

import duckdb
import pytest

from sectorlens.registry import catalog
from tools.check import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    result = QUERIES[name](spark, FOLDER)
    plan = plan_of(result)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    ours = result.toPandas()
    assert len(ours)
    if name in ORACLES:
        theirs = db.sql(ORACLES[name]).df()
        assert sorted(ours.columns) == sorted(theirs.columns)
        assert canonical(ours) == canonical(theirs)


def test_only_iterative_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"semantic_segments"}


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["proj_article_columns"](spark, FOLDER))
    assert "text" not in plan.split("ReadSchema:")[1]
    plan = plan_of(QUERIES["monthly_series"](spark, FOLDER))
    assert "o_custkey" not in plan and "LessThan(o_orderdate" in plan.split("PushedFilters:")[1]


def test_ranks_are_limited_before_the_shuffle(spark):
    for name in ("tfidf_topk", "explode_urls", "vector_topk"):
        assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, FOLDER)), name


def test_group_means_leave_the_rows_in_place(spark):
    plan = plan_of(QUERIES["group_mean_broadcast"](spark, FOLDER))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
