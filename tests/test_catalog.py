"""Every registered query against its SQL counterpart, and against forbidden plan shapes."""

import pytest

import __spark_entry__ as contract
from convivio.plans import oracle
from convivio.plans.catalog import REGISTRY
from oracle_check import compare, connect

QUERIES, SQL = dict(REGISTRY), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, data, name):
    kept = {}

    def build(session, folder):
        kept["df"] = QUERIES[name](session, folder)
        return kept["df"]

    assert compare(spark, duck, data, build, SQL[name])["problems"] == {}
    plan = kept["df"]._jdf.queryExecution().executedPlan().toString()
    for shape in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert shape not in plan


def test_every_query_has_sql_or_a_reason():
    # DuckDB cannot see the folder the views read, so file sizes have no SQL.
    assert set(QUERIES) - set(SQL) == {"a6_file_sizes"}
    assert set(SQL) <= set(QUERIES)
    assert QUERIES.items() <= contract.queries().items() and SQL.items() <= contract.oracle_sql().items()


def test_file_sizes(spark, data):
    import os

    got = {r.table_name: (r.num_ranges, r.size_mb) for r in QUERIES["a6_file_sizes"](spark, data).collect()}
    want = os.path.getsize(f"{data}/orders.parquet") / 1024 / 1024
    assert got["posts"] == (1, pytest.approx(want))


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "username", "num_posts", "num_likes", "num_followers"]
    assert df.count() == 150
