"""Every registered query equals its SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from airwave.plans.oracle import oracle_sql
from airwave.plans.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


# Nodes that would mean row-wise Python, all pairs, or rows from the driver.
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython",
          "MapInPandas", "ExistingRDD")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, sf_dir, name):
    ours, theirs, df, described = compare(spark, db, sf_dir, name)
    assert ours == theirs
    sql_types = {"bigint": "bigint", "int": "integer", "double": "double",
                 "string": "varchar", "boolean": "boolean"}
    kinds = {c[0]: str(c[1]).lower() for c in described}
    plan = df._jdf.queryExecution().executedPlan().toString()
    if not name.startswith("route_events"):  # its constant routing table comes from the driver
        assert not [node for node in BANNED if node in plan]
    assert {f.name: sql_types[f.dataType.simpleString()] for f in df.schema} == kinds


def test_entry(spark):
    assert entry.entry(spark).count() > 0
