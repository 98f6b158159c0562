"""Every registered query against its SQL in the second engine."""

import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as contract
from workload.oracle import all_oracles
from workload.queries import all_queries

SCALE = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in SCALE.glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_plans(monkeypatch):
    """Plans of all that is staged or loaded on the way."""
    plans, write = [], DataFrameWriter.parquet

    def recorded(self, *args, **options):
        plans.append(plan_of(self._df))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    return plans


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        return value.isoformat() if isinstance(value, datetime.date) else repr(value)

    return [names[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


#: Draws of numpy's sampler; see test_multinomial.
NO_SQL = {name for name in all_queries() if name.endswith("_multinomial")}


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles()) | NO_SQL and len(NO_SQL) == 3
    assert set(all_queries()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 15


@pytest.mark.parametrize("name", all_oracles())
def test_query_agrees_with_sql(spark, engine, name, stored_plans):
    found = all_queries()[name](spark, str(SCALE))
    stored_plans.append(plan_of(found))
    for plan in stored_plans:
        assert not [node for node in UNWANTED if node in plan]
    expected = engine.sql(all_oracles()[name])
    assert comparable(found.columns, found.collect()) == comparable(expected.columns, expected.fetchall())
