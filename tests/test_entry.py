"""Every registered query against its oracle, and the plans of the marts."""

import importlib
import math
import os

import duckdb
import pytest

from workload import marts, steps

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
entry = importlib.import_module("__spark_entry__")
QUERIES, ORACLES = ({**a, **b} for a, b in ((steps.QUERIES, marts.QUERIES), (steps.ORACLES, marts.ORACLES)))
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, db, name):
    df = QUERIES[name](spark, SF)
    mine = df.collect()
    result = db.execute(ORACLES[name])
    names, types = [c[0] for c in result.description], [str(c[1]) for c in result.description]
    cols = sorted(df.columns)
    assert cols == sorted(names)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == dict(zip(names, types, strict=True))
    order = [names.index(c) for c in cols]
    theirs = sorted(tuple(canonical(r[i]) for i in order) for r in result.fetchall())
    assert mine and sorted(tuple(canonical(r[c]) for c in cols) for r in mine) == theirs


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("mart_")))
def test_marts_have_no_nested_loop_or_cartesian_join(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text and "Python" not in text


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "cut_off_rate" in df.columns


def test_few_jobs_run_while_a_mart_is_planned(spark):
    context = spark.sparkContext
    QUERIES["mart_geo"](spark, SF)  # opens the tables, which reads file footers
    context.setJobGroup("plan of a mart", "")
    try:
        QUERIES["mart_geo"](spark, SF)
        # the calendar and two campaign dimensions are counted once; an adaptive count is up to three jobs
        assert len(context.statusTracker().getJobIdsForGroup("plan of a mart")) <= 9
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_no_fact_is_sorted_to_be_rolled_up(spark):
    text = QUERIES["campaign_rollup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    first = text.rindex("HashAggregate")  # the aggregate next to the scan
    assert "SortAggregate" not in text[first:]
