"""Missing ids by grouping."""

from martkit.operators import lookup


def _plan(df):
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


def test_missing_ids_are_grouped_not_joined(spark, rows):
    needed = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",), ("c",)], "id string")
    found = spark.createDataFrame([("b", 1), (None, 2), ("b", 3), ("d", 4)], "id string, n int")
    missing = lookup.missing_ids(needed, found, "id")
    assert rows(missing) == [("a",), ("c",)]
    assert "Join" not in _plan(lookup.missing_ids(needed, found, "id"))
    assert rows(lookup.missing_ids(needed, found.limit(0), "id")) == [("a",), ("b",), ("c",)]
    longs = spark.createDataFrame([(1,), (2,)], "id long")
    assert rows(lookup.missing_ids(longs, spark.createDataFrame([(2,)], "id int"), "id")) == [(1,)]
    fetched = spark.createDataFrame([(7, "b"), (8, "a"), (9, "a"), (10, None)], "n int, id string")
    assert rows(lookup.fill_gaps(found, fetched, "id")) == [
        ("a", 8), ("a", 9), ("b", 1), ("b", 3), ("d", 4), (None, 2)]
