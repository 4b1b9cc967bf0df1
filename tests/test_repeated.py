"""Dedup that keeps rows away from the window whose key no other row has."""

import pytest
from pyspark.sql import functions as F

from martkit.operators import dedup
from martkit.operators.bloom import Filter


@pytest.fixture(scope="module")
def reports(spark):
    return spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", 2, 1, "z"), (None, 1, 3, "n"), (None, 1, 3, "m"), ("a", None, 1, "o"),
         (None, None, 1, "p"), ("", 1, None, "q"), ("", 1, None, "r"), ("b", 9, 5, None), ("c", 9, 5, "s")],
        "k string, day int, _ingested_at int, v string")


@pytest.mark.parametrize("size", [dedup.REPEATED, Filter(32, 1)])
def test_latest_repeated_gives_the_rows_of_latest(spark, rows, reports, size):
    tripled = reports.unionAll(reports).unionAll(spark.createDataFrame([("c", 9, 6, "t")], reports.schema))
    for df in (reports, tripled, reports.limit(0)):
        got = dedup.latest_repeated(df, ["k", "day"], tie=["v"], size=size)
        assert got.columns == df.columns
        assert rows(got) == rows(dedup.latest(df, ["k", "day"], tie=["v"]))


def test_rows_alone_meet_no_window(spark, rows):
    ids = spark.range(2000).select("id", F.xxhash64("id").alias("_ingested_at"))
    twice = ids.unionAll(ids.where("id % 500 = 0"))
    got = dedup.latest_repeated(twice, ["id"])
    assert rows(got) == rows(ids)
    plan = got._jdf.queryExecution()
    got.collect()
    assert 4 <= _rows_into_windows(plan.executedPlan()) < 40  # the ids that come twice, and what the table takes for them


def _rows_into_windows(plan):
    """Rows that windows read, from the metrics of the exchange or the limit below them."""
    text = plan.getClass().getSimpleName()
    if text == "AdaptiveSparkPlanExec":
        return _rows_into_windows(plan.executedPlan())
    if text.endswith("QueryStageExec"):
        return _rows_into_windows(plan.plan())
    if text == "ShuffleExchangeExec" and "Window" in plan.child().toString().split("\n")[0]:
        return plan.metrics().apply("shuffleRecordsWritten").value()
    children = plan.children()
    return sum(_rows_into_windows(children.apply(i)) for i in range(children.size()))
