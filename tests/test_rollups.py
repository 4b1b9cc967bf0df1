"""Rollups that shuffle whole rows once."""

import os
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from martkit.operators import rollup
from martkit.operators.lookup import Bound
from martkit.plans import gold, silver
from martkit.plans.context import Context
from martkit.plans.gold import phrase_mart
from workload.marts import Models, model_ids
from workload.standins import CONTEXT

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _plan(df):
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


SUMS, ATTRS, RATIOS = ["n", "m"], ["name", "place"], {"r": ("n", "m")}


@pytest.mark.parametrize("hot_rows", [0, 2, 100_000])
def test_rollups_agree(spark, rows, hot_rows):
    df = spark.createDataFrame(
        [("a", 1, 1, 2, "x", None), ("a", 1, 1, 2, "y", "p"), ("a", 1, 3, 4, "x", "q"), ("a", 1, 5, None, None, None),
         (None, 1, 1, 1, "z", "p"), (None, 1, 2, 2, "z", "p"), ("b", None, None, None, None, None), ("b", 2, 1, 0, "w", "p")],
        "k string, day int, n int, m int, name string, place string")
    want = rows(rollup.rollup(df, ["day", "k"], SUMS, ATTRS, RATIOS))
    assert rows(rollup.rollup_once(df, ["day", "k"], SUMS, ATTRS, RATIOS)) == want
    assert rows(rollup.rollup_direct(df, ["day", "k"], SUMS, ATTRS, RATIOS, hot_rows=hot_rows)) == want
    assert rows(rollup.rollup_direct(df.limit(0), ["day", "k"], SUMS, ATTRS, RATIOS)) == []


def test_phrases_are_shuffled_once_by_their_keys(spark):
    m = Models(spark, SF)
    terms, creatives = m.a_search_terms(), m.b_creative()
    plan = _plan(phrase_mart(terms, creatives, m.ctx))
    by_phrase = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "top_search_combinations" in line]
    assert len(by_phrase) == 1


def test_campaign_days_are_shuffled_unsorted(spark):
    plan = _plan(Models(spark, SF).campaign_mart())
    assert "REPARTITION_BY_COL" in plan


def _shuffled(df, column):
    return [line for line in _plan(df).split("\n") if "Exchange hashpartitioning" in line and column in line]


def test_phrases_are_described_after_grouping(spark, rows):
    m = Models(spark, SF)
    late, early = m.phrases_mart(), phrase_mart(m.a_search_terms(), m.b_creative(), m.ctx)
    assert rows(late) == rows(early.select(late.columns))
    by_phrase = _shuffled(late, "top_search_combinations")
    assert by_phrase and not any("event_edition" in line or "cut_off_rate" in line for line in by_phrase)


def test_word_rows_are_described_after_grouping(spark, rows):
    m, keys = Models(spark, SF), [*gold.SET_KEYS, "raw_text"]
    total = {"combine": lambda p: rollup.phrase_totals(p, keys, "impressions", "total")}
    for kwargs in ({}, total):
        late = gold.word_stats(m.phrase_parts(), ["the"], **kwargs)
        assert rows(late) == rows(gold.word_stats(m.phrase_source(), ["the"], **kwargs).select(late.columns))
        assert not any("week_number" in line for line in _shuffled(late, "raw_text"))


def test_campaign_days_are_described_after_grouping(spark, rows):
    m = Models(spark, SF)
    late, early = m.campaign_mart(), gold.campaign_mart(m.a_campaign(), m.b_performance(), m.ctx)
    assert rows(late) == rows(early.select(late.columns))
    dealt = [line for line in _plan(late).split("\n") if "REPARTITION_BY_COL" in line]
    assert dealt and all("date" not in line.split(")")[0] for line in dealt)


@pytest.mark.parametrize("hot_rows", [0, 2, 100_000])
def test_described_rollups_agree(spark, rows, hot_rows):
    df = spark.createDataFrame(
        [("a", 1, 1, 2, "x"), ("a", 1, 3, 4, "y"), ("a", 2, 5, None, None), (None, 1, 1, 1, "z"), (None, 1, 2, 2, None),
         ("b", None, None, None, None), ("b", 2, 1, 0, "w")], "k string, day int, n int, m int, name string")

    def describe(groups):
        return groups.withColumn("place", F.concat("name", F.coalesce("k", F.lit("-"))))
    want = rows(rollup.rollup(describe(df), ["day", "k"], SUMS, ATTRS, RATIOS))
    assert rows(rollup.rollup_direct(df, ["day", "k"], SUMS, ATTRS, RATIOS, hot_rows=hot_rows, by=["k"], describe=describe)) == want


def test_old_versions_of_campaigns_do_not_count(spark):
    dim = spark.createDataFrame([(str(i % 3), "Active", i) for i in range(30)], "campaign_id string, effective_status string, _ingested_at int")
    dim = dim.withColumn("stop_time", F.lit(None).cast("timestamp"))
    assert silver.states_b(dim, Context(as_of=date(2024, 6, 1), bound=Bound(max_rows=3))).small


def test_ids_are_counted_without_a_window_over_whole_reports(spark, rows):
    assert "REPARTITION_BY_COL" in _plan(model_ids(spark, SF))
    again, once = Models(spark, SF), Models(spark, SF, replace(CONTEXT, read_again=False))
    assert rows(again.campaign_mart()) == rows(once.campaign_mart())
