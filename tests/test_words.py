"""Words of whole phrases (J33) without a shuffle per word."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from martkit.operators.rollup import phrase_totals
from martkit.plans import gold

SCHEMA = ("date date, platform string, account_name string, account_id string, campaign_name string, "
          "campaign_status string, campaign_id string, event_name string, event_edition string, week_display string, "
          "week_number int, week_number_to_sort int, weeks_left string, cut_off_rate string, "
          "cut_off_rate_sort_order int, currency string, raw_text string, cost double, impressions long, clicks long, "
          "unique_clicks long, conversions double, conversion_value double")


def source(spark):
    def row(day, campaign, text, n):
        return (day, "A", "n", "1", "c", "On", campaign, "e", "ed", "Week 1", 1, 1, "1", "EB", 2, "EUR", text, 1.5, n, 1,
                None, 0.0, 0.5)
    data = [row("2024-05-01", "c1", "two one two the", 5), row("2024-05-02", "c1", "two one two the", 7),
            row("2024-05-02", "c1", "two one two the", 1), row("2024-05-01", None, "one", 2),
            row("2024-05-01", "c1", None, 9), row("2024-05-01", "c1", "an", 9), row("2024-05-01", "c1", "", 9)]
    text = SCHEMA.replace("date date", "date string")
    return spark.createDataFrame(data, text).withColumn("date", F.col("date").cast("date"))


def after_explode(df):
    """Exchanges above the generator in the plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall("Exchange", text[:text.index("Generate")])


def test_word_stats_counts_words_in_their_phrase(spark, rows):
    stats = gold.word_stats(source(spark), ["the"])
    assert stats.columns == [*gold.WORD_KEYS, *gold.WORD_SUMS]
    assert rows(stats, F.col("date").cast("string"), "campaign_id", "word", "impressions", "clicks", "unique_clicks", "cost") == [
        ("2024-05-01", "c1", "one", 5, 1, None, 1.5), ("2024-05-01", "c1", "two", 10, 2, None, 3.0),
        ("2024-05-01", None, "one", 2, 1, None, 1.5),
        ("2024-05-02", "c1", "one", 8, 2, None, 3.0), ("2024-05-02", "c1", "two", 16, 4, None, 6.0)]
    assert not after_explode(stats)


def test_phrase_totals_group_whole_phrases(spark, rows):
    keys = [*gold.SET_KEYS, "phrase_key", "raw_text"]
    totals = gold.word_stats(source(spark), ["the"], combine=lambda p: phrase_totals(p, keys, "impressions", "total"))
    assert totals.columns == [*gold.GLOBAL_KEYS, "phrase_key", "total"]
    assert rows(totals, "campaign_id", "word", "total") == [("c1", "one", 13), ("c1", "two", 26), (None, "one", 2)]
    plain = phrase_totals(gold.word_stats(source(spark), ["the"]), [*gold.GLOBAL_KEYS, "phrase_key"], "impressions", "total")
    assert rows(totals) == rows(plain)
    assert not after_explode(totals)


def test_coded_mart_deals_small_campaigns_whole(spark, rows, tmp_path):
    src = source(spark)
    plain = gold.word_mart(gold.word_stats(src, ["the"]), gold.phrase_texts(src))

    def mart(name, limit):
        def store(df):
            df.write.parquet(str(tmp_path / name))
            return spark.read.parquet(str(tmp_path / name))
        return gold.coded_word_mart(src, ["the"], store, set_bytes=limit).select(plain.columns)

    for name, limit in (("dealt", 1 << 20), ("spread", 0), ("both", 650)):
        assert rows(mart(name, limit)) == rows(plain)
    tree = mart("plan", 1 << 20)._jdf.queryExecution().executedPlan().toString().split("Union")[1]
    dealt, spread = tree.split("\n   +- ")
    assert "Generate" in dealt and not re.search(r"hashpartitioning\([^)]*word", dealt)
    assert re.search(r"hashpartitioning\([^)]*word", spread)


def test_dealt_campaigns_are_shuffled_once(spark, tmp_path):
    def store(df):
        df.write.parquet(str(tmp_path / "once"))
        return spark.read.parquet(str(tmp_path / "once"))

    tree = gold.coded_word_mart(source(spark), ["the"], store)._jdf.queryExecution().executedPlan().toString()
    dealt = tree.split("Union")[1].split("\n   +- ")[0]
    assert dealt.count("REPARTITION_BY_NUM") == 1 and not re.search(r"Join[^\n]*word", dealt)
