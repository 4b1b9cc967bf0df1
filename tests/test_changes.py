"""Reconciliation of landed tables, marts rebuilt by day, and coded word marts."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import d
from martkit.plans import gold
from martkit.plans.build import Build
from martkit.sources import claims, load, reconcile
from workload.marts import STOP_WORDS, Models
from workload.standins import CONTEXT

SCHEMA = "date date, account_id string, campaign_id string, clicks long"
SF = "/root/testdata/sf0.001"


def facts(spark, *rows):
    return spark.createDataFrame([(d(day), acc, camp, n) for day, acc, camp, n in rows], SCHEMA)


def test_discrepancies_name_the_days_that_differ(spark, rows):
    source = facts(spark, ("2024-05-01", "a", "x", 1), ("2024-05-02", "a", None, 2), ("2024-05-02", "b", "x", 3),
                   ("2024-06-01", "b", "x", 4), ("2024-06-02", None, "x", 5), ("2024-07-01", "c", "x", 6))
    landed = facts(spark, ("2024-05-01", "a", "x", 1), ("2024-05-02", "a", "", 2), ("2024-05-02", "b", "x", 3),
                   ("2024-06-01", "b", "x", 4), ("2024-06-01", "b", "x", 4), ("2024-07-02", "c", "x", 6))
    got = rows(reconcile.discrepancies(source, landed))
    assert got == sorted([("a", d("2024-05-02"), 1, 1), ("b", d("2024-06-01"), 1, 2), (None, d("2024-06-02"), 1, 0),
                          ("c", d("2024-07-01"), 1, 0), ("c", d("2024-07-02"), 0, 1)],
                         key=lambda t: tuple((v is None, str(v)) for v in t))
    assert rows(reconcile.discrepancies(source, source.select("clicks", "campaign_id", "account_id", "date"))) == []
    assert rows(reconcile.discrepancies(source.limit(0), source.limit(0))) == []


def test_found_ranges_are_repaired(spark, tmp_path, rows):
    path = str(tmp_path / "facts")
    source = facts(spark, *[(f"2024-05-{k:02d}", acc, "x", k) for k in range(1, 20) for acc in ("a", "b")])
    load.write_clustered(source.where("NOT (account_id = 'b' AND clicks IN (3, 4, 9))"), path)
    found = reconcile.discrepancies(source, load.open_table(spark, path, SCHEMA))
    assert [(r[1], r[2]) for r in rows(reconcile.ranges(found))] == [
        (d("2024-05-03"), d("2024-05-04")), (d("2024-05-09"), d("2024-05-09"))]
    assert reconcile.repair_found(source, found, path) == 2
    assert rows(load.open_table(spark, path, SCHEMA), *source.columns) == rows(source)


class Landed(Build):
    """A campaign mart whose rows are those of one landed table."""

    def campaign_mart(self):
        return self.raw("facts").select("date", F.lit("a").alias("platform"), F.col("account_id").alias("event_name"),
                                        F.col("campaign_id").alias("campaign_name"), "clicks")


def test_only_changed_days_of_a_mart_are_rebuilt(spark, tmp_path, rows):
    raw, marts = str(tmp_path / "raw"), str(tmp_path / "marts")
    days = [f"2024-05-{k:02d}" for k in range(1, 8)]
    load.reload_range(facts(spark, *[(x, "a", "c", 1) for x in days]), f"{raw}/facts", d(days[0]), d(days[-1]), ["a"])
    build = Landed(lambda name: load.open_table(spark, f"{raw}/{name}", SCHEMA), CONTEXT)
    assert build.refresh(spark, "campaign", marts, raw) is None

    def files():
        return {p.parent.name: p.name for p in Path(f"{marts}/campaign").rglob("part-*.parquet")}

    before = files()
    assert build.refresh(spark, "campaign", marts, raw) == [] and files() == before
    # two days change, one of them loses its only row
    load.reload_range(facts(spark, (days[2], "a", "c", 5)), f"{raw}/facts", d(days[2]), d(days[3]), ["a"])
    load.reload_range(facts(spark, (days[5], "b", "c", 6)), f"{raw}/facts", d(days[5]), d(days[5]), ["b"])
    assert build.refresh(spark, "campaign", marts, raw) == [d(days[2]), d(days[3]), d(days[5])]
    after = files()
    assert set(before) - set(after) == {f"date={days[3]}"}
    assert {x for x in after if after[x] != before[x]} == {f"date={days[2]}", f"date={days[5]}"}
    schema = build.campaign_mart().schema
    assert rows(load.open_table(spark, f"{marts}/campaign", schema), *schema.names) == rows(build.campaign_mart(), *schema.names)
    # a table replaced whole rebuilds the mart
    load.materialize(facts(spark, (days[0], "z", "c", 9)), f"{raw}/facts")
    assert build.refresh(spark, "campaign", marts, raw) is None
    assert rows(load.open_table(spark, f"{marts}/campaign", schema), *schema.names) == rows(build.campaign_mart(), *schema.names)
    assert claims.changes(spark, f"{raw}/facts")[0] is None


@pytest.mark.skipif(not Path(SF).is_dir(), reason="driver tables are absent")
def test_coded_word_mart_equals_the_plain_one_and_hashes(spark, tmp_path):
    source = Models(spark, SF).phrase_source().where("date >= '1998-01-01'")
    source = source.withColumn("campaign_status", F.when(~F.col("campaign_id").endswith("7"), F.col("campaign_status")))
    kept = tmp_path / "source"
    source.write.parquet(str(kept))
    source = spark.read.parquet(str(kept))
    plans = []

    def store(df):
        plans.append(df)
        df.write.parquet(str(tmp_path / "phrases"))
        return spark.read.parquet(str(tmp_path / "phrases"))

    coded = gold.coded_word_mart(source, STOP_WORDS, store)
    plain = gold.word_mart(gold.word_stats(source, STOP_WORDS), gold.phrase_texts(source)).select(coded.columns)
    assert coded.count() == plain.count() > 0
    assert coded.exceptAll(plain).count() == 0
    for df in (coded, *plans):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
