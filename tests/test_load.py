import json
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import d
from martkit.sources import claims, load, quality
from martkit.sources.schemas import RAW, lookback_days, raw_schema
from martkit.sources.tables import jdbc_options, read_sheet, read_table, register_view, seed

SCHEMA = "date date, account_id string, campaign_id string, clicks long"


def facts(spark, *rows):
    return spark.createDataFrame([(d(day), acc, camp, n) for day, acc, camp, n in rows], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "facts")
    load.write_clustered(facts(spark, ("2024-05-01", "a", "c1", 1), ("2024-05-02", "a", "c1", 2),
                               ("2024-05-03", "a", "c1", 3), ("2024-05-02", "b", "c9", 20),
                               ("2024-05-09", "a", "c1", 9), ("2024-05-03", None, "c0", 5)), path)
    return path


def read(spark, path, rows):
    return rows(spark.read.schema(SCHEMA).parquet(path).select("date", "account_id", "clicks"))


def test_reload_twice_replaces_only_the_listed_account(spark, table, rows):
    batch = facts(spark, ("2024-05-02", "a", "c1", 200), ("2024-05-04", "a", "c2", 400))
    expected = [(d("2024-05-01"), "a", 1), (d("2024-05-02"), "a", 200), (d("2024-05-02"), "b", 20),
                (d("2024-05-03"), None, 5), (d("2024-05-04"), "a", 400), (d("2024-05-09"), "a", 9)]
    for _ in range(2):
        assert load.reload_range(batch, table, d("2024-05-02"), d("2024-05-04"), ["a"])
        assert read(spark, table, rows) == expected


def test_days_without_rows_disappear(spark, table, rows):
    batch = facts(spark, ("2024-05-09", "a", "c1", 90))
    load.reload_range(batch, table, d("2024-05-01"), d("2024-05-09"), ["a"])
    assert read(spark, table, rows) == [(d("2024-05-02"), "b", 20), (d("2024-05-03"), None, 5),
                                        (d("2024-05-09"), "a", 90)]
    assert {r[0] for r in spark.read.parquet(table).select("date").distinct().collect()} == {
        d("2024-05-02"), d("2024-05-03"), d("2024-05-09")}


def test_empty_batch_changes_nothing(spark, table, rows):
    before = read(spark, table, rows)
    assert not load.reload_range(facts(spark, ("2024-05-01", "a", "c", 1)).limit(0), table, d("2024-05-01"),
                                 d("2024-05-09"), ["a"])
    assert read(spark, table, rows) == before


def test_rows_outside_the_range_are_refused(spark, table, rows):
    before = read(spark, table, rows)
    for bad in (("2024-05-05", "a", "c", 1), ("2024-05-01", "b", "c", 1), ("2024-05-01", None, "c", 1)):
        with pytest.raises(ValueError, match="1 rows outside"):
            load.reload_range(facts(spark, bad, ("2024-05-01", "a", "c", 1)), table, d("2024-05-01"),
                              d("2024-05-02"), ["a"])
    assert read(spark, table, rows) == before


def test_other_columns_are_refused(spark, table):
    batch = facts(spark, ("2024-05-01", "a", "c", 1)).withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="extra"):
        load.reload_range(batch, table, d("2024-05-01"), d("2024-05-02"), ["a"])


def test_other_types_are_refused(spark, table):
    batch = facts(spark, ("2024-05-01", "a", "c", 1))
    changed = batch.withColumn(batch.columns[-1], F.col(batch.columns[-1]).cast("double"))
    with pytest.raises(ValueError, match=batch.columns[-1]):
        load.reload_range(changed, table, d("2024-05-01"), d("2024-05-02"), ["a"])


@pytest.mark.parametrize("stop", ["before the mark", "after the mark", "between two days", "before a drop"])
def test_a_stopped_reload_loses_no_row(spark, table, rows, monkeypatch, stop):
    """Accounts outside the batch keep their rows, whenever the load stops."""
    batch = facts(spark, ("2024-05-01", "a", "c", 70), ("2024-05-03", "a", "c", 71))
    args = (batch, table, d("2024-05-01"), d("2024-05-04"), ["a"])
    before = read(spark, table, rows)
    others = [r for r in before if r[1] != "a"]

    class Stop(Exception):
        pass

    with monkeypatch.context() as m:
        folder, calls = load._Folder, []

        def fail(*_):
            raise Stop

        if stop == "before the mark":
            m.setattr(folder, "write", fail)
        else:
            take, delete = folder.take, folder.delete
            first = {"after the mark": 1, "between two days": 2}.get(stop, 99)

            def counted(self, other, name):
                calls.append(name)
                if len(calls) == first:
                    delete(self, name)  # the old day is gone already
                    raise Stop
                take(self, other, name)

            def dropped(self, name=""):
                if stop == "before a drop" and calls and not name:
                    raise Stop
                delete(self, name)

            m.setattr(folder, "take", counted)
            m.setattr(folder, "delete", dropped)
        with pytest.raises(Stop):
            load.reload_range(*args)
    if stop == "before the mark":
        assert read(spark, table, rows) == before
    load.recover(spark, table)
    left = [r for r in read(spark, table, rows) if r[1] != "a"]
    assert left == others
    assert load.reload_range(*args)
    after = read(spark, table, rows)
    assert [r for r in after if r[1] != "a"] == others
    assert [r for r in after if r[1] == "a" and d("2024-05-01") <= r[0] <= d("2024-05-04")] == [
        (d("2024-05-01"), "a", 70), (d("2024-05-03"), "a", 71)]


def test_text_keys_keep_their_zeros(spark, tmp_path, rows):
    path, schema = str(tmp_path / "zeros"), "account_id string, v long"
    df = spark.createDataFrame([("007", 1), ("0123", 2)], schema)
    load.reload_accounts(df, path)
    assert rows(load.open_table(spark, path, schema), "account_id", "v") == [("007", 1), ("0123", 2)]
    keyed = df.withColumnRenamed("account_id", "date")
    assert rows(load.materialize(keyed, str(tmp_path / "mart")), "date", "v") == [("007", 1), ("0123", 2)]


def test_first_load_and_repair(spark, tmp_path, rows):
    path = str(tmp_path / "new")
    assert load.reload_range(facts(spark, ("2024-05-01", "a", "c", 1)), path, d("2024-05-01"), d("2024-05-01"), ["a"])
    history = facts(spark, ("2024-05-01", "a", "c", 7), ("2024-05-02", "b", "c", 8), ("2020-01-01", "a", "c", 9))
    load.repair(history, path, ["a"], d("2024-01-01"), d("2024-12-31"))
    assert read(spark, path, rows) == [(d("2024-05-01"), "a", 7)]


def test_window_chunks_and_years(spark, table):
    today = d("2024-06-01")
    facts_df = spark.read.parquet(table)
    assert load.next_window(facts_df, 14, d("2022-01-01"), today) == (d("2024-04-25"), today)
    assert load.next_window(None, 14, d("2022-01-01"), today) == (d("2022-01-01"), today)
    assert load.next_window(facts_df.limit(0), 30, d("2022-01-01"), today) == (d("2022-01-01"), today)
    ranges = spark.createDataFrame([(d("2024-01-01"), d("2024-03-15")), (d("2024-02-01"), d("2024-01-01"))],
                                   "start_date date, end_date date")
    chunks = [tuple(r) for r in load.date_chunks(ranges, 30).select("chunk_start", "chunk_end").collect()]
    assert chunks == [(d("2024-01-01"), d("2024-01-31")), (d("2024-02-01"), d("2024-03-02")),
                      (d("2024-03-03"), d("2024-03-15"))]
    assert load.year_slices(2023, today) == [(d("2023-01-01"), d("2023-12-31")), (d("2024-01-01"), today)]


def test_backfill_by_year(spark, tmp_path, rows):
    path = str(tmp_path / "years")
    df = facts(spark, ("2022-05-01", "a", "c", 1), ("2024-01-01", "a", "c", 2), ("2024-07-01", "a", "c", 3))
    assert load.backfill(df, path, 2022, d("2024-06-01"), ["a"]) == 2
    assert read(spark, path, rows) == [(d("2022-05-01"), "a", 1), (d("2024-01-01"), "a", 2)]


def test_snapshot_reload_by_account(spark, tmp_path, rows):
    path, schema = str(tmp_path / "dim"), "account_id string, campaign_id string, status string"
    load.reload_accounts(spark.createDataFrame([("a", "1", "x"), ("a", "2", "x"), ("b", "3", "x")], schema), path)
    fresh = spark.createDataFrame([("a", "1", "y")], schema)
    assert load.reload_accounts(fresh, path) and load.reload_accounts(fresh, path)
    assert not load.reload_accounts(fresh.limit(0), path)
    assert rows(spark.read.schema(schema).parquet(path), "account_id", "campaign_id", "status") == [
        ("a", "1", "y"), ("b", "3", "x")]


def test_full_refresh_skips_empty(spark, tmp_path):
    path = str(tmp_path / "ref")
    assert load.full_refresh(spark.range(3), path)
    assert not load.full_refresh(spark.range(0), path)
    assert spark.read.parquet(path).count() == 3


def test_clustered_files_are_sorted_and_one_day_can_be_split(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.range(1000).select(F.lit(d("2024-05-01")).alias("date"), (F.col("id") * 7 % 10).alias("k"))
    out = load.materialize(df, path, ["k"])
    per_file = out.groupBy(F.input_file_name()).agg(F.collect_list("k").alias("ks")).collect()
    assert sum(len(r.ks) for r in per_file) == 1000 and all(r.ks == sorted(r.ks) for r in per_file)
    hinted = df.hint("rebalance", "date")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in hinted


def test_stamp(spark):
    at = datetime(2024, 5, 1, 6)
    assert load.stamp(spark.range(1), at).first()["_ingested_at"] == at
    assert load.stamp(spark.range(1)).first()["_ingested_at"] is not None


def test_sheet_with_bom_quotes_and_repeated_header(spark, tmp_path, rows):
    path = tmp_path / "sheet.csv"
    path.write_bytes('﻿"code,name"\n"AA,Alpha"\r\n"code,name"\nBB,"Beta, Inc"\nCC,\n'.encode())
    assert rows(read_sheet(spark, str(path), ["code", "name"])) == [("AA", "Alpha"), ("BB", "Beta, Inc"), ("CC", None)]


def test_registry_and_readers(spark, tmp_path, rows):
    assert len(RAW) == 41 and all(raw_schema(name) for name in RAW)
    assert lookback_days("a_conversion_action") == 30 and lookback_days("a_geo") == 14
    df = seed(spark, [("AA", "Alpha")], RAW["countries"])
    df.write.parquet(str(tmp_path / "countries"))
    assert rows(read_table(spark, str(tmp_path), "countries")) == [("AA", "Alpha")]
    register_view(df, "countries_view")
    assert spark.table("countries_view").count() == 1


def test_jdbc_options_push_the_query_down():
    plain = jdbc_options("jdbc:x", "SELECT 1", {"user": "u"})
    assert plain["query"] == "SELECT 1" and plain["user"] == "u" and "dbtable" not in plain
    split = jdbc_options("jdbc:x", "SELECT 1", split=("id", 0, 100, 8))
    assert split["dbtable"] == "(SELECT 1) src" and split["numPartitions"] == "8" and "query" not in split


def test_quality(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, n int")
    assert rows(quality.check_unique(df, ["k"])) == [("a", 2)]
    assert rows(quality.check_not_null(df, ["k", "n"])) == [("k", 1), ("n", 0)]
    assert rows(quality.check_labels(df, "k", ["a"])) == [(None, 1)]
    assert quality.freshness(df, "n").first()[0] == 2


# loads side by side

@pytest.mark.parametrize("step", ["claim", "write_clustered", "commit", "release"])
def test_overlapping_reloads_keep_every_account(spark, table, rows, monkeypatch, step):
    """Account b reloads at each step of a's reload: it is told to wait, or both survive."""
    a = facts(spark, ("2024-05-02", "a", "c", 70))
    b = facts(spark, ("2024-05-02", "b", "c", 80))
    far = facts(spark, ("2024-05-09", "b", "c", 90))
    told, inside = [], []

    def between(name, function):
        def wrapped(*args, **kwargs):
            out = function(*args, **kwargs)
            if name == step and not inside:
                inside.append(1)
                assert load.reload_range(far, table, d("2024-05-09"), d("2024-05-09"), ["b"])  # another day: at once
                try:
                    load.reload_range(b, table, d("2024-05-02"), d("2024-05-02"), ["b"])
                except claims.Busy:
                    told.append(1)
            return out
        return wrapped

    with monkeypatch.context() as m:
        for name in ("claim", "commit", "release"):
            m.setattr(claims.Load, name, between(name, getattr(claims.Load, name)))
        m.setattr(load, "write_clustered", between("write_clustered", load.write_clustered))
        assert load.reload_range(a, table, d("2024-05-02"), d("2024-05-02"), ["a"])
    assert inside and bool(told) == (step != "release")
    assert load.reload_range(b, table, d("2024-05-02"), d("2024-05-02"), ["b"])
    after = read(spark, table, rows)
    assert {r for r in after if r[0] == d("2024-05-02")} == {(d("2024-05-02"), "a", 70), (d("2024-05-02"), "b", 80)}
    assert (d("2024-05-09"), "b", 90) in after and (d("2024-05-09"), "a", 9) in after
    assert not claims.Folder(spark, table + "__claims").names() and not claims.Folder(spark, table + "__staging").names()


def test_a_waiting_reload_goes_on_when_the_day_is_free(spark, table, rows):
    days = (d("2024-05-01"), d("2024-05-03"))
    batches = {acc: facts(spark, ("2024-05-02", acc, "c", n)) for n, acc in enumerate(("a", "b", "x", "y"), 100)}
    with ThreadPoolExecutor(4) as pool:
        done = [pool.submit(load.reload_range, df, table, *days, [acc], wait=120) for acc, df in batches.items()]
        assert all(f.result() for f in done)
    got = {(r[1], r[2]) for r in read(spark, table, rows) if days[0] <= r[0] <= days[1]}
    assert got == {("a", 100), ("b", 101), ("x", 102), ("y", 103), (None, 5)}


@pytest.mark.parametrize("stop", ["write", "become", "release"])
def test_a_stopped_refresh_leaves_a_whole_table(spark, tmp_path, rows, monkeypatch, stop):
    path = str(tmp_path / "ref")
    load.full_refresh(spark.range(3), path)

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(*{"write": (claims.Folder, "write", fail), "become": (claims.Folder, "become", fail),
                    "release": (claims.Load, "release", fail)}[stop])
        with pytest.raises(RuntimeError, match="stopped"):
            load.full_refresh(spark.range(10, 15), path)
    assert spark.read.parquet(path).count() in (3, 5)
    load.recover(spark, path)
    assert spark.read.parquet(path).count() == (3 if stop == "write" else 5)
    assert load.full_refresh(spark.range(2), path) and spark.read.parquet(path).count() == 2


def test_claims_of_others_are_kept_until_their_lease_is_over(spark, table):
    held = claims.Load(spark, table)
    with held:
        held.claim(["date=2024-05-02"])
    other = claims.Load(spark, table)
    other.__enter__()
    other.claim(["date=2024-05-02"])
    claims._LIVE.discard(other.id)
    owner = {"host": "elsewhere", "process": 1, "until": time.time() + 60}
    other.staging.delete(claims.OWNER)
    other.staging.write(claims.OWNER, json.dumps(owner))
    batch = facts(spark, ("2024-05-02", "a", "c", 1))
    with pytest.raises(claims.Busy):
        load.reload_range(batch, table, d("2024-05-02"), d("2024-05-02"), ["a"])
    with pytest.raises(claims.Busy):
        load.full_refresh(batch, table)
    other.staging.delete(claims.OWNER)
    other.staging.write(claims.OWNER, json.dumps(owner | {"until": 0}))
    assert load.reload_range(batch, table, d("2024-05-02"), d("2024-05-02"), ["a"])
