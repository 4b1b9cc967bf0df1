from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import d
from martkit.operators.dedup import latest
from martkit.sources import bucketed, claims, curve, drift, ledger, load, rejects
from martkit.sources.ledger import Chunk, ChunksFailed

SCHEMA = "date date, account_id string, campaign_id string, clicks long"
CHUNKS = [Chunk("a", d("2024-05-01"), d("2024-05-03")), Chunk("a", d("2024-05-04"), d("2024-05-06")),
          Chunk("b", d("2024-05-01"), d("2024-05-06"))]


class Source:
    """Rows of each day with a value; counts what is extracted and can fail on a day."""

    def __init__(self, spark, value, fail=None):
        self.spark, self.value, self.fail, self.asked = spark, value, fail, []

    def __call__(self, chunk):
        self.asked.append(chunk)
        if chunk.start == self.fail:
            raise OSError("timed out\nafter a while")
        days = self.spark.range(40).select(F.date_add(F.lit(d("2024-04-20")), F.col("id").cast("int")).alias("date"))
        return (days.where(F.col("date").between(F.lit(chunk.start), F.lit(chunk.end)))
                .select("date", F.lit(chunk.account).alias("account_id"), F.lit("c").alias("campaign_id"),
                        F.lit(self.value).cast("long").alias("clicks")))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = [("2024-05-01", "a", 1), ("2024-05-05", "b", 2), ("2024-05-05", "z", 3), ("2024-05-09", "a", 4)]
    load.write_clustered(spark.createDataFrame([(d(x), acc, "c", n) for x, acc, n in rows], SCHEMA), path)
    return path


def content(spark, table, rows):
    return rows(spark.read.schema(SCHEMA).parquet(table), "date", "account_id", "clicks")


def test_a_failed_chunk_leaves_the_window_and_the_next_call_goes_on(spark, table, rows):
    before = content(spark, table, rows)
    broken = Source(spark, 7, fail=d("2024-05-04"))
    with pytest.raises(ChunksFailed, match="a 2024-05-04..2024-05-06: OSError: timed out$"):
        ledger.load_chunks(spark, table, CHUNKS, broken)
    assert content(spark, table, rows) == before and broken.asked == CHUNKS
    assert rows(ledger.ledger(spark, table), "account_id", "start_date", "state", "n_rows", "error") == [
        ("a", d("2024-05-01"), "done", 3, None), ("a", d("2024-05-04"), "failed", None, "OSError: timed out"),
        ("b", d("2024-05-01"), "done", 6, None)]
    whole = Source(spark, 7)
    assert ledger.load_chunks(spark, table, CHUNKS[::-1], whole) and whole.asked == [CHUNKS[1]]
    days = [d(f"2024-05-0{i}") for i in range(1, 7)]
    assert content(spark, table, rows) == sorted(
        [(day, acc, 7) for day in days for acc in "ab"] + [(d("2024-05-05"), "z", 3), (d("2024-05-09"), "a", 4)],
        key=lambda t: tuple((False, str(v)) for v in t))
    assert {r.state for r in ledger.ledger(spark, table).collect()} == {"done"}
    again = Source(spark, 8)  # loaded before, so the same chunks begin anew
    assert ledger.load_chunks(spark, table, CHUNKS, again, workers=3) and sorted(again.asked) == CHUNKS
    assert {r[2] for r in content(spark, table, rows)} == {3, 4, 8}
    assert not claims.Folder(spark, f"{table}__chunks/{ledger.batch_name(CHUNKS)}").exists("rows")


@pytest.mark.parametrize("stop", [1, 2, 3, 4])
def test_stopped_after_any_chunk(spark, table, rows, monkeypatch, stop):
    """The process stops after a chunk or before the load; nothing done is extracted again."""
    class Stop(BaseException):
        pass

    before, first = content(spark, table, rows), Source(spark, 7)

    def extract(chunk):
        if len(first.asked) == stop:
            raise Stop
        return first(chunk)

    def ended(*_, **__):
        raise Stop

    with monkeypatch.context() as m:
        m.setattr(ledger, "reload_range", ended)
        with pytest.raises(Stop):
            ledger.load_chunks(spark, table, CHUNKS, extract)
    assert content(spark, table, rows) == before
    rest = Source(spark, 7)
    assert ledger.load_chunks(spark, table, CHUNKS, rest)
    assert rest.asked == CHUNKS[stop:] and len(content(spark, table, rows)) == 14


def test_chunks_without_rows_and_rows_of_other_days(spark, table, rows):
    before, source = content(spark, table, rows), Source(spark, 7)
    assert not ledger.load_chunks(spark, table, CHUNKS, lambda c: source(c).where(F.lit(False)))
    assert not ledger.load_chunks(spark, table, CHUNKS, lambda c: spark.createDataFrame([], SCHEMA))
    with pytest.raises(ChunksFailed, match="3 rows outside the chunk"):
        ledger.load_chunks(spark, table, CHUNKS, lambda c: source(CHUNKS[0]))
    assert content(spark, table, rows) == before
    for bad in ([CHUNKS[0], Chunk("a", d("2024-05-05"), d("2024-05-06"))], [CHUNKS[0], CHUNKS[0]._replace(end=d("2024-05-05"))]):
        with pytest.raises(ValueError, match="does not follow"):
            ledger.load_chunks(spark, table, bad, source)
    assert rows(ledger.ledger(spark, f"{table}-none")) == []


def test_chunks_of_ranges(spark):
    ranges = spark.createDataFrame([("a", d("2024-01-01"), d("2024-02-10"))], "account_id string, start_date date, end_date date")
    assert ledger.chunks_of(load.date_chunks(ranges, 30)) == [Chunk("a", d("2024-01-01"), d("2024-01-31")),
                                                             Chunk("a", d("2024-02-01"), d("2024-02-10"))]


@pytest.fixture
def rules(spark):
    return {"date": rejects.parses("date", "date"), "spend": rejects.parses("spend", "double"), "account": F.col("account") != ""}


def test_screen_sets_rows_apart_in_one_pass(spark, tmp_path, rows, rules):
    seen = spark.sparkContext.accumulator(0)
    given = spark.createDataFrame([("2024-05-01", "1.5", "a"), ("x", "y", "a"), (None, None, "b"), ("2024-05-02", "2", None),
                                   ("2024-05-02", "2", ""), ("x", "y", "a")], "date string, spend string, account string")

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    out = rejects.screen(given.mapInArrow(counted, given.schema), rules, str(tmp_path / "out"))
    assert rows(out.accepted) == [("2024-05-01", "1.5", "a"), (None, None, "b")]
    assert sorted(("null" if r.account is None else r.account, r.failed) for r in out.rejected.collect()) == [
        ("", ["account"]), ("a", ["date", "spend"]), ("a", ["date", "spend"]), ("null", ["account"])]
    assert (out.n_rows, out.n_rejected, out.broken) == (6, 4, {"date": 2, "spend": 2, "account": 2})
    assert rows(out.counts()) == [("account", 2), ("date", 2), ("spend", 2)] and seen.value == 6


def test_screen_of_nothing_and_with_names_in_use(spark, tmp_path, rows, rules):
    given = spark.createDataFrame([], "date string, spend string, account string")
    out = rejects.screen(given, rules, str(tmp_path / "none"))
    assert (rows(out.accepted), rows(out.rejected), out.n_rows, out.broken) == ([], [], 0, dict.fromkeys(rules, 0))
    assert rejects.screen(given, {}, str(tmp_path / "free")).n_rejected == 0
    with pytest.raises(ValueError, match="failed"):
        rejects.screen(given.withColumn("Failed", F.lit(1)), rules, str(tmp_path / "clash"))


DECLARED = "k bigint, tag string, u struct<id:bigint,on:boolean>, `odd name` double, never string"


def payloads(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n long, props string")


def test_drift_reports_what_is_not_declared(spark, rows):
    given = payloads(spark, '{"k":1,"tag":"a","u":{"id":1,"on":true}}', '{"k":"7","extra":{"x":1}}', '{"k":2.5,"u":{"id":"z","more":[1]}}',
                     '{"k":null,"odd name":3}', "not json", "", None, "[1]", '{"u":5}', '{"odd name":1e3,"extra":[]}')
    assert rows(drift.drift(given, "props", DECLARED)) == sorted([
        ("$", "", "broken", 2), ("$.k", "BIGINT", "as_declared", 1), ("$.k", "STRING", "other_type", 1), ("$.k", "DECIMAL", "other_type", 1),
        ("$.k", "VOID", "as_declared", 1), ("$.tag", "STRING", "as_declared", 1), ("$.u", "OBJECT", "as_declared", 2),
        ("$.u", "BIGINT", "other_type", 1), ("$.u.id", "BIGINT", "as_declared", 1), ("$.u.id", "STRING", "other_type", 1),
        ("$.u.on", "BOOLEAN", "as_declared", 1), ("$.u.more", "ARRAY", "undeclared", 1), ("$.extra", "OBJECT", "undeclared", 1),
        ("$.extra", "ARRAY", "undeclared", 1), ("$.odd name", "BIGINT", "as_declared", 1), ("$.odd name", "DOUBLE", "as_declared", 1),
        ("$.never", "", "absent", 0)], key=lambda t: tuple((False, str(v)) for v in t))
    assert rows(drift.drift(given.limit(0), "props", "k bigint")) == [("$.k", "", "absent", 0)]


def test_typed_reads_what_fits(spark, rows):
    given = payloads(spark, '{"k":1,"u":{"id":4,"on":false},"odd name":2}', '{"k":"7","u":3}', '{"k":"x","tag":5}', "not json", None)
    assert [tuple(r) for r in drift.typed(given, "props", DECLARED).orderBy("n").collect()] == [
        (0, 1, None, (4, False), 2.0, None), (1, 7, None, None, None, None), (2, None, "5", None, None, None),
        (3, None, None, None, None, None), (4, None, None, None, None, None)]
    with pytest.raises(ValueError, match="n"):
        drift.typed(given, "props", "N bigint")


def test_bucketed_tables_need_no_exchange(spark, rows, tmp_path):
    """Neither the dedup window nor the lookup of the campaign's state shuffles; without buckets both do."""
    facts = spark.range(2000).select(F.col("id"), (F.col("id") % 37).cast("string").alias("campaign_id"), (F.col("id") % 5).alias("day"),
                                     (F.col("id") * 7 % 1000).alias("_ingested_at"))
    states = spark.range(30).select(F.col("id").cast("string").alias("campaign_id"), F.lit("on").alias("state"))

    def joined(a, b):
        newest = latest(a, ["campaign_id", "day"], "_ingested_at", ["id"])
        return newest.join(b.hint("merge"), "campaign_id", "left")

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    stored = [bucketed.write_bucketed(df, f"bucketed_test_{i}", ["campaign_id"], 6, path=str(tmp_path / str(i))) for i, df in enumerate((facts, states))]
    try:
        plain, fast = joined(facts, states), joined(*stored)
        assert rows(fast) == rows(plain)
        assert exchanges(fast) == 0 and exchanges(plain) >= 2
        files = spark.sql("DESCRIBE EXTENDED bucketed_test_0").where("col_name = 'Num Buckets'").first()
        assert files.data_type == "6" and len(stored[0].inputFiles()) <= 6
    finally:
        for i in range(2):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_test_{i}")


def touched(folder, key, values):
    """How many files a filter on each value must read, by the files' own statistics."""
    spans = []
    for file in Path(folder).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(key)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    return sum(lo <= v <= hi for v in values for lo, hi in spans) / len(values), len(spans)


def test_files_along_a_curve_skip_on_every_key(spark, tmp_path, rows):
    """A filter on any one of three keys reads less than half of 64 files; sorted by the first key, one on the last reads nearly all."""
    n = F.col("id")
    df = spark.range(60_000).select((n * 7919 % 1000).alias("a"), F.concat(F.lit("k"), F.lpad((n * 104_729 % 997).cast("string"), 3, "0")).alias("b"),
                                    (n * 15_485_863 % 1009).alias("c"), n.alias("n"))
    curve.write_curved(df, str(tmp_path / "curve"), ["a", "b", "c"], 64)
    df.repartitionByRange(64, "a", "b", "c").sortWithinPartitions("a", "b", "c").write.parquet(str(tmp_path / "line"))
    assert rows(spark.read.parquet(str(tmp_path / "curve"))) == rows(df)
    for key, values in (("a", range(0, 1000, 50)), ("b", [f"k{i:03d}" for i in range(0, 997, 50)]), ("c", range(0, 1009, 50))):
        read, count = touched(tmp_path / "curve", key, list(values))
        assert count >= 50 and read < count * 0.5, key
    read, count = touched(tmp_path / "line", "c", list(range(0, 1009, 50)))
    assert read > count * 0.9


def test_curve_with_nulls_one_value_and_no_rows(spark, tmp_path, rows):
    schema = "date date, a string, b long, z string"
    given = spark.createDataFrame([(d("2024-05-01"), None, 1, "x"), (d("2024-05-02"), "q", None, None), (d("2024-05-01"), "q", 1, "x"),
                                   (d("2024-05-01"), "q", 1, "x")], schema)
    for i, df in enumerate((given, given.limit(0))):
        curve.write_curved(df, str(tmp_path / str(i)), ["a", "b", "z"], 4, partition="date")
        assert rows(spark.read.schema(schema).parquet(str(tmp_path / str(i))), *df.columns) == rows(df)
    assert sorted(p.name for p in (tmp_path / "0").iterdir() if p.is_dir()) == ["date=2024-05-01", "date=2024-05-02"]
    with pytest.raises(ValueError, match="63"):
        curve.write_curved(given, str(tmp_path / "x"), ["a", "b"], 4, bits=40)
