"""Load semantics on tables written from the driver data.

Tables go to the shared folder that ``spark.checkpoint.dir`` names, or below
the session's warehouse, which is shared storage on a cluster.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from martkit.functions.keys import surrogate_key
from martkit.operators.dedup import latest
from martkit.plans import build, landing, silver
from martkit.sources import bucketed, curve, drift, ledger, load, reconcile, rejects
from martkit.sources.quality import freshness
from martkit.sources.tables import read_sheet, read_table, seed

from . import oracle
from .column_steps import query
from .marts import Models
from .standins import CONTEXT, raw, raw_sql, table, workspace

START, END = date(1997, 3, 1), date(1998, 2, 28)


def _facts(spark, sf) -> DataFrame:
    """Orders by month: some eighty partitions instead of thousands of days."""
    return table(spark, sf, "orders").select(
        F.trunc("o_orderdate", "MM").alias("date"), (F.col("o_custkey") % 10).cast("string").alias("account_id"),
        F.col("o_custkey").cast("string").alias("campaign_id"), "o_orderkey", "o_totalprice")


_FACTS = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(o_custkey % 10 AS VARCHAR) AS account_id,
  CAST(o_custkey AS VARCHAR) AS campaign_id, o_orderkey, o_totalprice FROM orders"""


# Accounts 3 and 4 come again with changed prices and without May.
@query(f"""WITH f AS ({_FACTS}), hit AS (SELECT * FROM f WHERE date BETWEEN DATE '{START}' AND DATE '{END}'
  AND account_id IN ('3', '4'))
SELECT * FROM f WHERE NOT (date BETWEEN DATE '{START}' AND DATE '{END}' AND account_id IN ('3', '4'))
UNION ALL SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM hit WHERE month(date) <> 5""")
def reload_range_twice(spark, sf):
    path = f"{workspace(spark)}/facts"
    facts = _facts(spark, sf)
    load.write_clustered(facts, path, keys=("account_id", "campaign_id"))
    accounts = ["3", "4"]
    batch = facts.where(F.col("date").between(F.lit(START), F.lit(END)) & F.col("account_id").isin(accounts)
                        & (F.month("date") != 5))
    changed = batch.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for _ in range(2):
        load.reload_range(changed, path, START, END, accounts)
    load.reload_range(changed.where(F.lit(False)), path, START, END, accounts)
    return load.open_table(spark, path, facts.schema)


# Four accounts' reloads of the same months at the same time; each waits for the months that another holds.
@query(f"""WITH f AS ({_FACTS})
SELECT * REPLACE (CASE WHEN date BETWEEN DATE '{START}' AND DATE '{END}' AND account_id IN ('1', '2', '3', '4')
  THEN o_totalprice + CAST(account_id AS INTEGER) ELSE o_totalprice END AS o_totalprice) FROM f""")
def concurrent_reloads(spark, sf):
    path = f"{workspace(spark)}/facts"
    facts = _facts(spark, sf)
    load.write_clustered(facts, path, keys=("account_id", "campaign_id"))
    inside = facts.where(F.col("date").between(F.lit(START), F.lit(END)))

    def reload(account: int) -> bool:
        batch = inside.where(F.col("account_id") == str(account))
        return load.reload_range(batch.withColumn("o_totalprice", F.col("o_totalprice") + account), path, START, END,
                                 [str(account)], wait=600)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(reload, (1, 2, 3, 4)))
    return load.open_table(spark, path, facts.schema)


@query(f"""WITH f AS ({_FACTS}) SELECT * REPLACE (CASE WHEN account_id = '5' AND date >= DATE '1999-01-01'
  THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice) FROM f""")
def repaired_range(spark, sf):
    path = f"{workspace(spark)}/facts"
    facts = _facts(spark, sf)
    load.write_clustered(facts, path)
    load.repair(facts.withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["5"], date(1999, 1, 1),
                date(2002, 12, 31))
    return load.open_table(spark, path, facts.schema)


@query(f"WITH f AS ({_FACTS}) SELECT * FROM f WHERE year(date) >= 1999")
def year_backfill(spark, sf):
    path = f"{workspace(spark)}/facts"
    facts = _facts(spark, sf)
    load.backfill(facts, path, 1999, date(2001, 12, 31), [str(i) for i in range(10)])
    return load.open_table(spark, path, facts.schema)


@query("""SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS account_id, c_custkey, c_name FROM customer
  WHERE c_nationkey NOT IN (3, 4)
UNION ALL SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0'), c_custkey, 'new' FROM customer
  WHERE c_nationkey IN (3, 4) AND c_acctbal > 0""")
def reload_accounts(spark, sf):
    path = f"{workspace(spark)}/dim"
    account = F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("account_id")
    dim = table(spark, sf, "customer").select(account, "c_custkey", "c_name", "c_acctbal")
    load.reload_accounts(dim.drop("c_acctbal"), path)
    fresh = dim.where("account_id IN ('003', '004') AND c_acctbal > 0").drop("c_acctbal").withColumn("c_name", F.lit("new"))
    for _ in range(2):
        load.reload_accounts(fresh, path)
    return load.open_table(spark, path, fresh.schema).select("account_id", "c_custkey", "c_name")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 5000")
def full_refresh(spark, sf):
    path = f"{workspace(spark)}/ref"
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    load.full_refresh(rows.drop("s_acctbal"), path)
    load.full_refresh(rows.where("s_acctbal > 5000").drop("s_acctbal"), path)
    load.full_refresh(rows.where("s_acctbal > 1e9").drop("s_acctbal"), path)
    return spark.read.parquet(path)


@query(f"SELECT date, campaign_id, o_orderkey FROM ({_FACTS})")
def clustered_table(spark, sf):
    path = f"{workspace(spark)}/mart"
    mart = load.materialize(_facts(spark, sf), path, ["account_id", "campaign_id"])
    return mart.select("date", "campaign_id", "o_orderkey")


@query("""SELECT max(CAST(ts AS DATE)) AS last_date, max(CAST(ts AS DATE)) - 14 AS start_date,
  DATE '2024-02-10' AS end_date FROM events""")
def watermark_window(spark, sf):
    return load.watermark(table(spark, sf, "events").select(F.to_date("ts").alias("date")), 14, date(2024, 2, 10))


@query("""WITH r AS (SELECT c_nationkey AS account, min(CAST(o_orderdate AS DATE)) AS start_date,
  max(CAST(o_orderdate AS DATE)) AS end_date FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
s AS (SELECT *, CAST(unnest(generate_series(start_date, end_date, INTERVAL 31 DAY)) AS DATE) AS chunk_start FROM r)
SELECT *, least(chunk_start + 30, end_date) AS chunk_end FROM s""")
def date_chunks(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    day = F.to_date("o_orderdate")
    ranges = rows.groupBy(F.col("c_nationkey").alias("account")).agg(F.min(day).alias("start_date"),
                                                                     F.max(day).alias("end_date"))
    return load.date_chunks(ranges, 30)


# A chunk fails at first, which leaves the table as it was; the second call extracts that chunk alone.
@query(f"""WITH f AS ({_FACTS}) SELECT * REPLACE (CASE WHEN date BETWEEN DATE '{START}' AND DATE '{END}' AND account_id IN ('3', '4')
  THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM f""")
def chunk_ledger(spark, sf):
    path, facts = f"{workspace(spark)}/facts", _facts(spark, sf)
    load.write_clustered(facts, path, keys=("account_id", "campaign_id"))
    accounts = facts.where("account_id IN ('3', '4')").select("account_id").distinct()
    chunks = ledger.chunks_of(load.date_chunks(accounts.select("account_id", F.lit(START).alias("start_date"),
                                                               F.lit(END).alias("end_date")), 90))

    def extract(chunk, change=1.0):
        inside = F.col("date").between(F.lit(chunk.start), F.lit(chunk.end)) & (F.col("account_id") == chunk.account)
        return facts.where(inside).withColumn("o_totalprice", F.col("o_totalprice") + change)

    def failing(chunk):
        if chunk == chunks[-1]:
            raise OSError("timed out")
        return extract(chunk)

    def only_failed(chunk):
        return extract(chunk, 1.0 if chunk == chunks[-1] else 1000.0)

    try:
        ledger.load_chunks(spark, path, chunks, failing, workers=4)
    except ledger.ChunksFailed:
        ledger.load_chunks(spark, path, chunks, only_failed, workers=4)
    return load.open_table(spark, path, facts.schema)


# A report as text: some dates, numbers and accounts are broken, some rows in more than one way.
_TEXT_REPORT = """SELECT event_id, CASE WHEN event_id % 41 = 0 THEN 'tbc' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS date,
  CASE WHEN event_id % 29 = 0 THEN 'n/a' WHEN event_id % 3 > 0 THEN CAST(event_id % 100 AS VARCHAR) || '.5' END AS spend,
  CASE WHEN event_id % 23 > 0 THEN CAST(user_id % 10 AS VARCHAR) END AS account_id FROM events"""
_REJECTS = f"""SELECT *, concat_ws(',', CASE WHEN date = 'tbc' THEN 'date' END, CASE WHEN spend = 'n/a' THEN 'spend' END,
  CASE WHEN account_id IS NULL OR account_id = '7' THEN 'account' END) AS failed FROM ({_TEXT_REPORT})"""


def _screened(spark, sf) -> rejects.Screened:
    event = F.col("event_id")
    report = table(spark, sf, "events").select(
        "event_id", F.when(event % 41 == 0, "tbc").otherwise(F.to_date("ts").cast("string")).alias("date"),
        F.when(event % 29 == 0, "n/a").when(event % 3 > 0, F.concat((event % 100).cast("string"), F.lit(".5"))).alias("spend"),
        F.when(event % 23 > 0, (F.col("user_id") % 10).cast("string")).alias("account_id"))
    rules = {"date": rejects.parses("date", "date"), "spend": rejects.parses("spend", "double"),
             "account": F.col("account_id") != "7"}
    return rejects.screen(report, rules, f"{workspace(spark)}/screened")


@query(f"""SELECT event_id, date, spend, account_id, failed FROM ({_REJECTS}) WHERE failed <> ''
UNION ALL SELECT event_id, date, spend, account_id, NULL FROM ({_REJECTS}) WHERE failed = ''""")
def landed_rejects(spark, sf):
    """Both sides of one pass, the rejected with the rules they broke."""
    sides = _screened(spark, sf)
    return sides.rejected.withColumn("failed", F.array_join("failed", ",")).unionByName(
        sides.accepted.withColumn("failed", F.lit(None).cast("string")))


@query(f"""SELECT rule, CAST(count(*) FILTER (contains(failed, rule)) AS BIGINT) AS n_rows FROM ({_REJECTS}),
  (VALUES ('date'), ('spend'), ('account')) v(rule) GROUP BY rule""")
def reject_counts(spark, sf):
    return _screened(spark, sf).counts()


# Payloads of events whose shape has drifted: numbers as text, a new object, a field inside it, broken text.
_DECLARED = "k bigint, user struct<id:bigint>, campaign string"


def _payloads(spark, sf) -> DataFrame:
    e = F.col("event_id")
    user = F.concat(F.lit(',"user":{"id":'), F.col("user_id").cast("string"), F.when(e % 2 == 0, ',"vip":true').otherwise(""), F.lit("}"))
    text = F.concat(F.lit('{"k":'), F.when(e % 7 == 0, F.concat(F.lit('"'), e.cast("string"), F.lit('"'))).otherwise((e % 100).cast("string")),
                    F.when(e % 3 == 0, user).otherwise(""), F.when(e % 11 == 0, ',"extra":[1]').otherwise(""), F.lit("}"))
    return table(spark, sf, "events").select("event_id", F.when(e % 19 == 0, "gone {").otherwise(text).alias("props"))


@query("""WITH e AS (SELECT event_id AS e FROM events), ok AS (SELECT e FROM e WHERE e % 19 <> 0)
SELECT * FROM (SELECT '$' AS path, '' AS kind, 'broken' AS state, count(*) AS n_rows FROM e WHERE e % 19 = 0
UNION ALL SELECT '$.k', 'STRING', 'other_type', count(*) FROM ok WHERE e % 7 = 0
UNION ALL SELECT '$.k', 'BIGINT', 'as_declared', count(*) FROM ok WHERE e % 7 <> 0
UNION ALL SELECT '$.user', 'OBJECT', 'as_declared', count(*) FROM ok WHERE e % 3 = 0
UNION ALL SELECT '$.user.id', 'BIGINT', 'as_declared', count(*) FROM ok WHERE e % 3 = 0
UNION ALL SELECT '$.user.vip', 'BOOLEAN', 'undeclared', count(*) FROM ok WHERE e % 6 = 0
UNION ALL SELECT '$.extra', 'ARRAY', 'undeclared', count(*) FROM ok WHERE e % 11 = 0) WHERE n_rows > 0
UNION ALL SELECT '$.campaign', '', 'absent', 0""")
def payload_drift(spark, sf):
    return drift.drift(_payloads(spark, sf), "props", _DECLARED)


@query("""SELECT event_id, CASE WHEN event_id % 19 > 0 THEN CASE WHEN event_id % 7 = 0 THEN event_id ELSE event_id % 100 END END AS k,
  CASE WHEN event_id % 19 > 0 AND event_id % 3 = 0 THEN CAST(user_id AS BIGINT) END AS user_id FROM events""")
def payload_typed(spark, sf):
    """Numbers in text are read as numbers."""
    rows = drift.typed(_payloads(spark, sf), "props", _DECLARED)
    return rows.select("event_id", "k", F.col("user.id").alias("user_id"))


@query("""SELECT user_id, event_type, event_id, value, c_mktsegment AS segment FROM (SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
LEFT JOIN customer ON user_id = c_custkey""")
def bucketed_latest(spark, sf):
    """Events and customers in buckets of the same key: neither the dedup nor the join moves a row."""
    root = workspace(spark)
    name = root.rpartition("/")[2].replace("-", "_")
    events = bucketed.write_bucketed(table(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("long")),
                                     f"events_{name}", ["user_id"], 16, ["user_id", "event_type"], f"{root}/events")
    customers = bucketed.write_bucketed(table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("user_id"),
                                                                            F.col("c_mktsegment").alias("segment")),
                                        f"customers_{name}", ["user_id"], 16, path=f"{root}/customers")
    newest = latest(events, ["user_id", "event_type"], "ts", ["event_id"])
    return newest.join(customers, "user_id", "left").select("user_id", "event_type", "event_id", "value", "segment")


@query(f"SELECT date, account_id, campaign_id, o_orderkey, o_totalprice FROM ({_FACTS})")
def curved_table(spark, sf):
    """Orders in files along a curve through account, campaign and order, and read back."""
    path, facts = f"{workspace(spark)}/facts", _facts(spark, sf)
    curve.write_curved(facts, path, ["account_id", "campaign_id", "o_orderkey"], 16)
    return load.open_table(spark, path, facts.schema)


@query("""SELECT o_orderkey, '2024-05-01 06:00:00' AS stamped FROM orders""")
def ingestion_stamp(spark, sf):
    rows = load.stamp(table(spark, sf, "orders").select("o_orderkey"), datetime(2024, 5, 1, 6))
    return rows.select("o_orderkey", F.date_format("_ingested_at", "yyyy-MM-dd HH:mm:ss").alias("stamped"))


@query("SELECT epoch_us(max(ts)) AS loaded_at, count(*) AS n_rows FROM events")
def freshness_report(spark, sf):
    out = freshness(table(spark, sf, "events"), "ts")
    return out.withColumn("loaded_at", F.unix_micros(F.col("loaded_at").cast("timestamp")))


@query("SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer")
def sheet_reader(spark, sf):
    """Written as whole-line quoted text with a repeated header, then read back."""
    path = f"{workspace(spark)}/sheet"
    quote = F.lit('"')
    lines = table(spark, sf, "customer").select(
        F.concat(quote, F.col("c_custkey").cast("string"), F.lit(","), "c_name", quote).alias("value"))
    header = table(spark, sf, "nation").select(F.concat(F.lit('﻿"code,name"')).alias("value"))
    lines.unionByName(header).write.text(path)
    return read_sheet(spark, path, ["code", "name"])


@query(f"SELECT campaign_id, status, serving_status, end_date FROM ({raw_sql('a_campaign_dim')})")
def landed_table(spark, sf):
    root = workspace(spark)
    load.full_refresh(raw(spark, sf, "a_campaign_dim"), f"{root}/a_campaign_dim")
    return read_table(spark, root, "a_campaign_dim").select("campaign_id", "status", "serving_status", "end_date")


# Two regions: the second has other column names, one currency and a longer list of sources.
_EXPLICIT, _AMBIGUOUS, _MEDIUMS = ("SourceA", "a_ads"), ("SOURCEB",), ("cpc", " Paid ")
_SECOND = {"id_commande": "id_customer", "date_submit": "registration", "date_time_submit": "ordered_at",
           "total_ht": "amount", "specialty": "speciality"}


def _regions(spark, sf) -> list[landing.CrmRegion]:
    orders = raw(spark, sf, "crm_orders").withColumns({
        "new_customer": F.coalesce("new_customer", F.lit("NaN")), "total_ht": F.col("total_ht").try_cast("double")})
    second = orders.where("region = 'AMERICA'").withColumnsRenamed(_SECOND).drop("currency")
    return [landing.CrmRegion(orders.where("region <> 'AMERICA'"), _EXPLICIT, _AMBIGUOUS, _MEDIUMS),
            landing.CrmRegion(second, _EXPLICIT, (*_AMBIGUOUS, "b.example"), _MEDIUMS, _SECOND, {"currency": "USD"})]


@query(f"""SELECT id_commande, date_submit, utm_source, utm_medium, specialty, coalesce(new_customer, 'Unknown') AS new_customer,
  CASE WHEN region = 'AMERICA' THEN 'USD' ELSE currency END AS currency, TRY_CAST(total_ht AS DOUBLE) AS total_ht
FROM ({raw_sql('crm_orders')}) WHERE utm_source IN ('SourceA', 'a_ads') OR (utm_medium IN ('cpc', ' Paid ')
  AND (utm_source = 'SOURCEB' OR (utm_source = 'b.example' AND region = 'AMERICA')))""")
def landed_crm(spark, sf):
    """Landed by a full refresh and read back by the declared schema."""
    root = workspace(spark)
    load.full_refresh(landing.land_crm(_regions(spark, sf), datetime(2024, 5, 1, 6)), f"{root}/crm_orders")
    return read_table(spark, root, "crm_orders").select("id_commande", "date_submit", "utm_source", "utm_medium", "specialty",
                                                        "new_customer", "currency", F.col("total_ht").cast("double"))


@query(f"""SELECT lower(trim(utm_source)) AS utm_source, count(*) AS n_orders FROM ({raw_sql('crm_orders')})
WHERE lower(trim(utm_source)) NOT IN ('sourcea', 'a_ads', 'sourceb', 'b.example') GROUP BY 1""")
def crm_dropped_sources(spark, sf):
    return silver.crm_dropped_sources(raw(spark, sf, "crm_orders"), CONTEXT)


@query("""SELECT n_name, CASE n_regionkey WHEN 0 THEN 'south' WHEN 1 THEN 'west' END AS side FROM nation""")
def seed_rows(spark, sf):
    sides = seed(spark, [(0, "south"), (1, "west")], "n_regionkey long, side string")
    nations = table(spark, sf, "nation").withColumn("n_regionkey", F.col("n_regionkey").cast("long"))
    return nations.join(sides, "n_regionkey", "left").select("n_name", "side")


@query("""WITH k AS (SELECT o_custkey, nullif(o_orderstatus, 'P') AS status, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT count(DISTINCT (o_custkey, status, day)) FILTER (status IS NOT NULL) AS n_ids,
  count(*) FILTER (status IS NULL) AS n_missing, count(*) AS n_rows FROM k""")
def surrogate_ids(spark, sf):
    """The 64-bit keys are as many as their tuples, and missing where a part is."""
    rows = table(spark, sf, "orders").select(surrogate_key(
        "o_custkey", F.nullif("o_orderstatus", F.lit("P")), F.to_date("o_orderdate")).alias("id"))
    return rows.agg(F.count_distinct("id").alias("n_ids"), F.count_if(F.col("id").isNull()).alias("n_missing"),
                    F.count(F.lit(1)).alias("n_rows"))


@query(f"""SELECT CAST(date_trunc('month', date) AS DATE) AS date, account_id, campaign_id, cost_micros, clicks
FROM ({raw_sql('a_campaign_performance')}) WHERE date < DATE '2002-01-01'""")
def incremental_load(spark, sf):
    """The first load up to a day, then the next window, which reads the last weeks again."""
    root, rows = workspace(spark), raw(spark, sf, "a_campaign_performance").withColumn("date", F.trunc("date", "MM"))
    accounts = [str(i) for i in range(25)]

    def extract(start, end):
        return rows.where(F.col("date").between(F.lit(start), F.lit(end)) & F.col("account_id").isin(accounts))

    for today in (date(1999, 6, 1), date(2001, 12, 31)):
        build.load_increment(spark, root, "a_campaign_performance", extract, accounts, date(1970, 1, 1), today)
    return read_table(spark, root, "a_campaign_performance").select("date", "account_id", "campaign_id", "cost_micros", "clicks")


@query(f"SELECT platform, campaign_id, event_name, cost, impressions, clicks FROM ({oracle.mart_campaign()})")
def materialized_campaign(spark, sf):
    """The mart written by month, sorted by its keys, and read back."""
    class Monthly(Models):
        def campaign_mart(self):
            return super().campaign_mart().withColumn("date", F.trunc("date", "MM"))

    mart = Monthly(spark, sf).write("campaign", workspace(spark))
    return mart.select("platform", "campaign_id", "event_name", "cost", "impressions", "clicks")


# The landed side lacks rows, has some twice and others changed; the oracle compares the rows themselves.
_DAILY = """SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey % 10 AS VARCHAR) AS account_id, o_orderkey,
  nullif(o_orderstatus, 'P') AS status, o_totalprice FROM orders"""
_LANDED = """SELECT date, account_id, o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE status END AS status,
  CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM f, (VALUES (1), (2)) v(copy) WHERE o_orderkey % 103 <> 0 AND (copy = 1 OR o_orderkey % 107 = 0)"""


@query(f"""WITH f AS ({_DAILY}), l AS ({_LANDED}),
d AS (SELECT date, account_id FROM ((SELECT * FROM f EXCEPT ALL SELECT * FROM l)
  UNION ALL (SELECT * FROM l EXCEPT ALL SELECT * FROM f)) GROUP BY ALL),
nf AS (SELECT date, account_id, count(*) AS n FROM f GROUP BY ALL), nl AS (SELECT date, account_id, count(*) AS n FROM l GROUP BY ALL)
SELECT date, account_id, coalesce(nf.n, 0) AS n_source, coalesce(nl.n, 0) AS n_landed
FROM d LEFT JOIN nf USING (date, account_id) LEFT JOIN nl USING (date, account_id)""")
def discrepancies(spark, sf):
    source = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 10).cast("string").alias("account_id"), "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice")
    copies = F.when(F.col("o_orderkey") % 107 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    landed = source.where("o_orderkey % 103 <> 0").withColumns({
        "status": F.when(F.col("o_orderkey") % 97 == 0, F.lit("")).otherwise(F.col("status")),
        "o_totalprice": F.when(F.col("o_orderkey") % 101 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "copy": F.explode(copies)})
    return reconcile.discrepancies(source, landed)


@query(_FACTS)
def repaired_discrepancies(spark, sf):
    """Months that were landed wrong are found and loaded again; the table then equals its source."""
    path, facts = f"{workspace(spark)}/facts", _facts(spark, sf)
    wrong = (F.col("account_id") == "3") & (F.year("date") == 1997) | (F.col("account_id") == "8") & (F.month("date") == 4)
    landed = facts.where(~wrong | (F.col("o_orderkey") % 5 != 0))
    load.write_clustered(landed, path, keys=("account_id", "campaign_id"))
    found = reconcile.discrepancies(facts, load.open_table(spark, path, facts.schema))
    reconcile.repair_found(facts, found, path, step=31)
    return load.open_table(spark, path, facts.schema)


_FIRST, _LAST = date(1997, 3, 1), date(1997, 4, 30)


@query(f"""SELECT date, platform, campaign_id, event_name, cost, impressions, clicks FROM ({oracle.mart_campaign()})
WHERE date BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}'""")
def mart_after_reload(spark, sf):
    """The mart of two months: built on wrong costs, then only the days of a reload are built again."""
    root, name = workspace(spark), "a_campaign_performance"
    window = F.col("date").between(F.lit(_FIRST), F.lit(_LAST))
    true = raw(spark, sf, name).where(window)
    late = F.col("date") >= F.lit(date(1997, 4, 20))
    wrong = true.withColumn("cost_micros", F.when(late, F.col("cost_micros") * 2).otherwise(F.col("cost_micros")))
    accounts = [str(i) for i in range(25)]
    load.reload_range(wrong.where(F.col("account_id").isin(accounts)), f"{root}/{name}", _FIRST, _LAST, accounts)

    class Landed(Models):
        def __init__(self):
            super().__init__(spark, sf)
            given = self.raw
            self.raw = lambda table: (read_table(spark, root, name) if table == name else
                                      given(table).where(window) if "date" in given(table).columns else given(table))

    marts = Landed()
    marts.refresh(spark, "campaign", f"{root}/marts", root)
    right = true.where(late & F.col("account_id").isin(accounts))
    load.reload_range(right, f"{root}/{name}", date(1997, 4, 20), _LAST, accounts)
    marts.refresh(spark, "campaign", f"{root}/marts", root)
    mart = load.open_table(spark, f"{root}/marts/campaign", marts.campaign_mart().schema)
    return mart.select("date", "platform", "campaign_id", "event_name", "cost", "impressions", "clicks")
