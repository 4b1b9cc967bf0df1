"""Projection, filter and rule operators on the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from martkit.functions import casts, dates, rules, status, text
from martkit.functions.keys import md5_key
from martkit.functions.rules import Keep, Rule
from martkit.operators.dedup import combine_dims, exclude, first_wins, latest, recent
from martkit.operators.nested import asset_display
from martkit.operators.rollup import rollup
from martkit.operators.stack import align, stack, zero_metrics
from martkit.sources import quality
from martkit.sources.tables import register_view

from .oracle import TODAY, initcap
from .standins import AS_OF, CONVERSIONS_A, raw, raw_sql, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function name, with its oracle."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


@query("""SELECT user_id, event_type, CAST(ts AS DATE) AS day, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    newest = latest(events, ["user_id", "event_type", "day"], "ts", ["event_id"])
    return newest.select("user_id", "event_type", "day", "event_id", "value")


@query("""SELECT lang, source, doc_id, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars, doc_id) = 1""")
def dedup_first(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "source", "doc_id", "n_chars")
    return first_wins(docs, ["lang", "source"], ["n_chars", "doc_id"])


@query("""SELECT id, name, origin FROM (
  SELECT s_nationkey AS id, s_name AS name, 'supplier' AS origin, 0 AS b FROM supplier
  UNION ALL SELECT c_nationkey, c_name, 'customer', 1 FROM customer)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY b, name) = 1""")
def combined_dims(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("id"), F.col("s_name").alias("name"),
                                            F.lit("supplier").alias("origin"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("id"), F.col("c_name").alias("name"),
                                            F.lit("customer").alias("origin"))
    return combine_dims([s, c], ["id"], ["name"])


@query("SELECT event_id, CAST(ts AS DATE) AS day, value FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 14")
def recent_filter(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"), "value")
    return recent(events, "day", 14, date(2024, 1, 30))


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')")
def exclude_accounts(spark, sf):
    return exclude(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "5-LOW"]).select(
        "o_orderkey", "o_custkey", "o_orderpriority")


_EXACT = (Rule("cheap", equals=("ECONOMY", "PROMO")), Rule("mid", like=("%MED%", "ST_NDARD")), Rule("sm", like=("SM%",)))


@query("""SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'cheap'
  WHEN p_type LIKE '%MED%' OR p_type LIKE 'ST_NDARD' THEN 'mid' WHEN p_type LIKE 'SM%' THEN 'sm' ELSE p_type END
  AS label FROM part""")
def rules_exact(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", rules.first_match("p_type", _EXACT, F.col("p_type")).alias("label"))


_KEYWORDS = (Rule("license", contains=("license", "copyright"), fold="upper"), Rule("mail", contains=("@",)),
             Rule("specific", contains=("eau les", "the the"), fold="upper"), Rule("generic", contains=("eau", "the"),
                                                                                fold="upper"))


@query("""SELECT doc_id, CASE WHEN contains(upper(text), 'LICENSE') OR contains(upper(text), 'COPYRIGHT') THEN 'license'
  WHEN contains(text, '@') THEN 'mail' WHEN contains(upper(text), 'EAU LES') OR contains(upper(text), 'THE THE')
  THEN 'specific' WHEN contains(upper(text), 'EAU') OR contains(upper(text), 'THE') THEN 'generic'
  ELSE 'Other/Unmapped' END AS label FROM documents""")
def rules_keyword(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return rules.with_first_match(docs, "label", "text", _KEYWORDS, "Other/Unmapped").drop("text")


@query("""SELECT o_orderkey, CASE WHEN contains(kind, 'LOW') THEN 'OTHER' WHEN kind LIKE '%HIGH%' THEN 'PURCHASE'
  WHEN o_orderstatus = 'F' THEN 'LEAD' WHEN o_orderstatus LIKE '%P%' THEN 'SIGNUP' ELSE 'OTHER' END AS class
  FROM (SELECT *, o_orderpriority AS kind FROM orders)""")
def classify_a(spark, sf):
    ordered = (Rule("OTHER", contains=("LOW",)), Rule("PURCHASE", like=("%HIGH%",)),
               Rule("LEAD", equals=("F",), column="o_orderstatus"),
               Rule("SIGNUP", like=("%P%",), column="o_orderstatus"))
    return table(spark, sf, "orders").select(
        "o_orderkey", rules.first_match("o_orderpriority", ordered, "OTHER").alias("class"))


@query("""SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'PURCHASE' WHEN lower(event_type) LIKE '%sign%'
  THEN 'SIGNUP' WHEN lower(event_type) LIKE '%view%' THEN 'PAGE_VIEW' ELSE 'OTHER' END AS class FROM events""")
def classify_b(spark, sf):
    ordered = (Rule("PURCHASE", equals=("purchase",)), Rule("SIGNUP", like=("%SIGN%",), fold="lower"),
               Rule("PAGE_VIEW", like=("%View%",), fold="lower"))
    return table(spark, sf, "events").select("event_id",
                                             rules.first_match("event_type", ordered, "OTHER").alias("class"))


@query(f"""SELECT row_id, CASE WHEN conversion_action_name = 'Brochure' OR conversion_category = 'FORM'
  THEN all_conversions ELSE conversions END AS conversions FROM ({raw_sql('a_conversion_action')})""")
def route_metric(spark, sf):
    routed = rules.route_metric(CONVERSIONS_A.secondary, "all_conversions", "conversions", "conversion_action_name")
    return raw(spark, sf, "a_conversion_action").select("row_id", routed.alias("conversions"))


@query("""SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 0.0 WHEN event_type = 'purchase' THEN value
  ELSE 0.0 END AS value FROM events""")
def guard_value(spark, sf):
    guarded = rules.guard_value("value", [Rule(equals=("purchase",))], [Rule(equals=("error", "view"))], "event_type")
    return table(spark, sf, "events").select("event_id", guarded.alias("value"))


@query("""SELECT * FROM (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS platform, event_type
  FROM events) WHERE (platform = 'A' AND event_type NOT IN ('error')) OR (platform = 'B'
  AND event_type IN ('purchase', 'signup'))""")
def keep_classes(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("platform"), "event_type")
    return rules.keep_classes(rows, "platform", "event_type",
                              {"A": Keep(drop=("error",)), "B": Keep(only=("purchase", "signup"))})


@query("""SELECT event_id, TRY_CAST(regexp_extract(props, '"k": *([^,}]*)', 1) AS BIGINT) AS k, TRY_CAST(event_type AS DOUBLE) AS bad,
  CAST(round(value) AS BIGINT) AS rounded FROM events""")
def safe_cast(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", casts.safe_cast(F.get_json_object("props", "$.k"), "bigint").alias("k"),
                         casts.safe_cast("event_type", "double").alias("bad"),
                         casts.safe_long(events, "value").alias("rounded"))


@query("""SELECT o_orderkey, CAST(o_orderkey * 1234567 AS DOUBLE) / 1000000 AS units,
  CAST(o_orderkey AS DOUBLE) / 100.0 AS caps FROM orders""")
def from_micros(spark, sf):
    micros = (F.col("o_orderkey") * 1234567).alias("m")
    return table(spark, sf, "orders").select("o_orderkey", micros).select(
        "o_orderkey", casts.from_micros("m").alias("units"), casts.from_cents("o_orderkey").alias("caps"))


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'H' WHEN 'MACHINERY' THEN 'M' ELSE 'Unknown' END
  AS bucket FROM customer""")
def recode(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", rules.recode("c_mktsegment", {"HOUSEHOLD": "H", "MACHINERY": "M"}, "Unknown").alias("bucket"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1_Urgent_' WHEN '2-HIGH' THEN '2_High_'
  WHEN '3-MEDIUM' THEN '3_Medium_' WHEN '4-NOT SPECIFIED' THEN '4_Not Specified_' ELSE '5_Low_' END || o_orderstatus
  AS word FROM orders""")
def initcap_words(spark, sf):
    word = F.concat(F.replace("o_orderpriority", F.lit("-"), F.lit("_")), F.lit("_"), "o_orderstatus").alias("word")
    return table(spark, sf, "orders").select("o_orderkey", word).select(
        "o_orderkey", text.initcap_words("word").alias("word"))


@query("""SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') IS NOT NULL THEN
  md5(concat_ws('|', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus)) END AS key
  FROM orders""")
def surrogate_key(spark, sf):
    part = F.nullif("o_orderstatus", F.lit("P"))
    return table(spark, sf, "orders").select("o_orderkey",
                                             md5_key(F.to_date("o_orderdate"), "o_custkey", part).alias("key"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(day(o_orderdate) AS INT) AS day FROM orders""")
def date_parts(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *dates.date_parts(F.to_date("o_orderdate")))


@query(f"SELECT campaign_id, row_id, CASE WHEN serving_status = 'ENDED' OR end_date < {TODAY} THEN 'Completed' "
       f"WHEN status = 'PAUSED' THEN 'Off' WHEN status = 'REMOVED' THEN 'Deleted' WHEN status = 'ENABLED' "
       f"AND serving_status = 'SERVING' THEN 'Active' ELSE coalesce({initcap('serving_status')}, {initcap('status')}, "
       f"'Not delivering') END AS campaign_status FROM ({raw_sql('a_campaign_dim')})")
def status_a(spark, sf):
    shown = status.delivery_status_a("status", "serving_status", "end_date", AS_OF)
    return raw(spark, sf, "a_campaign_dim").select("campaign_id", "row_id", shown.alias("campaign_status"))


@query(f"SELECT campaign_id, row_id, CASE WHEN CAST(stop_time AS DATE) < {TODAY} THEN 'Completed' "
       f"WHEN effective_status = 'PAUSED' THEN 'Off' WHEN effective_status = 'ACTIVE' THEN 'Active' "
       f"ELSE coalesce({initcap('effective_status')}, 'Not delivering') END AS campaign_status "
       f"FROM ({raw_sql('b_campaign_dim')})")
def status_b(spark, sf):
    shown = status.delivery_status_b("effective_status", "stop_time", AS_OF)
    return raw(spark, sf, "b_campaign_dim").select("campaign_id", "row_id", shown.alias("campaign_status"))


@query("""SELECT date, platform, cost, channel_type, reach FROM (
  SELECT CAST(o_orderdate AS DATE) AS date, 'A' AS platform, o_totalprice AS cost, o_orderpriority AS channel_type,
    CAST(NULL AS BIGINT) AS reach FROM orders
  UNION ALL SELECT CAST(l_shipdate AS DATE), 'B', l_extendedprice, 'Social', CAST(l_quantity AS BIGINT) FROM lineitem)""")
def stack_padded(spark, sf):
    schema = [("date", "date"), ("platform", "string"), ("cost", "double"), ("channel_type", "string"),
              ("reach", "bigint")]
    a = align(table(spark, sf, "orders"), schema, {
        "date": F.col("o_orderdate"), "platform": "A", "cost": F.col("o_totalprice"),
        "channel_type": F.col("o_orderpriority")})
    b = align(table(spark, sf, "lineitem"), schema, {
        "date": F.col("l_shipdate"), "platform": "B", "cost": F.col("l_extendedprice"), "channel_type": "Social",
        "reach": F.col("l_quantity")})
    return stack(a, b)


@query("""SELECT o_orderkey AS id, o_orderpriority AS axis_a, 'Unspecified' AS axis_b, 'A Only' AS granularity FROM orders
UNION ALL SELECT o_orderkey, 'Unspecified', o_orderstatus, 'B Only' FROM orders""")
def stack_axes(spark, sf):
    orders = table(spark, sf, "orders")
    key, other = F.col("o_orderkey").alias("id"), F.lit("Unspecified")
    a = orders.select(key, F.col("o_orderpriority").alias("axis_a"), other.alias("axis_b"),
                      F.lit("A Only").alias("granularity"))
    b = orders.select(F.lit("B Only").alias("granularity"), F.col("o_orderstatus").alias("axis_b"),
                      other.alias("axis_a"), key)
    return stack(a, b)


@query("""SELECT event_id, event_type, CAST(0 AS DOUBLE) AS cost, CAST(0 AS BIGINT) AS clicks, value FROM events""")
def zeroed_metrics(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return zero_metrics(events, {"cost": "double", "clicks": "bigint"})


@query("""SELECT o_orderkey, CASE WHEN lower(o_orderpriority) IN ('1-urgent', '2-high') THEN 'A'
  WHEN lower(o_orderpriority) = '3-medium' THEN 'B' END AS platform FROM orders
WHERE lower(o_orderpriority) IN ('1-urgent', '2-high', '3-medium')""")
def crm_platform(spark, sf):
    aliases = (Rule("A", equals=("1-Urgent", "2-High"), fold="lower"), Rule("B", equals=("3-medium",), fold="lower"))
    rows = table(spark, sf, "orders").select(
        "o_orderkey", rules.first_match("o_orderpriority", aliases, "Other").alias("platform"))
    return rows.where(F.col("platform") != "Other")


@query(f"""SELECT id_commande, utm_source, utm_medium FROM ({raw_sql('crm_orders')})
WHERE utm_source IN ('a_ads') OR (utm_source IN ('SourceA', 'SOURCEB') AND utm_medium IN ('cpc', ' Paid '))""")
def paid_media(spark, sf):
    rows = raw(spark, sf, "crm_orders").select("id_commande", "utm_source", "utm_medium")
    return rules.paid_media(rows, "utm_source", "utm_medium", ["a_ads"], ["SourceA", "SOURCEB"], ["cpc", " Paid "])


@query(f"""SELECT id_commande, CASE WHEN lower(trim(new_customer)) IN ('new', 'first') THEN 1 ELSE 0 END AS is_new
FROM ({raw_sql('crm_orders')})""")
def new_customer_flag(spark, sf):
    return raw(spark, sf, "crm_orders").select("id_commande",
                                               rules.flag_in("new_customer", ["new", "first"]).alias("is_new"))


@query(r"""SELECT page_id, regexp_extract(url, 'utm_source=([^&#]*)', 1) AS utm_source,
  regexp_extract(url, '[^/]*$', 0) AS tail, nullif(regexp_extract(url, '[^/]*$', 0), '') AS tail_or_null FROM pages""")
def path_parts(spark, sf):
    source = F.regexp_extract("url", r"utm_source=([^&#]*)", 1)
    return table(spark, sf, "pages").select(
        "page_id", source.alias("utm_source"), text.path_tail("url", "/").alias("tail"),
        text.path_tail("url", "/", empty_as_null=True).alias("tail_or_null"))


@query("""SELECT event_id, CAST(hour(ts) AS INT) AS hour_of_day, replace('act_' || user_id, 'act_', '') AS account_id
FROM events""")
def hour_and_prefix(spark, sf):
    span = F.concat(F.date_format("ts", "HH:mm:ss"), F.lit(" - "), F.date_format("ts", "HH:59:59"))
    prefixed = F.concat(F.lit("act_"), F.col("user_id").cast("string"))
    return table(spark, sf, "events").select("event_id", text.hour_of_range(span).alias("hour_of_day"),
                                             text.remove_all(prefixed, "act_").alias("account_id"))


@query("""SELECT p_partkey, CASE WHEN p_size <= 25 AND nullif(p_type, 'PROMO') IS NULL THEN '_none_'
  WHEN p_size <= 25 THEN ' ' || p_type ELSE p_name || ' ' || coalesce(nullif(p_type, 'PROMO'), '') END AS phrase,
  coalesce(nullif(CASE WHEN p_size > 30 THEN p_name ELSE '' END, ''), p_brand) AS display FROM part""")
def phrase_text(spark, sf):
    headline, body = F.when(F.col("p_size") > 25, F.col("p_name")), F.nullif("p_type", F.lit("PROMO"))
    shown = F.when(F.col("p_size") > 30, F.col("p_name")).otherwise("")
    return table(spark, sf, "part").select("p_partkey", text.phrase_text(headline, body, "_none_").alias("phrase"),
                                           asset_display(shown, "p_brand").alias("display"))


@query("""SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS campaign_id, sum(round(l_extendedprice)) AS cost,
  CAST(sum(CAST(l_quantity AS BIGINT) * 40) AS BIGINT) AS impressions,
  CAST(sum(CAST(l_quantity AS BIGINT) - 1) AS BIGINT) AS clicks, max(l_returnflag) AS campaign_status,
  CAST(sum(CAST(l_quantity AS BIGINT) - 1) AS DOUBLE) / nullif(sum(CAST(l_quantity AS BIGINT) * 40), 0) AS ctr,
  sum(round(l_extendedprice)) / nullif(sum(CAST(l_quantity AS BIGINT) - 1), 0) AS average_cpc
FROM lineitem GROUP BY 1, 2""")
def campaign_rollup(spark, sf):
    quantity = F.col("l_quantity").cast("bigint")
    rows = table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("campaign_id"),
        F.round("l_extendedprice").alias("cost"), (quantity * 40).alias("impressions"), (quantity - 1).alias("clicks"),
        F.col("l_returnflag").alias("campaign_status"))
    return rollup(rows, ["date", "campaign_id"], ["cost", "impressions", "clicks"], ["campaign_status"],
                  {"ctr": ("clicks", "impressions"), "average_cpc": ("cost", "clicks")})


@query("""SELECT lower(text) AS word, text AS phrase, CAST(sum(n_chars) AS BIGINT) AS impressions,
  max(source) AS source FROM documents GROUP BY 1, 2""")
def phrase_rollup(spark, sf):
    rows = table(spark, sf, "documents").select(F.col("text").alias("phrase"), F.col("n_chars").alias("impressions"),
                                                "source")
    return rollup(rows, ["phrase"], ["impressions"], ["source"]).withColumn("word", F.lower("phrase"))


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def quality_unique(spark, sf):
    return quality.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"""SELECT 'device' AS column_name, count(*) FILTER (device IS NULL) AS n_nulls FROM ({raw_sql('a_performance')})
UNION ALL SELECT 'date', count(*) FILTER (date IS NULL) FROM ({raw_sql('a_performance')})""")
def quality_not_null(spark, sf):
    return quality.check_not_null(raw(spark, sf, "a_performance"), ["device", "date"])


@query("SELECT event_type, count(*) AS n_rows FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1")
def quality_labels(spark, sf):
    return quality.check_labels(table(spark, sf, "events"), "event_type", ["view", "click"])


@query("SELECT l_orderkey, l_extendedprice, l_returnflag = 'R' AS returned FROM lineitem")
def published_view(spark, sf):
    returned = (F.col("l_returnflag") == "R").alias("returned")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", returned)
    register_view(rows, "returned_lines")
    return spark.table("returned_lines")
