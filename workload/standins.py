"""Driver tables in the shape of landed raw tables.

Every stand-in is one SELECT that both Spark and DuckDB accept, over the whole
of its tables, so a query and its oracle start from the same rows. ``{orders}``
names a table. All vocabulary is invented. Summed money is in whole units or
binary fractions, so that sums of doubles do not depend on the order of rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from martkit.functions.rules import Keep, Rule
from martkit.operators.editions import EditionRule
from martkit.plans.context import Context, ConversionRules

AS_OF = date(1999, 6, 30)
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages",
          "conversations")
TIES = ("row_id", "tie_price", "tie_qty", "tie_tax")

# A day's report is delivered once, and again for open orders a day later.
_A = """
  FROM (SELECT *, 0 AS pass FROM {orders} UNION ALL
        SELECT *, 1 AS pass FROM {orders} WHERE o_orderstatus = 'O') o
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey"""
_A_KEY = """
  CAST(o.o_orderdate AS DATE) AS date, CAST(c.c_nationkey AS STRING) AS account_id, n.n_name AS account_name,
  CAST(o.o_custkey AS STRING) AS campaign_id, c.c_name AS campaign_name, o.o_orderstatus AS campaign_status"""
_A_GROUP = """
  CAST(o.o_orderkey % 7 AS STRING) AS ad_group_id, 'Group ' || (o.o_orderkey % 7) AS ad_group_name"""
_A_METRICS = """
  CAST(round(o.o_totalprice) AS BIGINT) * 1000000 AS cost_micros, o.o_totalprice / 40 AS average_cpc,
  CAST(o.o_orderkey % 997 + 20 AS BIGINT) AS impressions, CAST(o.o_orderkey % 20 + o.pass AS BIGINT) AS clicks,
  CAST(o.o_orderkey % 20 AS DOUBLE) / 100 AS ctr, CAST(o.o_orderkey % 5 AS DOUBLE) AS conversions,
  round(o.o_totalprice) / 8 AS conversions_value, CAST(o.o_orderkey % 9 AS DOUBLE) AS all_conversions,
  round(o.o_totalprice) / 4 AS all_conversions_value, CAST(o.o_orderkey % 3 AS DOUBLE) AS view_through_conversions,
  CAST(o.o_orderkey % 13 AS BIGINT) AS engagements"""
_A_CONTEXT = """
  c.c_mktsegment AS bidding_strategy_type, CASE WHEN n.n_regionkey = 1 THEN 'USD' ELSE 'EUR' END AS currency,
  CAST(CAST(o.o_orderdate AS DATE) + 1 + o.pass AS TIMESTAMP) AS _ingested_at,
  o.o_orderkey * 2 + o.pass AS row_id"""
_A_ACTION = """
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Winter Ticket' WHEN '2-HIGH' THEN 'summer ticket'
    WHEN '3-MEDIUM' THEN 'Brochure' WHEN '4-NOT SPECIFIED' THEN 'Broken Ticket tag' ELSE 'Visit' END
    AS conversion_action_name"""
_AGE = """
  CASE o.o_custkey % 8 WHEN 0 THEN 'AGE_RANGE_18_24' WHEN 1 THEN 'AGE_RANGE_25_34' WHEN 2 THEN 'AGE_RANGE_35_44'
    WHEN 3 THEN 'AGE_RANGE_45_54' WHEN 4 THEN 'AGE_RANGE_55_64' WHEN 5 THEN 'AGE_RANGE_65_UP'
    WHEN 6 THEN 'AGE_RANGE_UNDETERMINED' END AS age_range"""
_GENDER = "CASE o.o_custkey % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' ELSE 'UNDETERMINED_X' END AS gender"
_GEO = """
  CAST(c.c_nationkey AS STRING) AS geo_criterion_id,
  CASE WHEN o.o_orderstatus = 'F' THEN 'AREA' ELSE 'PRESENCE' END AS location_type"""


def _a(*parts: str, where: str = "") -> str:
    return "SELECT " + ", ".join([_A_KEY, *parts, _A_METRICS, _A_CONTEXT]) + _A + where


_B = """
  FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
  JOIN {nation} n ON s.s_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey"""
_B_KEY = """
  CAST(l.l_shipdate AS DATE) AS date, CAST(l.l_suppkey % 10 AS STRING) AS account_id,
  'Account ' || (l.l_suppkey % 10) AS account_name, CAST(l.l_suppkey AS STRING) AS campaign_id,
  s.s_name || ' - ' || lower(n.n_name) || ' expo' AS campaign_name, l.l_linestatus AS campaign_status,
  CAST(l.l_linenumber AS STRING) AS adset_id, 'Set ' || l.l_linenumber AS adset_name,
  CAST(l.l_partkey AS STRING) AS ad_id, 'Ad ' || l.l_partkey AS ad_name"""
_B_METRICS = """
  CAST(l.l_quantity AS BIGINT) * 40 + l.l_linenumber AS impressions,
  CASE WHEN l.l_linenumber = 1 AND l.l_returnflag = 'R' THEN CAST(0 AS BIGINT)
    ELSE CAST(l.l_quantity AS BIGINT) END AS clicks,
  CAST(l.l_quantity AS BIGINT) - 1 AS unique_clicks, round(l.l_extendedprice) AS spend, l.l_discount AS ctr,
  l.l_tax AS unique_ctr, l.l_extendedprice / 10 AS average_cpc, l.l_extendedprice / 100 AS cpm,
  CAST(l.l_quantity AS BIGINT) * 30 AS reach, 1 + l.l_discount AS frequency,
  CAST(round(l.l_tax * 100) AS DOUBLE) AS conversions, round(l.l_extendedprice) / 2 AS conversion_value"""
_B_CONTEXT = """
  CASE WHEN r.r_name = 'AMERICA' THEN 'USD' ELSE 'EUR' END AS currency,
  CAST(CAST(l.l_shipdate AS DATE) + 1 + l.l_linenumber % 3 AS TIMESTAMP) AS _ingested_at,
  l.l_orderkey * 10 + l.l_linenumber AS row_id, l.l_extendedprice AS tie_price, l.l_quantity AS tie_qty,
  l.l_discount * 1000 + l.l_tax AS tie_tax"""


def _b(*parts: str) -> str:
    return "SELECT " + ", ".join([_B_KEY, *parts, _B_METRICS, _B_CONTEXT]) + _B


# Two actions per event, values for the first type and sometimes a second one.
_E = """
  CAST(e.ts AS DATE) AS date, CAST(e.user_id % 10 AS STRING) AS account_id,
  'Account ' || (e.user_id % 10) AS account_name, CAST(e.user_id % 20 AS STRING) AS campaign_id,
  'campaign nation_' || (e.user_id % 20) || ' expo' AS campaign_name,
  CAST(e.user_id % 7 AS STRING) AS adset_id, 'Set ' || (e.user_id % 7) AS adset_name,
  CAST(e.user_id AS STRING) AS ad_id, 'Ad ' || e.user_id AS ad_name,
  'C' || (e.user_id % 30) AS country, CASE WHEN e.user_id % 6 > 0 THEN '2' || (e.user_id % 6) || '-29' END AS age,
  CASE e.user_id % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender,
  CASE WHEN e.user_id % 11 = 3 THEN '[]' WHEN e.user_id % 11 = 5 THEN NULL ELSE
    '[{"action_type":"' || e.event_type || '","value":"' || (e.event_id % 7) ||
    '"},{"action_type":"contact","value":"1"},{"value":"9"}]' END AS actions,
  '[{"action_type":"' || e.event_type || '","value":"' || CAST(e.event_id % 1000 AS STRING) ||
    '.5"},{"action_type":"' || e.event_type || '","value":"2"}]' AS action_values,
  'EUR' AS currency, CAST(e.ts AS TIMESTAMP) AS _ingested_at, e.event_id AS row_id
  FROM {events} e"""

RAW: dict[str, str] = {
    "a_campaign_performance": _a("o.o_orderpriority AS advertising_channel_type"),
    "a_performance": _a(_A_GROUP, """
  CAST(o.o_orderkey % 11 AS STRING) AS ad_id, 'Ad ' || (o.o_orderkey % 11) AS ad_name, 'TEXT' AS ad_type,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' END AS device,
  CASE o.o_orderkey % 2 WHEN 0 THEN 'SEARCH' ELSE 'CONTENT' END AS ad_network_type"""),
    "a_conversion_action": _a(_A_ACTION, """
  left(o.o_orderpriority, 1) AS conversion_action_id, CASE o.o_orderstatus WHEN 'F' THEN 'BUY' WHEN 'O' THEN 'FORM'
    ELSE 'LOOK_CART' END AS conversion_category"""),
    "a_age_range": _a(_A_GROUP, _AGE),
    "a_gender": _a(_A_GROUP, _GENDER),
    "a_age_conversions": _a(_A_GROUP, _AGE, _A_ACTION),
    "a_gender_conversions": _a(_A_GROUP, _GENDER, _A_ACTION),
    "a_geo": _a(_A_GROUP, _GEO),
    "a_geo_restricted": _a(_GEO, where=" WHERE o.o_totalprice > 450000"),
    "a_user_location_conversions": _a(_A_ACTION, "CAST(c.c_nationkey AS STRING) AS user_geo_criterion_id",
                                      "CASE WHEN o.o_orderstatus = 'F' THEN 'AREA' END AS location_type"),
    "a_search_terms": """SELECT CAST('1998-01-01' AS DATE) + CAST(d.doc_id % 700 AS INT) AS date,
  d.lang AS account_id, 'NATION_' || (length(d.source) - 4) AS account_name, d.source AS campaign_id,
  'Search ' || d.source AS campaign_name, CASE WHEN d.n_chars > 500 THEN 'ENABLED' ELSE 'PAUSED' END AS campaign_status,
  CAST(d.doc_id % 5 AS STRING) AS ad_group_id, 'Group ' || (d.doc_id % 5) AS ad_group_name, d.text AS search_term,
  CAST(d.doc_id % 31 AS STRING) AS keyword_id, d.n_chars * 250000 AS cost_micros, d.n_chars AS impressions,
  d.doc_id % 10 AS clicks, CAST(d.doc_id % 4 AS DOUBLE) AS conversions,
  CAST(d.n_chars AS DOUBLE) / 4 AS conversions_value, 'EUR' AS currency,
  CAST(CAST('1998-01-01' AS DATE) + CAST(d.doc_id % 700 AS INT) AS TIMESTAMP) AS _ingested_at, d.doc_id AS row_id
  FROM {documents} d""",
    "a_campaign_dim": """SELECT CAST(c_custkey AS STRING) AS campaign_id,
  CASE (c_custkey + pass) % 3 WHEN 0 THEN 'PAUSED' WHEN 1 THEN 'ENABLED' ELSE 'REMOVED' END AS status,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'SERVING' WHEN 'FURNITURE' THEN 'ENDED' WHEN 'MACHINERY' THEN 'NOT_ELIGIBLE'
    WHEN 'BUILDING' THEN 'SERVING' END AS serving_status,
  CASE WHEN c_custkey % 4 > 0 THEN CAST('1999-01-01' AS DATE) + CAST(c_custkey % 400 AS INT) END AS end_date,
  CAST(CAST('1998-01-01' AS DATE) + pass AS TIMESTAMP) AS _ingested_at, c_custkey * 2 + pass AS row_id
  FROM (SELECT *, 0 AS pass FROM {customer} UNION ALL SELECT *, 1 AS pass FROM {customer} WHERE c_acctbal > 2000) c
  WHERE c_nationkey <> 3""",
    "b_performance": _b(),
    "b_conversion_action": _b("""CASE l.l_returnflag WHEN 'A' THEN 'site.purchase' WHEN 'R' THEN 'Lead_Form'
    ELSE 'site.PAGE_VIEW' END AS conversion_action"""),
    "b_age_gender": _b("""CASE l.l_linenumber WHEN 1 THEN '18-24' WHEN 2 THEN '25-34' ELSE '65+' END AS age,
  CASE l.l_returnflag WHEN 'A' THEN 'male' WHEN 'R' THEN 'female' ELSE 'unknown' END AS gender"""),
    "b_region": _b("""'C' || s.s_nationkey AS country,
  CASE l.l_linenumber WHEN 1 THEN '' WHEN 2 THEN NULL ELSE r.r_name END AS region"""),
    "b_events": "SELECT" + _E,
    "b_campaign_dim": """SELECT CAST(s_suppkey AS STRING) AS campaign_id,
  CASE (s_suppkey + pass) % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PAUSED' ELSE 'PENDING_REVIEW' END AS effective_status,
  CASE WHEN s_suppkey % 4 > 0 THEN CAST(CAST('1999-01-01' AS DATE) + CAST(s_suppkey % 400 AS INT) AS TIMESTAMP) END
    AS stop_time, CAST(CAST('1998-01-01' AS DATE) + pass AS TIMESTAMP) AS _ingested_at, s_suppkey * 2 + pass AS row_id
  FROM (SELECT *, 0 AS pass FROM {supplier} UNION ALL SELECT *, 1 AS pass FROM {supplier} WHERE s_acctbal > 2000) s
  WHERE s_nationkey <> 3""",
    "b_ad_dim": """SELECT CAST(p_partkey AS STRING) AS ad_id, CAST(p_partkey % 700 AS STRING) AS creative_id,
  CAST(CAST('1998-01-01' AS DATE) + p_size AS TIMESTAMP) AS _ingested_at, p_partkey AS row_id FROM {part}
  WHERE p_size > 3""",
    "b_creative_dim": """SELECT CAST(p_partkey % 900 AS STRING) AS creative_id,
  CASE WHEN p_size > 25 THEN p_name END AS headline, CASE WHEN p_size % 3 > 0 THEN p_type END AS body,
  p_brand AS call_to_action_type, 'http://x/' || p_partkey AS destination_url, 'img' || p_partkey AS image_url,
  CAST(CAST('1998-01-01' AS DATE) + p_size AS TIMESTAMP) AS _ingested_at, p_partkey AS row_id FROM {part}""",
    "crm_orders": """SELECT CAST(o.o_orderkey AS STRING) AS id_commande, CAST(year(o.o_orderdate) AS INT) AS year,
  CAST(o.o_orderdate AS DATE) AS date_submit, CAST(o.o_orderdate AS TIMESTAMP) AS date_time_submit,
  ' ' || n.n_name || ' EXPO' AS conference_series, year(o.o_orderdate) || ' ' || n.n_name AS conference_editions,
  CASE WHEN o.o_orderkey % 10 > 0 THEN CAST(CAST(round(o.o_totalprice) AS BIGINT) AS STRING) || '.25' ELSE 'n/a' END AS total_ht,
  CASE WHEN n.n_regionkey = 1 THEN 'USD ' ELSE 'EUR' END AS currency, 'web' AS order_type, 'City' AS city,
  n.n_name AS country, r.r_name AS region, 'en' AS primary_language, c.c_mktsegment AS specialty,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'SourceA' WHEN '2-HIGH' THEN 'a_ads' WHEN '3-MEDIUM' THEN 'SOURCEB'
    WHEN '4-NOT SPECIFIED' THEN 'b.example' ELSE 'mail' END AS utm_source,
  CASE o.o_orderstatus WHEN 'F' THEN 'cpc' WHEN 'O' THEN ' Paid ' ELSE 'organic' END AS utm_medium,
  ' Camp ' || o.o_custkey AS utm_campaign, 'Paid' AS orders,
  CASE o.o_orderstatus WHEN 'F' THEN ' New ' WHEN 'O' THEN 'returning' END AS new_customer, 'EB' AS cut_off_rate
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "geo_targets": """SELECT CAST(n.n_nationkey AS STRING) AS `Criteria ID`, n.n_name AS `Name`,
  n.n_name || ', ' || r.r_name AS `Canonical Name`, 'C' || n.n_nationkey AS `Country Code`,
  CASE WHEN n.n_nationkey % 2 = 0 THEN 'Country' END AS `Target Type`
  FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey WHERE r.r_name <> 'ASIA'""",
    "countries": """SELECT 'C' || n_nationkey AS country_code, lower(n_name) AS country_name FROM {nation}
  WHERE n_regionkey <> 2""",
    # One edition per nation and year that has orders.
    "calendar": """SELECT y || ' ' || n_name || CASE WHEN k % 2 = 0 THEN ' EXPO' ELSE '' END AS conference_editions,
  d AS event_start_date, d + 2 AS event_end_date, CASE WHEN k % 5 > 0 THEN d - 120 END AS seb_end_date,
  d - 60 AS eb_end_date, CASE WHEN k % 3 > 0 THEN d - 30 END AS advance_end_date, d - 1 AS fp_end_date
  FROM (SELECT DISTINCT n.n_name, n.n_nationkey AS k, CAST(year(o.o_orderdate) AS INT) AS y,
      make_date(CAST(year(o.o_orderdate) AS INT), 1 + n.n_nationkey % 12, 1 + n.n_nationkey) AS d
    FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
    WHERE n.n_nationkey % 7 <> 6) t""",
}

ACCOUNT_RULES = (
    Rule("HOME", equals=("NATION_0",)),
    Rule("GROUP_2", like=("NATION_2_",)),
    Rule("GROUP_1", like=("%ION_13", "%ION_14")),
)
CAMPAIGN_RULES = tuple([
    Rule("HOME", contains=("NATION_0 ", "NATION-0 "), fold="upper"),
    Rule("GROUP_1", contains=("nation_13", "nation_14"), fold="upper"),
    *[Rule(f"NATION_{n}", contains=(f"NATION_{n} ",), fold="upper") for n in range(1, 20)],
    Rule("GROUP_2", contains=("NATION_2",), fold="upper"),
])
EDITION_RULES = tuple([
    EditionRule("HOME", ("% NATION_0 EXPO",)),
    EditionRule("GROUP_1", ("%NATION_13%", "%NATION_14%")),
    EditionRule("GROUP_2", ("%NATION_2%",), ("% NATION_2", "% NATION_2 EXPO")),
    *[EditionRule(f"NATION_{n}", (f"% NATION_{n}", f"% NATION_{n} EXPO")) for n in range(1, 20)],
])
SERIES_RULES = (
    Rule("HOME", like=("NATION_0 %",)),
    Rule("GROUP_1", like=("%_13 %",), equals=("NATION_14 EXPO",)),
    Rule("GROUP_2", like=("NATION_2_ EXPO",)),
    Rule("NATION_X", contains=("NATION_1", "NATION_3")),
)
_TICKET = Rule("PURCHASE", contains=("Ticket",))
_BUY = Rule("PURCHASE", equals=("BUY",), column="conversion_category")
_BROKEN = Rule("OTHER", contains=("Broken",))
_FORM = Rule("LEAD", equals=("FORM",), column="conversion_category")
CONVERSIONS_A = ConversionRules(
    classes=(_BROKEN, _TICKET, Rule("LEAD", equals=("Brochure",)), _BUY, _FORM,
             Rule("ADD_TO_CART", contains=("CART",), column="conversion_category")),
    secondary=(Rule(equals=("Brochure",)), _FORM), allow_value=(_TICKET, _BUY), deny_value=(_BROKEN,))
CONVERSIONS_B = ConversionRules(
    classes=(Rule("PURCHASE", equals=("site.purchase",)), Rule("LEAD", like=("%lead%",), fold="lower"),
             Rule("PAGE_VIEW", like=("%page_view%",), fold="lower")),
    allow_value=(Rule(equals=("site.purchase",)),))
GEO_CONVERSIONS_A = ConversionRules(
    classes=(_BROKEN, Rule("PURCHASE", contains=("ticket",), fold="lower"), Rule("LEAD", equals=("Brochure",))),
    secondary=(Rule(equals=("Brochure",)),), allow_value=(Rule(contains=("ticket",), fold="lower"),),
    deny_value=(_BROKEN,))
GEO_CONVERSIONS_B = ConversionRules(
    classes=(Rule("PURCHASE", equals=("purchase",), fold="lower", trim=True), Rule("SIGNUP", equals=("signup",)),
             Rule("CONTACT", contains=("contact",), fold="lower"), Rule("PAGE_VIEW", equals=("view",))),
    allow_value=(Rule(equals=("purchase",), fold="lower", trim=True),))

CONTEXT = Context(
    as_of=AS_OF, platform_a="A", platform_b="B", account_rules=ACCOUNT_RULES, campaign_rules=CAMPAIGN_RULES,
    edition_rules=EDITION_RULES, series_rules=SERIES_RULES,
    source_aliases={"A": ("sourcea", "a_ads"), "B": ("sourceb", "b.example")},
    new_customer_values=("new", "first"), conversions_a=CONVERSIONS_A, conversions_b=CONVERSIONS_B,
    geo_conversions_a=GEO_CONVERSIONS_A, geo_conversions_b=GEO_CONVERSIONS_B,
    geo_keep={"A": Keep(drop=("OTHER",)), "B": Keep(only=("PURCHASE", "SIGNUP", "CONTACT"))}, tie=TIES)

PLACEHOLDER = re.compile(r"\{(\w+)\}")


def workspace(spark: SparkSession) -> str:
    """A new folder in the shared folder, or below the warehouse, which is shared storage on a cluster."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/martkit-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.table(view(spark, sf_dir, name))


def view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Temporary view of a driver table, one name per scale directory."""
    alias = f"t_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}_{name}"
    if not spark.catalog.tableExists(alias):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(alias)
    return alias


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Stand-in raw table in Spark."""
    return spark.sql(PLACEHOLDER.sub(lambda m: view(spark, sf_dir, m.group(1)), RAW[name]))


def raw_sql(name: str) -> str:
    """The same stand-in for DuckDB."""
    return PLACEHOLDER.sub(r"\1", RAW[name]).replace("`", '"')
