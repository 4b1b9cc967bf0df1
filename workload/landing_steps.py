"""Landing of whole reports and dimensions, from payloads shaped out of the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from martkit.plans import landing
from martkit.sources import load
from martkit.sources.tables import read_table

from .column_steps import query
from .join_steps import _REPORT, _STATUSES, _plain, _sql
from .oracle import statement
from .standins import table, workspace

AT = datetime(2024, 5, 1, 6)


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _report_a(spark, sf) -> DataFrame:
    """Line items as a nested report of platform A, numbers as text."""
    line = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    n = F.col("l_linenumber")
    cost = (F.col("l_quantity").cast("long") * 1_000_000).cast("string")
    action = F.concat(F.lit("customers/1/conversionActions/"), _text("l_suppkey"))
    keyword = F.when(n % 3 > 0, F.concat(F.lit("customers/1/adGroupCriteria/5~"), F.when(n % 3 == 1, _text("l_suppkey")).otherwise("")))
    return line.select(
        F.struct(_text(F.to_date("l_shipdate")).alias("date"), action.alias("conversion_action"),
                 F.col("l_returnflag").alias("conversion_action_name"), F.lit("PURCHASE").alias("conversion_action_category"),
                 F.struct(keyword.alias("ad_group_criterion")).alias("keyword")).alias("segments"),
        F.struct(_text(F.col("o_custkey") % 10).alias("id"), F.lit("Account").alias("descriptive_name"),
                 F.lit("EUR").alias("currency_code")).alias("customer"),
        F.struct(_text("o_custkey").alias("id"), F.lit("Camp").alias("name"), F.col("l_linestatus").alias("status"),
                 F.lit("CLICKS").alias("bidding_strategy_type")).alias("campaign"),
        F.struct(_text("l_orderkey").alias("id"), _text(n).alias("name")).alias("ad_group"),
        F.struct(F.lower("l_returnflag").alias("search_term")).alias("search_term_view"),
        F.struct(_text(n * 5).alias("impressions"), F.when(n % 2 == 0, _text(n)).alias("clicks"), cost.alias("average_cpc"),
                 cost.alias("cost_micros"), F.when(n % 4 > 0, _text(n % 4)).alias("all_conversions"),
                 _text(n % 4 / 2).alias("conversions")).alias("metrics"))


_LINES = """SELECT *, CAST(l_shipdate AS DATE) AS date, CAST(o_custkey AS VARCHAR) AS campaign_id, CAST(o_custkey % 10 AS VARCHAR)
  AS account_id, CAST(l_orderkey AS VARCHAR) AS ad_group_id, CAST(l_linenumber AS BIGINT) AS n FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey"""


@query(f"""SELECT date, account_id, campaign_id, l_linestatus AS campaign_status, ad_group_id, lower(l_returnflag) AS search_term,
  CASE n % 3 WHEN 1 THEN CAST(l_suppkey AS VARCHAR) END AS keyword_id, n * 5 AS impressions,
  CASE WHEN n % 2 = 0 THEN n ELSE 0 END AS clicks, CAST(0 AS DOUBLE) AS ctr, CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS average_cpc,
  CAST(l_quantity AS BIGINT) * 1000000 AS cost_micros, CAST(n % 4 AS DOUBLE) / 2 AS conversions,
  CAST(n % 4 AS DOUBLE) AS all_conversions, 'EUR' AS currency FROM ({_LINES})""")
def landed_a_report(spark, sf):
    """Search terms: missing metrics are 0, money in micros, the keyword id is the tail of a path."""
    return landing.land_a(_report_a(spark, sf), "a_search_terms", AT).select(
        "date", "account_id", "campaign_id", "campaign_status", "ad_group_id", "search_term", "keyword_id", "impressions",
        "clicks", "ctr", "average_cpc", "cost_micros", "conversions", "all_conversions", "currency")


@query(f"""SELECT date, account_id, campaign_id, CAST(l_suppkey AS VARCHAR) AS conversion_action_id, l_returnflag AS conversion_action_name,
  'PURCHASE' AS conversion_category, CAST(n % 4 AS DOUBLE) / 2 AS conversions, CAST(n % 4 AS DOUBLE) AS all_conversions,
  CAST(0 AS DOUBLE) AS all_conversions_value FROM ({_LINES}) WHERE n % 4 > 0""")
def landed_a_conversions(spark, sf):
    """Rows without conversions, missing ones too, are not landed."""
    return landing.land_a(_report_a(spark, sf), "a_conversion_action", AT).select(
        "date", "account_id", "campaign_id", "conversion_action_id", "conversion_action_name", "conversion_category",
        "conversions", "all_conversions", "all_conversions_value")


@query(statement({"rep": _plain(_REPORT), "st": _plain(_STATUSES)}, """SELECT CAST(date_start AS DATE) AS date, account_id,
  rep.campaign_id, coalesce(effective_status, 'UNKNOWN') AS campaign_status, adset_id, CAST(spend AS DOUBLE) AS spend,
  coalesce(CAST(impressions AS BIGINT), 0) AS impressions, CAST(0 AS BIGINT) AS unique_clicks,
  CASE adset_id WHEN '1' THEN 2.5 WHEN '2' THEN 0 WHEN '3' THEN 7 ELSE 0 END::DOUBLE AS daily_budget_cap,
  CASE adset_id WHEN '1' THEN 0 WHEN '2' THEN 30 WHEN '3' THEN 0 ELSE 0 END::DOUBLE AS lifetime_budget_cap,
  CASE WHEN adset_id IN ('1', '2') THEN 'ACTIVE' WHEN adset_id = '3' THEN 'PAUSED' ELSE 'UNKNOWN' END AS adset_status, 'EUR' AS currency
  FROM rep LEFT JOIN st ON rep.campaign_id = CAST(st.campaign_id AS VARCHAR)"""))
def landed_pacing(spark, sf):
    """Spend per ad set with the caps of its newest budget; broken caps are 0, ad sets without one are unknown."""
    old, new = datetime(2024, 4, 1), datetime(2024, 5, 1)
    budgets = spark.createDataFrame(
        [("1", "99900", "5", "PAUSED", old), ("1", "250", "tbc", "ACTIVE", new), ("2", None, "3000", "ACTIVE", new),
         ("3", "700", "0", "PAUSED", new), ("3", "1", "1", "ACTIVE", old)],
        "adset_id string, daily_budget string, lifetime_budget string, status string, _ingested_at timestamp")
    out = landing.land_b_pacing(_sql(spark, sf, _REPORT), budgets, _sql(spark, sf, _STATUSES), "EUR", AT)
    return out.select("date", "account_id", "campaign_id", "campaign_status", "adset_id", "spend", "impressions", "unique_clicks",
                      "daily_budget_cap", "lifetime_budget_cap", "adset_status", "currency")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS creative_id, p_name AS creative_name, 'Account' AS account_name,
  CASE WHEN p_size > 40 THEN p_name ELSE coalesce(CASE WHEN p_size % 2 = 0 THEN p_brand END, p_type) END AS headline,
  p_name AS body, 'http://l/' || p_type AS destination_url, p_brand AS call_to_action_type,
  CASE WHEN p_size < 20 THEN 'i' || p_size END AS image_url FROM part""")
def landed_creatives(spark, sf):
    """Written by a full refresh and read back by the declared schema."""
    size, none = F.col("p_size"), F.lit(None).cast("string")
    cta = F.struct(F.col("p_brand").alias("type"))
    link = F.struct(F.col("p_type").alias("name"), F.col("p_name").alias("message"),
                    F.concat(F.lit("http://l/"), "p_type").alias("link"), none.alias("picture"), cta.alias("call_to_action"))
    video = F.struct(F.when(size % 2 == 0, F.col("p_brand")).alias("title"), F.lit("").alias("message"), none.alias("image_url"),
                     cta.alias("call_to_action"))
    feed = F.struct(F.when(size > 40, F.array(F.struct(F.col("p_name").alias("text")))).alias("titles"),
                    F.lit(None).cast("array<struct<text:string>>").alias("bodies"),
                    F.lit(None).cast("array<struct<website_url:string>>").alias("link_urls"),
                    F.lit(None).cast("array<struct<url:string>>").alias("images"))
    payload = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.lit("1").alias("account_id"), F.lit("ACTIVE").alias("status"),
        F.lit("tag").alias("url_tags"), F.lit("").alias("call_to_action_type"),
        F.when(size < 20, F.concat(F.lit("i"), _text(size))).alias("image_url"), none.alias("thumbnail_url"),
        F.struct(link.alias("link_data"), video.alias("video_data")).alias("object_story_spec"), feed.alias("asset_feed_spec"))
    root = workspace(spark)
    load.full_refresh(landing.land_creatives(payload, "Account", AT), f"{root}/b_creative_dim")
    return read_table(spark, root, "b_creative_dim").select("creative_id", "creative_name", "account_name", "headline", "body",
                                                            "destination_url", "call_to_action_type", "image_url")


@query("""SELECT CAST(l_partkey AS VARCHAR) AS ad_id, 'RESPONSIVE_SEARCH_AD' AS ad_type, ['u' || l_partkey] AS final_urls,
  [min(l_returnflag)] AS headlines, CAST([] AS VARCHAR[]) AS descriptions FROM lineitem GROUP BY l_partkey""")
def landed_ads(spark, sf):
    """Every ad comes in many reports; one row stays, the first by its texts."""
    def texts(*items):
        return F.array(*[F.struct(c.alias("text")) for c in items]).cast("array<struct<text:string>>")
    none = F.lit(None).cast("string")
    ad = F.struct(
        F.col("l_partkey").alias("id"), F.lit("RESPONSIVE_SEARCH_AD").alias("type"),
        F.array(F.concat(F.lit("u"), _text("l_partkey"))).alias("final_urls"),
        F.struct(texts(F.col("l_returnflag")).alias("headlines"), texts().alias("descriptions")).alias("responsive_search_ad"),
        F.struct(texts().alias("headlines"), texts().alias("descriptions"), F.struct(none.alias("text")).alias("long_headline"))
        .alias("responsive_display_ad"),
        F.struct(*[none.alias(c) for c in ("headline_part1", "headline_part2", "headline_part3", "description", "description2")])
        .alias("expanded_text_ad"))
    return landing.land_ads(table(spark, sf, "lineitem").select(ad.alias("ad")), AT).drop(landing.STAMP)


@query("""SELECT CAST(l_suppkey % 50 AS VARCHAR) AS audience_criterion_id, min((CAST(l_orderkey AS VARCHAR), l_returnflag))[1] AS ad_group_id,
  min((CAST(l_orderkey AS VARCHAR), l_returnflag))[2] AS audience_name, 'USER_LIST' AS audience_type FROM lineitem
WHERE l_linenumber % 2 = 0 GROUP BY 1""")
def landed_audiences(spark, sf):
    """Other criterion types go; of an audience that many ad groups use one row stays."""
    kind = F.when(F.col("l_linenumber") % 2 == 0, "USER_LIST").otherwise("AGE_RANGE")
    report = table(spark, sf, "lineitem").select(
        F.struct(_text("l_orderkey").alias("id")).alias("ad_group"),
        F.struct(_text(F.col("l_suppkey") % 50).alias("criterion_id"), F.col("l_returnflag").alias("display_name"),
                 kind.alias("type")).alias("ad_group_criterion"))
    return landing.land_audiences(report, ["USER_LIST"], AT).drop(landing.STAMP)
