"""Join, calendar and nested-data operators on the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from martkit.functions import dates
from martkit.functions.rules import first_match
from martkit.operators import bloom, lookup, nested
from martkit.operators.dedup import combine_dims
from martkit.operators.editions import edition_days, label_events, match_series, nearest_edition
from martkit.operators.nested import Field
from martkit.operators.rollup import phrase_totals, top_phrases
from martkit.operators.stack import stack
from martkit.plans import calendar as calendars, gold, landing
from martkit.plans.calendar import CalendarSpec, YearException
from martkit.functions.status import IDLE
from martkit.plans.silver import states_a

from . import oracle
from .column_steps import query
from .marts import STOP_WORDS, Models, editions
from .oracle import SHARED, TODAY, statement, week_diff
from .standins import AS_OF, CONTEXT, EDITION_RULES, PLACEHOLDER, raw, raw_sql, table, view


def _sql(spark, sf, statement_text):
    """A stand-in statement in Spark."""
    return spark.sql(PLACEHOLDER.sub(lambda m: view(spark, sf, m.group(1)), statement_text))


def _plain(text):
    """A stand-in statement for DuckDB."""
    return PLACEHOLDER.sub(r"\1", text)


# Orders as a fact: one row per order, the nation of the customer as series.
_FACT = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, n_name AS account_name FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
_NAMED = {"fact0": _FACT, "fact": f"SELECT *, {oracle.EVENT_A} AS event_name FROM fact0"}


def fact(spark, sf):
    rows = (table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", F.to_date("o_orderdate").alias("date"), F.col("n_name").alias("account_name")))
    return rows.withColumn("event_name", first_match("account_name", CONTEXT.account_rules, F.col("account_name")))


@query(statement(SHARED | _NAMED | oracle.label_cte("x", "fact"),
                 "SELECT o_orderkey, date, event_name, conference_editions, event_start_date FROM x_k"))
def nearest_editions(spark, sf):
    return nearest_edition(fact(spark, sf), editions(spark, sf)).select(
        "o_orderkey", "date", "event_name", "conference_editions", "event_start_date")


@query(statement(SHARED | _NAMED | oracle.label_cte("x", "fact"),
                 f"SELECT o_orderkey, date, event_name, {', '.join(oracle.LABELS)} FROM x_l"))
def labelled_events(spark, sf):
    return label_events(fact(spark, sf), editions(spark, sf), AS_OF).drop("account_name")


@query(statement(oracle.editions_cte(), "SELECT series, conference_editions, event_end_date FROM editions"))
def edition_series(spark, sf):
    return match_series(raw(spark, sf, "calendar"), EDITION_RULES).select(
        "series", "conference_editions", "event_end_date")


@query(statement(oracle.editions_cte() | {
    "days": "SELECT *, CAST(unnest(generate_series(event_end_date - 400, event_end_date, INTERVAL 1 DAY)) AS DATE) "
            "AS date FROM editions"},
    """SELECT series, date, conference_editions, CAST(abs(date_diff('day', date, event_start_date)) AS INT)
  AS edition_distance FROM days QUALIFY row_number() OVER (PARTITION BY series, date
  ORDER BY abs(date_diff('day', date, event_start_date)), event_start_date, conference_editions) = 1"""))
def edition_calendar(spark, sf):
    days = edition_days(match_series(raw(spark, sf, "calendar").select(
        "event_start_date", "conference_editions", "event_end_date", "seb_end_date", "eb_end_date",
        "advance_end_date", "fp_end_date"), EDITION_RULES))
    return days.select("series", "date", "conference_editions", "edition_distance")


_DATED = SHARED | _NAMED | oracle.label_cte("x", "fact")


def _dated(spark, sf):
    """Every order with its nearest edition, or with none, for the date operators."""
    return nearest_edition(fact(spark, sf), editions(spark, sf))


@query(statement(_DATED, f"SELECT o_orderkey, conference_editions, {oracle.tier_case()} AS cut_off_rate FROM x_k"))
def tier(spark, sf):
    return _dated(spark, sf).select("o_orderkey", "conference_editions",
                                    dates.tier("date", "conference_editions").alias("cut_off_rate"))


@query(statement(_DATED | {"p": f"SELECT *, {oracle.tier_case()} AS rate FROM x_k"},
                 f"SELECT o_orderkey, conference_editions, CAST({oracle.order_case('rate')} AS INT) AS sort_order FROM p"))
def tier_order(spark, sf):
    rate = dates.tier("date", "conference_editions")
    return _dated(spark, sf).withColumn("rate", rate).select(
        "o_orderkey", "conference_editions", dates.tier_order("rate").alias("sort_order"))


@query(statement(_DATED | {"p": f"SELECT *, {oracle.week_case()} AS weeks FROM x_k"},
                 "SELECT o_orderkey, conference_editions, weeks AS week_number, 'Week ' || weeks AS week, "
                 "52 - CAST(weekofyear(date) AS INT) AS year_end FROM p"))
def countdown_week(spark, sf):
    week = dates.countdown_week("date", "conference_editions", "event_start_date")
    return _dated(spark, sf).select("o_orderkey", "conference_editions", week.alias("week_number"),
                                    dates.week_label(week).alias("week"),
                                    dates.weeks_to_year_end("date").alias("year_end"))


@query(statement(_DATED, f"SELECT o_orderkey, conference_editions, {oracle.left_case()} AS weeks_left FROM x_k"))
def weeks_left(spark, sf):
    left = dates.weeks_left("conference_editions", "event_start_date", AS_OF)
    return _dated(spark, sf).select("o_orderkey", "conference_editions", left.alias("weeks_left"))


@query(statement(SHARED, "SELECT o_orderkey, coalesce(dim_status, 'Not delivering') AS campaign_status FROM orders "
                         "LEFT JOIN dim_a ON CAST(o_custkey AS VARCHAR) = dim_id"))
def dim_status(spark, sf):
    states = states_a(raw(spark, sf, "a_campaign_dim"), CONTEXT)
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("campaign_id"))
    return lookup.with_status(rows, states.df, IDLE).drop("campaign_id")


@query("""SELECT l_orderkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_suppkey NOT IN
  (SELECT s_suppkey FROM supplier WHERE s_acctbal < 3000)""")
def not_in_split(spark, sf):
    keys = table(spark, sf, "supplier").where("s_acctbal < 3000").select(F.col("s_suppkey").alias("l_suppkey"))
    return lookup.exclude_keys(table(spark, sf, "lineitem"), keys, "l_suppkey").select(
        "l_orderkey", "l_suppkey", "l_extendedprice")


@query("""SELECT l_orderkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_suppkey NOT IN
  (SELECT s_suppkey FROM supplier WHERE s_acctbal < 3000)""")
def not_in_filtered(spark, sf):
    """The same rows by a Bloom filter of the keys and an exact join of what it lets through."""
    keys = table(spark, sf, "supplier").where("s_acctbal < 3000").select(F.col("s_suppkey").alias("l_suppkey"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    return bloom.exclude_many(rows, keys, "l_suppkey", bloom.Filter.for_keys(1 << 20))


@query("""SELECT 'with NULL' AS key_set, l_orderkey, l_suppkey FROM lineitem WHERE l_suppkey NOT IN
  (SELECT CASE WHEN s_acctbal > 100 THEN s_suppkey END FROM supplier WHERE s_acctbal < 3000)
UNION ALL SELECT 'without', l_orderkey, nullif(l_suppkey, 7) FROM lineitem WHERE nullif(l_suppkey, 7) NOT IN
  (SELECT s_suppkey FROM supplier WHERE s_acctbal < 3000)""")
def not_in_null_aware(spark, sf):
    """A key set with a NULL removes everything; one without it, only its keys and NULL rows."""
    low = table(spark, sf, "supplier").where("s_acctbal < 3000")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    some = low.select(F.when(F.col("s_acctbal") > 100, F.col("s_suppkey")).alias("l_suppkey"))
    every = low.select(F.col("s_suppkey").alias("l_suppkey"))
    sets = {"with NULL": (rows, some), "without": (rows.withColumn("l_suppkey", F.nullif("l_suppkey", F.lit(7))), every)}
    parts = [lookup.exclude_keys(r, k, "l_suppkey", null_aware=True).select(F.lit(n).alias("key_set"), "*")
             for n, (r, k) in sets.items()]
    return parts[0].unionByName(parts[1])


@query("""SELECT l_orderkey AS id, l_suppkey AS campaign_id, l_extendedprice AS cost FROM lineitem
  WHERE l_suppkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 400000""")
def stack_sources(spark, sf):
    narrow = table(spark, sf, "orders").where("o_totalprice > 400000").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("campaign_id"), F.col("o_totalprice").alias("cost"))
    wide = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("campaign_id"),
        F.col("l_extendedprice").alias("cost"))
    return stack(lookup.exclude_keys(wide, narrow, "campaign_id"), narrow)


@query(statement({"geo_targets": raw_sql("geo_targets")},
                 f"SELECT c_custkey, {oracle.GEO_NAMES} FROM customer c LEFT JOIN geo_targets g "
                 "ON CAST(c.c_nationkey AS VARCHAR) = g.\"Criteria ID\""))
def geo_lookup(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.lit(None).cast("string").alias("user_geo"),
                                               F.col("c_nationkey").alias("geo"))
    return lookup.with_geo(rows, raw(spark, sf, "geo_targets"), ["user_geo", "geo"]).drop("user_geo", "geo")


@query(statement({"countries": raw_sql("countries")},
                 "SELECT s_suppkey, coalesce(country_name, 'C' || s_nationkey) AS country_name FROM supplier "
                 "LEFT JOIN countries ON country_code = 'C' || s_nationkey"))
def country_fallback(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("C"), "s_nationkey").alias("country_code"))
    return lookup.with_country(rows, raw(spark, sf, "countries")).drop("country_code")


@query(statement({"bridge_raw": raw_sql("b_ad_dim"), "look_raw": raw_sql("b_creative_dim"),
                  "bridge": oracle.newest("bridge_raw", ["ad_id"], "creative_id DESC"),
                  "look": oracle.newest("look_raw", ["creative_id"], "row_id DESC")},
                 "SELECT l_orderkey, l_linenumber, l_partkey, headline, body FROM lineitem "
                 "LEFT JOIN bridge b ON CAST(l_partkey AS VARCHAR) = b.ad_id LEFT JOIN look k "
                 "ON b.creative_id = k.creative_id"))
def bridge_join(spark, sf):
    ads = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                              F.col("l_partkey").cast("string").alias("ad_id"))
    return lookup.with_creative(ads, raw(spark, sf, "b_ad_dim"), raw(spark, sf, "b_creative_dim"),
                                ["headline", "body"], tie=["row_id"]).drop("ad_id")


@query("""WITH bridge AS (SELECT DISTINCT p_partkey AS ad_id, p_brand AS creative_id FROM part WHERE p_size > 20),
  look AS (SELECT DISTINCT p_brand AS creative_id, p_type AS headline FROM part)
SELECT l_orderkey, l_linenumber, headline FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)
LEFT JOIN bridge ON l_partkey = ad_id LEFT JOIN look USING (creative_id)""")
def bridge_fan_out(spark, sf):
    part = table(spark, sf, "part")
    bridge = part.where("p_size > 20").select(F.col("p_partkey").alias("ad_id"), F.col("p_brand").alias("creative_id"),
                                              F.lit(0).alias("_ingested_at"))
    looks = part.select(F.col("p_brand").alias("creative_id"), F.col("p_type").alias("headline"))
    ads = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                              F.col("l_partkey").cast("string").alias("ad_id"),).distinct()
    return lookup.with_creative(ads, bridge, looks, ["headline"], fan_out=True).drop("ad_id")


@query("""SELECT o_orderkey, o_totalprice AS spend, coalesce(c_acctbal / 100.0, 0.0) AS daily_budget_cap,
  coalesce(CAST(c_custkey AS DOUBLE) / 100.0, 0.0) AS lifetime_budget_cap,
  coalesce(c_mktsegment, 'UNKNOWN') AS adset_status FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_nationkey <> 3) ON o_custkey = c_custkey""")
def pacing_join(spark, sf):
    """Every budget has an older, other version on the side."""
    spend = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("adset_id"),
                                              F.col("o_totalprice").alias("spend"))
    budgets = table(spark, sf, "customer").where("c_nationkey <> 3").select(
        F.col("c_custkey").alias("adset_id"), F.col("c_acctbal").cast("string").alias("daily_budget"),
        F.col("c_custkey").cast("string").alias("lifetime_budget"), F.col("c_mktsegment").alias("status"),
        F.lit(datetime(2024, 5, 2)).alias("_ingested_at"))
    older = budgets.withColumns({"daily_budget": F.lit("1"), "status": F.lit("PAUSED"),
                                 "_ingested_at": F.lit(datetime(2024, 5, 1))})
    return lookup.pacing(spend, older.unionByName(budgets)).drop("adset_id")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice, coalesce(s_name, 'UNKNOWN') AS status FROM lineitem
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 2000) ON l_suppkey = s_suppkey""")
def status_default(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey")
    side = table(spark, sf, "supplier").where("s_acctbal > 2000").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("status"), F.lit(datetime(2024, 5, 2)).alias("_ingested_at"))
    older = side.withColumns({"status": F.lit("old"), "_ingested_at": F.lit(datetime(2024, 5, 1))})
    side = older.unionByName(side)  # every key twice
    return lookup.with_default(rows, side, ["l_suppkey"], {"status": "UNKNOWN"}).drop("l_suppkey")


@query("""SELECT p_partkey AS id, 'found' AS origin FROM part WHERE p_size > 10
UNION ALL SELECT id, 'fetched' FROM (SELECT DISTINCT l_partkey AS id FROM lineitem) WHERE id NOT IN
  (SELECT p_partkey FROM part WHERE p_size > 10)""")
def gap_fill(spark, sf):
    found = table(spark, sf, "part").where("p_size > 10").select(F.col("p_partkey").alias("id"),
                                                                 F.lit("found").alias("origin"))
    ids = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"))
    fetched = lookup.missing_ids(ids, found, "id").withColumn("origin", F.lit("fetched"))
    return lookup.fill_gaps(found, fetched, "id")


@query("SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part "
       "WHERE p_size > 10)")
def missing_ids(spark, sf):
    found = table(spark, sf, "part").where("p_size > 10").select(F.col("p_partkey").alias("id"))
    return lookup.missing_ids(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id")), found, "id")


# Nested payloads ------------------------------------------------------------

_EV = {"raw_b": raw_sql("b_events")}


@query(statement(_EV | {"flat": oracle.ACTIONS.replace("{p}", "b")},
                 "SELECT row_id, conversion_action_name, n_actions AS conversions, action_value AS conversion_value "
                 "FROM flat"))
def explode_actions(spark, sf):
    rows = raw(spark, sf, "b_events").select("row_id", "actions", "action_values")
    return nested.explode_actions(rows)


@query(statement(_EV | {"flat": oracle.ACTIONS.replace("{p}", "b").replace(")[1], '$.value')", ")[-1], '$.value')")},
                 "SELECT row_id, conversion_action_name AS conversion_action, n_actions AS conversions, "
                 "coalesce(action_value, 0.0::DOUBLE) AS conversion_value FROM flat"))
def explode_lookup_last(spark, sf):
    rows = raw(spark, sf, "b_events").select("row_id", "actions", "action_values")
    return nested.explode_actions(rows, names=("conversion_action", "conversions", "conversion_value"),
                                  duplicate="last", missing=0.0)


@query(statement(_EV, """SELECT row_id, coalesce(list_sum(list_transform(CAST(CAST(actions AS JSON) AS JSON[]),
  lambda x: CAST(json_extract_string(x, '$.value') AS DOUBLE))), 0.0::DOUBLE) AS conversions,
  list_sum(list_transform(CAST(CAST(action_values AS JSON) AS JSON[]),
  lambda x: CAST(json_extract_string(x, '$.value') AS DOUBLE))) AS conversion_value FROM raw_b"""))
def array_sum(spark, sf):
    rows = raw(spark, sf, "b_events")
    return rows.select("row_id",
                       nested.sum_actions(nested.parse_actions(rows, "actions")).alias("conversions"),
                       nested.sum_actions(nested.parse_actions(rows, "action_values")).alias("conversion_value"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_scalar(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("""SELECT CAST(event_id AS VARCHAR) AS id, CAST(ts AS DATE) AS date, event_type AS action, value AS spend,
  CAST(0 AS BIGINT) AS clicks, CAST(CASE WHEN user_id % 3 = 0 THEN 0 ELSE event_id END AS BIGINT) AS impressions FROM events""")
def flatten_report(spark, sf):
    report = table(spark, sf, "events").select(
        F.struct(F.to_date("ts").cast("string").alias("date"), F.col("event_type").alias("type")).alias("segments"),
        F.struct(F.col("event_id").alias("id"), F.col("value").cast("string").alias("spend"),
                 F.when(F.col("user_id") % 3 > 0, F.col("event_id").cast("string")).alias("impressions"),
                 ).alias("metrics"))
    return nested.flatten_report(report, [
        Field("metrics.id", "id"), Field("segments.date", "date", "date"), Field("segments.type", "action"),
        Field("metrics.spend", "spend", "double", 0.0), Field("metrics.clicks", "clicks", "bigint", 0),
        Field("metrics.impressions", "impressions", "bigint", 0)])


@query("""SELECT p_partkey,
  CASE WHEN p_size > 40 THEN CASE WHEN p_size < 45 THEN p_name END
    WHEN p_size % 3 = 0 THEN coalesce(nullif(CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END, ''), p_type)
    ELSE p_type END AS headline,
  CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_name END AS body,
  coalesce('http://l/' || nullif(p_type, 'PROMO'), 'tag') AS destination_url,
  coalesce(nullif(CASE WHEN p_size < 10 THEN p_type ELSE '' END, ''), p_brand) AS call_to_action_type,
  coalesce(CASE WHEN p_size < 20 THEN 'i' || p_size END, CASE WHEN p_size > 40 THEN 'f' || p_size END) AS image_url
FROM part""")
def creative_resolver(spark, sf):
    size, text = F.col("p_size"), F.lit(None).cast("string")
    cta = F.struct(F.col("p_brand").alias("type"))
    link = F.struct(F.col("p_type").alias("name"), F.col("p_name").alias("message"),
                    F.concat(F.lit("http://l/"), F.nullif("p_type", F.lit("PROMO"))).alias("link"),
                    F.lit("").alias("picture"), cta.alias("call_to_action"))
    video = F.when(size % 3 == 0, F.struct(
        F.when(size % 2 == 0, F.col("p_brand")).otherwise("").alias("title"), F.col("p_brand").alias("message"),
        text.alias("image_url"), cta.alias("call_to_action")))
    titles = F.when(size > 40, F.array(F.struct(F.when(size < 45, F.col("p_name")).alias("text"))))
    images = F.when(size > 40, F.array(F.struct(F.concat(F.lit("f"), size).alias("url"))))
    feed = F.struct(titles.alias("titles"), F.array().cast("array<struct<text:string>>").alias("bodies"),
                    F.array().cast("array<struct<website_url:string>>").alias("link_urls"), images.alias("images"))
    payload = table(spark, sf, "part").select(
        "p_partkey", F.lit("tag").alias("url_tags"),
        F.when(size < 10, F.col("p_type")).otherwise("").alias("call_to_action_type"),
        F.when(size < 20, F.concat(F.lit("i"), size)).alias("image_url"), text.alias("thumbnail_url"),
        F.struct(link.alias("link_data"), video.alias("video_data")).alias("object_story_spec"),
        feed.alias("asset_feed_spec"))
    return nested.resolve_creative(payload).select("p_partkey", "headline", "body", "destination_url",
                                                   "call_to_action_type", "image_url")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS ad_id, kind AS ad_type, ['u' || p_size] AS final_urls,
  CASE kind WHEN 'RESPONSIVE_SEARCH_AD' THEN [p_name, p_type] WHEN 'RESPONSIVE_DISPLAY_AD' THEN
    CASE WHEN p_size > 30 THEN [p_name, 'long'] ELSE [p_name] END
  WHEN 'EXPANDED_TEXT_AD' THEN CASE WHEN p_size > 30 THEN [p_name, p_brand] ELSE [p_name] END ELSE [] END AS headlines,
  CASE kind WHEN 'EXPANDED_TEXT_AD' THEN [p_type] WHEN 'RESPONSIVE_SEARCH_AD' THEN [p_brand]
    WHEN 'RESPONSIVE_DISPLAY_AD' THEN [p_brand] ELSE [] END AS descriptions
FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN 'RESPONSIVE_SEARCH_AD' WHEN 'SMALL' THEN 'RESPONSIVE_DISPLAY_AD'
  WHEN 'PROMO' THEN 'EXPANDED_TEXT_AD' ELSE 'IMAGE_AD' END AS kind FROM part)""")
def ad_assets(spark, sf):
    def item(c):
        return F.struct(c.alias("text"))
    size, name, brand, kind = F.col("p_size"), F.col("p_name"), F.col("p_brand"), F.col("p_type")
    ad_type = (F.when(kind == "ECONOMY", "RESPONSIVE_SEARCH_AD").when(kind == "SMALL", "RESPONSIVE_DISPLAY_AD")
               .when(kind == "PROMO", "EXPANDED_TEXT_AD").otherwise("IMAGE_AD"))
    ad = F.struct(
        F.col("p_partkey").alias("id"), ad_type.alias("type"),
        F.array(F.concat(F.lit("u"), size)).alias("final_urls"),
        F.struct(F.array(item(name), item(kind)).alias("headlines"),
                 F.array(item(brand)).alias("descriptions")).alias("responsive_search_ad"),
        F.struct(F.array(item(name)).alias("headlines"), F.array(item(brand)).alias("descriptions"),
                 item(F.when(size > 30, "long").otherwise("")).alias("long_headline")).alias("responsive_display_ad"),
        F.struct(name.alias("headline_part1"), F.when(size > 30, brand).otherwise("").alias("headline_part2"),
                 F.lit(None).cast("string").alias("headline_part3"), kind.alias("description"),
                 F.lit("").alias("description2")).alias("expanded_text_ad"))
    return nested.ad_assets(table(spark, sf, "part").select(ad.alias("ad")))


@query("""SELECT p_partkey % 300 AS audience_criterion_id, p_type AS audience_type, p_name AS audience_name FROM part
WHERE p_type IN ('ECONOMY', 'SMALL', 'LARGE')
QUALIFY row_number() OVER (PARTITION BY p_partkey % 300 ORDER BY p_partkey) = 1""")
def audience_dim(spark, sf):
    rows = table(spark, sf, "part").select((F.col("p_partkey") % 300).alias("audience_criterion_id"),
                                           F.col("p_type").alias("audience_type"),
                                           F.col("p_name").alias("audience_name"), "p_partkey")
    return nested.audience_dim(rows, ["ECONOMY", "SMALL", "LARGE"], ["p_partkey"]).drop("p_partkey")


_REPORT = """SELECT CAST(CAST(ts AS DATE) AS STRING) AS date_start, CAST(user_id % 10 AS STRING) AS account_id,
  'Account' AS account_name, CAST(user_id AS STRING) AS campaign_id, 'Camp' AS campaign_name,
  CAST(event_id % 7 AS STRING) AS adset_id, 'Set' AS adset_name, CAST(event_id AS STRING) AS ad_id, 'Ad' AS ad_name,
  CASE WHEN user_id % 3 > 0 THEN CAST(event_id AS STRING) END AS impressions, CAST(event_id % 50 AS STRING) AS clicks,
  CAST(event_id % 100 AS STRING) || '.5' AS spend, CAST(hour(ts) AS STRING) || ':00:00 - x' AS {hour},
  '[{"action_type":"' || event_type || '","value":"' || (event_id % 7) || '"},{"action_type":"call","value":"1"}]'
    AS actions, '[{"action_type":"' || event_type || '","value":"3"},{"action_type":"' || event_type ||
    '","value":"' || (event_id % 9) || '.25"}]' AS action_values FROM {events}""".replace("{hour}", landing.HOUR_RANGE)
_STATUSES = """SELECT c_custkey AS campaign_id, c_mktsegment AS effective_status FROM {customer} WHERE c_nationkey > 4"""
_LANDED = {"rep": _plain(_REPORT), "st": _plain(_STATUSES)}
_LAND_COLS = """CAST(date_start AS DATE) AS date, account_id, campaign_id, coalesce(effective_status, 'UNKNOWN')
  AS campaign_status, adset_id, ad_id"""
_LAND_JOIN = "FROM rep LEFT JOIN st ON rep.campaign_id = CAST(st.campaign_id AS VARCHAR)"


@query(statement(_LANDED, f"""SELECT {_LAND_COLS.replace('campaign_id,', 'rep.campaign_id,', 1)},
  CAST(split_part({landing.HOUR_RANGE}, ':', 1) AS INT) AS hour_of_day,
  coalesce(CAST(impressions AS BIGINT), 0) AS impressions, CAST(clicks AS BIGINT) AS clicks,
  CAST(0 AS BIGINT) AS unique_clicks, CAST(spend AS DOUBLE) AS spend, CAST(0 AS DOUBLE) AS ctr,
  CAST(ad_id AS BIGINT) % 7 + 1.0::DOUBLE AS conversions, 3.25::DOUBLE + CAST(ad_id AS BIGINT) % 9 AS conversion_value,
  CASE account_id WHEN '1' THEN 'USD' WHEN '2' THEN 'EUR' END AS currency {_LAND_JOIN}"""))
def landed_hourly_report(spark, sf):
    out = landing.land_b(_sql(spark, sf, _REPORT), "b_hourly", _sql(spark, sf, _STATUSES), {"1": "USD", "2": "EUR"})
    return out.select("date", "account_id", "campaign_id", "campaign_status", "adset_id", "ad_id", "hour_of_day",
                      "impressions", "clicks", "unique_clicks", "spend", "ctr", "conversions", "conversion_value",
                      "currency")


@query(statement(_LANDED, f"""SELECT {_LAND_COLS.replace('campaign_id,', 'rep.campaign_id,', 1)}, conversion_action,
  CASE conversion_action WHEN 'call' THEN 1.0::DOUBLE ELSE CAST(CAST(ad_id AS BIGINT) % 7 AS DOUBLE) END AS conversions,
  CASE conversion_action WHEN 'call' THEN 0.0::DOUBLE ELSE CAST(ad_id AS BIGINT) % 9 + 0.25::DOUBLE END
    AS conversion_value FROM (SELECT *, json_extract_string(actions, '$[0].action_type') AS conversion_action FROM rep
    UNION ALL SELECT *, 'call' FROM rep) rep LEFT JOIN st ON rep.campaign_id = CAST(st.campaign_id AS VARCHAR)"""))
def landed_actions(spark, sf):
    out = landing.land_b_actions(_sql(spark, sf, _REPORT), _sql(spark, sf, _STATUSES), "EUR")
    return out.select("date", "account_id", "campaign_id", "campaign_status", "adset_id", "ad_id", "conversion_action",
                      "conversions", "conversion_value")


# Calendar -------------------------------------------------------------------

_SPEC = CalendarSpec(
    replacements=(("BUILDING", "HALL"), ("HALL", "HALL ONE")), patterns=("HALL", "HOUSEHOLD", "MACHINERY"),
    series_names={"HOUSEHOLD": "HOME"}, prefix_allow={"HALL": ("HALL ONE", "HALL TWO")},
    year_exceptions=(YearException("MACHINERY", 1998, (1995, 1996), (1, 2, 3, 5, 8, 13, 21)),), min_year=1996,
    excluded_series=("FURNITURE",), only_year={"HOME": 1999}, country_code_series=("MACHINERY",))
# One titled event per customer: its newest order gives the year, its orders the rates.
_EVENTS = """SELECT o_custkey AS id_manifestation, max(CAST(o_orderdate AS DATE)) + 30 AS event_start_date,
  max(CAST(o_orderdate AS DATE)) + 33 AS event_end_date,
  c_mktsegment || ' ' || CAST(max(CAST(year(o_orderdate) AS INT)) AS STRING) || ' x' AS original_title,
  lower(n_name) AS host_nation FROM {orders} JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey GROUP BY o_custkey, c_mktsegment, n_name"""
_RATES = """SELECT o_custkey AS id_manifestation, CAST(o_orderdate AS DATE) - 100 AS date1,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) - 40 END AS date2 FROM {orders}"""


def _built(spark, sf):
    return calendars.build_calendar(_sql(spark, sf, _EVENTS), _sql(spark, sf, _RATES), _SPEC,
                                    raw(spark, sf, "countries"))


_BUILD = {
    "ev": _plain(_EVENTS), "ra": _plain(_RATES), "countries": raw_sql("countries"),
    "t": "SELECT * REPLACE (replace(replace(original_title, 'BUILDING', 'HALL'), 'HALL', 'HALL ONE') AS original_title) "
         "FROM ev",
    "y": r"""SELECT *, TRY_CAST(regexp_extract(original_title, '(\d{4})', 1) AS INT) AS year,
  regexp_replace(original_title, ' \d{4}.*', '') AS s0 FROM t WHERE contains(original_title, 'HALL')
  OR contains(original_title, 'HOUSEHOLD') OR contains(original_title, 'MACHINERY')""",
    "s": "SELECT *, CASE WHEN s0 = 'HOUSEHOLD' THEN 'HOME' ELSE s0 END AS conference_series FROM y",
    "k": """SELECT * FROM s WHERE NOT (starts_with(conference_series, 'HALL')
  AND conference_series NOT IN ('HALL ONE', 'HALL TWO')) AND (NOT contains(original_title, 'MACHINERY') OR year >= 1998
  OR (year BETWEEN 1995 AND 1996 AND id_manifestation IN (1, 2, 3, 5, 8, 13, 21))) AND year >= 1996
  AND conference_series <> 'FURNITURE' AND NOT (conference_series = 'HOME' AND year <> 1999)""",
    "e": """SELECT k.*, year || ' ' || conference_series || CASE WHEN conference_series = 'MACHINERY' THEN ' ' ||
  coalesce(c.country_code, '') ELSE '' END AS conference_editions FROM k LEFT JOIN countries c
  ON k.host_nation = c.country_name""",
    "b": """SELECT id_manifestation, min(date1) AS seb_start_date, min(date2) AS seb_end_date, max(date1)
  AS eb_start_date, max(date2) AS eb_end_date FROM ra GROUP BY id_manifestation""",
    "cal": """SELECT DISTINCT id_manifestation, year, conference_series, conference_editions, event_start_date,
  event_end_date, seb_start_date, seb_end_date, eb_start_date, eb_end_date, eb_end_date + 1 AS fp_start_date,
  event_start_date - 1 AS fp_end_date, event_start_date AS onsite_start_date, event_end_date AS onsite_end_date
  FROM e JOIN b USING (id_manifestation)"""}


@query(statement(_BUILD, "SELECT * FROM cal"))
def build_calendar(spark, sf):
    return _built(spark, sf)


@query(statement(_BUILD, "SELECT 'unknown_series' AS check_name, count(*) FILTER (conference_series NOT IN ('HOME')) "
                         "AS n_rows FROM cal " + " ".join(
                             f"UNION ALL SELECT '{c}', count(*) FILTER ({c} IS NULL) FROM cal"
                             for c in ("seb_start_date", "seb_end_date", "eb_start_date", "eb_end_date", "fp_end_date",
                                       "onsite_start_date", "onsite_end_date"))))
def calendar_checks(spark, sf):
    return calendars.calendar_checks(_built(spark, sf), ["HOME"])


# Region 2 arrives as text with a time part, some bad cells and a header row.
_REGION2 = """SELECT CASE WHEN o_orderkey = 7 THEN 'conference_editions' ELSE 'E' || o_orderkey END
    AS conference_editions, CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 00:00:00' AS event_start_date,
  CAST(CAST(o_orderdate AS DATE) + 2 AS STRING) AS event_end_date,
  CASE WHEN o_orderstatus = 'F' THEN 'tbc' ELSE CAST(CAST(o_orderdate AS DATE) - 90 AS STRING) END AS seb_end_date,
  '' AS eb_start_date, CAST(CAST(o_orderdate AS DATE) - 60 AS STRING) AS eb_end_date,
  CASE WHEN o_orderstatus = 'O' THEN CAST(CAST(year(o_orderdate) AS INT) AS STRING) END AS advance_start_date,
  CAST(CAST(o_orderdate AS DATE) - 20 AS STRING) AS advance_end_date,
  CAST(CAST(o_orderdate AS DATE) - 19 AS STRING) AS standard_start_date,
  CAST(CAST(o_orderdate AS DATE) - 1 AS STRING) AS standard_end_date FROM {orders}"""


def _d(c):
    return f"CASE WHEN regexp_matches({c}[1:10], '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN TRY_CAST({c}[1:10] AS DATE) END"


@query(statement(_BUILD | {"r2": _plain(_REGION2)}, f"""SELECT 'R1' AS region, CAST(year(event_start_date) AS INT) AS year,
  conference_editions, event_start_date, event_end_date, seb_start_date, seb_end_date, eb_start_date, eb_end_date,
  CAST(NULL AS DATE) AS advance_start_date, CAST(NULL AS DATE) AS advance_end_date, fp_start_date, fp_end_date,
  onsite_start_date, onsite_end_date FROM cal
UNION ALL SELECT 'R2', CAST(year({_d('event_start_date')}) AS INT), conference_editions, {_d('event_start_date')},
  {_d('event_end_date')}, NULL, {_d('seb_end_date')}, {_d('eb_start_date')}, {_d('eb_end_date')},
  {_d('advance_start_date')}, {_d('advance_end_date')}, {_d('standard_start_date')}, {_d('standard_end_date')},
  {_d('event_start_date')}, {_d('event_end_date')} FROM r2 WHERE conference_editions <> 'conference_editions'"""))
def unify_calendar(spark, sf):
    return calendars.unify_calendar(_built(spark, sf), _sql(spark, sf, _REGION2), ("R1", "R2"))


# Words ----------------------------------------------------------------------

@query(statement(oracle.word_ctes(), "SELECT * FROM stats"))
def token_stats(spark, sf):
    return gold.word_stats(Models(spark, sf).phrase_parts(), STOP_WORDS)


@query(statement(oracle.word_ctes() | oracle.TOPS, "SELECT * FROM totals"))
def phrase_total(spark, sf):
    keys = [*gold.SET_KEYS, "raw_text"]  # whole phrases are totalled before they are split into words
    return gold.word_stats(Models(spark, sf).phrase_parts(), STOP_WORDS,
                           combine=lambda phrases: phrase_totals(phrases, keys, "impressions", "total_impressions"))


@query("""SELECT source, lang, string_agg(phrase || ' (' || total || ')', chr(10) ORDER BY total DESC, phrase) AS tops
FROM (SELECT source, lang, text AS phrase, CAST(sum(n_chars) AS BIGINT) AS total FROM documents
  GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY sum(n_chars) DESC, text) <= 10)
GROUP BY source, lang""")
def top_ten(spark, sf):
    docs = table(spark, sf, "documents").select("source", "lang", F.col("text").alias("phrase"), "n_chars")
    totals = phrase_totals(docs, ["source", "lang", "phrase"], "n_chars", "total")
    return top_phrases(totals, ["source", "lang"], "phrase", "total", 10, "tops")


@query("""SELECT p_partkey AS ad_id, p_name AS name FROM part UNION ALL
SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT p_partkey FROM part)""")
def combined_accounts(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("ad_id"), F.col("p_name").alias("name"))
    supp = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ad_id"), F.col("s_name").alias("name"))
    return combine_dims([part, supp], ["ad_id"], ["name"])
