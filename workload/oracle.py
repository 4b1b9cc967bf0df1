"""DuckDB statements for the silver models and marts, from shared CTE parts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from .standins import AS_OF, CAMPAIGN_RULES, raw_sql

TODAY = f"DATE '{AS_OF}'"
LABELS = ["event_edition", "cut_off_rate", "cut_off_rate_sort_order", "week", "week_number", "week_number_to_sort",
          "weeks_left"]
HEAD = ["date", "account_id", "account_name", "event_name", "campaign_id", "campaign_name", "campaign_status"]
SERIES = [
    ("HOME", "conference_editions LIKE '% NATION_0 EXPO'"),
    ("GROUP_1", "conference_editions LIKE '%NATION_13%' OR conference_editions LIKE '%NATION_14%'"),
    ("GROUP_2", "conference_editions LIKE '%NATION_2%' AND conference_editions NOT LIKE '% NATION_2' "
                "AND conference_editions NOT LIKE '% NATION_2 EXPO'"),
    *[(f"NATION_{n}", f"conference_editions LIKE '% NATION_{n}' OR conference_editions LIKE '% NATION_{n} EXPO'")
      for n in range(1, 20)],
]
EVENT_A = ("CASE WHEN account_name = 'NATION_0' THEN 'HOME' WHEN account_name LIKE 'NATION_2_' THEN 'GROUP_2' "
           "WHEN account_name LIKE '%ION_13' OR account_name LIKE '%ION_14' THEN 'GROUP_1' ELSE account_name END")
EVENT_B = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(upper(campaign_name), '{k.upper()}')" for k in r.contains) + f" THEN '{r.label}'"
    for r in CAMPAIGN_RULES) + " ELSE 'Other/Unmapped' END"


def week_diff(end: str, start: str) -> str:
    return (f"CAST((({end} - dayofweek({end})::INT) - ({start} - dayofweek({start})::INT)) // 7 AS INT)")


def tier_case(day: str = "date") -> str:
    return (f"CASE WHEN conference_editions IS NULL THEN 'No Rate' WHEN {day} <= seb_end_date THEN 'SEB' "
            f"WHEN {day} <= eb_end_date THEN 'EB' WHEN {day} <= advance_end_date THEN 'Advance' "
            f"WHEN {day} <= fp_end_date THEN 'FP' WHEN {day} <= event_start_date THEN 'Onsite' "
            f"ELSE 'Onsite / Late' END")


def order_case(c: str = "cut_off_rate") -> str:
    return (f"CASE {c} WHEN 'SEB' THEN 1 WHEN 'EB' THEN 2 WHEN 'Advance' THEN 3 WHEN 'FP' THEN 4 WHEN 'Onsite' THEN 5 "
            f"WHEN 'Onsite / Late' THEN 6 ELSE 7 END")


def week_case(day: str = "date") -> str:
    return (f"CASE WHEN conference_editions IS NOT NULL THEN {week_diff('event_start_date', day)} "
            f"ELSE 52 - CAST(weekofyear({day}) AS INT) END")


def left_case() -> str:
    return (f"CASE WHEN conference_editions IS NULL THEN CAST(52 - weekofyear({TODAY}) AS VARCHAR) "
            f"WHEN event_start_date < {TODAY} THEN 'Unknown' "
            f"ELSE CAST({week_diff('event_start_date', TODAY)} AS VARCHAR) END")


def initcap(c: str) -> str:
    return (f"array_to_string(list_transform(string_split({c}, '_'), "
            f"lambda x: upper(left(x, 1)) || lower(substr(x, 2))), '_')")


STATUS_A = ("CASE WHEN serving_status = 'ENDED' OR end_date < {t} THEN 'Completed' WHEN status = 'PAUSED' THEN 'Off' "
            "WHEN status = 'REMOVED' THEN 'Deleted' WHEN status = 'ENABLED' AND serving_status = 'SERVING' "
            "THEN 'Active' ELSE coalesce({v}, {s}, 'Not delivering') END").format(
                t=TODAY, v=initcap("serving_status"), s=initcap("status"))
STATUS_B = ("CASE WHEN CAST(stop_time AS DATE) < {t} THEN 'Completed' WHEN effective_status = 'PAUSED' THEN 'Off' "
            "WHEN effective_status = 'ACTIVE' THEN 'Active' ELSE coalesce({s}, 'Not delivering') END").format(
                t=TODAY, s=initcap("effective_status"))
TIE_B = "row_id DESC, tie_price DESC, tie_qty DESC, tie_tax DESC"
TIE_A = "row_id DESC"


def newest(source: str, keys: Iterable[str], tie: str) -> str:
    return (f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY _ingested_at DESC NULLS LAST, {tie}) = 1")


def editions_cte() -> dict[str, str]:
    series = " UNION ALL ".join(f"SELECT '{s}' AS series, * FROM calendar WHERE {cond}" for s, cond in SERIES)
    return {"calendar": raw_sql("calendar"), "editions": series}


def dim_cte(platform: str) -> dict[str, str]:
    raw, status, tie = (("a_campaign_dim", STATUS_A, TIE_A) if platform == "a"
                        else ("b_campaign_dim", STATUS_B, TIE_A))
    return {f"dim_raw_{platform}": raw_sql(raw),
            f"dim_{platform}": f"SELECT campaign_id AS dim_id, {status} AS dim_status "
                               f"FROM ({newest(f'dim_raw_{platform}', ['campaign_id'], tie)})"}


def label_cte(prefix: str, source: str) -> dict[str, str]:
    """Nearest edition by rank over all matches, then the derived labels."""
    return {
        f"{prefix}_n": f"SELECT *, row_number() OVER () AS rid FROM {source}",
        f"{prefix}_j": f"""SELECT f.*, e.conference_editions, e.event_start_date, e.seb_end_date, e.eb_end_date,
  e.advance_end_date, e.fp_end_date, row_number() OVER (PARTITION BY f.rid ORDER BY
    abs(date_diff('day', f.date, e.event_start_date)) NULLS FIRST, e.event_start_date, e.conference_editions) AS rn
  FROM {prefix}_n f LEFT JOIN editions e ON f.event_name = e.series AND f.date <= e.event_end_date
    AND f.date >= e.event_end_date - 400""",
        f"{prefix}_k": f"""SELECT *, coalesce(conference_editions, event_name) AS event_edition,
  {tier_case()} AS cut_off_rate, {week_case()} AS week_number, {left_case()} AS weeks_left
  FROM {prefix}_j WHERE rn = 1""",
        f"{prefix}_l": f"""SELECT *, CAST({order_case()} AS INT) AS cut_off_rate_sort_order,
  'Week ' || week_number AS week, week_number AS week_number_to_sort FROM {prefix}_k""",
    }


def statement(ctes: dict[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes.items()) + "\n" + final


DELIVERY_A = ("CAST(cost_micros AS DOUBLE) / 1000000 AS cost, impressions, clicks, clicks AS unique_clicks")
CTR_A = "ctr, ctr AS unique_ctr"
CONV_A = "conversions, conversions_value AS conversion_value"
DELIVERY_B = "spend AS cost, average_cpc, impressions, clicks, unique_clicks, ctr, unique_ctr"
ZERO = ("CAST(0 AS DOUBLE) AS cost, CAST(0 AS DOUBLE) AS average_cpc, CAST(0 AS BIGINT) AS impressions, "
        "CAST(0 AS BIGINT) AS clicks, CAST(0 AS BIGINT) AS unique_clicks, CAST(0 AS DOUBLE) AS ctr, "
        "CAST(0 AS DOUBLE) AS unique_ctr")
AGE_CASE = ("CASE age_range WHEN 'AGE_RANGE_18_24' THEN '18-24' WHEN 'AGE_RANGE_25_34' THEN '25-34' "
            "WHEN 'AGE_RANGE_35_44' THEN '35-44' WHEN 'AGE_RANGE_45_54' THEN '45-54' "
            "WHEN 'AGE_RANGE_55_64' THEN '55-64' WHEN 'AGE_RANGE_65_UP' THEN '65+' ELSE 'Unknown' END")
SET_B = "adset_id AS ad_group_id, adset_name AS ad_group_name"
GEO_NAMES = ("coalesce(g.\"Name\", 'Unknown') AS region_name, coalesce(g.\"Canonical Name\", 'Unknown') "
             "AS canonical_name, coalesce(g.\"Country Code\", 'Unknown') AS country_code, "
             "coalesce(g.\"Target Type\", 'Unknown') AS geo_target_type")
ACTIONS = """SELECT e.* EXCLUDE (actions, action_values),
  json_extract_string(a.act, '$.action_type') AS conversion_action_name,
  TRY_CAST(json_extract_string(a.act, '$.value') AS DOUBLE) AS n_actions,
  TRY_CAST(json_extract_string(list_filter(CAST(CAST(action_values AS JSON) AS JSON[]),
    lambda v: json_extract_string(v, '$.action_type') = json_extract_string(a.act, '$.action_type'))[1], '$.value')
    AS DOUBLE) AS action_value
  FROM raw_{p} e, (SELECT unnest(CAST(CAST(e.actions AS JSON) AS JSON[])) AS act) a
  WHERE json_extract_string(a.act, '$.action_type') IS NOT NULL"""


def _simple(p: str, raw: str, keys: Sequence[str], cols: str, platform: str, status: bool = True) -> dict[str, str]:
    """raw -> newest -> typed -> status -> labels for models without special steps."""
    tie = TIE_A if platform == "a" else TIE_B
    event = EVENT_A if platform == "a" else EVENT_B
    out = {f"raw_{p}": raw_sql(raw), f"new_{p}": newest(f"raw_{p}", keys, tie)}
    return out | _typed(p, f"new_{p}", event, cols, platform, status)


def _typed(p: str, source: str, event: str, cols: str, platform: str, status: bool = True) -> dict[str, str]:
    base = f"date, account_id, account_name, {event} AS event_name, campaign_id, campaign_name"
    if status:
        typed = (f"SELECT t.*, coalesce(d.dim_status, 'Not delivering') AS campaign_status "
                 f"FROM (SELECT {base}, {cols} FROM {source}) t LEFT JOIN dim_{platform} d ON t.campaign_id = d.dim_id")
    else:
        typed = f"SELECT {base}, campaign_status, {cols} FROM {source}"
    return {f"typed_{p}": typed} | label_cte(p, f"typed_{p}")


_GROUP = ["ad_group_id", "ad_group_name"]
_AD = ["ad_id", "ad_name"]
_COUNTS = ["impressions", "clicks", "unique_clicks"]
_RATES = ["ctr", "unique_ctr"]
_CONV = ["conversions", "conversion_value"]
_GEO = ["region_name", "canonical_name", "country_code", "geo_target_type"]
_DEMO = ["age_group", "gender", "report_granularity"]
_EXTRA = ["all_conversions", "view_through_conversions"]


def _axes(p: str, ages: str, genders: str, extra: Sequence[str], cols: str) -> dict[str, str]:
    keys = ["date", "campaign_id", "ad_group_id"]
    out = {f"raw_age_{p}": raw_sql(ages), f"raw_gen_{p}": raw_sql(genders),
           f"new_age_{p}": newest(f"raw_age_{p}", [*keys, "age_range", *extra], TIE_A),
           f"new_gen_{p}": newest(f"raw_gen_{p}", [*keys, "gender", *extra], TIE_A)}
    common = f"date, account_id, account_name, campaign_id, campaign_name, ad_group_id, ad_group_name, {cols}"
    out[f"axes_{p}"] = (
        f"SELECT {common}, {AGE_CASE} AS age_group, 'Unspecified' AS gender, 'Age Only' AS report_granularity "
        f"FROM new_age_{p} UNION ALL "
        f"SELECT {common}, 'Unspecified', {initcap('gender')}, 'Gender Only' FROM new_gen_{p}")
    names = ", ".join([*_GROUP, *_DEMO, *extra, "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV, "currency"])
    if extra:
        names += ", all_conversions, view_through_conversions"
    return out | _typed(p, f"axes_{p}", EVENT_A, names, "a")


def silver_parts() -> dict[str, tuple[dict[str, str], list[str]]]:
    """Model -> (CTEs ending in ``<model>_l``, output columns)."""
    parts: dict[str, tuple[dict[str, str], list[str]]] = {}

    def add(name, ctes, cols):
        parts[name] = (ctes, [*HEAD, *cols, *LABELS])

    add("a_campaign", _simple("a_campaign", "a_campaign_performance", ["date", "campaign_id"],
                              f"advertising_channel_type AS channel_type, {DELIVERY_A}, {CTR_A}, "
                              "bidding_strategy_type, currency", "a"),
        ["channel_type", "cost", *_COUNTS, *_RATES, "bidding_strategy_type", "currency"])
    add("a_conversion", _simple("a_conversion", "a_conversion_action",
                                ["date", "campaign_id", "conversion_action_id", "conversion_category"],
                                "conversion_action_id, conversion_action_name, conversion_category, "
                                f"{CONV_A}, all_conversions, all_conversions_value, bidding_strategy_type, currency",
                                "a"),
        ["conversion_action_id", "conversion_action_name", "conversion_category", *_CONV, "all_conversions",
         "all_conversions_value", "bidding_strategy_type", "currency"])
    add("a_performance", _simple(
        "a_performance", "a_performance", ["date", "campaign_id", "ad_group_id", "ad_id", "device", "ad_network_type"],
        f"ad_group_id, ad_group_name, ad_id, ad_name, ad_type, {DELIVERY_A}, {CTR_A}, "
        "CAST(cost_micros AS DOUBLE) / 1000000 / nullif(clicks, 0) AS average_cpc, CAST(NULL AS DOUBLE) AS conversions, "
        "CAST(NULL AS DOUBLE) AS conversion_value, view_through_conversions, all_conversions, engagements, "
        "bidding_strategy_type, device, ad_network_type, currency", "a"),
        [*_GROUP, *_AD, "ad_type", "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV, "view_through_conversions",
         "all_conversions", "engagements", "bidding_strategy_type", "device", "ad_network_type", "currency"])
    add("a_demographics", _axes("a_demographics", "a_age_range", "a_gender", [],
                                f"{DELIVERY_A}, average_cpc, {CTR_A}, {CONV_A}, currency"),
        [*_GROUP, *_DEMO, "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV, "currency"])
    add("a_demo_conversions", _axes("a_demo_conversions", "a_age_conversions", "a_gender_conversions",
                                    ["conversion_action_name"],
                                    f"{ZERO}, {CONV_A}, conversion_action_name, all_conversions, "
                                    "view_through_conversions, currency"),
        [*_GROUP, *_DEMO, "conversion_action_name", "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV, *_EXTRA,
         "currency"])
    metrics = (f"{DELIVERY_A}, average_cpc, {CTR_A}, {CONV_A}, view_through_conversions, all_conversions, "
               "bidding_strategy_type, currency")
    names = ("cost, impressions, clicks, unique_clicks, average_cpc, ctr, unique_ctr, conversions, conversion_value, "
             "view_through_conversions, all_conversions, bidding_strategy_type, currency")
    geo = {"raw_std": raw_sql("a_geo"), "raw_res": raw_sql("a_geo_restricted"), "geo_targets": raw_sql("geo_targets"),
           "split_std": "SELECT * FROM raw_std WHERE campaign_id NOT IN (SELECT DISTINCT campaign_id FROM raw_res)",
           "new_std": newest("split_std", ["date", "campaign_id", "ad_group_id", "geo_criterion_id", "location_type"],
                             TIE_A),
           "new_res": newest("raw_res", ["date", "campaign_id", "geo_criterion_id", "location_type"], TIE_A),
           "both_src": f"""SELECT date, account_id, account_name, campaign_id, campaign_name, ad_group_id, ad_group_name,
  geo_criterion_id, {metrics} FROM new_std UNION ALL SELECT date, account_id, account_name, campaign_id, campaign_name,
  'N/A', 'Restricted', geo_criterion_id, {metrics} FROM new_res""",
           "named": f"SELECT b.*, {GEO_NAMES} FROM both_src b LEFT JOIN geo_targets g "
                    "ON b.geo_criterion_id = g.\"Criteria ID\""}
    add("a_geo", geo | _typed("a_geo", "named", EVENT_A, ", ".join([*_GROUP, *_GEO, names]), "a"),
        [*_GROUP, *_GEO, "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV, "view_through_conversions",
         "all_conversions", "bidding_strategy_type", "currency"])
    place = {"raw_ul": raw_sql("a_user_location_conversions"), "geo_targets": raw_sql("geo_targets"),
             "new_ul": newest("raw_ul", ["date", "campaign_id", "user_geo_criterion_id", "location_type",
                                         "conversion_action_name"], TIE_A),
             "named_ul": f"""SELECT u.date, u.account_id, u.account_name, u.campaign_id, u.campaign_name,
  u.location_type, u.conversion_action_name, {CONV_A}, all_conversions, all_conversions_value, {GEO_NAMES}
  FROM new_ul u LEFT JOIN geo_targets g ON u.user_geo_criterion_id = g."Criteria ID" """}
    add("a_user_location", place | _typed(
        "a_user_location", "named_ul", EVENT_A,
        f"'N/A' AS ad_group_id, 'Unknown' AS ad_group_name, location_type, conversion_action_name, "
        f"{', '.join(_GEO)}, {ZERO}, conversions, conversion_value, CAST(0 AS DOUBLE) AS view_through_conversions, "
        "all_conversions, all_conversions_value, 'N/A' AS bidding_strategy_type, 'N/A' AS currency", "a"),
        [*_GROUP, "location_type", "conversion_action_name", *_GEO, "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV,
         "view_through_conversions", "all_conversions", "all_conversions_value", "bidding_strategy_type", "currency"])
    add("a_search_terms", _simple(
        "a_search_terms", "a_search_terms", ["date", "campaign_id", "ad_group_id", "search_term"],
        f"ad_group_id, ad_group_name, search_term, keyword_id, {DELIVERY_A}, "
        "CAST(clicks AS DOUBLE) / nullif(impressions, 0) AS ctr, "
        f"CAST(clicks AS DOUBLE) / nullif(impressions, 0) AS unique_ctr, {CONV_A}, currency", "a", status=False),
        [*_GROUP, "search_term", "keyword_id", "cost", *_COUNTS, *_RATES, *_CONV, "currency"])
    plain_b = f"{DELIVERY_B}, cpm, conversions, conversion_value, reach, frequency, currency"
    add("b_performance", _simple("b_performance", "b_performance", ["date", "campaign_id", "adset_id", "ad_id"],
                                 f"{SET_B}, ad_id, ad_name, {plain_b}", "b"),
        [*_GROUP, *_AD, "cost", "average_cpc", "cpm", *_COUNTS, *_RATES, *_CONV, "reach", "frequency", "currency"])
    creative = {
        "raw_bp": raw_sql("b_performance"), "bridge_raw": raw_sql("b_ad_dim"), "look_raw": raw_sql("b_creative_dim"),
        "new_bp": newest("raw_bp", ["date", "ad_id"], TIE_B),
        "bridge": newest("bridge_raw", ["ad_id"], "creative_id DESC"),
        "look": newest("look_raw", ["creative_id"], TIE_A),
        "linked": """SELECT p.*, c.headline AS ad_headline, c.body AS ad_primary_text, c.call_to_action_type,
  c.destination_url AS landing_page_url, c.image_url FROM new_bp p LEFT JOIN bridge b ON p.ad_id = b.ad_id
  LEFT JOIN look c ON b.creative_id = c.creative_id"""}
    texts = ["ad_headline", "ad_primary_text", "call_to_action_type", "landing_page_url", "image_url"]
    add("b_creative", creative | _typed("b_creative", "linked", EVENT_B,
                                        f"{SET_B}, ad_id, ad_name, {', '.join(texts)}, {plain_b}", "b"),
        [*_GROUP, *_AD, *texts, "cost", "average_cpc", "cpm", *_COUNTS, *_RATES, *_CONV, "reach", "frequency",
         "currency"])
    add("b_conversion", _simple("b_conversion", "b_conversion_action",
                                ["date", "campaign_id", "adset_id", "ad_id", "conversion_action"],
                                f"{SET_B}, ad_id, ad_name, conversion_action, conversions, conversion_value, currency",
                                "b"),
        [*_GROUP, *_AD, "conversion_action", *_CONV, "currency"])
    add("b_demographics", _simple(
        "b_demographics", "b_age_gender", ["date", "campaign_id", "adset_id", "ad_id", "age", "gender"],
        f"{SET_B}, age AS age_group, {initcap('gender')} AS gender, 'Combined' AS report_granularity, {DELIVERY_B}, "
        "conversions, conversion_value, currency", "b"),
        [*_GROUP, *_DEMO, "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV, "currency"])
    add("b_geo", _simple(
        "b_geo", "b_region", ["date", "campaign_id", "adset_id", "ad_id", "country", "region"],
        "adset_id, adset_name, ad_id, ad_name, region AS region_name, region || ', ' || country AS canonical_name, "
        "country AS country_code, CASE WHEN region IS NULL OR region = '' THEN 'Country' ELSE 'Region' END "
        f"AS geo_target_type, {DELIVERY_B}, conversions, conversion_value, currency", "b"),
        ["adset_id", "adset_name", *_AD, *_GEO, "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV, "currency"])

    def actions(p, keys):
        return {f"raw_{p}": raw_sql("b_events"), f"flat_{p}": ACTIONS.replace("{p}", p),
                f"new_{p}": newest(f"flat_{p}", ["date", *keys, "conversion_action_name"], TIE_A)}
    counted = ("conversion_action_name, coalesce(n_actions, 0.0::DOUBLE) AS conversions, "
               "coalesce(action_value, 0.0::DOUBLE) AS conversion_value, CAST(0 AS DOUBLE) AS all_conversions, "
               "CAST(0 AS DOUBLE) AS view_through_conversions")
    add("b_demo_conversions",
        actions("b_demo_conversions", ["campaign_id", "adset_id", "ad_id", "age", "gender"]) | _typed(
            "b_demo_conversions", "new_b_demo_conversions", EVENT_B,
            f"{SET_B}, coalesce(age, 'Unknown') AS age_group, " + initcap("coalesce(gender, 'Unknown')") +
            f" AS gender, 'Age and Gender' AS report_granularity, {ZERO}, {counted}, currency", "b"),
        [*_GROUP, *_DEMO, "conversion_action_name", "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV, *_EXTRA,
         "currency"])
    add("b_geo_conversions", actions("b_geo_conversions", ["campaign_id", "adset_id", "ad_id", "country"]) | _typed(
        "b_geo_conversions", "new_b_geo_conversions", EVENT_B,
        f"{SET_B}, 'TARGETED_LOCATION' AS location_type, 'Unknown' AS region_name, country AS canonical_name, "
        f"country AS country_code, 'Country' AS geo_target_type, {ZERO}, {counted}, "
        "'N/A' AS bidding_strategy_type, currency", "b"),
        [*_GROUP, "location_type", "conversion_action_name", *_GEO, "cost", "average_cpc", *_COUNTS, *_RATES, *_CONV,
         "view_through_conversions", "all_conversions", "bidding_strategy_type", "currency"])
    return parts


SILVER = silver_parts()
SHARED = editions_cte() | dim_cte("a") | dim_cte("b")


def silver_sql(name: str) -> str:
    ctes, cols = SILVER[name]
    return statement(SHARED | ctes, f"SELECT {', '.join(cols)} FROM {name}_l")


CRM = """SELECT id_commande AS conversion_id, date_submit AS date, date_time_submit AS conversion_timestamp,
  coalesce(TRY_CAST(total_ht AS DOUBLE), 0) AS revenue, trim(currency) AS currency,
  lower(trim(utm_source)) AS utm_source, lower(trim(utm_medium)) AS utm_medium,
  lower(trim(utm_campaign)) AS campaign_name, CASE WHEN lower(utm_source) IN ('sourcea', 'a_ads') THEN 'A'
    WHEN lower(utm_source) IN ('sourceb', 'b.example') THEN 'B' ELSE 'Other' END AS platform, year,
  trim(conference_series) AS conference_series, trim(conference_editions) AS conference_editions, trim(city) AS city,
  trim(country) AS country, trim(region) AS region, trim(orders) AS orders, trim(new_customer) AS new_customer,
  trim(cut_off_rate) AS cut_off_rate, trim(order_type) AS order_type, trim(primary_language) AS primary_language,
  trim(specialty) AS specialty FROM crm_raw"""
CRM_CTES = {"crm_raw": raw_sql("crm_orders"), "crm_all": CRM,
            "crm": "SELECT * FROM crm_all WHERE platform IN ('A', 'B')"}
_PARTS = "CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day"
_MHEAD = (f"date, {_PARTS}, week AS week_display, week_number, week_number_to_sort, weeks_left, event_name, "
          "event_edition, account_id, account_name, campaign_id, campaign_name, campaign_status, cut_off_rate, "
          "cut_off_rate_sort_order")


def _both(a: str, b: str) -> dict[str, str]:
    return SHARED | SILVER[a][0] | SILVER[b][0]


CAMPAIGN_B = """SELECT date, campaign_id, max(week) AS week, max(week_number) AS week_number,
  max(week_number_to_sort) AS week_number_to_sort, max(weeks_left) AS weeks_left, max(event_name) AS event_name,
  max(event_edition) AS event_edition, max(account_id) AS account_id, max(account_name) AS account_name,
  max(campaign_name) AS campaign_name, max(campaign_status) AS campaign_status, max(cut_off_rate) AS cut_off_rate,
  max(cut_off_rate_sort_order) AS cut_off_rate_sort_order, max(currency) AS currency, sum(cost) AS cost,
  CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
  CAST(sum(unique_clicks) AS BIGINT) AS unique_clicks FROM b_performance_l GROUP BY date, campaign_id"""


def mart_campaign() -> str:
    ctes = _both("a_campaign", "b_performance") | {"rolled": CAMPAIGN_B}
    return statement(ctes, f"""SELECT 'A' AS platform, {_MHEAD}, channel_type, bidding_strategy_type,
  cost AS cost, impressions, clicks, unique_clicks, ctr AS ctr, unique_ctr AS unique_ctr,
  cost / nullif(clicks, 0) AS average_cpc, currency FROM a_campaign_l
UNION ALL SELECT 'B', {_MHEAD}, 'Social', NULL, cost, impressions, clicks, unique_clicks,
  CAST(clicks AS DOUBLE) / nullif(impressions, 0),
  CAST(unique_clicks AS DOUBLE) / nullif(impressions, 0), cost / nullif(clicks, 0), currency
  FROM rolled""")


CLASS_A = """CASE WHEN contains(conversion_action_name, 'Broken') THEN 'OTHER'
  WHEN contains(conversion_action_name, 'Ticket') THEN 'PURCHASE' WHEN conversion_action_name = 'Brochure' THEN 'LEAD'
  WHEN conversion_category = 'BUY' THEN 'PURCHASE' WHEN conversion_category = 'FORM' THEN 'LEAD'
  WHEN conversion_category LIKE '%CART%' THEN 'ADD_TO_CART' ELSE 'OTHER' END"""
ROUTE_A = """CASE WHEN conversion_action_name = 'Brochure' OR conversion_category = 'FORM' THEN all_conversions
  ELSE conversions END"""
GUARD_A = """CASE WHEN contains(conversion_action_name, 'Broken') THEN 0.0 WHEN contains(conversion_action_name, 'Ticket')
  OR conversion_category = 'BUY' THEN conversion_value ELSE 0.0 END"""
CLASS_B = """CASE WHEN conversion_action = 'site.purchase' THEN 'PURCHASE'
  WHEN lower(conversion_action) LIKE '%lead%' THEN 'LEAD' WHEN lower(conversion_action) LIKE '%page_view%'
  THEN 'PAGE_VIEW' ELSE 'OTHER' END"""


def mart_conversion() -> str:
    return statement(_both("a_conversion", "b_conversion"), f"""SELECT 'A' AS platform, {_MHEAD},
  CAST(NULL AS VARCHAR) AS ad_group_name, CAST(NULL AS VARCHAR) AS ad_name, conversion_action_name AS conversion_name,
  conversion_category AS conversion_raw_category, {CLASS_A} AS standardized_conversion_type,
  {ROUTE_A} AS conversions, CAST({GUARD_A} AS DOUBLE) AS conversion_value, currency FROM a_conversion_l
UNION ALL SELECT 'B', {_MHEAD}, ad_group_name, ad_name, conversion_action, conversion_action, {CLASS_B}, conversions,
  CASE WHEN conversion_action = 'site.purchase' THEN conversion_value ELSE 0.0 END, currency FROM b_conversion_l""")


_AD_HEAD = (f"date, {_PARTS}, week AS week_display, week_number, weeks_left, event_name, event_edition, account_id, "
            "account_name, campaign_name, campaign_status, ad_group_id, ad_group_name, ad_id, ad_name, cut_off_rate, "
            "cut_off_rate_sort_order, cost, impressions, clicks, unique_clicks, conversions, conversion_value, ctr, "
            "unique_ctr, average_cpc")
AD_STACK = f"""SELECT 'A' AS platform, {_AD_HEAD}, view_through_conversions, all_conversions, engagements,
  bidding_strategy_type, ad_network_type, CAST(NULL AS DOUBLE) AS cpm, CAST(NULL AS BIGINT) AS reach,
  CAST(NULL AS DOUBLE) AS frequency, currency, device AS device_type FROM a_performance_l
UNION ALL SELECT 'B', {_AD_HEAD}, NULL, NULL, NULL, NULL, NULL, cpm, reach, frequency, currency, NULL
  FROM b_performance_l"""


def mart_ad() -> str:
    return statement(_both("a_performance", "b_performance"), AD_STACK)


def mart_demographics() -> str:
    cols = (f"{_MHEAD}, age_group, gender, report_granularity, cost, average_cpc, impressions, clicks, unique_clicks, "
            "ctr, unique_ctr, conversions, conversion_value, currency")
    return statement(_both("a_demographics", "b_demographics"),
                     f"SELECT 'A' AS platform, {cols} FROM a_demographics_l UNION ALL "
                     f"SELECT 'B', {cols} FROM b_demographics_l")


_GEO_COLS = (f"{_MHEAD}, country_code, region_name, canonical_name, geo_target_type, cost, impressions, clicks, "
             "unique_clicks, ctr, unique_ctr, average_cpc, currency")


def mart_geo() -> str:
    cols = f"{_GEO_COLS}, conversions, conversion_value"
    ctes = _both("a_geo", "b_geo") | {
        "countries": raw_sql("countries"),
        "u": f"SELECT 'A' AS platform, {cols} FROM a_geo_l UNION ALL SELECT 'B', {cols} FROM b_geo_l"}
    return statement(ctes, "SELECT u.*, coalesce(c.country_name, u.country_code) AS country_name FROM u "
                           "LEFT JOIN countries c ON u.country_code = c.country_code")


def mart_targeted_geo() -> str:
    cols = f"{_GEO_COLS}, location_type, conversion_action_name"
    ctes = _both("a_user_location", "b_geo_conversions") | {
        "countries": raw_sql("countries"),
        "u": f"""SELECT 'A' AS platform, {cols}, CASE WHEN contains(conversion_action_name, 'Broken') THEN 'OTHER'
  WHEN contains(lower(conversion_action_name), 'ticket') THEN 'PURCHASE'
  WHEN conversion_action_name = 'Brochure' THEN 'LEAD' ELSE 'OTHER' END AS standardized_conversion_type,
  CASE WHEN conversion_action_name = 'Brochure' THEN all_conversions ELSE conversions END AS conversions,
  CAST(CASE WHEN contains(conversion_action_name, 'Broken') THEN 0.0
    WHEN contains(lower(conversion_action_name), 'ticket') THEN conversion_value ELSE 0.0 END AS DOUBLE)
    AS conversion_value FROM a_user_location_l
UNION ALL SELECT 'B', {cols}, CASE WHEN lower(trim(conversion_action_name)) = 'purchase' THEN 'PURCHASE'
  WHEN conversion_action_name = 'signup' THEN 'SIGNUP' WHEN contains(lower(conversion_action_name), 'contact')
  THEN 'CONTACT' WHEN conversion_action_name = 'view' THEN 'PAGE_VIEW' ELSE 'OTHER' END, conversions,
  CASE WHEN lower(trim(conversion_action_name)) = 'purchase' THEN conversion_value ELSE 0.0 END
  FROM b_geo_conversions_l"""}
    return statement(ctes, """SELECT u.*, coalesce(c.country_name, u.country_code) AS country_name FROM u
LEFT JOIN countries c ON u.country_code = c.country_code
WHERE (u.platform = 'A' AND u.standardized_conversion_type <> 'OTHER') OR (u.platform = 'B'
  AND u.standardized_conversion_type IN ('PURCHASE', 'SIGNUP', 'CONTACT'))""")


_PHRASE = ("date, '{p}' AS platform, event_edition, event_name, account_id, account_name, campaign_id, campaign_name, "
           "campaign_status, week AS week_display, week_number, week_number_to_sort, weeks_left, cut_off_rate, "
           "cut_off_rate_sort_order, cost, impressions, clicks, unique_clicks, conversions, conversion_value, currency")
PHRASE_SOURCE = f"""SELECT {_PHRASE.replace('{p}', 'A')}, search_term AS raw_text FROM a_search_terms_l
  WHERE search_term IS NOT NULL
UNION ALL SELECT {_PHRASE.replace('{p}', 'B')}, CASE WHEN ad_headline IS NULL AND ad_primary_text IS NULL
  THEN '_unknown_creative_' ELSE coalesce(ad_headline, '') || ' ' || coalesce(ad_primary_text, '') END
  FROM b_creative_l"""
_SUMS = """sum(cost) AS cost, CAST(sum(impressions) AS BIGINT) AS impressions,
  CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(unique_clicks) AS BIGINT) AS unique_clicks,
  sum(conversions) AS conversions, sum(conversion_value) AS conversion_value"""
_RATIOS = """CAST(sum(clicks) AS DOUBLE) / nullif(sum(impressions), 0) AS ctr,
  CAST(sum(unique_clicks) AS DOUBLE) / nullif(sum(impressions), 0) AS unique_ctr,
  sum(cost) / nullif(sum(clicks), 0) AS average_cpc"""


def phrase_ctes() -> dict[str, str]:
    return _both("a_search_terms", "b_creative") | {"src": PHRASE_SOURCE}


def mart_phrases() -> str:
    keys = ("date, platform, event_edition, event_name, campaign_id, campaign_name, campaign_status, week_display, "
            "week_number, week_number_to_sort, weeks_left, cut_off_rate, cut_off_rate_sort_order")
    return statement(phrase_ctes(), f"""SELECT {keys}, {_PARTS}, lower(raw_text) AS word,
  raw_text AS top_search_combinations, {_SUMS}, {_RATIOS}, max(currency) AS currency FROM src
  GROUP BY {keys}, raw_text""")


def word_ctes() -> dict[str, str]:
    keys = ("date, platform, account_name, account_id, campaign_name, campaign_status, campaign_id, event_name, "
            "event_edition, week_display, week_number, week_number_to_sort, weeks_left, cut_off_rate, "
            "cut_off_rate_sort_order, currency, word, phrase_key")
    return phrase_ctes() | {
        "tok": r"""SELECT *, unnest(string_split(regexp_replace(lower(raw_text), '[^0-9A-Za-z_\t\n\f\r ]', '', 'g'),
  ' ')) AS word, md5(raw_text) AS phrase_key FROM src""",
        "stats": f"""SELECT {keys}, sum(cost) AS cost, CAST(sum(impressions) AS BIGINT) AS impressions,
  CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(unique_clicks) AS BIGINT) AS unique_clicks,
  sum(conversions) AS conversions, sum(conversion_value) AS conversion_value FROM tok
  WHERE length(word) > 2 AND word NOT IN ('the', 'and', 'for') GROUP BY {keys}"""}


GLOBAL = "event_edition, platform, campaign_id, campaign_status, cut_off_rate, word"
TOPS = {
    "shown": "SELECT DISTINCT md5(raw_text) AS phrase_key, CASE WHEN length(raw_text) > 100 THEN left(raw_text, 100) "
             "|| '...' ELSE raw_text END AS clean_phrase FROM src",
    "totals": f"SELECT {GLOBAL}, phrase_key, CAST(sum(impressions) AS BIGINT) AS total_impressions FROM stats "
              f"GROUP BY {GLOBAL}, phrase_key",
    "tops": f"""SELECT {GLOBAL}, string_agg(clean_phrase || ' (' || total_impressions || ')', chr(10)
  ORDER BY total_impressions DESC, phrase_key) AS top_search_combinations FROM (
    SELECT *, row_number() OVER (PARTITION BY {GLOBAL} ORDER BY total_impressions DESC, phrase_key) AS rk FROM totals)
  JOIN shown USING (phrase_key) WHERE rk <= 10 GROUP BY {GLOBAL}"""}


def mart_words() -> str:
    keys = ("date, platform, campaign_name, campaign_status, campaign_id, event_name, event_edition, week_display, "
            "week_number, week_number_to_sort, weeks_left, cut_off_rate, cut_off_rate_sort_order, word")
    ctes = word_ctes() | TOPS | {
        "daily": f"SELECT {keys}, {_SUMS}, {_RATIOS}, max(currency) AS currency FROM stats GROUP BY {keys}"}
    return statement(ctes, f"SELECT d.*, {_PARTS}, t.top_search_combinations FROM daily d "
                           f"LEFT JOIN tops t USING ({GLOBAL})")


SERIES_CASE = """CASE WHEN conference_series LIKE 'NATION_0 %' THEN 'HOME'
  WHEN conference_series = 'NATION_14 EXPO' OR conference_series LIKE '%_13 %' THEN 'GROUP_1'
  WHEN conference_series LIKE 'NATION_2_ EXPO' THEN 'GROUP_2'
  WHEN contains(conference_series, 'NATION_1') OR contains(conference_series, 'NATION_3') THEN 'NATION_X'
  ELSE coalesce(conference_series, 'Unmapped Event') END"""
ROI_STACK = f"""SELECT date, year, platform, lower(trim(campaign_name)) AS campaign_name, currency, event_name,
  CAST(NULL AS TIMESTAMP) AS conversion_timestamp, CAST(NULL AS VARCHAR) AS conference_series,
  CAST(NULL AS VARCHAR) AS conference_editions, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS country,
  CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS orders, CAST(NULL AS VARCHAR) AS new_customer,
  CAST(NULL AS VARCHAR) AS cut_off_rate, CAST(NULL AS VARCHAR) AS order_type, CAST(NULL AS VARCHAR) AS primary_language,
  CAST(NULL AS VARCHAR) AS specialty, CAST(NULL AS VARCHAR) AS utm_source, CAST(NULL AS VARCHAR) AS utm_medium,
  cost, impressions, clicks, CAST(0 AS DOUBLE) AS revenue, CAST(0 AS BIGINT) AS total_sales,
  CAST(0 AS BIGINT) AS new_customers_count FROM ads
UNION ALL SELECT date, year, platform, campaign_name, currency, {SERIES_CASE}, conversion_timestamp, conference_series,
  conference_editions, city, country, region, orders, new_customer, cut_off_rate, order_type, primary_language,
  specialty, utm_source, utm_medium, CAST(0 AS DOUBLE), 0, 0, revenue, 1,
  CASE WHEN lower(trim(new_customer)) IN ('new', 'first') THEN 1 ELSE 0 END FROM crm"""


def roi_ctes() -> dict[str, str]:
    return _both("a_performance", "b_performance") | {"ads": AD_STACK} | CRM_CTES | {"roi": ROI_STACK}


def mart_roi() -> str:
    return statement(roi_ctes(), "SELECT * REPLACE (epoch_us(conversion_timestamp) AS conversion_timestamp) FROM roi")


FIN = """SELECT year, platform, event_name, sum(cost) AS cost, CAST(sum(impressions) AS BIGINT) AS impressions,
  CAST(sum(clicks) AS BIGINT) AS clicks, sum(revenue) AS revenue, CAST(sum(total_sales) AS BIGINT)
  AS total_sales, CAST(sum(new_customers_count) AS BIGINT) AS new_customers_count FROM roi
  GROUP BY year, platform, event_name"""


def measures_financials() -> str:
    return statement(roi_ctes() | {"fin": FIN}, """SELECT *, revenue / nullif(cost, 0) AS roas,
  (revenue - cost) / nullif(cost, 0) AS roi, CAST(clicks * 100 AS DOUBLE) / nullif(impressions, 0)
  AS ctr_pct, cost / nullif(clicks, 0) AS cpc FROM fin""")


def measures_yoy() -> str:
    return statement(roi_ctes() | {"fin": FIN}, """SELECT f.year, f.platform, f.event_name, f.cost, f.revenue,
  p.cost AS cost_prev, p.revenue AS revenue_prev, (f.cost - p.cost) / nullif(p.cost, 0) AS cost_yoy,
  (f.revenue - p.revenue) / nullif(p.revenue, 0) AS revenue_yoy
  FROM fin f LEFT JOIN fin p ON f.year = p.year + 1 AND f.platform IS NOT DISTINCT FROM p.platform
  AND f.event_name IS NOT DISTINCT FROM p.event_name""")


def measures_ytd() -> str:
    return statement(roi_ctes() | {
        "daily": "SELECT platform, date, sum(cost) AS cost, sum(revenue) AS revenue FROM roi GROUP BY platform, date"},
        """SELECT platform, date, cost AS cost, revenue AS revenue,
  sum(cost) OVER w AS cost_ytd, sum(revenue) OVER w AS revenue_ytd FROM daily
  WINDOW w AS (PARTITION BY platform, year(date) ORDER BY date ROWS UNBOUNDED PRECEDING)""")
