from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import d, ts
from martkit.functions.rules import Keep, Rule
from martkit.operators.editions import EditionRule, prepare_editions
from martkit.plans import calendar as cal
from martkit.plans import gold, measures, silver
from martkit.plans.context import Context, ConversionRules
from martkit.sources.schemas import RAW, raw_schema

BUY, LEAD = Rule("BUY", equals=("buy",)), Rule("LEAD", contains=("lead",))
KIND = ConversionRules(classes=(BUY, LEAD), secondary=(LEAD,), allow_value=(BUY,), deny_value=(LEAD,))
CTX = Context(
    as_of=date(2024, 6, 1), platform_a="A", platform_b="B",
    account_rules=(Rule("EXPO", equals=("Expo account",)),),
    campaign_rules=(Rule("EXPO", contains=("EXPO",), fold="upper"),),
    edition_rules=(EditionRule("EXPO", ("% EXPO",)),),
    series_rules=(Rule("EXPO", contains=("Expo",)),), source_aliases={"A": ("a_ads", "search"), "B": ("b_ads",)},
    new_customer_values=("new",), conversions_a=KIND, conversions_b=KIND, geo_conversions_a=KIND,
    geo_conversions_b=KIND, geo_keep={"A": Keep(drop=("OTHER",)), "B": Keep(only=("BUY",))}, tie=("tie",))


@pytest.fixture(scope="module")
def editions(spark):
    rows = [("2024 EXPO", d("2024-07-01"), d("2024-07-03"), d("2024-03-01"), d("2024-04-01"), None, d("2024-06-30"))]
    return prepare_editions(spark.createDataFrame(rows, "conference_editions string, event_start_date date, "
                            "event_end_date date, seb_end_date date, eb_end_date date, advance_end_date date, "
                            "fp_end_date date"), CTX.edition_rules)


def make(spark, name, *rows):
    """Rows of a raw table from dicts; absent columns are NULL."""
    schema = raw_schema(name)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


BASE_A = dict(date=d("2024-05-01"), account_id="1", account_name="Expo account", campaign_id="c1", campaign_name="C1",
              currency="EUR", _ingested_at=ts("2024-05-02T00:00:00"))
BASE_B = dict(BASE_A, campaign_name="my expo campaign", adset_id="s1", adset_name="S1", ad_id="a1", ad_name="A1")


@pytest.fixture
def inputs_a(spark, editions):
    dim = make(spark, "a_campaign_dim", dict(campaign_id="c1", status="ENABLED", serving_status="SERVING",
                                             _ingested_at=ts("2024-05-02T00:00:00")))
    return silver.Inputs(editions, silver.states_a(dim, CTX))


@pytest.fixture
def inputs_b(spark, editions):
    dim = make(spark, "b_campaign_dim", dict(campaign_id="c1", effective_status="ACTIVE",
                                             stop_time=ts("2024-05-31T10:00:00"),
                                             _ingested_at=ts("2024-05-02T00:00:00")))
    return silver.Inputs(editions, silver.states_b(dim, CTX))


def test_silver_campaign(spark, inputs_a):
    raw = make(spark, "a_campaign_performance",
               dict(BASE_A, cost_micros=1_000_000, clicks=5, impressions=10, ctr=0.5),
               dict(BASE_A, cost_micros=2_000_000, clicks=7, impressions=10, ctr=0.7,
                    _ingested_at=ts("2024-05-03T00:00:00")),
               dict(BASE_A, campaign_id="c2", account_name="Else", cost_micros=None, clicks=0))
    got = {r.campaign_id: r for r in silver.a_campaign_performance(raw, inputs_a, CTX).collect()}
    assert (got["c1"].clicks, got["c1"].cost, got["c1"].campaign_status, got["c1"].event_name) == (7, 2.0, "Active", "EXPO")
    assert (got["c1"].event_edition, got["c1"].cut_off_rate, got["c1"].week_number) == ("2024 EXPO", "FP", 9)
    assert (got["c2"].event_edition, got["c2"].campaign_status, got["c2"].cost) == ("Else", "Not delivering", None)


def test_recent_days_limit_comes_before_dedup(spark, inputs_a):
    raw = make(spark, "a_campaign_performance", BASE_A, dict(BASE_A, date=d("2024-05-20")))
    assert silver.a_campaign_performance(raw, inputs_a, replace(CTX, recent_days=14)).count() == 1


def test_conversion_ids_may_collide_without_losing_rows(spark, inputs_a):
    raw = make(spark, "a_conversion_action",
               dict(BASE_A, conversion_action_id="7", conversion_category="X", conversions=1.0),
               dict(BASE_A, conversion_action_id="7", conversion_category="Y", conversions=2.0),
               dict(BASE_A, conversion_action_id=None, conversion_category="X", conversions=3.0),
               dict(BASE_A, campaign_id="c2", conversion_action_id=None, conversion_category="X", conversions=4.0))
    full = silver.a_conversion_action(raw, inputs_a, CTX)
    assert full.count() == 4 and full.where("id IS NULL").count() == 2
    collapsed = silver.a_conversion_action(raw, inputs_a, replace(CTX, collapse_ids=True))
    assert collapsed.count() == 2


def test_demographics_axes(spark, inputs_a):
    ages = make(spark, "a_age_range", dict(BASE_A, ad_group_id="g", age_range="AGE_RANGE_65_UP", clicks=1),
                dict(BASE_A, ad_group_id="g", age_range="ODD", clicks=2))
    genders = make(spark, "a_gender", dict(BASE_A, ad_group_id="g", gender="FEMALE", clicks=3))
    got = sorted((r.age_group, r.gender, r.report_granularity, r.clicks)
                 for r in silver.a_demographics(ages, genders, inputs_a, CTX).collect())
    assert got == [("65+", "Unspecified", "Age Only", 1), ("Unknown", "Unspecified", "Age Only", 2),
                   ("Unspecified", "Female", "Gender Only", 3)]


def test_geo_split_and_restricted_defaults(spark, inputs_a):
    targets = make(spark, "geo_targets", {"Criteria ID": "5", "Name": "Lyon", "Canonical Name": "Lyon,FR",
                                          "Country Code": "FR", "Target Type": "City"})
    standard = make(spark, "a_geo", dict(BASE_A, ad_group_id="g", ad_group_name="G", geo_criterion_id="5"),
                    dict(BASE_A, campaign_id="c2", ad_group_id="g", ad_group_name="G", geo_criterion_id="6"))
    restricted = make(spark, "a_geo_restricted", dict(BASE_A, geo_criterion_id="5"))
    got = sorted((r.campaign_id, r.ad_group_id, r.ad_group_name, r.region_name)
                 for r in silver.a_geo(standard, restricted, targets, inputs_a, CTX).collect())
    assert got == [("c1", "N/A", "Restricted", "Lyon"), ("c2", "g", "G", "Unknown")]


def test_action_json_is_deduplicated_after_unnesting(spark, inputs_b):
    def row(at, acts):
        return dict(BASE_B, country="FR", actions=acts, action_values='[{"action_type":"buy","value":"9.5"}]',
                    _ingested_at=ts(at))
    old = row("2024-05-02T00:00:00", '[{"action_type":"lead","value":"1"},{"action_type":"buy","value":"1"}]')
    new = row("2024-05-03T00:00:00", '[{"action_type":"buy","value":"2"}]')
    out = silver.b_geo_conversions(make(spark, "b_country", old, new), inputs_b, CTX)
    assert sorted((r.conversion_action_name, r.conversions, r.conversion_value, r.cost) for r in out.collect()) == [
        ("buy", 2.0, 9.5, 0.0), ("lead", 1.0, 0.0, 0.0)]
    assert out.first().campaign_status == "Completed"


def test_region_level(spark, inputs_b):
    raw = make(spark, "b_region", *[dict(BASE_B, country="FR", region=r) for r in (None, "", "Unknown", "Rhone")])
    def level(ctx):
        return sorted((str(r.region_name), r.geo_target_type) for r in silver.b_geo(raw, inputs_b, ctx).collect())
    assert level(CTX) == [("", "Country"), ("None", "Country"), ("Rhone", "Region"), ("Unknown", "Region")]
    assert ("Unknown", "Country") in level(replace(CTX, missing_regions=("", "Unknown")))


def test_absent_cpc_is_derived(spark, inputs_b):
    raw = make(spark, "b_age_gender", dict(BASE_B, age="18-24", gender="male", spend=10.0, clicks=4)).drop("average_cpc")
    out = silver.b_demographics(raw, inputs_b, CTX).first()
    assert (out.average_cpc, out.gender, out.report_granularity) == (2.5, "Male", "Combined")


def test_crm_drops_unknown_sources(spark):
    raw = make(spark, "crm_orders", dict(id_commande="1", utm_source="A_ADS", total_ht=5.0, conference_series=" Expo 24 "),
               dict(id_commande="2", utm_source="b_ads", total_ht=None), dict(id_commande="3", utm_source="mail"),
               dict(id_commande="4", utm_source=" a_ads"))
    out = silver.crm_conversions(raw, CTX)
    assert sorted((r.conversion_id, r.platform, r.revenue) for r in out.collect()) == [("1", "A", 5.0), ("2", "B", 0.0)]


def columns(*groups):
    return [c for g in groups for c in g.split()]


HEAD = "unique_id platform date year month day week_display week_number week_number_to_sort weeks_left event_name " \
       "event_edition account_id account_name campaign_id campaign_name campaign_status"
GEO = "cut_off_rate cut_off_rate_sort_order country_code region_name canonical_name geo_target_type"
MONEY = "cost impressions clicks unique_clicks"
CONV, RATE = "conversions conversion_value", "ctr unique_ctr average_cpc"


def test_mart_columns_in_order(spark, inputs_a, inputs_b):
    countries = make(spark, "countries", dict(country_code="FR", country_name="France"))
    targets, empty = make(spark, "geo_targets"), lambda n: make(spark, n)
    perf_a, perf_b = silver.a_performance(empty("a_performance"), inputs_a, CTX), silver.b_performance(
        empty("b_performance"), inputs_b, CTX)
    assert gold.campaign_mart(silver.a_campaign_performance(empty("a_campaign_performance"), inputs_a, CTX), perf_b,
                              CTX).columns == columns(
        HEAD, "cut_off_rate cut_off_rate_sort_order channel_type bidding_strategy_type", MONEY, RATE, "currency")
    assert gold.conversion_mart(
        silver.a_conversion_action(empty("a_conversion_action"), inputs_a, CTX),
        silver.b_conversion_action(empty("b_conversion_action"), inputs_b, CTX), CTX).columns == columns(
        HEAD, "ad_group_name ad_name cut_off_rate cut_off_rate_sort_order conversion_name conversion_raw_category "
              "standardized_conversion_type", CONV, "currency")
    assert gold.demographics_mart(
        silver.a_demographics(empty("a_age_range"), empty("a_gender"), inputs_a, CTX),
        silver.b_demographics(empty("b_age_gender"), inputs_b, CTX), CTX).columns == columns(
        HEAD, "age_group gender report_granularity cut_off_rate cut_off_rate_sort_order cost average_cpc impressions "
              "clicks unique_clicks ctr unique_ctr", CONV, "currency")
    assert gold.geo_mart(silver.a_geo(empty("a_geo"), empty("a_geo_restricted"), targets, inputs_a, CTX),
                         silver.b_geo(empty("b_region"), inputs_b, CTX), countries, CTX).columns == columns(
        HEAD, GEO, MONEY, CONV, RATE, "currency country_name")
    assert gold.targeted_geo_mart(
        silver.a_user_location(empty("a_user_location_conversions"), targets, inputs_a, CTX),
        silver.b_geo_conversions(empty("b_country"), inputs_b, CTX), countries, CTX).columns == columns(
        HEAD, GEO, "location_type conversion_action_name standardized_conversion_type", MONEY, CONV, RATE,
        "currency country_name")
    ads = gold.ad_mart(perf_a, perf_b, CTX)
    assert ads.columns == columns(
        "unique_id platform date year month day week_display week_number weeks_left event_name event_edition account_id "
        "account_name campaign_name campaign_status ad_group_id ad_group_name ad_id ad_name cut_off_rate "
        "cut_off_rate_sort_order", MONEY, CONV, RATE, "view_through_conversions all_conversions engagements "
        "bidding_strategy_type ad_network_type cpm reach frequency currency device_type")
    creative = silver.b_creative_performance(empty("b_performance"), empty("b_ad_dim"), empty("b_creative_dim"),
                                             inputs_b, CTX)
    phrases = gold.phrase_mart(silver.a_search_terms(empty("a_search_terms"), inputs_a, CTX), creative, CTX)
    assert phrases.columns == columns(
        "id date platform year month day event_edition event_name campaign_id campaign_name campaign_status week_display "
        "week_number week_number_to_sort weeks_left cut_off_rate cut_off_rate_sort_order word top_search_combinations",
        MONEY, RATE, CONV, "currency")
    roi = gold.roi_mart(ads, silver.crm_conversions(empty("crm_orders"), CTX), CTX)
    assert roi.columns == columns(
        "date year platform campaign_name currency event_name conversion_timestamp conference_series conference_editions "
        "city country region orders new_customer cut_off_rate order_type primary_language specialty utm_source utm_medium "
        "cost impressions clicks revenue total_sales new_customers_count")
    assert silver.a_demographic_conversions(empty("a_age_conversions"), empty("a_gender_conversions"), inputs_a,
                                            CTX).count() == 0
    assert silver.b_demographic_conversions(empty("b_age_gender_conversions"), inputs_b, CTX).count() == 0


def test_campaign_mart_rolls_up_ads(spark, inputs_a, inputs_b):
    a = silver.a_campaign_performance(make(spark, "a_campaign_performance", dict(BASE_A, cost_micros=3_000_000, clicks=0)),
                                      inputs_a, CTX)
    b = silver.b_performance(make(spark, "b_performance", dict(BASE_B, spend=4.0, clicks=2, impressions=10, unique_clicks=1),
                                  dict(BASE_B, ad_id="a2", spend=6.0, clicks=3, impressions=10, unique_clicks=1)),
                             inputs_b, CTX)
    got = {r.platform: r for r in gold.campaign_mart(a, b, CTX).collect()}
    assert (got["A"].cost, got["A"].average_cpc, got["A"].year) == (3.0, None, 2024)
    assert (got["B"].cost, got["B"].clicks, got["B"].ctr, got["B"].average_cpc, got["B"].channel_type) == (
        10.0, 5, 0.25, 2.0, "Social")
    assert got["B"].event_edition == "2024 EXPO" and got["B"].bidding_strategy_type is None


def test_conversion_mart_classes(spark, inputs_a, inputs_b):
    def action(name, **kw):
        return dict(BASE_A, conversion_action_id=name, conversion_action_name=name, conversions=1.0, all_conversions=2.0,
                    conversions_value=50.0, **kw)
    a = silver.a_conversion_action(make(spark, "a_conversion_action", action("lead form"), action("buy"), action("x")),
                                   inputs_a, CTX)
    b = silver.b_conversion_action(make(spark, "b_conversion_action", dict(BASE_B, conversion_action="buy", conversions=1.0,
                                                                           conversion_value=7.0)), inputs_b, CTX)
    got = sorted((r.platform, r.conversion_name, r.standardized_conversion_type, r.conversions, r.conversion_value)
                 for r in gold.conversion_mart(a, b, CTX).collect())
    assert got == [("A", "buy", "BUY", 1.0, 50.0), ("A", "lead form", "LEAD", 2.0, 0.0), ("A", "x", "OTHER", 1.0, 0.0),
                   ("B", "buy", "BUY", 1.0, 7.0)]


def test_series_labels_align_between_cost_and_revenue(spark, inputs_a, inputs_b):
    ads = gold.ad_mart(silver.a_performance(make(spark, "a_performance", dict(BASE_A, ad_id="1", cost_micros=5_000_000,
                                                                              clicks=1)), inputs_a, CTX),
                       silver.b_performance(make(spark, "b_performance"), inputs_b, CTX), CTX)
    crm = silver.crm_conversions(make(spark, "crm_orders", dict(
        id_commande="1", year=2024, date_submit=d("2024-05-01"), utm_source="a_ads", total_ht=20.0,
        conference_series="Expo 2024", new_customer="New")), CTX)
    roi = gold.roi_mart(ads, crm, CTX)
    row = measures.financials(roi, ["year", "platform", "event_name"]).collect()
    assert len(row) == 1
    assert (row[0].event_name, row[0].roas, row[0].roi, row[0].total_sales, row[0].new_customers_count, row[0].cpc) == (
        "EXPO", 4.0, 3.0, 1, 1, 5.0)


def test_year_measures(spark):
    yearly = spark.createDataFrame([(2023, None, 10.0), (2024, None, 15.0), (2024, "x", 1.0)], "year int, k string, v double")
    got = {(r.year, r.k): (r.v_prev, r.v_yoy) for r in measures.year_over_year(yearly, ["k"], ["v"]).collect()}
    assert got == {(2023, None): (None, None), (2024, None): (10.0, 0.5), (2024, "x"): (None, None)}
    daily = spark.createDataFrame([(d("2024-01-01"), 1.0), (d("2024-01-01"), 2.0), (d("2024-01-05"), 4.0),
                                   (d("2025-01-01"), 8.0)], "date date, v double")
    ytd = {r.date: r.v_ytd for r in measures.year_to_date(daily, [], ["v"]).collect()}
    assert ytd == {d("2024-01-01"): 3.0, d("2024-01-05"): 7.0, d("2025-01-01"): 8.0}


def test_word_mart(spark):
    schema = ("date date, platform string, account_name string, account_id string, campaign_name string, "
              "campaign_status string, campaign_id string, event_name string, event_edition string, week_display string, "
              "week_number int, week_number_to_sort int, weeks_left string, cut_off_rate string, "
              "cut_off_rate_sort_order int, currency string, raw_text string, cost double, impressions long, clicks long, "
              "unique_clicks long, conversions double, conversion_value double")

    def row(day, text, n):
        return (d(day), "A", "n", "1", "c", "On", "c1", "e", "ed", "Week 1", 1, 1, "1", "EB", 2, "EUR", text, 1.0, n, 1,
                1, 0.0, 0.0)
    def mart(*data):
        src = spark.createDataFrame(data, schema)
        return {(r.date, r.word): (r.impressions, r.top_search_combinations)
                for r in gold.word_mart(gold.word_stats(src, ["the"]), gold.phrase_texts(src)).collect()}

    got = mart(row("2024-05-01", "Best best EXPO!", 5), row("2024-05-02", "the expo", 9))
    tops = "the expo (9)\nBest best EXPO! (5)"
    start = "word " * 24
    alike = mart(row("2024-05-01", start + "one", 5), row("2024-05-01", start + "two", 7))
    shown = start[:100] + "..."
    assert alike[(d("2024-05-01"), "word")] == (24 * 12, f"{shown} (168)\n{shown} (120)")
    assert alike[(d("2024-05-01"), "one")] == (5, f"{shown} (5)")
    assert got == {(d("2024-05-01"), "best"): (10, "Best best EXPO! (10)"), (d("2024-05-01"), "expo"): (5, tops),
                   (d("2024-05-02"), "expo"): (9, tops)}


# Calendar -------------------------------------------------------------------

def test_build_calendar(spark, rows):
    spec = cal.CalendarSpec(
        replacements=(("GRAND FAIR", "FAIR G"),), patterns=("FAIR", "SHOW", "OLD"), series_names={"SHOW": "SHOWS"},
        prefix_allow={"FAIR": ("FAIR", "FAIR G")}, year_exceptions=(cal.YearException("OLD", 2023, (2020, 2022), (9,)),),
        min_year=2022, excluded_series=("SHOW X",), country_code_series=("OLD",))
    events = spark.createDataFrame(
        [(1, "GRAND FAIR 2024 Paris"), (2, "FAIR ODD 2024"), (3, "SHOW 2021"), (4, "SHOW 2023"), (5, "SHOW X 2023"),
         (6, "none 2024"), (7, "OLD 2022"), (8, "OLD 2024"), (9, "OLD 2022"), (10, "FAIR"), (11, "FAIR 2024"), (12, None)],
        "id_manifestation int, original_title string").withColumns({
            "event_start_date": F.lit(d("2024-05-20")), "event_end_date": F.lit(d("2024-05-22")),
            "host_nation": F.when(F.col("id_manifestation") == 8, "France").otherwise("Nowhere")})
    rates = spark.createDataFrame(
        [(i, d("2024-01-01"), d("2024-01-31")) for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12)]
        + [(1, d("2024-02-01"), d("2024-02-29")), (99, d("2024-01-01"), d("2024-01-02"))],
        "id_manifestation int, date1 date, date2 date")
    countries = spark.createDataFrame([("FR", "France")], "country_code string, country_name string")
    out = cal.build_calendar(events, rates, spec, countries)
    assert rows(out, "id_manifestation", "conference_editions") == [
        (1, "2024 FAIR G"), (4, "2023 SHOWS"), (8, "2024 OLD FR"), (9, "2022 OLD ")]
    first = out.where("id_manifestation = 1").first()
    assert (first.seb_start_date, first.seb_end_date, first.eb_start_date, first.eb_end_date) == (
        d("2024-01-01"), d("2024-01-31"), d("2024-02-01"), d("2024-02-29"))
    assert (first.fp_start_date, first.fp_end_date, first.onsite_end_date) == (
        d("2024-03-01"), d("2024-05-19"), d("2024-05-22"))
    checks = dict(rows(cal.calendar_checks(out, ["SHOWS", "OLD"])))
    assert checks["unknown_series"] == 1 and checks["seb_end_date"] == 0


def test_unify_keeps_boundaries_under_their_names(spark):
    region1 = make(spark, "calendar_region1", dict(
        conference_editions="E1", event_start_date=d("2024-05-20"), event_end_date=d("2024-05-22"),
        seb_start_date=d("2024-01-01"), seb_end_date=d("2024-01-31")))
    region2 = make(spark, "calendar_region2", {f.name: f.name for f in raw_schema("calendar_region2")}, dict(
        conference_editions="E2", event_start_date="2024-06-01 00:00:00", event_end_date="2024-06-03",
        seb_end_date="2024-02-15 00:00:00", advance_end_date="tbc", standard_end_date="2024-05-31"))
    got = {r.conference_editions: r for r in cal.unify_calendar(region1, region2, ("R1", "R2")).collect()}
    assert set(got) == {"E1", "E2"}
    assert (got["E1"].seb_start_date, got["E1"].seb_end_date) == (d("2024-01-01"), d("2024-01-31"))
    assert (got["E2"].seb_start_date, got["E2"].seb_end_date, got["E2"].fp_end_date, got["E2"].advance_end_date) == (
        None, d("2024-02-15"), d("2024-05-31"), None)
    assert (got["E2"].year, got["E2"].region, got["E2"].onsite_end_date) == (2024, "R2", d("2024-06-03"))
    assert list(got["E1"].asDict()) == [n for n, _ in cal.CALENDAR]


def test_every_landed_schema_has_a_stamp_or_is_reference_data():
    reference = {"calendar_region2", "geo_targets", "countries"}
    assert all("_ingested_at" in ddl for name, ddl in RAW.items() if name not in reference)
