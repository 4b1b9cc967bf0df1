from datetime import datetime

import pytest
from conftest import d
from pyspark.sql import functions as F

from martkit.plans import landing
from martkit.sources.schemas import raw_schema

AT = datetime(2024, 5, 2, 6)


def names(table):
    return [f.name for f in raw_schema(table)]


def test_platform_a_report(spark):
    report = spark.sql("""SELECT struct('2024-05-01' AS date, 'MOBILE' AS device, 'SEARCH' AS ad_network_type) AS segments,
      struct(11 AS id, 'Acc' AS descriptive_name, 'EUR' AS currency_code) AS customer,
      struct(22 AS id, 'Camp' AS name, 'ENABLED' AS status, 'CPC' AS bidding_strategy_type) AS campaign,
      struct(33 AS id, 'Group' AS name) AS ad_group,
      struct(struct(44 AS id, 'Ad' AS name, 'TEXT' AS type) AS ad) AS ad_group_ad,
      struct(100 AS impressions, 10 AS clicks, 0.1D AS ctr, 2500000 AS average_cpc, 9000000 AS cost_micros) AS metrics""")
    out = landing.land_a(report, "a_performance", AT)
    assert out.columns == names("a_performance")
    row = out.first()
    assert (row.date, row.account_id, row.campaign_id, row.ad_id, row.average_cpc, row.cost_micros, row.engagements) == (
        d("2024-05-01"), "11", "22", "44", 2.5, 9000000, 0)  # a missing metric is 0
    assert row._ingested_at == AT
    bad = report.withColumn("metrics", F.struct(F.lit("n/a").alias("clicks")))
    assert landing.land_a(bad, "a_performance", AT, strict=False).first().clicks == 0
    assert landing.land_a(bad, "a_performance", AT, strict=False).first().average_cpc is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        landing.land_a(bad, "a_performance", AT).collect()


def test_crm_regions_under_one_schema(spark):
    a = spark.createDataFrame([("1", "s", "cpc", None, "NaN"), ("2", "q", "cpc", "x", "y"), ("3", "q", "mail", "x", "y")],
                              "id_commande string, utm_source string, utm_medium string, city string, orders string")
    b = spark.createDataFrame([("4", "q", "cpc", "sp")], "id_customer string, src string, utm_medium string, speciality string")
    regions = [landing.CrmRegion(a, ("s",), ("q",), ("cpc",)),
               landing.CrmRegion(b, (), ("q",), ("cpc",), {"id_commande": "id_customer", "utm_source": "src",
                                                           "specialty": "speciality"}, {"currency": "USD"})]
    got = {r.id_commande: r for r in landing.land_crm(regions, AT).collect()}
    assert set(got) == {"1", "2", "4"}
    assert (got["1"].city, got["1"].orders, got["1"].currency, got["1"].time_submit) == ("Unknown", "Unknown", "Unknown", None)
    assert (got["4"].specialty, got["4"].currency, got["4"].utm_source) == ("sp", "USD", "q")


def test_source_predicates_and_parsed_ids(spark):
    report = spark.sql("""SELECT struct('2024-05-01' AS date, 'x/y/77' AS conversion_action) AS segments,
      struct('VIDEO' AS advertising_channel_type) AS campaign, struct(v AS all_conversions) AS metrics
      FROM VALUES (0.0D), (1.5D) AS t(v)""")
    rows = landing.land_a(report, "a_conversion_action", AT).collect()
    assert [(r.conversion_action_id, r.all_conversions) for r in rows] == [("77", 1.5)]
    assert landing.land_a(report, "a_geo_restricted", AT, channels=["VIDEO"]).count() == 2
    assert landing.land_a(report, "a_geo_restricted", AT, channels=["OTHER"]).count() == 0
    terms = spark.sql("SELECT struct(struct(v AS ad_group_criterion) AS keyword) AS segments FROM VALUES (''), ('a~5') t(v)")
    assert {r.keyword_id for r in landing.land_a(terms, "a_search_terms", AT).collect()} == {None, "5"}


def test_every_report_lands_in_its_schema(spark):
    report = spark.sql("SELECT struct('2024-05-01' AS date) AS segments, struct(1.0D AS all_conversions, "
                       "1 AS cost_micros) AS metrics")
    for table in ("a_campaign_performance", "a_conversion_action", "a_age_range", "a_gender", "a_age_conversions",
                  "a_gender_conversions", "a_geo", "a_geo_restricted", "a_user_location", "a_user_location_conversions",
                  "a_search_terms", "a_keywords", "a_audience", "a_placement", "a_landing_page", "a_schedule",
                  "a_campaign_asset", "a_budget_pacing", "a_campaign_dim"):
        out = landing.land_a(report, table, AT)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in raw_schema(table)]
        assert out.count() == 1


def test_dimensions_of_platform_a(spark, rows):
    ads = spark.sql("""SELECT struct(v AS id, 'EXPANDED_TEXT_AD' AS type, array('u') AS final_urls,
      struct(array(struct('h' AS text)) AS headlines, array(struct('d' AS text)) AS descriptions) AS responsive_search_ad,
      struct(array(struct('h' AS text)) AS headlines, array(struct('d' AS text)) AS descriptions,
        struct('l' AS text) AS long_headline) AS responsive_display_ad,
      struct('p1' AS headline_part1, '' AS headline_part2, CAST(NULL AS STRING) AS headline_part3, 'd1' AS description,
        'd2' AS description2) AS expanded_text_ad) AS ad FROM VALUES (1), (1) AS t(v)""")
    assert rows(landing.land_ads(ads, AT).drop("_ingested_at")) == [("1", "EXPANDED_TEXT_AD", ["u"], ["p1"], ["d1", "d2"])]
    audiences = spark.sql("""SELECT struct(g AS id) AS ad_group, struct(7 AS criterion_id, 'n' AS display_name,
      'A' AS type) AS ad_group_criterion FROM VALUES (2), (1) AS t(g)""")
    assert rows(landing.land_audiences(audiences, ["A"], AT).drop("_ingested_at")) == [("1", "7", "n", "A")]
    assets = spark.sql("""SELECT struct(1 AS id, 'G' AS name) AS asset_group, struct(2 AS id, 'T' AS type, 'file' AS name,
      struct('' AS text) AS text_asset) AS asset, struct('HEADLINE' AS field_type, 'ENABLED' AS status) AS asset_group_asset""")
    out = landing.land_assets(assets, AT)
    assert out.columns == names("a_campaign_asset_dim") and out.first().asset_content == "file"


ITEM = """'2024-05-01' AS date_start, '1' AS account_id, 'Acc' AS account_name, '9' AS campaign_id, 'C' AS campaign_name,
  's1' AS adset_id, 'S' AS adset_name, 'a1' AS ad_id, 'A' AS ad_name, '12' AS impressions, '3' AS clicks, '4.5' AS spend,
  array(struct('buy' AS action_type, '2' AS value), struct('lead' AS action_type, '1' AS value)) AS actions,
  array(struct('buy' AS action_type, '7' AS value), struct('buy' AS action_type, '8' AS value)) AS action_values"""


def statuses(spark):
    return spark.createDataFrame([("9", "ACTIVE")], "campaign_id string, effective_status string")


def test_platform_b_reports(spark):
    report = spark.sql(f"SELECT {ITEM}, '07:00:00 - 07:59:59' AS hourly_stats_aggregated_by_advertiser_time_zone")
    for table in ("b_performance", "b_age_gender", "b_age_gender_conversions", "b_region", "b_country", "b_device",
                  "b_hourly", "b_position"):
        out = landing.land_b(report, table, statuses(spark), {"1": "EUR"}, AT)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in raw_schema(table)]
        row = out.first()
        assert (row.date, row.campaign_status, row.impressions, row.unique_clicks, row.spend, row.average_cpc,
                row.currency) == (d("2024-05-01"), "ACTIVE", 12, 0, 4.5, 0.0, "EUR")
        if "conversions" in out.columns:
            assert (row.conversions, row.conversion_value) == (3.0, 15.0)
        if "region" in out.columns:
            assert row.region == "Unknown" and row.actions.startswith('[{"action_type":"buy"')
        if "hour_of_day" in out.columns:
            assert row.hour_of_day == 7


def test_actions_and_pacing(spark, rows):
    report = spark.sql(f"SELECT {ITEM}")
    out = landing.land_b_actions(report, statuses(spark).limit(0), "EUR", AT)
    assert out.columns == names("b_conversion_action")
    assert rows(out, "conversion_action", "conversions", "conversion_value", "campaign_status") == [
        ("buy", 2.0, 8.0, "UNKNOWN"), ("lead", 1.0, 0.0, "UNKNOWN")]
    budgets = spark.createDataFrame([("s1", "5000", None, "ACTIVE")],
                                    "adset_id string, daily_budget string, lifetime_budget string, status string")
    paced = landing.land_b_pacing(report, budgets, statuses(spark), "EUR", AT)
    assert paced.columns == names("b_budget_pacing")
    row = paced.first()
    assert (row.spend, row.daily_budget_cap, row.lifetime_budget_cap, row.adset_status) == (4.5, 50.0, 0.0, "ACTIVE")


def test_creatives(spark):
    item = spark.sql("""SELECT 5 AS id, 'n' AS name, '1' AS account_id, 'ON' AS status, 'tags' AS url_tags,
      '' AS call_to_action_type, '' AS image_url, 'thumb' AS thumbnail_url,
      struct(struct('ln' AS name, 'lm' AS message, 'll' AS link, 'lp' AS picture, struct('GO' AS type) AS call_to_action)
        AS link_data, CAST(NULL AS STRUCT<title: STRING, message: STRING, image_url: STRING,
          call_to_action: STRUCT<type: STRING>>) AS video_data) AS object_story_spec,
      CAST(NULL AS STRUCT<titles: ARRAY<STRUCT<text: STRING>>, bodies: ARRAY<STRUCT<text: STRING>>,
        link_urls: ARRAY<STRUCT<website_url: STRING>>, images: ARRAY<STRUCT<url: STRING>>>) AS asset_feed_spec""")
    out = landing.land_creatives(item, "Acc", AT)
    assert out.columns == names("b_creative_dim")
    row = out.first()
    assert (row.creative_id, row.headline, row.destination_url, row.call_to_action_type, row.image_url) == (
        "5", "ln", "ll", "GO", "thumb")
