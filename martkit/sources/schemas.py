"""Landed table schemas as DDL (one entry per raw dataset shape).

Built from column groups, because the datasets share most of their columns.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Names and types of the landed columns.
_KEY = ("date date, account_id string, account_name string, campaign_id string, campaign_name string, "
        "campaign_status string")
_ADG = "ad_group_id string, ad_group_name string"
_MET_A = ("impressions bigint, clicks bigint, ctr double, average_cpc double, cost_micros bigint, "
          "conversions double, conversions_value double, all_conversions double")
_VTC = "view_through_conversions double"
_CTX_A = "bidding_strategy_type string, currency string"
_SET = "adset_id string, adset_name string, ad_id string, ad_name string"
_MET_B = ("impressions bigint, clicks bigint, unique_clicks bigint, spend double, ctr double, unique_ctr double, "
          "average_cpc double, cpm double")
_REACH = "reach bigint, frequency double"
_CONV_B = "conversions double, conversion_value double"
_JSON = "actions string, action_values string"
_STAMP = "_ingested_at timestamp"
_ACTION = "conversion_action_name string"


def _table(*groups: str) -> str:
    return ", ".join([*groups, _STAMP])


RAW: dict[str, str] = {
    "a_performance": _table(_KEY, _ADG, "ad_id string, ad_name string, ad_type string, ad_network_type string, "
                            "device string", _MET_A, _VTC, "engagements bigint", _CTX_A),
    "a_campaign_performance": _table(_KEY, "advertising_channel_type string, cost_micros bigint, impressions bigint, "
                                     "clicks bigint, ctr double", _CTX_A),
    "a_conversion_action": _table(_KEY, "conversion_action_id string", _ACTION, "conversion_category string, "
                                  "conversions double, conversions_value double, all_conversions double, "
                                  "all_conversions_value double", _CTX_A),
    "a_age_range": _table(_KEY, _ADG, "age_range string", _MET_A, _VTC, "engagements bigint", _CTX_A),
    "a_gender": _table(_KEY, _ADG, "gender string", _MET_A, _VTC, "engagements bigint", _CTX_A),
    "a_age_conversions": _table(_KEY, _ADG, "age_range string", _ACTION, "conversions double, "
                                "conversions_value double, all_conversions double", _VTC, "currency string"),
    "a_gender_conversions": _table(_KEY, _ADG, "gender string", _ACTION, "conversions double, "
                                   "conversions_value double, all_conversions double", _VTC, "currency string"),
    "a_geo": _table(_KEY, _ADG, "geo_criterion_id string, location_type string", _MET_A, _VTC, _CTX_A),
    "a_geo_restricted": _table(_KEY, "channel_type string, geo_criterion_id string, location_type string", _MET_A,
                               _VTC, _CTX_A),
    "a_user_location": _table(_KEY, _ADG, "user_geo_criterion_id string, is_targeting_location boolean", _MET_A,
                              _VTC, _CTX_A),
    "a_user_location_conversions": _table(
        "date date, account_id string, account_name string, campaign_id string, campaign_name string, "
        "user_geo_criterion_id string, location_type string", _ACTION, "conversions double, "
        "conversions_value double, all_conversions double, all_conversions_value double"),
    "a_search_terms": _table(_KEY, _ADG, "search_term string, keyword_id string", _MET_A, _CTX_A),
    "a_keywords": _table(_KEY, _ADG, "keyword_id string, keyword_text string, keyword_match_type string, "
                         "quality_score bigint", _MET_A, _CTX_A),
    "a_audience": _table(_KEY, _ADG, "audience_criterion_id string", _MET_A, _VTC, "engagements bigint", _CTX_A),
    "a_placement": _table(_KEY, _ADG, "placement_resource_name string, placement_display_name string", _MET_A, _VTC,
                          "engagements bigint", _CTX_A),
    "a_landing_page": _table(_KEY, _ADG, "landing_page_url string", _MET_A, _CTX_A),
    "a_schedule": _table(_KEY, _ADG, "day_of_week string, hour bigint", _MET_A, _CTX_A),
    "a_campaign_asset": _table(_KEY, "asset_group_id string, asset_group_name string, asset_id string, "
                               "asset_type string, asset_text string", _MET_A, _CTX_A),
    "a_budget_pacing": _table(_KEY, "daily_budget_micros bigint, total_budget_micros bigint, budget_type string, "
                              "cost_micros bigint, clicks bigint, impressions bigint, search_budget_lost_is double, "
                              "content_budget_lost_is double", _CTX_A),
    "a_campaign_dim": _table("account_id string, campaign_id string, campaign_name string, status string, "
                             "serving_status string, start_date date, end_date date"),
    "a_ad_dim": _table("ad_id string, ad_type string, final_urls array<string>, headlines array<string>, "
                       "descriptions array<string>"),
    "a_audience_dim": _table("ad_group_id string, audience_criterion_id string, audience_name string, "
                             "audience_type string"),
    "a_campaign_asset_dim": _table("asset_group_id string, asset_group_name string, asset_id string, "
                                   "asset_type string, asset_content string, field_type string, asset_status string"),
    "b_performance": _table(_KEY, _SET, _MET_B, _REACH, _CONV_B, "currency string"),
    "b_conversion_action": _table(_KEY, _SET, "conversion_action string", _CONV_B, "currency string"),
    "b_age_gender": _table(_KEY, _SET, "age string, gender string", _MET_B, _REACH, _CONV_B, "currency string"),
    "b_age_gender_conversions": _table(_KEY, _SET, "age string, gender string", _MET_B, _REACH, _JSON,
                                       "currency string"),
    "b_region": _table(_KEY, _SET, "country string, region string", _MET_B, _CONV_B, _JSON, "currency string"),
    "b_country": _table(_KEY, _SET, "country string", _MET_B, _CONV_B, _JSON, "currency string"),
    "b_device": _table(_KEY, _SET, "device string", _MET_B, _CONV_B, "currency string"),
    "b_hourly": _table(_KEY, _SET, "hour_of_day int", _MET_B, _CONV_B, "currency string"),
    "b_position": _table(_KEY, _SET, "publisher_platform string, platform_position string", _MET_B, _CONV_B,
                         "currency string"),
    "b_budget_pacing": _table(_KEY, "adset_id string, adset_name string, spend double, impressions bigint, "
                              "clicks bigint, unique_clicks bigint, daily_budget_cap double, "
                              "lifetime_budget_cap double, adset_status string, currency string"),
    "b_campaign_dim": _table("account_id string, campaign_id string, campaign_name string, effective_status string, "
                             "start_time timestamp, stop_time timestamp"),
    "b_ad_dim": _table("ad_id string, ad_name string, account_id string, account_name string, status string, "
                       "creative_id string, created_time string, updated_time string"),
    "b_creative_dim": _table("creative_id string, creative_name string, account_id string, account_name string, "
                             "status string, headline string, body string, destination_url string, "
                             "call_to_action_type string, image_url string"),
    "crm_orders": _table("id_commande string, year int, date_submit date, date_time_submit timestamp, "
                         "time_submit string, time_period string, time_submit_converted string, "
                         "time_period_converted string, conference_series string, conference_editions string, "
                         "cut_off_rate string, total_ht double, currency string, order_type string, city string, "
                         "country string, region string, primary_language string, specialty string, "
                         "utm_source string, utm_medium string, utm_campaign string, orders string, "
                         "new_customer string"),
    "calendar_region1": _table("id_manifestation int, year int, conference_series string, "
                               "conference_editions string, event_start_date date, event_end_date date, "
                               "seb_start_date date, seb_end_date date, eb_start_date date, eb_end_date date, "
                               "fp_start_date date, fp_end_date date, onsite_start_date date, onsite_end_date date"),
    "calendar_region2": ("conference_editions string, event_start_date string, event_end_date string, "
                         "seb_end_date string, eb_start_date string, eb_end_date string, "
                         "advance_start_date string, advance_end_date string, standard_start_date string, "
                         "standard_end_date string"),
    "geo_targets": ("`Criteria ID` string, `Name` string, `Canonical Name` string, `Country Code` string, "
                    "`Target Type` string"),
    "countries": "country_code string, country_name string",
}

# Cluster columns inside a date partition, and days re-read by each load.
CLUSTER: dict[str, tuple[str, ...]] = {
    "a_campaign_performance": ("account_id", "campaign_id", "advertising_channel_type"),
    "a_conversion_action": ("account_id", "campaign_id", "conversion_action_name"),
    "a_age_range": ("account_id", "campaign_id", "ad_group_id", "age_range"),
    "a_gender": ("account_id", "campaign_id", "ad_group_id", "gender"),
    "a_age_conversions": ("account_id", "campaign_id", "age_range", "conversion_action_name"),
    "a_gender_conversions": ("account_id", "campaign_id", "gender", "conversion_action_name"),
    "a_geo": ("account_id", "campaign_id", "ad_group_id", "geo_criterion_id"),
    "a_geo_restricted": ("account_id", "campaign_id", "geo_criterion_id"),
    "a_search_terms": ("account_id", "campaign_id", "ad_group_id", "keyword_id"),
    "a_keywords": ("account_id", "campaign_id", "ad_group_id", "keyword_id"),
    "a_schedule": ("account_id", "campaign_id", "day_of_week", "hour"),
    "b_performance": ("account_id", "campaign_id", "ad_id"),
    "b_conversion_action": ("account_id", "campaign_id", "conversion_action"),
    "b_age_gender": ("account_id", "campaign_id", "age", "gender"),
    "b_age_gender_conversions": ("account_id", "campaign_id", "age", "gender"),
    "b_region": ("account_id", "campaign_id", "country", "region"),
    "b_country": ("account_id", "campaign_id", "country"),
    "b_device": ("account_id", "campaign_id", "device"),
    "b_hourly": ("account_id", "campaign_id", "hour_of_day"),
    "b_position": ("account_id", "campaign_id", "publisher_platform"),
    "a_user_location": ("account_id", "campaign_id", "ad_group_id", "user_geo_criterion_id"),
    "a_user_location_conversions": ("account_id", "campaign_id", "conversion_action_name", "user_geo_criterion_id"),
    "a_audience": ("account_id", "campaign_id", "audience_criterion_id"),
    "a_placement": ("account_id", "campaign_id", "ad_group_id", "placement_resource_name"),
    "a_landing_page": ("account_id", "campaign_id", "ad_group_id"),
    "a_campaign_asset": ("account_id", "campaign_id", "asset_group_id"),
    "crm_orders": ("utm_source", "utm_medium", "utm_campaign", "conference_series"),
    "calendar_region1": ("conference_series", "year"),
}
DEFAULT_CLUSTER = ("account_id", "campaign_id")
LOOKBACK_DAYS = 14
LONG_LOOKBACK_DAYS = 30
LONG_LOOKBACK = ("a_conversion_action", "a_age_conversions", "a_gender_conversions", "a_user_location_conversions",
                 "b_age_gender_conversions")


def raw_schema(name: str) -> StructType:
    return StructType.fromDDL(RAW[name])


def lookback_days(name: str) -> int:
    return LONG_LOOKBACK_DAYS if name in LONG_LOOKBACK else LOOKBACK_DAYS
