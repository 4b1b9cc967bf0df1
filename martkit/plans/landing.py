"""Report payloads of both platforms to landed tables.

A payload is a DataFrame with the nested structure of the report interface. The
landed schema decides names and types; here only the paths are listed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions.casts import from_micros
from ..functions.rules import paid_media
from ..functions.text import hour_of_range, path_tail
from ..operators import nested
from ..operators.dedup import first_wins
from ..operators.lookup import pacing, with_default
from ..operators.nested import Field, actions_json, flatten_report, parse_actions, sum_actions
from ..operators.stack import stack
from ..sources.load import stamp
from ..sources.schemas import raw_schema

STAMP = "_ingested_at"
UNKNOWN_STATUS, UNKNOWN_PLACE = "UNKNOWN", "Unknown"

# Paths of landed columns in platform A reports. Columns that are
# not listed are metrics of the same name.
PATHS_A: dict[str, str] = {
    "date": "segments.date", "account_id": "customer.id", "account_name": "customer.descriptive_name",
    "campaign_id": "campaign.id", "campaign_name": "campaign.name", "campaign_status": "campaign.status",
    "status": "campaign.status", "serving_status": "campaign.serving_status", "start_date": "campaign.start_date",
    "end_date": "campaign.end_date", "ad_group_id": "ad_group.id", "ad_group_name": "ad_group.name",
    "ad_id": "ad_group_ad.ad.id", "ad_name": "ad_group_ad.ad.name", "ad_type": "ad_group_ad.ad.type",
    "ad_network_type": "segments.ad_network_type", "device": "segments.device",
    "bidding_strategy_type": "campaign.bidding_strategy_type", "currency": "customer.currency_code",
    "advertising_channel_type": "campaign.advertising_channel_type",
    "channel_type": "campaign.advertising_channel_type", "conversion_action_id": "segments.conversion_action",
    "conversion_action_name": "segments.conversion_action_name",
    "conversion_category": "segments.conversion_action_category", "age_range": "ad_group_criterion.age_range.type",
    "gender": "ad_group_criterion.gender.type", "geo_criterion_id": "geographic_view.country_criterion_id",
    "location_type": "geographic_view.location_type", "search_term": "search_term_view.search_term",
    "keyword_text": "ad_group_criterion.keyword.text",
    "keyword_match_type": "ad_group_criterion.keyword.match_type",
    "quality_score": "ad_group_criterion.quality_info.quality_score",
    "placement_resource_name": "group_placement_view.placement",
    "placement_display_name": "group_placement_view.display_name",
    "landing_page_url": "landing_page_view.unexpanded_final_url", "day_of_week": "segments.day_of_week",
    "hour": "segments.hour", "asset_group_id": "asset_group.id", "asset_group_name": "asset_group.name",
    "asset_id": "asset.id", "asset_type": "asset.type", "asset_text": "asset.text_asset.text",
    "daily_budget_micros": "campaign_budget.amount_micros",
    "total_budget_micros": "campaign_budget.total_amount_micros", "budget_type": "campaign_budget.type",
    "search_budget_lost_is": "metrics.search_budget_lost_impression_share",
    "content_budget_lost_is": "metrics.content_budget_lost_impression_share",
    "audience_criterion_id": "ad_group_criterion.criterion_id", "audience_name": "ad_group_criterion.display_name",
    "audience_type": "ad_group_criterion.type", "field_type": "asset_group_asset.field_type",
    "asset_status": "asset_group_asset.status",
}
PATHS_BY_TABLE: dict[str, dict[str, str]] = {
    "a_search_terms": {"keyword_id": "segments.keyword.ad_group_criterion"},
    "a_keywords": {"keyword_id": "ad_group_criterion.criterion_id"},
    "a_audience": {"audience_criterion_id": "ad_group_audience_view.resource_name"},
    "a_user_location": {"user_geo_criterion_id": "user_location_view.country_criterion_id",
                        "is_targeting_location": "user_location_view.targeting_location"},
    "a_user_location_conversions": {"user_geo_criterion_id": "geographic_view.country_criterion_id"},
}
# Measures that must be positive for a row to be landed (source-side predicate).
POSITIVE: dict[str, str] = {
    "a_campaign_performance": "metrics.cost_micros", "a_conversion_action": "metrics.all_conversions",
    "a_age_conversions": "metrics.all_conversions", "a_gender_conversions": "metrics.all_conversions",
    "a_user_location_conversions": "metrics.all_conversions",
}
# Source columns of platform B breakdowns, default for missing ones.
BREAKDOWNS_B: dict[str, str] = {
    "device": "impression_device", "publisher_platform": "publisher_platform",
    "platform_position": "platform_position", "age": "age", "gender": "gender", "country": "country",
    "region": "region",
}
HOUR_RANGE = "hourly_stats_aggregated_by_advertiser_time_zone"
COUNTS_B = ("impressions", "clicks", "unique_clicks", "reach")
RATES_B = ("spend", "ctr", "unique_ctr", "cpm", "frequency")


def _stamped(df: DataFrame, at: datetime | None) -> DataFrame:
    return stamp(df, at, STAMP)


def land_a(report: DataFrame, name: str, at: datetime | None = None, channels: Sequence[str] = (),
           strict: bool = True) -> DataFrame:
    """Landed rows of a platform A report.

    ``channels`` limits restricted and asset reports to their channel types.
    Missing metrics are 0, as in the report objects, but for the average price
    of a click. Text that does not parse raises; with ``strict`` off it counts
    as missing.
    """
    if name in POSITIVE:
        report = report.where(F.col(POSITIVE[name]) > 0)
    if channels:
        report = report.where(F.col(PATHS_A["channel_type"]).isin(list(channels)))
    paths = PATHS_A | PATHS_BY_TABLE.get(name, {})
    schema = [f for f in raw_schema(name) if f.name != STAMP]
    fields = []
    for f in schema:
        metric = f.name not in paths and f.name != "average_cpc" and f.dataType.simpleString() in ("bigint", "double")
        fields.append(Field(paths.get(f.name, f"metrics.{f.name}"), f.name, f.dataType.simpleString(), 0 if metric else None))
    out = flatten_report(report, fields, strict)
    parsed: dict[str, Column] = {}
    if "average_cpc" in out.columns:
        parsed["average_cpc"] = from_micros("average_cpc")
    if name == "a_conversion_action":
        parsed["conversion_action_id"] = path_tail("conversion_action_id", "/")
    if name == "a_search_terms":
        parsed["keyword_id"] = path_tail("keyword_id", empty_as_null=True)
    if name == "a_audience":
        parsed["audience_criterion_id"] = path_tail("audience_criterion_id")
    return _stamped(out.withColumns(parsed) if parsed else out, at)


def land_assets(report: DataFrame, at: datetime | None = None, channels: Sequence[str] = ()) -> DataFrame:
    """Asset dimension with the shown text of every asset."""
    shown = report.withColumn("metrics", F.struct(
        nested.asset_display("asset.text_asset.text", "asset.name").alias("asset_content")))
    return land_a(shown, "a_campaign_asset_dim", at, channels)


def land_audiences(report: DataFrame, types: Sequence[str], at: datetime | None = None) -> DataFrame:
    """Audiences of the listed types, one row per audience."""
    return nested.audience_dim(land_a(report, "a_audience_dim", at), types, ["ad_group_id", "audience_name"])


def land_ads(report: DataFrame, at: datetime | None = None) -> DataFrame:
    """Ad dimension with asset arrays, one row per ad."""
    rows = nested.ad_assets(report)
    texts = [F.array_join(c, "\n").alias(f"_{c}") for c in ("final_urls", "headlines", "descriptions")]
    ordered = rows.select("*", *texts)
    order = ["ad_type", "_final_urls", "_headlines", "_descriptions"]
    return _stamped(first_wins(ordered, ["ad_id"], order).select(*rows.columns), at)


def _number(report: DataFrame, name: str, dtype: str, strict: bool) -> Column:
    if name not in report.columns:
        return F.lit(0).cast(dtype)
    c = F.col(name).cast(dtype) if strict else F.col(name).try_cast(dtype)
    return F.coalesce(c, F.lit(0).cast(dtype))


def _base_b(report: DataFrame, name: str, currency: Mapping[str, str] | str, strict: bool,
            given: Mapping[str, Column] | None = None) -> DataFrame:
    """Typed columns of a platform B report, without the campaign status."""
    have = set(report.columns)
    cols: dict[str, Column] = {"date": F.col("date_start").cast("date"), **(given or {})}
    for f in raw_schema(name):
        n = f.name
        if n in cols or n in (STAMP, "campaign_status"):
            continue
        if n in BREAKDOWNS_B:
            src = F.col(BREAKDOWNS_B[n]) if BREAKDOWNS_B[n] in have else F.lit(None)
            cols[n] = F.coalesce(src.cast("string"), F.lit(UNKNOWN_PLACE))
        elif n == "hour_of_day":
            cols[n] = hour_of_range(HOUR_RANGE if HOUR_RANGE in have else F.lit(None).cast("string"))
        elif n in COUNTS_B:
            cols[n] = _number(report, n, "bigint", strict)
        elif n in RATES_B:
            cols[n] = _number(report, n, "double", strict)
        elif n == "average_cpc":
            cols[n] = _number(report, "cpc", "double", strict)
        elif n in ("conversions", "conversion_value"):
            source = "actions" if n == "conversions" else "action_values"
            cols[n] = sum_actions(parse_actions(report, source), strict) if source in have else F.lit(0.0)
        elif n in ("actions", "action_values"):
            text = n in have and isinstance(report.schema[n].dataType, StringType)
            cols[n] = (F.coalesce(F.col(n), F.lit("[]")) if text
                       else actions_json(n) if n in have else F.lit("[]"))
        elif n == "currency":
            cols[n] = F.lit(currency) if isinstance(currency, str) else _by_account(currency)
        else:
            cols[n] = F.col(n).cast(f.dataType) if n in have else F.lit(None).cast(f.dataType)
    return report.select(*[c.alias(n) for n, c in cols.items()])


def _by_account(currency: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for item in currency.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col("account_id").cast("string"))


def _ordered(df: DataFrame, name: str, at: datetime | None) -> DataFrame:
    return _stamped(df, at).select([f.name for f in raw_schema(name)])


def _with_campaign_status(df: DataFrame, statuses: DataFrame) -> DataFrame:
    side = statuses.select(F.col("campaign_id").cast("string").alias("campaign_id"), *[c for c in [STAMP] if c in statuses.columns],
                           F.col("effective_status").alias("campaign_status"))
    return with_default(df, side, ["campaign_id"], {"campaign_status": UNKNOWN_STATUS})


def land_b(report: DataFrame, name: str, statuses: DataFrame, currency: Mapping[str, str] | str,
           at: datetime | None = None, strict: bool = True) -> DataFrame:
    """Landed rows of a platform B report; conversions sum all actions."""
    return _ordered(_with_campaign_status(_base_b(report, name, currency, strict), statuses), name, at)


def land_b_actions(report: DataFrame, statuses: DataFrame, currency: Mapping[str, str] | str,
                   at: datetime | None = None, strict: bool = True) -> DataFrame:
    """One landed row per action; the last value of a type is its revenue."""
    rows = nested.explode_actions(report, names=("conversion_action", "_count", "_value"), duplicate="last",
                                  missing=0.0, strict=strict)
    typed = _base_b(rows, "b_conversion_action", currency, strict,
                    {"conversions": F.col("_count"), "conversion_value": F.col("_value")})
    return _ordered(_with_campaign_status(typed, statuses), "b_conversion_action", at)


def land_b_pacing(report: DataFrame, budgets: DataFrame, statuses: DataFrame, currency: Mapping[str, str] | str,
                  at: datetime | None = None, strict: bool = True) -> DataFrame:
    """Spend per ad set and day with its budget caps."""
    name = "b_budget_pacing"
    spend = _base_b(report, name, currency, strict).drop("daily_budget_cap", "lifetime_budget_cap", "adset_status")
    return _ordered(_with_campaign_status(pacing(spend, budgets), statuses), name, at)


def land_creatives(creatives: DataFrame, account_name: str, at: datetime | None = None) -> DataFrame:
    """Creative dimension with resolved texts."""
    rows = nested.resolve_creative(creatives).withColumns({
        "creative_id": F.col("id").cast("string"), "creative_name": F.col("name"),
        "account_name": F.lit(account_name)})
    return _ordered(rows, "b_creative_dim", at)


# CRM ------------------------------------------------------------------------

# Text columns of the landed orders that are never missing.
FILLED = ("conference_series", "conference_editions", "cut_off_rate", "currency", "order_type", "city", "country", "region",
          "primary_language", "specialty", "utm_source", "utm_medium", "utm_campaign", "orders", "new_customer")


@dataclass(frozen=True)
class CrmRegion:
    """One region's orders: its paid-media lists, and the landed columns that have other names or one value there."""

    rows: DataFrame
    explicit: tuple[str, ...]
    ambiguous: tuple[str, ...] = ()
    paid_mediums: tuple[str, ...] = ()
    names: Mapping[str, str] = field(default_factory=dict)
    constants: Mapping[str, object] = field(default_factory=dict)


def land_crm(regions: Sequence[CrmRegion], at: datetime | None = None, unknown: str = UNKNOWN_PLACE) -> DataFrame:
    """Paid orders of all regions under the landed names (C28, C33, H5); full-refresh the result.

    Missing text, NULL or the text of a NaN, becomes ``unknown``.
    """
    schema = [f for f in raw_schema("crm_orders") if f.name != STAMP]
    landed = []
    for region in regions:
        source, medium = (region.names.get(c, c) for c in ("utm_source", "utm_medium"))
        rows = paid_media(region.rows, source, medium, region.explicit, region.ambiguous, region.paid_mediums)
        cols = []
        for f in schema:
            name = region.names.get(f.name, f.name)
            c = (F.lit(region.constants[f.name]) if f.name in region.constants
                 else F.col(name) if name in rows.columns else F.lit(None))
            c = c.cast(f.dataType)
            if f.name in FILLED:
                c = F.when(c.isNull() | (c == "NaN"), F.lit(unknown)).otherwise(c)
            cols.append(c.alias(f.name))
        landed.append(rows.select(*cols))
    return _stamped(stack(*landed), at)
