"""Silver models (J9-J24): dedup, type, normalise, label.

Each model is one lazy chain. All share the same head (recent rows, newest row
per key, campaign status) and tail (edition labels), and differ in keys and
columns. The prepared small sides (:class:`Inputs`) are built once per mart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import from_micros, ratio, safe_cast, safe_long
from ..functions.keys import surrogate_key
from ..functions.rules import Rule, first_match, recode, with_first_match
from ..functions.status import IDLE, delivery_status_a, delivery_status_b
from ..functions.text import initcap_words
from ..operators.dedup import latest, latest_repeated, recent, top_one
from ..operators.editions import DISTANCE, LABELS, Editions, label_events
from ..operators.lookup import campaign_states, exclude_keys, fits, lookup, with_creative, with_geo
from ..operators.nested import explode_actions
from ..operators.stack import stack, zero_metrics
from .context import Context

# Age ranges of platform A and the labels of breakdown reports.
AGE_GROUPS = {
    "AGE_RANGE_18_24": "18-24",
    "AGE_RANGE_25_34": "25-34",
    "AGE_RANGE_35_44": "35-44",
    "AGE_RANGE_45_54": "45-54",
    "AGE_RANGE_55_64": "55-64",
    "AGE_RANGE_65_UP": "65+",
}
UNKNOWN, UNSPECIFIED, NOT_AVAILABLE = "Unknown", "Unspecified", "N/A"
AGE_ONLY, GENDER_ONLY, COMBINED, AGE_AND_GENDER = "Age Only", "Gender Only", "Combined", "Age and Gender"
TARGETED_LOCATION, COUNTRY_LEVEL, REGION_LEVEL = "TARGETED_LOCATION", "Country", "Region"

HEAD = ["id", "date", "account_id", "account_name", "event_name", "campaign_id", "campaign_name", "campaign_status"]
GROUP = ["ad_group_id", "ad_group_name"]
AD = ["ad_id", "ad_name"]
RATES = ["ctr", "unique_ctr"]
COUNTS = ["impressions", "clicks", "unique_clicks"]
CONVERSIONS = ["conversions", "conversion_value"]
GEO = ["region_name", "canonical_name", "country_code", "geo_target_type"]
ZERO_DELIVERY = {"cost": "double", "average_cpc": "double", "impressions": "bigint", "clicks": "bigint",
                 "unique_clicks": "bigint", "ctr": "double", "unique_ctr": "double"}


@dataclass(frozen=True)
class States:
    """Campaign states with the answer of their size check."""

    df: DataFrame
    small: bool


@dataclass(frozen=True)
class Inputs:
    """Prepared small sides shared by the models of one platform.

    Without ``editions`` a model leaves its labels out, see :func:`described_a`
    and :func:`described_b`.
    """

    editions: Editions | None = None
    states: States | None = None


def states_a(dim: DataFrame, ctx: Context) -> States:
    return _states(dim, delivery_status_a("status", "serving_status", "end_date", ctx.as_of), ctx)


def states_b(dim: DataFrame, ctx: Context) -> States:
    return _states(dim, delivery_status_b("effective_status", "stop_time", ctx.as_of), ctx)


def _states(dim: DataFrame, status: Column, ctx: Context) -> States:
    df = campaign_states(dim, status, ctx.tie)
    # The raw dimension bounds the deduplicated one and needs no shuffle to count; if it is too large, old versions may be why.
    return States(df, fits(dim.select("campaign_id", status.alias("s")), ctx.bound) or fits(df, ctx.bound))


def _newest(raw: DataFrame, keys: Sequence[str], ctx: Context) -> DataFrame:
    tie = [t for t in ctx.tie if t in raw.columns]
    return latest(recent(raw, "date", ctx.recent_days, ctx.as_of), keys, tie=tie)


def _newest_b(raw: DataFrame, keys: Sequence[str], ctx: Context) -> DataFrame:
    """As :func:`_newest`; a report of platform B gives nearly all keys once."""
    if not ctx.read_again:
        return _newest(raw, keys, ctx)
    tie = [t for t in ctx.tie if t in raw.columns]
    return latest_repeated(recent(raw, "date", ctx.recent_days, ctx.as_of), keys, tie=tie)


def _typed(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select ``name -> source``: text sources are taken as they are."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def _text(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("string") for n in names}


def _double(**sources: str) -> dict[str, Column]:
    return {n: safe_cast(s, "double") for n, s in sources.items()}


def _long(df: DataFrame, **sources: str) -> dict[str, Column]:
    return {n: safe_long(df, s) for n, s in sources.items()}


def _head(event_name: Column, *key: str | Column) -> dict[str, str | Column]:
    return {"id": surrogate_key(F.col("date").cast("date"), *key), "date": F.col("date").cast("date"),
            **_text("account_id"), "account_name": "account_name", "event_name": event_name,
            **_text("campaign_id"), "campaign_name": "campaign_name"}


def _event_a(ctx: Context) -> Column:
    return first_match("account_name", ctx.account_rules, F.col("account_name"))


def _named_b(src: DataFrame, ctx: Context) -> DataFrame:
    """Platform B rows with the event series found in the campaign name."""
    return with_first_match(src, "event_name", "campaign_name", ctx.campaign_rules, ctx.campaign_default)


def _with_status(df: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    states = inputs.states
    joined = lookup(df, states.df, ["campaign_id"], small=states.small)
    return joined.withColumn("campaign_status", F.coalesce("campaign_status", F.lit(IDLE)))


def _finish(df: DataFrame, columns: Sequence[str], inputs: Inputs, ctx: Context) -> DataFrame:
    if inputs.editions is None:
        return df.select(*columns)
    labelled = label_events(df, inputs.editions, ctx.as_of, keep_distance=ctx.collapse_ids)
    if ctx.collapse_ids:
        tie = [F.col(c).asc_nulls_last() for c in columns if c != "id"]
        labelled = top_one(labelled, ["id"], [F.col(DISTANCE).asc_nulls_first(), *tie])
    return labelled.select(*columns, *LABELS)


def _delivery_a(df: DataFrame, cpc: bool = True, ctr: bool = True) -> dict[str, Column]:
    out = {"cost": from_micros("cost_micros"), **_long(df, impressions="impressions", clicks="clicks",
                                                       unique_clicks="clicks")}
    if cpc:
        out |= _double(average_cpc="average_cpc")
    if ctr:
        out |= _double(ctr="ctr", unique_ctr="ctr")
    return out


def _delivery_b(df: DataFrame) -> dict[str, Column]:
    """Platform B metrics; absent CPC and CPM are derived."""
    cpc = F.col("average_cpc") if "average_cpc" in df.columns else ratio("spend", "clicks")
    return {**_double(cost="spend"), "average_cpc": safe_cast(cpc, "double"),
            **_long(df, impressions="impressions", clicks="clicks", unique_clicks="unique_clicks"),
            **_double(ctr="ctr", unique_ctr="unique_ctr")}


def _cpm(df: DataFrame) -> Column:
    cpm = F.col("cpm") if "cpm" in df.columns else ratio(F.col("spend") * 1000, "impressions")
    return safe_cast(cpm, "double")


def described_a(df: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """Groups of platform A rows with the labels, which follow from series and day."""
    return label_events(df, inputs.editions, ctx.as_of)


def described_b(df: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """Groups of platform B rows with series, status and labels, which follow from campaign and day."""
    return label_events(_with_status(_named_b(df, ctx), inputs, ctx), inputs.editions, ctx.as_of)


# Platform A ---------------------------------------------------------------

def a_campaign_performance(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """J9."""
    src = _newest(raw, ["date", "campaign_id"], ctx)
    typed = _typed(src, {**_head(_event_a(ctx), "campaign_id"), "channel_type": "advertising_channel_type",
                         **_delivery_a(src, cpc=False), "bidding_strategy_type": "bidding_strategy_type",
                         "currency": "currency"})
    return _finish(_with_status(typed, inputs, ctx),
                   [*HEAD, "channel_type", "cost", *COUNTS, *RATES, "bidding_strategy_type", "currency"], inputs, ctx)


def a_conversion_action(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """J10."""
    src = _newest(raw, ["date", "campaign_id", "conversion_action_id", "conversion_category"], ctx)
    typed = _typed(src, {**_head(_event_a(ctx), "campaign_id", "conversion_action_id"),
                         **_text("conversion_action_id"), "conversion_action_name": "conversion_action_name",
                         "conversion_category": "conversion_category",
                         **_double(conversions="conversions", conversion_value="conversions_value",
                                   all_conversions="all_conversions", all_conversions_value="all_conversions_value"),
                         "bidding_strategy_type": "bidding_strategy_type", "currency": "currency"})
    return _finish(_with_status(typed, inputs, ctx),
                   [*HEAD, "conversion_action_id", "conversion_action_name", "conversion_category", *CONVERSIONS,
                    "all_conversions", "all_conversions_value", "bidding_strategy_type", "currency"], inputs, ctx)


def a_performance(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """CPC is derived, plain conversions are not reported here."""
    src = _newest(raw, ["date", "campaign_id", "ad_group_id", "ad_id", "device", "ad_network_type"], ctx)
    blank = F.lit("")
    typed = _typed(src, {**_head(_event_a(ctx), "ad_id", F.coalesce("device", blank),
                                 F.coalesce("ad_network_type", blank)),
                         **_text("ad_group_id"), "ad_group_name": "ad_group_name", **_text("ad_id"),
                         "ad_name": "ad_name", "ad_type": "ad_type", **_delivery_a(src, cpc=False),
                         **_double(view_through_conversions="view_through_conversions",
                                   all_conversions="all_conversions"),
                         **_long(src, engagements="engagements"), "bidding_strategy_type": "bidding_strategy_type",
                         "device": "device", "ad_network_type": "ad_network_type", "currency": "currency"})
    missing = F.lit(None).cast("double")
    full = typed.withColumns({"average_cpc": ratio("cost", "clicks"), "conversions": missing,
                              "conversion_value": missing})
    return _finish(_with_status(full, inputs, ctx),
                   [*HEAD, *GROUP, *AD, "ad_type", "cost", "average_cpc", *COUNTS, *RATES, *CONVERSIONS,
                    "view_through_conversions", "all_conversions", "engagements", "bidding_strategy_type", "device",
                    "ad_network_type", "currency"], inputs, ctx)


def _axes(ages: DataFrame, genders: DataFrame, extra_keys: Sequence[str], ctx: Context, build) -> DataFrame:
    """Age and gender reports stacked, each with the other axis unspecified (H2)."""
    keys = ["date", "campaign_id", "ad_group_id"]
    age = build(_newest(ages, [*keys, "age_range", *extra_keys], ctx), "age", "age_range", {
        "age_group": recode("age_range", AGE_GROUPS, UNKNOWN), "gender": F.lit(UNSPECIFIED),
        "report_granularity": F.lit(AGE_ONLY)})
    gender = build(_newest(genders, [*keys, "gender", *extra_keys], ctx), "gender", "gender", {
        "age_group": F.lit(UNSPECIFIED), "gender": initcap_words("gender"),
        "report_granularity": F.lit(GENDER_ONLY)})
    return stack(age, gender)


def a_demographics(ages: DataFrame, genders: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """J12."""
    def build(src, axis, column, labels):
        return _typed(src, {**_head(_event_a(ctx), "campaign_id", "ad_group_id", F.lit(axis), column),
                            **_text("ad_group_id"), "ad_group_name": "ad_group_name", **labels, **_delivery_a(src),
                            **_double(conversions="conversions", conversion_value="conversions_value"),
                            "currency": "currency"})
    base = _axes(ages, genders, [], ctx, build)
    return _finish(_with_status(base, inputs, ctx),
                   [*HEAD, *GROUP, "age_group", "gender", "report_granularity", "cost", "average_cpc", *COUNTS,
                    *RATES, *CONVERSIONS, "currency"], inputs, ctx)


def a_demographic_conversions(ages: DataFrame, genders: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """Conversion grain, delivery metrics zeroed."""
    action = "conversion_action_name"

    def build(src, axis, column, labels):
        return zero_metrics(_typed(src, {
            **_head(_event_a(ctx), "campaign_id", "ad_group_id", F.lit(axis), column, action),
            **_text("ad_group_id"), "ad_group_name": "ad_group_name", **labels, action: action,
            **_double(conversions="conversions", conversion_value="conversions_value",
                      all_conversions="all_conversions", view_through_conversions="view_through_conversions"),
            "currency": "currency"}), ZERO_DELIVERY)
    base = _axes(ages, genders, [action], ctx, build)
    return _finish(_with_status(base, inputs, ctx),
                   [*HEAD, *GROUP, "age_group", "gender", "report_granularity", action, "cost", "average_cpc", *COUNTS,
                    *RATES, *CONVERSIONS, "all_conversions", "view_through_conversions", "currency"], inputs, ctx)


def a_geo(standard: DataFrame, restricted: DataFrame, targets: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """Campaigns of the restricted report leave the standard one."""
    place = ["geo_criterion_id", "location_type"]
    split = exclude_keys(standard, restricted, "campaign_id", ctx.null_aware)

    def build(src, group_id, group_name):
        return _typed(src, {
            **_head(_event_a(ctx), "campaign_id", F.coalesce(group_id, F.lit(NOT_AVAILABLE)), *place),
            "ad_group_id": F.coalesce(group_id, F.lit(NOT_AVAILABLE)),
            "ad_group_name": F.coalesce(group_name, F.lit(ctx.restricted_label)),
            "user_geo_criterion_id": F.lit(None).cast("string"), **_text("geo_criterion_id"),
            **_delivery_a(src), **_double(conversions="conversions", conversion_value="conversions_value",
                                          view_through_conversions="view_through_conversions",
                                          all_conversions="all_conversions"),
            "bidding_strategy_type": "bidding_strategy_type", "currency": "currency"})
    none = F.lit(None).cast("string")
    base = stack(
        build(_newest(split, ["date", "campaign_id", "ad_group_id", *place], ctx),
              F.col("ad_group_id").cast("string"), F.col("ad_group_name")),
        build(_newest(restricted, ["date", "campaign_id", *place], ctx), none, none))
    named = with_geo(base, targets, ["user_geo_criterion_id", "geo_criterion_id"], UNKNOWN)
    return _finish(_with_status(named, inputs, ctx),
                   [*HEAD, *GROUP, *GEO, "cost", "average_cpc", *COUNTS, *RATES, *CONVERSIONS,
                    "view_through_conversions", "all_conversions", "bidding_strategy_type", "currency"], inputs, ctx)


def a_user_location(raw: DataFrame, targets: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """Conversions by user location, delivery metrics zeroed."""
    keys = ["campaign_id", "user_geo_criterion_id", "location_type", "conversion_action_name"]
    src = _newest(raw, ["date", *keys], ctx)
    typed = zero_metrics(_typed(src, {
        **_head(_event_a(ctx), *keys), "ad_group_id": F.lit(NOT_AVAILABLE), "ad_group_name": F.lit(UNKNOWN),
        "user_geo_criterion_id": "user_geo_criterion_id", "location_type": "location_type",
        "conversion_action_name": "conversion_action_name",
        **_double(conversions="conversions", conversion_value="conversions_value", all_conversions="all_conversions",
                  all_conversions_value="all_conversions_value"),
        "bidding_strategy_type": F.lit(NOT_AVAILABLE), "currency": F.lit(NOT_AVAILABLE)}),
        {**ZERO_DELIVERY, "view_through_conversions": "double"})
    named = with_geo(typed, targets, ["user_geo_criterion_id"], UNKNOWN)
    return _finish(_with_status(named, inputs, ctx),
                   [*HEAD, *GROUP, "location_type", "conversion_action_name", *GEO, "cost", "average_cpc", *COUNTS,
                    *RATES, *CONVERSIONS, "view_through_conversions", "all_conversions", "all_conversions_value",
                    "bidding_strategy_type", "currency"], inputs, ctx)


def a_search_terms(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """Keeps the raw status, so the campaign dimension is not joined."""
    src = _newest(raw, ["date", "campaign_id", "ad_group_id", "search_term"], ctx)
    typed = _typed(src, {**_head(_event_a(ctx), "campaign_id", "ad_group_id", "search_term"),
                         "campaign_status": "campaign_status", **_text("ad_group_id"),
                         "ad_group_name": "ad_group_name", "search_term": "search_term", **_text("keyword_id"),
                         **_delivery_a(src, cpc=False, ctr=False),
                         **_double(conversions="conversions", conversion_value="conversions_value"),
                         "currency": "currency"})
    rate = ratio("clicks", "impressions")
    return _finish(typed.withColumns({"ctr": rate, "unique_ctr": rate}),
                   [*HEAD, *GROUP, "search_term", "keyword_id", "cost", *COUNTS, *RATES, *CONVERSIONS, "currency"],
                   inputs, ctx)


# Platform B ---------------------------------------------------------------

def _set_and_ad() -> dict[str, str | Column]:
    return {"ad_group_id": F.col("adset_id").cast("string"), "ad_group_name": "adset_name", **_text("ad_id"),
            "ad_name": "ad_name"}


def _unnamed_head() -> dict[str, str | Column]:
    return {name: c for name, c in _head(F.lit(None), "ad_id").items() if name != "event_name"}


def _finish_b(df: DataFrame, columns: Sequence[str], inputs: Inputs, ctx: Context) -> DataFrame:
    """Series, status and labels of rows of platform B, or none of them without editions."""
    if inputs.editions is None:
        return df.select(*[c for c in columns if c not in ("event_name", "campaign_status")])
    return _finish(_with_status(_named_b(df, ctx), inputs, ctx), columns, inputs, ctx)


def b_performance(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """J17. Without editions the rows come without series, status and labels."""
    src = _newest_b(raw, ["date", "campaign_id", "adset_id", "ad_id"], ctx)
    typed = _typed(src, {**_unnamed_head(), **_set_and_ad(), **_delivery_b(src), "cpm": _cpm(src),
                         **_double(conversions="conversions", conversion_value="conversion_value"),
                         **_long(src, reach="reach"), **_double(frequency="frequency"), "currency": "currency"})
    return _finish_b(typed, [*HEAD, *GROUP, *AD, "cost", "average_cpc", "cpm", *COUNTS, *RATES, *CONVERSIONS, "reach",
                             "frequency", "currency"], inputs, ctx)


def b_creative_performance(raw: DataFrame, bridge: DataFrame, creatives: DataFrame, inputs: Inputs,
                           ctx: Context) -> DataFrame:
    """Ad rows with the texts of their creative.

    The series is named after the join, whose shuffle need not carry it. Without
    editions the rows come without series, status and labels.
    """
    src = _newest_b(raw, ["date", "ad_id"], ctx)
    typed = _typed(src, {**_unnamed_head(), **_set_and_ad(), **_delivery_b(src), "cpm": _cpm(src),
                         **_double(conversions="conversions", conversion_value="conversion_value"),
                         **_long(src, reach="reach"), **_double(frequency="frequency"), "currency": "currency"})
    texts = ["headline", "body", "call_to_action_type", "destination_url", "image_url"]
    tie = [t for t in ctx.tie if t in creatives.columns]
    linked = with_creative(typed, bridge, creatives, texts, tie=tie, fan_out=ctx.fan_out)
    linked = linked.withColumnsRenamed({"headline": "ad_headline", "body": "ad_primary_text",
                                        "destination_url": "landing_page_url"})
    return _finish_b(linked, [*HEAD, *GROUP, *AD, "ad_headline", "ad_primary_text", "call_to_action_type",
                              "landing_page_url", "image_url", "cost", "average_cpc", "cpm", *COUNTS, *RATES,
                              *CONVERSIONS, "reach", "frequency", "currency"], inputs, ctx)


def b_conversion_action(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """J19."""
    src = _named_b(_newest_b(raw, ["date", "campaign_id", "adset_id", "ad_id", "conversion_action"], ctx), ctx)
    typed = _typed(src, {**_head(F.col("event_name"), "ad_id", "conversion_action"), **_set_and_ad(),
                         "conversion_action": "conversion_action",
                         **_double(conversions="conversions", conversion_value="conversion_value"),
                         "currency": "currency"})
    return _finish(_with_status(typed, inputs, ctx),
                   [*HEAD, *GROUP, *AD, "conversion_action", *CONVERSIONS, "currency"], inputs, ctx)


def b_demographics(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """J20."""
    keys = ["campaign_id", "adset_id", "ad_id", "age", "gender"]
    src = _named_b(_newest_b(raw, ["date", *keys], ctx), ctx)
    typed = _typed(src, {**_head(F.col("event_name"), *keys), "ad_group_id": F.col("adset_id").cast("string"),
                         "ad_group_name": "adset_name", "age_group": "age", "gender": initcap_words("gender"),
                         "report_granularity": F.lit(COMBINED), **_delivery_b(src),
                         **_double(conversions="conversions", conversion_value="conversion_value"),
                         "currency": "currency"})
    return _finish(_with_status(typed, inputs, ctx),
                   [*HEAD, *GROUP, "age_group", "gender", "report_granularity", "cost", "average_cpc", *COUNTS,
                    *RATES, *CONVERSIONS, "currency"], inputs, ctx)


def _actions(raw: DataFrame, keys: Sequence[str], ctx: Context) -> DataFrame:
    """Unnest the action JSON first, deduplicate per action second."""
    narrow = explode_actions(recent(raw, "date", ctx.recent_days, ctx.as_of),
                             names=("conversion_action_name", "_count", "_value"), strict=ctx.strict_json)
    tie = [t for t in ctx.tie if t in raw.columns]
    return latest(narrow, ["date", *keys, "conversion_action_name"], tie=tie)


def _action_metrics() -> dict[str, Column]:
    zero = F.lit(0.0)
    return {"conversion_action_name": F.col("conversion_action_name"),
            "conversions": F.coalesce("_count", zero), "conversion_value": F.coalesce("_value", zero),
            "all_conversions": zero, "view_through_conversions": zero}


def b_demographic_conversions(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """J21."""
    keys = ["campaign_id", "adset_id", "ad_id", "age", "gender"]
    src = _named_b(_actions(raw, keys, ctx), ctx)
    typed = zero_metrics(_typed(src, {
        **_head(F.col("event_name"), *keys, "conversion_action_name"),
        "ad_group_id": F.col("adset_id").cast("string"), "ad_group_name": "adset_name",
        "age_group": F.coalesce("age", F.lit(UNKNOWN)),
        "gender": initcap_words(F.coalesce("gender", F.lit(UNKNOWN))),
        "report_granularity": F.lit(AGE_AND_GENDER), **_action_metrics(), "currency": "currency"}), ZERO_DELIVERY)
    return _finish(_with_status(typed, inputs, ctx),
                   [*HEAD, *GROUP, "age_group", "gender", "report_granularity", "conversion_action_name", "cost",
                    "average_cpc", *COUNTS, *RATES, *CONVERSIONS, "all_conversions", "view_through_conversions",
                    "currency"], inputs, ctx)


def b_geo(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """A missing region makes the row country level."""
    keys = ["campaign_id", "adset_id", "ad_id", "country", "region"]
    src = _named_b(_newest_b(raw, ["date", *keys], ctx), ctx)
    region = F.col("region")
    level = F.when(region.isNull() | region.isin(list(ctx.missing_regions)), F.lit(COUNTRY_LEVEL)).otherwise(
        F.lit(REGION_LEVEL))
    typed = _typed(src, {**_head(F.col("event_name"), *keys), "adset_id": F.col("adset_id").cast("string"),
                         "adset_name": "adset_name", **_text("ad_id"), "ad_name": "ad_name", "region_name": "region",
                         "canonical_name": F.concat("region", F.lit(", "), "country"), "country_code": "country",
                         "geo_target_type": level, **_delivery_b(src),
                         **_double(conversions="conversions", conversion_value="conversion_value"),
                         "currency": "currency"})
    return _finish(_with_status(typed, inputs, ctx),
                   [*HEAD, "adset_id", "adset_name", *AD, *GEO, "cost", "average_cpc", *COUNTS, *RATES, *CONVERSIONS,
                    "currency"], inputs, ctx)


def b_geo_conversions(raw: DataFrame, inputs: Inputs, ctx: Context) -> DataFrame:
    """Country level conversions from the action JSON."""
    keys = ["campaign_id", "adset_id", "ad_id", "country"]
    src = _named_b(_actions(raw, keys, ctx), ctx)
    typed = zero_metrics(_typed(src, {
        **_head(F.col("event_name"), *keys, "conversion_action_name"),
        "ad_group_id": F.col("adset_id").cast("string"), "ad_group_name": "adset_name",
        "location_type": F.lit(TARGETED_LOCATION), "region_name": F.lit(UNKNOWN), "canonical_name": "country",
        "country_code": "country", "geo_target_type": F.lit(COUNTRY_LEVEL), **_action_metrics(),
        "bidding_strategy_type": F.lit(NOT_AVAILABLE), "currency": "currency"}), ZERO_DELIVERY)
    return _finish(_with_status(typed, inputs, ctx),
                   [*HEAD, *GROUP, "location_type", "conversion_action_name", *GEO, "cost", "average_cpc", *COUNTS,
                    *RATES, *CONVERSIONS, "view_through_conversions", "all_conversions", "bidding_strategy_type",
                    "currency"], inputs, ctx)


# CRM ----------------------------------------------------------------------

def platform_of(column: str, ctx: Context) -> Column:
    """Traffic source to platform."""
    rules = [Rule(p, equals=tuple(a), fold="lower") for p, a in ctx.source_aliases.items()]
    return first_match(column, rules, ctx.source_other)


def crm_dropped_sources(raw: DataFrame, ctx: Context) -> DataFrame:
    """Sources that belong to no known platform, with the orders that :func:`crm_conversions` leaves out."""
    rows = recent(raw, "date_submit", ctx.recent_days, ctx.as_of)
    known = F.coalesce(platform_of("utm_source", ctx).isin(list(ctx.source_aliases)), F.lit(False))
    return (rows.where(~known).groupBy(F.lower(F.trim("utm_source")).alias("utm_source"))
            .agg(F.count(F.lit(1)).alias("n_orders")))


def crm_conversions(raw: DataFrame, ctx: Context) -> DataFrame:
    """Cleaned orders of the known platforms."""
    def lowered(c):
        return F.lower(F.trim(c))
    trimmed = ["conference_series", "conference_editions", "city", "country", "region", "orders", "new_customer",
               "cut_off_rate", "order_type", "primary_language", "specialty"]
    src = recent(raw, "date_submit", ctx.recent_days, ctx.as_of)
    cleaned = src.select(
        F.col("id_commande").cast("string").alias("conversion_id"), F.col("date_submit").cast("date").alias("date"),
        F.col("date_time_submit").cast("timestamp").alias("conversion_timestamp"),
        F.coalesce(safe_cast("total_ht", "double"), F.lit(0.0)).alias("revenue"), F.trim("currency").alias("currency"),
        lowered("utm_source").alias("utm_source"), lowered("utm_medium").alias("utm_medium"),
        lowered("utm_campaign").alias("campaign_name"), platform_of("utm_source", ctx).alias("platform"), "year",
        *[F.trim(c).alias(c) for c in trimmed])
    return cleaned.where(F.col("platform").isin(list(ctx.source_aliases)))
