"""Everything a build needs besides tables: the date, vocabularies, options."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from ..functions.rules import Keep, Rule
from ..operators.editions import EditionRule
from ..operators.lookup import DEFAULT_BOUND, Bound


@dataclass(frozen=True)
class ConversionRules:
    """Classes of one platform's actions, metric routing and value guard."""

    classes: tuple[Rule, ...]
    default: str = "OTHER"
    secondary: tuple[Rule, ...] = ()
    allow_value: tuple[Rule, ...] = ()
    deny_value: tuple[Rule, ...] = ()


@dataclass(frozen=True)
class Context:
    """Parameters of one build; vocabularies are the caller's data.

    ``as_of`` replaces the wall clock (N7). ``recent_days`` limits raw rows in
    development runs (C1). ``tie`` names columns that settle equal ingestion
    stamps (N8). ``collapse_ids`` keeps one row per surrogate id, as a rank over
    that id would (N3); by default no row is lost. ``null_aware`` and
    ``fan_out`` select the literal SQL reading of N9 and N12. ``read_again``
    reads reports of B again to keep most rows out of the dedup shuffle; the
    rows are the same without it, which suits results of few columns.
    """

    as_of: date
    platform_a: str = "Platform A"
    platform_b: str = "Platform B"
    account_rules: tuple[Rule, ...] = ()
    campaign_rules: tuple[Rule, ...] = ()
    # Labels of rows that no rule names.
    campaign_default: str = "Other/Unmapped"
    edition_rules: tuple[EditionRule, ...] = ()
    window_days: int = 400
    series_rules: tuple[Rule, ...] = ()
    series_default: str = "Unmapped Event"
    source_aliases: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    source_other: str = "Other"
    new_customer_values: tuple[str, ...] = ()
    conversions_a: ConversionRules = ConversionRules(())
    conversions_b: ConversionRules = ConversionRules(())
    geo_conversions_a: ConversionRules = ConversionRules(())
    geo_conversions_b: ConversionRules = ConversionRules(())
    geo_keep: Mapping[str, Keep] = field(default_factory=dict)
    channel_b: str = "Social"
    restricted_label: str = "Restricted"
    phrase_placeholder: str = "_unknown_creative_"
    missing_regions: tuple[str, ...] = ("",)
    recent_days: int | None = None
    tie: tuple[str, ...] = ()
    collapse_ids: bool = False
    null_aware: bool = False
    fan_out: bool = False
    read_again: bool = True
    strict_json: bool = False
    bound: Bound = DEFAULT_BOUND
