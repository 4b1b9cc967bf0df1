"""Calendar of editions: builder for one region, union of regions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.casts import safe_date
from ..functions.rules import recode
from ..functions.text import replace_in_order
from ..operators.lookup import lookup, one_per_key
from ..operators.stack import stack

CALENDAR: tuple[tuple[str, str], ...] = (
    ("region", "string"), ("year", "int"), ("conference_editions", "string"),
    ("event_start_date", "date"), ("event_end_date", "date"), ("seb_start_date", "date"), ("seb_end_date", "date"),
    ("eb_start_date", "date"), ("eb_end_date", "date"), ("advance_start_date", "date"), ("advance_end_date", "date"),
    ("fp_start_date", "date"), ("fp_end_date", "date"), ("onsite_start_date", "date"), ("onsite_end_date", "date"),
)


@dataclass(frozen=True)
class YearException:
    """Titles containing ``keyword``: all from ``from_year``, older ones by id."""

    keyword: str
    from_year: int
    old_years: tuple[int, int]
    old_ids: tuple[int, ...]


@dataclass(frozen=True)
class CalendarSpec:
    """Vocabulary of the calendar builder."""

    replacements: tuple[tuple[str, str], ...] = ()
    patterns: tuple[str, ...] = ()
    series_names: Mapping[str, str] | None = None
    prefix_allow: Mapping[str, tuple[str, ...]] | None = None
    year_exceptions: tuple[YearException, ...] = ()
    min_year: int = 0
    excluded_series: tuple[str, ...] = ()
    only_year: Mapping[str, int] | None = None
    country_code_series: tuple[str, ...] = ()


def clean_events(events: DataFrame, spec: CalendarSpec, countries: DataFrame | None = None) -> DataFrame:
    """Titles to (year, series, edition), filtered by the lists of ``spec``."""
    title, series, year = F.col("original_title"), F.col("conference_series"), F.col("year")
    df = events.withColumn("original_title", replace_in_order("original_title", spec.replacements))
    df = df.where(reduce(lambda a, b: a | b, [title.contains(p) for p in spec.patterns]))
    df = df.withColumns({
        "year": F.regexp_extract(title, r"(\d{4})", 1).try_cast("int"),
        "conference_series": F.regexp_replace(title, r" \d{4}.*", ""),
    })
    if spec.series_names:
        df = df.withColumn("conference_series", recode(series, spec.series_names, series))
    for prefix, allowed in (spec.prefix_allow or {}).items():
        df = df.where(~(series.startswith(prefix) & ~series.isin(list(allowed))))
    for rule in spec.year_exceptions:
        old = year.between(*rule.old_years) & F.col("id_manifestation").isin(list(rule.old_ids))
        df = df.where(~title.contains(rule.keyword) | (year >= rule.from_year) | old)
    df = df.where(year >= spec.min_year)
    if spec.excluded_series:
        df = df.where(~series.isin(list(spec.excluded_series)))
    for name, only in (spec.only_year or {}).items():
        df = df.where(~((series == name) & (year != only)))
    edition = F.concat(year.cast("string"), F.lit(" "), series)
    if spec.country_code_series:
        # The code is appended even when it is unknown, leaving a blank.
        names = countries.select(F.col("country_name").alias("host_nation"), F.col("country_code").alias("_code"))
        df = lookup(df, one_per_key(names, ["host_nation"]), ["host_nation"])
        suffix = F.concat(F.lit(" "), F.coalesce("_code", F.lit("")))
        edition = F.when(series.isin(list(spec.country_code_series)), F.concat(edition, suffix)).otherwise(edition)
    return df.withColumn("conference_editions", edition).select(
        "id_manifestation", "event_start_date", "event_end_date", "year", "conference_series", "conference_editions")


def rate_bounds(rates: DataFrame) -> DataFrame:
    """Tier boundaries per event from the earliest and latest rate rows."""
    return rates.groupBy("id_manifestation").agg(
        F.min("date1").alias("seb_start_date"), F.min("date2").alias("seb_end_date"),
        F.max("date1").alias("eb_start_date"), F.max("date2").alias("eb_end_date"))


def build_calendar(events: DataFrame, rates: DataFrame, spec: CalendarSpec, countries: DataFrame | None = None) -> DataFrame:
    """Events with rates to one row per edition."""
    cleaned = clean_events(events, spec, countries)
    joined = rate_bounds(rates).join(cleaned, "id_manifestation")
    full = joined.withColumns({
        "fp_start_date": F.date_add("eb_end_date", 1),
        "fp_end_date": F.date_sub("event_start_date", 1),
        "onsite_start_date": F.col("event_start_date"),
        "onsite_end_date": F.col("event_end_date"),
    })
    return full.select(
        "id_manifestation", "year", "conference_series", "conference_editions", "event_start_date", "event_end_date",
        "seb_start_date", "seb_end_date", "eb_start_date", "eb_end_date", "fp_start_date", "fp_end_date",
        "onsite_start_date", "onsite_end_date").distinct()


def calendar_checks(calendar: DataFrame, valid_series: Sequence[str]) -> DataFrame:
    """Counts of unknown series and of missing dates."""
    dated = ("seb_start_date", "seb_end_date", "eb_start_date", "eb_end_date", "fp_end_date",
             "onsite_start_date", "onsite_end_date")
    known = F.coalesce(F.col("conference_series").isin(list(valid_series)), F.lit(False))
    counts = calendar.agg(F.count_if(~known).alias("unknown_series"),
                          *[F.count_if(F.col(c).isNull()).alias(c) for c in dated])
    pairs = [F.struct(F.lit(c).alias("check_name"), F.col(c).alias("n_rows")) for c in ("unknown_series", *dated)]
    return counts.select(F.inline(F.array(*pairs)))


def unify_calendar(region1: DataFrame, region2: DataFrame, names: tuple[str, str],
                   header_marker: str = "conference_editions") -> DataFrame:
    """Typed and text calendars to one.

    Stacked by name: each boundary keeps its meaning in both regions (N4).
    """
    missing = F.lit(None).cast("date")
    first = region1.withColumns({
        "region": F.lit(names[0]), "year": F.year("event_start_date"),
        "advance_start_date": missing, "advance_end_date": missing})
    rows = region2.where(F.col("conference_editions") != F.lit(header_marker))
    start, end = safe_date("event_start_date"), safe_date("event_end_date")
    second = rows.select(
        F.lit(names[1]).alias("region"), F.year(start).alias("year"), "conference_editions",
        start.alias("event_start_date"), end.alias("event_end_date"),
        missing.alias("seb_start_date"), safe_date("seb_end_date").alias("seb_end_date"),
        safe_date("eb_start_date").alias("eb_start_date"), safe_date("eb_end_date").alias("eb_end_date"),
        safe_date("advance_start_date").alias("advance_start_date"),
        safe_date("advance_end_date").alias("advance_end_date"),
        safe_date("standard_start_date").alias("fp_start_date"), safe_date("standard_end_date").alias("fp_end_date"),
        start.alias("onsite_start_date"), end.alias("onsite_end_date"))
    columns = [name for name, _ in CALENDAR]
    return stack(first.select(columns), second)
