"""Nearest calendar edition and the labels derived from it.

The window condition needs no range join. An edition covers ``window_days + 1``
dates, so the calendar is unfolded to one row per (series, date) holding the
nearest edition, which the fact meets in a plain equi join. Its size is the
calendar times a constant, whatever the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import dates
from .lookup import DEFAULT_BOUND, Bound, lookup, measure

# Edition columns carried to the fact, in comparison order after the distance.
CARRIED = ("event_start_date", "conference_editions", "event_end_date", "seb_end_date", "eb_end_date",
           "advance_end_date", "fp_end_date")
DISTANCE = "edition_distance"
LABELS = ("event_edition", "cut_off_rate", "cut_off_rate_sort_order", "week", "week_number",
          "week_number_to_sort", "weeks_left")


@dataclass(frozen=True)
class EditionRule:
    """Editions of ``series``: any ``like`` pattern and no ``not_like`` one (D3)."""

    series: str
    like: tuple[str, ...]
    not_like: tuple[str, ...] = ()


@dataclass(frozen=True)
class Editions:
    """Prepared (series, date) lookup and whether it passed the size check."""

    days: DataFrame
    small: bool


def match_series(calendar: DataFrame, rules: Sequence[EditionRule], edition: str = "conference_editions") -> DataFrame:
    """One row per edition and matching series; no join, one pass."""
    name = F.col(edition)
    labels = []
    for rule in rules:
        test = reduce(lambda a, b: a | b, [name.like(p) for p in rule.like])
        for pattern in rule.not_like:
            test = test & ~name.like(pattern)
        labels.append(F.when(test, F.lit(rule.series)))
    return calendar.withColumn("series", F.explode(F.array_distinct(F.array_compact(F.array(*labels)))))


def edition_days(matched: DataFrame, window_days: int = 400) -> DataFrame:
    """Nearest edition of every (series, date) inside a window.

    A date is in the window when ``end - window_days <= date <= end``. Equal
    distances go to the earlier start, then to the smaller edition name.
    """
    end, start = F.col("event_end_date"), F.col("event_start_date")
    unfolded = (matched.where(end.isNotNull())
                .withColumn("date", F.explode(F.sequence(F.date_sub(end, window_days), end))))
    distance = F.abs(F.datediff(F.col("date"), start)).alias(DISTANCE)
    best = unfolded.groupBy("series", "date").agg(F.min(F.struct(distance, *CARRIED)).alias("e"))
    return best.select("series", "date", "e.*")


def prepare_editions(calendar: DataFrame, rules: Sequence[EditionRule], window_days: int = 400,
                     bound: Bound = DEFAULT_BOUND) -> Editions:
    """Build the lookup once per mart; its size is checked on the calendar."""
    matched = match_series(calendar.select(*CARRIED), rules)
    days = edition_days(matched, window_days)
    rows, size = measure(matched)
    factor = window_days + 1
    return Editions(days, rows * factor <= bound.max_rows and size * factor <= bound.max_bytes)


def nearest_edition(fact: DataFrame, editions: Editions, series: str = "event_name", day: str = "date") -> DataFrame:
    """Fact with the columns of its nearest edition; unmatched rows keep NULLs."""
    days = editions.days.withColumnsRenamed({"series": series, "date": day})
    return lookup(fact, days, [series, day], small=editions.small)


def label_events(fact: DataFrame, editions: Editions, as_of: date, series: str = "event_name",
                 keep_distance: bool = False) -> DataFrame:
    """Edition, pricing tier, countdown week and weeks left."""
    day, edition, start = F.col("date"), F.col("conference_editions"), F.col("event_start_date")
    joined = nearest_edition(fact, editions, series).withColumns({
        "event_edition": F.coalesce(edition, F.col(series)),
        "cut_off_rate": dates.tier(day, edition),
        "week_number": dates.countdown_week(day, edition, start),
        "weeks_left": dates.weeks_left(edition, start, as_of),
    })
    labelled = joined.withColumns({
        "cut_off_rate_sort_order": dates.tier_order("cut_off_rate"),
        "week": dates.week_label("week_number"),
        "week_number_to_sort": F.col("week_number"),
    })
    return labelled.drop(*CARRIED, *([] if keep_distance else [DISTANCE]))
