"""Build of silver models and marts from landed tables, and the daily load of one table.

A build reads every raw table by its registry name through one function, for
landed tables :func:`landed`, and prepares shared small sides once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.editions import prepare_editions
from ..sources import schemas
from ..sources.claims import Folder, changes
from ..sources.load import materialize, next_window, open_table, recover, reload_range, replace_days
from ..sources.tables import read_table
from . import gold, silver
from .context import Context

#: Marts whose rows come from raw rows of their own day.
DAILY = ("campaign", "conversion", "ad", "demographics", "geo", "targeted_geo", "phrases")
Read = Callable[[str], DataFrame]


def landed(spark: SparkSession, root: str) -> Read:
    """Reader of the landed tables below ``root``."""
    return lambda name: read_table(spark, root, name)


def load_increment(spark: SparkSession, root: str, name: str, extract: Callable[[date, date], DataFrame],
                   accounts: Sequence[str], first: date, today: date) -> tuple[date, date] | None:
    """Land the next window of a table (B7, B1): newest day minus its lookback, to ``today``.

    ``extract`` gives the stamped rows of a range of days. Returns the window, or
    None if there were no rows and the table stayed as it was.
    """
    path = f"{root}/{name}"
    recover(spark, path)
    target = open_table(spark, path, schemas.raw_schema(name))
    start, end = next_window(target, schemas.lookback_days(name), first, today)
    keys = schemas.CLUSTER.get(name, schemas.DEFAULT_CLUSTER)
    return (start, end) if reload_range(extract(start, end), path, start, end, accounts, keys) else None


class Build:
    """The silver models and marts of one build; shared small sides are prepared once."""

    def __init__(self, read: Read, ctx: Context):
        self.raw, self.ctx, self._cache = read, ctx, {}

    def _once(self, key: str, build):
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def _editions(self):
        return prepare_editions(self.raw("calendar"), self.ctx.edition_rules, self.ctx.window_days, self.ctx.bound)

    def _inputs(self, platform: str) -> silver.Inputs:
        ed = self._once("editions", self._editions)
        if platform == "a":
            states = self._once("a", lambda: silver.states_a(self.raw("a_campaign_dim"), self.ctx))
        else:
            states = self._once("b", lambda: silver.states_b(self.raw("b_campaign_dim"), self.ctx))
        return silver.Inputs(ed, states)

    def a_campaign(self):
        return silver.a_campaign_performance(self.raw("a_campaign_performance"), self._inputs("a"), self.ctx)

    def a_conversion(self):
        return silver.a_conversion_action(self.raw("a_conversion_action"), self._inputs("a"), self.ctx)

    def a_performance(self):
        return silver.a_performance(self.raw("a_performance"), self._inputs("a"), self.ctx)

    def a_demographics(self):
        return silver.a_demographics(self.raw("a_age_range"), self.raw("a_gender"), self._inputs("a"), self.ctx)

    def a_demo_conversions(self):
        return silver.a_demographic_conversions(self.raw("a_age_conversions"), self.raw("a_gender_conversions"),
                                                self._inputs("a"), self.ctx)

    def a_geo(self):
        return silver.a_geo(self.raw("a_geo"), self.raw("a_geo_restricted"), self.raw("geo_targets"),
                            self._inputs("a"), self.ctx)

    def a_user_location(self):
        return silver.a_user_location(self.raw("a_user_location_conversions"), self.raw("geo_targets"),
                                      self._inputs("a"), self.ctx)

    def a_search_terms(self):
        ed = self._once("editions", self._editions)
        return silver.a_search_terms(self.raw("a_search_terms"), silver.Inputs(ed), self.ctx)

    def b_performance(self):
        return silver.b_performance(self.raw("b_performance"), self._inputs("b"), self.ctx)

    def b_creative(self):
        return silver.b_creative_performance(self.raw("b_performance"), self.raw("b_ad_dim"),
                                             self.raw("b_creative_dim"), self._inputs("b"), self.ctx)

    def b_conversion(self):
        return silver.b_conversion_action(self.raw("b_conversion_action"), self._inputs("b"), self.ctx)

    def b_demographics(self):
        return silver.b_demographics(self.raw("b_age_gender"), self._inputs("b"), self.ctx)

    def b_demo_conversions(self):
        return silver.b_demographic_conversions(self.raw("b_age_gender_conversions"), self._inputs("b"), self.ctx)

    def b_geo(self):
        return silver.b_geo(self.raw("b_region"), self._inputs("b"), self.ctx)

    def b_geo_conversions(self):
        return silver.b_geo_conversions(self.raw("b_country"), self._inputs("b"), self.ctx)

    def crm(self):
        return silver.crm_conversions(self.raw("crm_orders"), self.ctx)

    def ad_mart(self):
        return gold.ad_mart(self.a_performance(), self.b_performance(), self.ctx)

    def phrase_source(self):
        return gold.phrase_source(self.a_search_terms(), self.b_creative(), self.ctx)

    def phrase_parts(self):
        """The phrases of each platform, described once they are grouped; ids that collapse rows need the labels first."""
        if self.ctx.collapse_ids or self.ctx.platform_a == self.ctx.platform_b:
            return [gold.Phrases(self.phrase_source())]
        a, b = silver.Inputs(self._once("editions", self._editions)), self._inputs("b")
        terms = silver.a_search_terms(self.raw("a_search_terms"), silver.Inputs(), self.ctx)
        creatives = silver.b_creative_performance(self.raw("b_performance"), self.raw("b_ad_dim"),
                                                  self.raw("b_creative_dim"), silver.Inputs(), self.ctx)
        return [gold.Phrases(gold.term_phrases(terms, self.ctx), lambda df: silver.described_a(df, a, self.ctx)),
                gold.Phrases(gold.creative_phrases(creatives, self.ctx), lambda df: silver.described_b(df, b, self.ctx))]

    def roi_mart(self):
        return gold.roi_mart(self.ad_mart(), self.crm(), self.ctx)

    def campaign_mart(self):
        if self.ctx.collapse_ids or not self.ctx.read_again:
            return gold.campaign_mart(self.a_campaign(), self.b_performance(), self.ctx)
        bare, inputs = silver.b_performance(self.raw("b_performance"), silver.Inputs(), self.ctx), self._inputs("b")
        return gold.campaign_mart(self.a_campaign(), bare, self.ctx, lambda df: silver.described_b(df, inputs, self.ctx))

    def conversion_mart(self):
        return gold.conversion_mart(self.a_conversion(), self.b_conversion(), self.ctx)

    def demographics_mart(self):
        return gold.demographics_mart(self.a_demographics(), self.b_demographics(), self.ctx)

    def geo_mart(self):
        return gold.geo_mart(self.a_geo(), self.b_geo(), self.raw("countries"), self.ctx)

    def targeted_geo_mart(self):
        return gold.targeted_geo_mart(self.a_user_location(), self.b_geo_conversions(), self.raw("countries"), self.ctx)

    def phrases_mart(self):
        return gold.phrases_mart(self.phrase_parts())

    def write(self, name: str, root: str) -> DataFrame:
        """Rebuild the mart ``name`` of ``gold.CLUSTER`` below ``root``, by day and sorted by its keys."""
        return materialize(getattr(self, f"{name}_mart")(), f"{root}/{name}", gold.CLUSTER[name])

    def _reading(self, read: Read) -> Build:
        """The same build with another reader of raw tables."""
        other = object.__new__(type(self))
        other.__dict__ = {**self.__dict__, "raw": read, "_cache": {}}
        return other

    def sources(self, name: str) -> list[str]:
        """The raw tables with a day that the mart ``name`` reads."""
        seen = set()

        def read(table: str) -> DataFrame:
            df = self.raw(table)
            if "date" in df.columns:
                seen.add(table)
            return df

        getattr(self._reading(read), f"{name}_mart")()
        return sorted(seen)

    def of_days(self, name: str, days: Sequence[date]) -> DataFrame:
        """The mart ``name`` for some days, from those days of its raw tables.

        Every row of the marts in ``DAILY`` comes from raw rows of its own day.
        """
        if name not in DAILY:
            raise ValueError(f"{name} is not built day by day")
        inside = F.col("date").cast("date").isin(list(days))

        def read(table: str) -> DataFrame:
            df = self.raw(table)
            return df.where(inside) if "date" in df.columns else df

        return getattr(self._reading(read), f"{name}_mart")()

    def refresh(self, spark: SparkSession, name: str, root: str, raw_root: str) -> list[date] | None:
        """Rebuild the days of a written mart whose raw tables below ``raw_root`` have changed since it was last built.

        Returns the days, or None if the whole mart was written: the first
        time, or after a raw table was replaced whole. What has been built is
        noted beside the mart after the swap, so a stopped refresh runs again.
        """
        path = f"{root}/{name}"
        notes = Folder(spark, f"{path}__seen")
        seen = json.loads(notes.read("changes")) if notes.exists("changes") else None
        parts, now = set(), {}
        for table in self.sources(name):
            own, now[table] = changes(spark, f"{raw_root}/{table}", (seen or {}).get(table, ""))
            parts = None if own is None or parts is None else parts | own
        days = None
        if seen is None or parts is None:
            self.write(name, root)
        else:
            days = sorted(date.fromisoformat(p.partition("=")[2]) for p in parts)
            if days:
                replace_days(self.of_days(name, days), path, days, gold.CLUSTER[name])
        notes.delete("changes")
        notes.write("changes", json.dumps(now))
        return days
