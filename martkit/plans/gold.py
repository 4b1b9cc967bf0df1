"""Marts (J25-J33): both platforms aligned by name and stacked."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.casts import ratio
from ..functions.dates import date_parts
from ..functions.keys import surrogate_key
from ..functions.rules import first_match, flag_in, guard_value, keep_classes, route_metric
from ..functions.text import phrase_text, shorten, tokens
from ..operators.lookup import with_country
from ..operators.rollup import DELIVERY_RATIOS, phrase_totals, rollup, rollup_direct, rollup_once, top_phrases
from ..operators.stack import align, stack
from .context import Context, ConversionRules

Schema = tuple[tuple[str, str], ...]


def _schema(*ddl: str) -> Schema:
    return tuple(tuple(part.strip().rsplit(" ", 1)) for text in ddl for part in text.split(","))


# Names, types and order of the mart columns.
_DATES = "unique_id bigint, platform string, date date, year int, month int, day int, week_display string"
_SORT = "week_number int, week_number_to_sort int, weeks_left string"
_EVENT = "event_name string, event_edition string, account_id string, account_name string"
_CAMPAIGN = "campaign_id string, campaign_name string, campaign_status string"
_TIER = "cut_off_rate string, cut_off_rate_sort_order int"
_COUNTS = "impressions bigint, clicks bigint, unique_clicks bigint"
_RATES = "ctr double, unique_ctr double, average_cpc double"
_CONV = "conversions double, conversion_value double"
_GEO = "country_code string, region_name string, canonical_name string, geo_target_type string"

CAMPAIGN = _schema(_DATES, _SORT, _EVENT, _CAMPAIGN, _TIER, "channel_type string, bidding_strategy_type string",
                   "cost double", _COUNTS, _RATES, "currency string")
CONVERSION = _schema(_DATES, _SORT, _EVENT, _CAMPAIGN, "ad_group_name string, ad_name string", _TIER,
                     "conversion_name string, conversion_raw_category string, standardized_conversion_type string",
                     _CONV, "currency string")
AD = _schema(_DATES, "week_number int, weeks_left string", _EVENT, "campaign_name string, campaign_status string",
             "ad_group_id string, ad_group_name string, ad_id string, ad_name string", _TIER, "cost double", _COUNTS,
             _CONV, _RATES, "view_through_conversions double, all_conversions double, engagements bigint",
             "bidding_strategy_type string, ad_network_type string, cpm double, reach bigint, frequency double",
             "currency string, device_type string")
DEMOGRAPHICS = _schema(_DATES, _SORT, _EVENT, _CAMPAIGN, "age_group string, gender string, report_granularity string",
                       _TIER, "cost double, average_cpc double", _COUNTS, "ctr double, unique_ctr double", _CONV,
                       "currency string")
GEO = _schema(_DATES, _SORT, _EVENT, _CAMPAIGN, _TIER, _GEO, "cost double", _COUNTS, _CONV, _RATES, "currency string")
TARGETED_GEO = _schema(_DATES, _SORT, _EVENT, _CAMPAIGN, _TIER, _GEO, "location_type string",
                       "conversion_action_name string, standardized_conversion_type string, cost double", _COUNTS,
                       _CONV, _RATES, "currency string")
ROI = _schema("date date, year int, platform string, campaign_name string, currency string, event_name string",
              "conversion_timestamp timestamp, conference_series string, conference_editions string, city string",
              "country string, region string, orders string, new_customer string, cut_off_rate string",
              "order_type string, primary_language string, specialty string, utm_source string, utm_medium string",
              "cost double, impressions bigint, clicks bigint, revenue double, total_sales bigint",
              "new_customers_count bigint")
PHRASE_KEYS = ("date", "platform", "year", "month", "day", "event_edition", "event_name", "campaign_id",
               "campaign_name", "campaign_status", "week_display", "week_number", "week_number_to_sort", "weeks_left",
               "cut_off_rate", "cut_off_rate_sort_order", "word", "top_search_combinations")
PHRASE_METRICS = ("cost", "impressions", "clicks", "unique_clicks", "ctr", "unique_ctr", "average_cpc", "conversions",
                  "conversion_value", "currency")
SUMMED = ("cost", "impressions", "clicks", "unique_clicks")
WORD_SUMS = (*SUMMED, "conversions", "conversion_value")

# Partition by date and sort by these inside each file.
CLUSTER: dict[str, tuple[str, ...]] = {
    "campaign": ("platform", "event_name", "campaign_name"),
    "conversion": ("platform", "event_name", "standardized_conversion_type"),
    "ad": ("platform", "event_name", "campaign_name"),
    "demographics": ("platform", "event_name", "campaign_name"),
    "geo": ("platform", "event_name", "country_code"),
    "targeted_geo": ("platform", "event_name", "country_code"),
    "phrases": ("platform", "event_edition", "word"),
    "roi": ("platform", "campaign_name", "event_name"),
}


def _mart(silver: DataFrame, platform: str, schema: Schema, **fills: object) -> DataFrame:
    """Silver rows in mart shape: platform label, date parts, renamed id and week."""
    parts = dict(zip(("year", "month", "day"), date_parts("date"), strict=True))
    base = {"unique_id": F.col("id"), "platform": platform, "week_display": F.col("week"), **parts}
    return align(silver, schema, {**base, **fills})


def campaign_mart(a: DataFrame, b: DataFrame, ctx: Context, describe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Campaign rows of A, ad rows of B rolled up to campaign and day.

    ``describe`` gives groups of bare rows of B the attributes that follow from campaign and day.
    """
    attrs = ["week", "week_number", "week_number_to_sort", "weeks_left", "event_name", "event_edition", "account_id",
             "account_name", "campaign_name", "campaign_status", "cut_off_rate", "cut_off_rate_sort_order", "currency"]
    if ctx.read_again:
        # A campaign's days stay together, so what is shuffled next holds like rows side by side.
        rolled = rollup_direct(b, ["campaign_id", "date"], SUMMED, attrs, DELIVERY_RATIOS, by=["campaign_id"], describe=describe)
    else:
        rolled = rollup_once(describe(b) if describe else b, ["date", "campaign_id"], SUMMED, attrs, DELIVERY_RATIOS)
    rolled = rolled.withColumns({"id": surrogate_key("date", "campaign_id"), "channel_type": F.lit(ctx.channel_b)})
    return stack(_mart(a.withColumn("average_cpc", ratio("cost", "clicks")), ctx.platform_a, CAMPAIGN),
                 _mart(rolled, ctx.platform_b, CAMPAIGN))


def _classified(df: DataFrame, rules: ConversionRules, name: str, route: bool) -> dict[str, Column]:
    out = {"standardized_conversion_type": first_match(name, rules.classes, rules.default),
           "conversion_value": guard_value("conversion_value", rules.allow_value, rules.deny_value, name)}
    if route:
        out["conversions"] = route_metric(rules.secondary, "all_conversions", "conversions", name)
    return out


def conversion_mart(a: DataFrame, b: DataFrame, ctx: Context) -> DataFrame:
    """Classified conversions."""
    none = F.lit(None)
    left = _mart(a, ctx.platform_a, CONVERSION, ad_group_name=none, ad_name=none,
                 conversion_name=F.col("conversion_action_name"), conversion_raw_category=F.col("conversion_category"),
                 **_classified(a, ctx.conversions_a, "conversion_action_name", True))
    right = _mart(b, ctx.platform_b, CONVERSION, conversion_name=F.col("conversion_action"),
                  conversion_raw_category=F.col("conversion_action"),
                  **_classified(b, ctx.conversions_b, "conversion_action", False))
    return stack(left, right)


def ad_mart(a: DataFrame, b: DataFrame, ctx: Context) -> DataFrame:
    """Ad rows, platform specific metrics padded with NULLs."""
    return stack(_mart(a, ctx.platform_a, AD, device_type=F.col("device")), _mart(b, ctx.platform_b, AD))


def demographics_mart(a: DataFrame, b: DataFrame, ctx: Context) -> DataFrame:
    """J28."""
    return stack(_mart(a, ctx.platform_a, DEMOGRAPHICS), _mart(b, ctx.platform_b, DEMOGRAPHICS))


def geo_mart(a: DataFrame, b: DataFrame, countries: DataFrame, ctx: Context) -> DataFrame:
    """Geo rows with country names."""
    rows = stack(_mart(a, ctx.platform_a, GEO), _mart(b, ctx.platform_b, GEO))
    return with_country(rows, countries).select(*[n for n, _ in GEO], "country_name")


def targeted_geo_mart(a: DataFrame, b: DataFrame, countries: DataFrame, ctx: Context) -> DataFrame:
    """Classified geo conversions, per-platform class filter.

    The filter runs before the name lookup; it only reads mart columns.
    """
    name = "conversion_action_name"
    rows = stack(_mart(a, ctx.platform_a, TARGETED_GEO, **_classified(a, ctx.geo_conversions_a, name, True)),
                 _mart(b, ctx.platform_b, TARGETED_GEO, **_classified(b, ctx.geo_conversions_b, name, False)))
    kept = keep_classes(rows, "platform", "standardized_conversion_type", ctx.geo_keep)
    return with_country(kept, countries).select(*[n for n, _ in TARGETED_GEO], "country_name")


_PHRASE = _schema("date date, platform string", _EVENT, _CAMPAIGN, "week_display string", _SORT, _TIER,
                  "raw_text string, cost double", _COUNTS, _CONV, "currency string")


@dataclass(frozen=True)
class Phrases:
    """Phrases of one platform, and what gives groups of them the columns that follow from their other keys."""

    rows: DataFrame
    describe: Callable[[DataFrame], DataFrame] | None = None

    def grouped(self, keys: Sequence[str], group: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
        """Rows grouped by ``keys``; those that follow from the others are added to the groups, so no shuffle has them."""
        out = group(self.rows, [k for k in keys if k in self.rows.columns])
        if self.describe:
            out = self.describe(out).withColumnRenamed("week", "week_display")
        return out.select(*keys, *[c for c in out.columns if c not in keys and c not in _NAMES])


_NAMES = {name for name, _ in _PHRASE} - {"raw_text"} - {name for name in (*SUMMED, "conversions", "conversion_value", "currency")}


def _phrases(rows: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Rows in the shape of phrases; rows without labels stay without them."""
    there = {*rows.columns, *fills} if "week" not in rows.columns else {n for n, _ in _PHRASE}
    return align(rows, [(n, t) for n, t in _PHRASE if n in there], fills)


def term_phrases(terms: DataFrame, ctx: Context) -> DataFrame:
    """Typed search terms of A."""
    week = {"week_display": F.col("week")} if "week" in terms.columns else {}
    return _phrases(terms.where(F.col("search_term").isNotNull()),
                    {"platform": ctx.platform_a, "raw_text": F.col("search_term"), **week})


def creative_phrases(creatives: DataFrame, ctx: Context) -> DataFrame:
    """Shown creative texts of B."""
    week = {"week_display": F.col("week")} if "week" in creatives.columns else {}
    shown = phrase_text("ad_headline", "ad_primary_text", ctx.phrase_placeholder)
    return _phrases(creatives, {"platform": ctx.platform_b, "raw_text": shown, **week})


def phrase_source(terms: DataFrame, creatives: DataFrame, ctx: Context) -> DataFrame:
    """Typed search terms of A and shown creative texts of B, stacked."""
    return stack(term_phrases(terms, ctx), creative_phrases(creatives, ctx))


def phrase_mart(terms: DataFrame, creatives: DataFrame, ctx: Context) -> DataFrame:
    """Daily statistics per exact phrase."""
    return phrases_mart([Phrases(phrase_source(terms, creatives, ctx))])


def _parts(source: DataFrame | Sequence[Phrases]) -> Sequence[Phrases]:
    return [Phrases(source)] if isinstance(source, DataFrame) else source


def phrases_mart(parts: Sequence[Phrases]) -> DataFrame:
    """J31 of the phrases of each platform.

    Date parts, the lower-cased word and what describes a phrase follow from
    the other keys, so they are added after grouping instead of widening the
    shuffle.
    """
    keys = [k for k in PHRASE_KEYS if k not in ("year", "month", "day", "word")]
    named = [Phrases(p.rows.withColumnRenamed("raw_text", "top_search_combinations"), p.describe) for p in parts]
    out = stack(*[p.grouped(keys, lambda df, by: rollup_once(df, by, WORD_SUMS, ["currency"])) for p in named])
    out = out.withColumns({name: ratio(n, d) for name, (n, d) in DELIVERY_RATIOS.items()})
    out = out.select("*", *date_parts("date"), F.lower("top_search_combinations").alias("word"))
    key = surrogate_key("date", "event_edition", "platform", "campaign_id", "top_search_combinations")
    return out.select(key.alias("id"), *PHRASE_KEYS, *PHRASE_METRICS)


def roi_mart(ads: DataFrame, crm: DataFrame, ctx: Context) -> DataFrame:
    """Ad cost rows and CRM sales rows in one stack."""
    kept = {"date", "year", "platform", "campaign_name", "currency", "event_name", "cost", "impressions", "clicks"}
    blank = {n: F.lit(None) for n, _ in ROI if n not in kept}
    spend = align(ads, ROI, {**blank, "campaign_name": F.lower(F.trim("campaign_name")), "revenue": 0.0,
                             "total_sales": 0, "new_customers_count": 0})
    series = F.col("conference_series")
    event = first_match(series, ctx.series_rules, F.coalesce(series, F.lit(ctx.series_default)))
    sales = align(crm, ROI, {"event_name": event, "cost": 0.0, "impressions": 0, "clicks": 0, "total_sales": 1,
                             "new_customers_count": flag_in("new_customer", ctx.new_customer_values)})
    return stack(spend, sales)


WORD_KEYS = ("date", "platform", "account_name", "account_id", "campaign_name", "campaign_status", "campaign_id",
             "event_name", "event_edition", "week_display", "week_number", "week_number_to_sort", "weeks_left",
             "cut_off_rate", "cut_off_rate_sort_order", "currency", "word", "phrase_key")
GLOBAL_KEYS = ("event_edition", "platform", "campaign_id", "campaign_status", "cut_off_rate", "word")


def word_rows(phrases: DataFrame, measures: Sequence[str], stop_words: Sequence[str], min_length: int = 3) -> DataFrame:
    """One row per phrase and different word of its ``raw_text``; measures count as often as the word stands there.

    A sorted list shows where each word starts, so the words of a phrase are
    counted inside its row and need no grouping.
    """
    # One step each: a later one reads the list of the one before many times.
    listed = phrases.withColumn("_words", F.sort_array(tokens("raw_text", min_length, stop_words))).drop("raw_text")
    places = F.transform("_words", lambda w, i: F.when(~w.eqNullSafe(F.get("_words", i - 1)), i))
    begun = listed.withColumn("_starts", F.filter(places, lambda i: i.isNotNull()))
    counted = begun.withColumn("_words", F.transform("_starts", lambda i, j: F.struct(
        F.get("_words", i).alias("word"), (F.coalesce(F.get("_starts", j + 1), F.size("_words")) - i).alias("n")))).drop("_starts")
    # The inner form would make Spark tokenise twice, to filter out empty lists first.
    words = counted.withColumn("_word", F.explode_outer("_words")).drop("_words").where(F.col("_word").isNotNull())
    return words.withColumns({"word": F.col("_word.word"), **{m: F.col(m) * F.col("_word.n") for m in measures}}).drop("_word")


def word_stats(source: DataFrame | Sequence[Phrases], stop_words: Sequence[str], min_length: int = 3,
               combine: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per word and whole phrase with summed statistics.

    A 128-bit hash stands for the phrase, so a word row never carries the text;
    :func:`phrase_texts` has the texts. Phrases are summed whole and split into
    words last, so no shuffle carries a row per word. ``combine`` groups the
    phrases in its own way instead; it keeps ``raw_text``.
    """
    keys, key = [k for k in WORD_KEYS if k not in ("word", "phrase_key")], F.md5("raw_text")

    def whole(df: DataFrame, by: list[str]) -> DataFrame:
        df = df.where(F.col("raw_text").isNotNull())
        return df if combine else rollup(df, by, WORD_SUMS)

    phrases = stack(*[p.grouped([*keys, "raw_text"], whole) for p in _parts(source)])
    if combine:
        phrases = combine(phrases.withColumn("phrase_key", key))
    if "phrase_key" not in phrases.columns:
        phrases = phrases.withColumn("phrase_key", key)
    measures = [c for c in phrases.columns if c not in (*WORD_KEYS, "raw_text")]
    keys = [c for c in phrases.columns if c not in ("phrase_key", "raw_text", *measures)]
    return word_rows(phrases, measures, stop_words, min_length).select(*keys, "word", "phrase_key", *measures)


def phrase_texts(source: DataFrame, width: int = 100) -> DataFrame:
    """One row per phrase: its key and the text to display, shortened to ``width``."""
    return source.select(F.md5("raw_text").alias("phrase_key"), shorten("raw_text", width).alias("clean_phrase")).where(
        F.col("phrase_key").isNotNull()).distinct()


def word_mart(stats: DataFrame, texts: DataFrame, k: int = 10) -> DataFrame:
    """Daily statistics per word with its top phrases over all dates.

    Phrases are ranked whole, by their keys where totals are equal, and only
    the chosen ones get their texts.
    """
    totals = phrase_totals(stats, [*GLOBAL_KEYS, "phrase_key"], "impressions", "total_impressions")
    tops = top_phrases(totals, GLOBAL_KEYS, "phrase_key", "total_impressions", k, "top_search_combinations",
                       texts=texts, text="clean_phrase")
    keys = [c for c in WORD_KEYS if c not in ("phrase_key", "currency", "account_name", "account_id")]
    daily = rollup(stats, keys, [*SUMMED, "conversions", "conversion_value"], ["currency"], DELIVERY_RATIOS)
    return daily.join(tops, list(GLOBAL_KEYS), "left").select(
        *keys, *date_parts("date"), "top_search_combinations", *PHRASE_METRICS)


DAY_KEYS = tuple(c for c in WORD_KEYS if c not in ("word", "phrase_key", "currency", "account_name", "account_id"))
SET_KEYS = tuple(c for c in GLOBAL_KEYS if c != "word")
MAX_CODES = 1000  #: currencies that are coded by their place in a list
ROW_BYTES, TASK_BYTES = 200, 16 << 20  #: columns of a stored phrase beside its text; stored phrases of one task


def _code(columns: Sequence[str], name: str) -> dict[str, Column]:
    """Two longs that stand for a tuple of columns; NULL differs from every text."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return {f"{name}1": F.xxhash64(*parts), f"{name}2": F.xxhash64(F.lit(name), *parts)}


def _set_known() -> Column:
    """False if a key of the campaign is missing: such rows have no top phrases, as NULL equals nothing."""
    return ~reduce(Column.__or__, [F.col(c).isNull() for c in SET_KEYS])


def _dealt_words(held: DataFrame, currency: Column, stop_words: Sequence[str], min_length: int, k: int, width: int) -> DataFrame:
    """Word rows with their top phrases of campaigns that lie whole in one task.

    No joins, whose keys would hold the word and so shuffle every row again: a
    phrase's total over all dates stands on each of its rows, one of them stands
    for the phrase where words are ranked, and the list goes to all days of the word.
    """
    ends = (Window.unboundedPreceding, Window.unboundedFollowing)
    phrase, word = Window.partitionBy(*SET_KEYS, "raw_text").orderBy("date"), Window.partitionBy(*SET_KEYS, "word")
    rows = held.select(*DAY_KEYS, currency.alias("currency"), *WORD_SUMS, "raw_text", F.row_number().over(phrase).alias("_nth"),
                       F.sum("impressions").over(phrase.rowsBetween(*ends)).alias("_total"))
    one = F.col("_nth") == 1
    rows = rows.withColumns({"_phrase": F.when(one, F.unhex(F.md5("raw_text"))),
                             "_shown": F.when(one, shorten("raw_text", width))}).drop("_nth")
    words = word_rows(rows, [*WORD_SUMS, "_total"], stop_words, min_length)
    ranks = word.orderBy(F.col("_phrase").isNull(), F.col("_total").desc_nulls_last(), F.col("_phrase").asc_nulls_last())
    ranked = words.withColumn("_rank", F.row_number().over(ranks))
    entry = F.struct("_rank", F.concat("_shown", F.lit(" ("), F.col("_total").cast("string"), F.lit(")")).alias("t"))
    chosen = F.when(F.col("_phrase").isNotNull() & (F.col("_rank") <= k), entry)
    daily = ranked.groupBy(*DAY_KEYS, "word").agg(
        *[F.sum(c).alias(c) for c in WORD_SUMS], F.max("currency").alias("currency"), F.collect_list(chosen).alias("_own"))
    daily = daily.withColumn("_all", F.collect_list(F.when(F.size("_own") > 0, F.col("_own"))).over(word))
    text = F.array_join(F.transform(F.array_sort(F.flatten("_all")), lambda x: x["t"]), "\n")
    return daily.withColumn("top_search_combinations", F.when(_set_known(), text)).drop("_own", "_all")


def _coded_words(held: DataFrame, currency: Column, days: DataFrame, texts: DataFrame, stop_words: Sequence[str],
                 min_length: int, k: int) -> DataFrame:
    """Word rows of stored phrases with their top phrases; every grouping and join holds the campaign's code."""
    day, group = ["d1", "d2", "g1", "g2"], ["g1", "g2", "word"]
    words = word_rows(held.select(*day, currency.alias("currency"), *WORD_SUMS, "raw_text"), WORD_SUMS, stop_words, min_length)
    daily = words.groupBy(*day, "word").agg(*[F.sum(c).alias(c) for c in WORD_SUMS], F.max("currency").alias("currency"))
    totals = phrase_totals(held.where(_set_known()), ["g1", "g2", "phrase", "raw_text"], "impressions", "total_impressions")
    totals = word_rows(totals, ["total_impressions"], stop_words, min_length)
    tops = top_phrases(totals, group, "phrase", "total_impressions", k, "top_search_combinations", texts=texts, text="clean_phrase")
    return daily.join(tops, group, "left").join(days, day)


def coded_word_mart(source: DataFrame | Sequence[Phrases], stop_words: Sequence[str], store: Callable[[DataFrame], DataFrame],
                    min_length: int = 3, k: int = 10, width: int = 100, set_bytes: int = 4 << 20) -> DataFrame:
    """J33 from one stored table.

    ``source`` is read once: phrases are summed per day and campaign, and
    ``store`` writes them and reads them back.

    Campaigns of up to ``set_bytes`` are dealt whole to tasks, once, before their
    phrases are split; nothing after that is shuffled. The larger ones, at most
    one per ``set_bytes`` of the table, spread over tasks by word: there word
    rows carry two longs for the day's attributes and two for the campaign's
    instead of the texts, the phrase is 16 bytes, and texts join the finished
    groups. MAX over currencies runs on their places in a sorted list.
    """
    def whole(df: DataFrame, by: list[str]) -> DataFrame:
        return rollup(df.where(F.col("raw_text").isNotNull()), by, WORD_SUMS)

    held = store(stack(*[p.grouped([*DAY_KEYS, "currency", "raw_text"], whole) for p in _parts(source)]))
    money = [r[0] for r in held.select("currency").where("currency IS NOT NULL").distinct().limit(MAX_CODES + 1).collect()]
    coded = len(money) <= MAX_CODES
    places = F.array(*[F.lit(c) for c in sorted(money, key=str.encode)]).cast("array<string>")
    currency = F.nullif(F.array_position(places, F.col("currency")), F.lit(0)) if coded else F.col("currency")
    size = F.sum(F.octet_length("raw_text") + F.lit(ROW_BYTES))
    sets = held.withColumns(_code(SET_KEYS, "g"))
    # campaigns of equal first codes count as one, large or not
    large = F.broadcast(sets.groupBy("g1").agg(size.alias("_size")).where(F.col("_size") > set_bytes).select("g1"))
    tasks = 1 + (held.agg(size).first()[0] or 0) // TASK_BYTES
    dealt = sets.join(large, "g1", "left_anti").select(*held.columns).repartition(tasks, *SET_KEYS)
    spread = sets.join(large, "g1", "left_semi").withColumns({**_code(DAY_KEYS, "d"), "phrase": F.unhex(F.md5("raw_text"))})
    texts = spread.select("phrase", shorten("raw_text", width).alias("clean_phrase")).distinct()
    days = spread.select("d1", "d2", "g1", "g2", *DAY_KEYS).distinct()
    out = _dealt_words(dealt, currency, stop_words, min_length, k, width).unionByName(
        _coded_words(spread, currency, days, texts, stop_words, min_length, k).drop("d1", "d2", "g1", "g2"))
    if coded:
        out = out.withColumn("currency", F.get(places, (F.col("currency") - 1).cast("int")))
    out = out.withColumns({name: ratio(n, d) for name, (n, d) in DELIVERY_RATIOS.items()})
    return out.select(*DAY_KEYS, "word", *date_parts("date"), "top_search_combinations", *PHRASE_METRICS)
