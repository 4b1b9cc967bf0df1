from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import d, ts
from martkit.functions import casts, dates, rules, status, text
from martkit.functions.keys import md5_key, surrogate_key
from martkit.functions.rules import Keep, Rule

AS_OF = date(2024, 6, 1)


def one(spark, expr, schema=None, row=None):
    df = spark.range(1) if row is None else spark.createDataFrame([row], schema)
    return df.select(expr.alias("x")).first()[0]


@pytest.mark.parametrize("value, expected", [("abc", None), ("12.0", None), ("12", 12), (None, None)])
def test_safe_cast_of_text(spark, value, expected):
    assert one(spark, casts.safe_cast("v", "bigint"), "v string", (value,)) == expected


@pytest.mark.parametrize("value, expected", [(2.5, 3), (-2.5, -3), (2.4, 2), (None, None)])
def test_safe_long_rounds_half_away_from_zero(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(casts.safe_long(df, "v")).first()[0] == expected


def test_units_and_ratio(spark):
    assert one(spark, casts.from_micros(F.lit(2_500_000))) == 2.5
    assert one(spark, casts.from_cents(F.lit("250"))) == 2.5
    assert one(spark, casts.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, casts.ratio(F.lit(3), F.lit(4))) == 0.75


@pytest.mark.parametrize("value, expected", [
    ("2024-05-01 00:00:00", d("2024-05-01")), ("2024", None), ("tbc", None), ("", None), (None, None),
    ("2024-13-01", None)])
def test_safe_date(spark, value, expected):
    assert one(spark, casts.safe_date("v"), "v string", (value,)) == expected


@pytest.mark.parametrize("value, expected", [
    ("NOT_ELIGIBLE", "Not_Eligible"), ("PAUSED", "Paused"), ("in review_x", "In Review_X"), (None, None)])
def test_initcap_words(spark, value, expected):
    assert one(spark, text.initcap_words("v"), "v string", (value,)) == expected


@pytest.mark.parametrize("end, start, expected", [
    ("2026-01-04", "2026-01-03", 1), ("2026-01-05", "2026-01-04", 0), ("2024-05-20", "2024-05-01", 3),
    ("2024-05-01", "2024-05-20", -3)])
def test_week_diff_counts_sundays(spark, end, start, expected):
    assert one(spark, dates.week_diff(F.lit(d(end)), F.lit(d(start)))) == expected


@pytest.mark.parametrize("day, expected", [("2020-12-31", -1), ("2026-12-31", -1), ("2024-01-03", 51)])
def test_weeks_to_year_end(spark, day, expected):
    assert one(spark, dates.weeks_to_year_end(F.lit(d(day)))) == expected


EDITION = "e string, seb_end_date date, eb_end_date date, advance_end_date date, fp_end_date date, event_start_date date"


@pytest.mark.parametrize("day, expected", [
    ("2024-01-31", "SEB"), ("2024-02-01", "EB"), ("2024-03-05", "FP"), ("2024-05-20", "Onsite"),
    ("2024-05-21", "Onsite / Late")])
def test_tier_skips_null_boundary(spark, day, expected):
    row = ("x", d("2024-01-31"), d("2024-02-29"), None, d("2024-05-19"), d("2024-05-20"))
    assert one(spark, dates.tier(F.lit(d(day)), "e"), EDITION, row) == expected


def test_tier_without_edition_sorts_last(spark):
    row = (None, None, None, None, None, None)
    assert one(spark, dates.tier(F.lit(d("2024-01-01")), "e"), EDITION, row) == "No Rate"
    order = [one(spark, dates.tier_order(F.lit(t))) for t in
             ("SEB", "EB", "Advance", "FP", "Onsite", "Onsite / Late", "No Rate")]
    assert order == [1, 2, 3, 4, 5, 6, 7]


def test_weeks_left(spark):
    def left(edition, start):
        return one(spark, dates.weeks_left("e", "s", AS_OF), "e string, s date", (edition, start))
    assert left("x", d("2024-05-31")) == "Unknown"
    assert left("x", d("2024-06-09")) == "2"
    assert left(None, None) == str(52 - AS_OF.isocalendar().week)


@pytest.mark.parametrize("st, serving, end, expected", [
    ("PAUSED", "SERVING", d("2024-01-01"), "Completed"), ("PAUSED", "ENDED", None, "Completed"),
    ("PAUSED", "SERVING", d("2024-06-01"), "Off"), ("REMOVED", None, None, "Deleted"),
    ("ENABLED", "SERVING", None, "Active"), ("ENABLED", "NOT_ELIGIBLE", None, "Not_Eligible"),
    ("ENABLED", None, None, "Enabled"), (None, None, None, "Not delivering")])
def test_status_a(spark, st, serving, end, expected):
    got = one(spark, status.delivery_status_a("s", "v", "e", AS_OF), "s string, v string, e date", (st, serving, end))
    assert got == expected


@pytest.mark.parametrize("st, stop, expected", [
    ("ACTIVE", ts("2024-05-31T23:00:00"), "Completed"), ("PAUSED", None, "Off"),
    ("ACTIVE", ts("2024-06-01T00:00:00"), "Active"), ("WITH_ISSUES", None, "With_Issues"),
    (None, None, "Not delivering")])
def test_status_b(spark, st, stop, expected):
    got = one(spark, status.delivery_status_b("s", "t", AS_OF), "s string, t timestamp", (st, stop))
    assert got == expected


def test_surrogate_key(spark):
    def key(*parts):
        schema = ", ".join(f"c{i} string" for i in range(len(parts)))
        return one(spark, surrogate_key(*[f"c{i}" for i in range(len(parts))]), schema, parts)
    assert key("a", None) is None
    assert key("a", "bc") != key("ab", "c")
    assert key("a", "b") == key("a", "b")
    assert one(spark, md5_key("c0", "c1"), "c0 string, c1 string", ("a", None)) is None


RULES = (Rule("specific", contains=("winter expo",), fold="upper"), Rule("generic", contains=("expo",), fold="upper"))


@pytest.mark.parametrize("value, expected", [
    ("The Winter Expo", "specific"), ("EXPO", "generic"), ("fair", "other"), (None, "other")])
def test_first_match_order(spark, value, expected):
    assert one(spark, rules.first_match("v", RULES, "other"), "v string", (value,)) == expected
    df = spark.createDataFrame([(value,)], "v string")
    assert rules.with_first_match(df, "x", "v", RULES, "other").collect() == [(value, expected)]


def test_case_flag(spark):
    strict, folded = Rule("t", like=("%Ticket%",)), Rule("t", like=("%Ticket%",), fold="lower")
    assert one(spark, rules.first_match("v", [strict], "no"), "v string", ("winter ticket",)) == "no"
    assert one(spark, rules.first_match("v", [folded], "no"), "v string", ("winter ticket",)) == "t"


def test_rule_on_second_column_and_like_wildcard(spark):
    chain = (Rule("a", equals=("x", "y")), Rule("b", like=("Z_%",), column="w"))
    schema = "v string, w string"
    assert one(spark, rules.first_match("v", chain, F.col("v")), schema, ("y", "q")) == "a"
    assert one(spark, rules.first_match("v", chain, F.col("v")), schema, ("k", "Z1")) == "b"
    assert one(spark, rules.first_match("v", chain, F.col("v")), schema, ("k", "Z")) == "k"


def test_empty_rule_is_refused():
    with pytest.raises(ValueError):
        rules.matches(Rule("x"), F.col("v"))


def test_metric_routing_and_guard(spark):
    df = spark.createDataFrame([("lead", 1.0, 5.0, 50.0), ("buy", 2.0, 6.0, 60.0), (None, 3.0, 7.0, 70.0)],
                               "a string, conv double, alt double, value double")
    lead, buy = Rule(equals=("lead",)), Rule(equals=("buy",))
    got = df.select(rules.route_metric([lead], "alt", "conv", "a"), rules.guard_value("value", [buy], [lead], "a"))
    assert [tuple(r) for r in got.collect()] == [(5.0, 0.0), (2.0, 60.0), (3.0, 0.0)]


def test_keep_classes(spark, rows):
    df = spark.createDataFrame([("A", "OTHER"), ("A", "X"), ("B", "X"), ("B", "BUY"), ("C", "BUY")], "p string, c string")
    kept = rules.keep_classes(df, "p", "c", {"A": Keep(drop=("OTHER",)), "B": Keep(only=("BUY",))})
    assert rows(kept) == [("A", "X"), ("B", "BUY")]


def test_paid_media_and_flag(spark, rows):
    df = spark.createDataFrame([("x_ads", None), ("search", "cpc"), ("search", "organic"), ("mail", "cpc"), (None, "cpc")],
                               "s string, m string")
    assert rows(rules.paid_media(df, "s", "m", ["x_ads"], ["search"], ["cpc"])) == [("search", "cpc"), ("x_ads", None)]
    assert one(spark, rules.flag_in("v", ["new", "yes"]), "v string", (" New ",)) == 1
    assert one(spark, rules.flag_in("v", ["new", "yes"]), "v string", (None,)) == 0


def test_text_helpers(spark):
    assert one(spark, text.phrase_text("h", "b", "none"), "h string, b string", (None, None)) == "none"
    assert one(spark, text.phrase_text("h", "b", "none"), "h string, b string", ("x", None)) == "x "
    assert one(spark, text.tokens("v", 3, ["the"]), "v string", ("The Wow! to été_1 best",)) == ["wow", "t_1", "best"]
    assert one(spark, text.shorten("v", 3), "v string", ("abcd",)) == "abc..."
    assert one(spark, text.path_tail("v"), "v string", ("a/b~12",)) == "12"
    assert one(spark, text.path_tail("v"), "v string", ("",)) == ""
    assert one(spark, text.path_tail("v", empty_as_null=True), "v string", ("",)) is None
    assert one(spark, text.hour_of_range("v"), "v string", ("07:00:00 - 07:59:59",)) == 7
    assert one(spark, text.hour_of_range("v"), "v string", (None,)) == 0
    assert one(spark, text.remove_all("v", "act_"), "v string", ("act_1act_2",)) == "12"
    assert one(spark, text.replace_in_order("v", [("A", "B"), ("B", "C")]), "v string", ("AB",)) == "CC"
