import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import d, ts
from martkit.operators import lookup, nested
from martkit.operators.dedup import combine_dims, exclude, latest, recent
from martkit.operators.editions import EditionRule, edition_days, label_events, match_series, nearest_edition
from martkit.operators.editions import Editions, prepare_editions
from martkit.operators.lookup import Bound
from martkit.operators.nested import Field
from martkit.operators.rollup import DELIVERY_RATIOS, phrase_totals, rollup, top_phrases
from martkit.operators.stack import align, stack, zero_metrics

TIGHT = Bound(max_rows=0, max_bytes=0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Dedup ----------------------------------------------------------------------

def test_latest_newest_wins_and_ties(spark, rows):
    df = spark.createDataFrame([("k1", ts("2024-05-01T06:00:00"), 1, 5), ("k1", ts("2024-05-01T07:00:00"), 0, 7),
                                ("k2", ts("2024-05-01T06:00:00"), 1, 1), ("k2", ts("2024-05-01T06:00:00"), 2, 2),
                                ("k3", None, 9, 3), ("k3", ts("2024-05-01T06:00:00"), 1, 4)],
                               "k string, _ingested_at timestamp, n int, clicks int")
    once = latest(df, ["k"], tie=["n"])
    assert rows(once, "k", "clicks") == [("k1", 7), ("k2", 2), ("k3", 4)]
    assert rows(latest(once, ["k"], tie=["n"])) == rows(once)


def test_latest_limits_groups_before_the_shuffle(spark):
    keyed = spark.range(10).select((F.col("id") % 3).alias("k"), F.current_timestamp().alias("_ingested_at"))
    text = plan(latest(keyed, ["k"]))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[exchange:] and "Partial" in text[exchange:]


def test_combine_recent_exclude(spark, rows):
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, v string")
    b = spark.createDataFrame([("2", "late"), ("3", "z"), (None, "n")], "id string, v string")
    assert rows(combine_dims([a, b], ["id"])) == [("1", "x"), ("2", "y"), ("3", "z"), (None, "n")]
    assert rows(exclude(b, "id", ["2"])) == [("3", "z"), (None, "n")]
    days = spark.createDataFrame([(d("2024-05-18"),), (d("2024-05-17"),)], "date date")
    assert rows(recent(days, "date", 14, d("2024-06-01"))) == [(d("2024-05-18"),)]
    assert recent(days, "date", None, d("2024-06-01")) is days


# Lookups --------------------------------------------------------------------

def test_plain_join_equals_broadcast_join_with_hot_key(spark, rows):
    fact = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(300)] + [(None, 999)],
                                 "k string, n int")
    side = spark.createDataFrame([("hot", "H"), ("k0", "Z"), ("unused", "U")], "k string, v string")
    for how in ("left", "inner", "left_anti", "left_semi"):
        small = lookup.lookup(fact, side, ["k"], how, small=True)
        large = lookup.lookup(fact, side, ["k"], how)
        assert rows(small) == rows(large)
    assert lookup.lookup(fact, side, ["k"]).count() == fact.count()


def test_lookups_keep_the_row_count(spark, rows):
    spend = spark.createDataFrame([("s1", "c1", "FR", 1), ("s2", None, None, 2)],
                                  "adset_id string, campaign_id string, country_code string, n int")
    budgets = spark.createDataFrame([("s1", "100", None, "OLD", 1), ("s1", "300", None, "NEW", 2), (None, "9", "9", "X", 3)],
                                    "adset_id string, daily_budget string, lifetime_budget string, status string, "
                                    "_ingested_at int")
    assert rows(lookup.pacing(spend, budgets), "n", "daily_budget_cap", "adset_status") == [
        (1, 3.0, "NEW"), (2, 0.0, "UNKNOWN")]
    states = spark.createDataFrame([("c1", "A"), ("c1", "B")], "campaign_id string, status string")
    assert rows(lookup.with_default(spend, states, ["campaign_id"], {"status": "?"}), "n", "status") == [(1, "B"), (2, "?")]
    countries = spark.createDataFrame([("FR", "Fr"), ("FR", "France")], "country_code string, country_name string")
    assert rows(lookup.with_country(spend, countries), "n", "country_name") == [(1, "France"), (2, None)]
    targets = spark.createDataFrame([(1, "a", "b", "c", "d"), (1, "z", "b", "c", "d")],
                                    "`Criteria ID` int, Name string, `Canonical Name` string, `Country Code` string, "
                                    "`Target Type` string")
    geo = spend.drop("country_code").withColumn("geo", F.lit("1"))
    assert rows(lookup.with_geo(geo, targets, ["geo"]), "n", "region_name") == [(1, "z"), (2, "z")]


def test_measure_counts_rows_and_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "s string, n int")
    count, size = lookup.measure(df)
    assert count == 2 and size >= 1000
    assert lookup.fits(df) and not lookup.fits(df, Bound(max_rows=1)) and not lookup.fits(df, Bound(max_bytes=500))
    assert lookup.measure(df.where("n > 9")) == (0, 0)


def test_exclude_keys_null_semantics(spark, rows):
    fact = spark.createDataFrame([("c1",), ("c2",), (None,)], "c string")
    keys = spark.createDataFrame([("c1",), (None,)], "c string")
    assert rows(lookup.exclude_keys(fact, keys, "c")) == [("c2",), (None,)]
    assert rows(lookup.exclude_keys(fact, keys, "c", null_aware=True)) == []
    plain = keys.where("c is not null")
    assert rows(lookup.exclude_keys(fact, plain, "c", null_aware=True)) == [("c2",)]
    assert rows(lookup.exclude_keys(fact, plain.limit(0), "c", null_aware=True)) == [("c1",), ("c2",), (None,)]


def test_geo_country_and_defaults(spark, rows):
    targets = spark.createDataFrame([("1", "Lyon", "Lyon,FR", "FR", None)],
                                    "`Criteria ID` string, `Name` string, `Canonical Name` string, "
                                    "`Country Code` string, `Target Type` string")
    fact = spark.createDataFrame([("1", "2", 10), (None, "1", 11), ("7", "1", 12)], "u string, g string, n int")
    got = lookup.with_geo(fact, targets, ["u", "g"])
    assert rows(got, "n", "region_name", "geo_target_type") == [
        (10, "Lyon", "Unknown"), (11, "Lyon", "Unknown"), (12, "Unknown", "Unknown")]
    countries = spark.createDataFrame([("FR", "France")], "country_code string, country_name string")
    coded = spark.createDataFrame([("FR",), ("ZZ",), (None,)], "country_code string")
    assert rows(lookup.with_country(coded, countries)) == [("FR", "France"), ("ZZ", "ZZ"), (None, None)]
    status = spark.createDataFrame([("1", "ON")], "u string, s string")
    assert rows(lookup.with_default(fact, status, ["u"], {"s": "UNKNOWN"}), "n", "s") == [
        (10, "ON"), (11, "UNKNOWN"), (12, "UNKNOWN")]


def test_pacing_gap_fill(spark, rows):
    spend = spark.createDataFrame([("s1", 1.0), ("s2", 2.0)], "adset_id string, spend double")
    budgets = spark.createDataFrame([("s1", "5000", None, "ACTIVE")],
                                    "adset_id string, daily_budget string, lifetime_budget string, status string")
    assert rows(lookup.pacing(spend, budgets)) == [("s1", 1.0, 50.0, 0.0, "ACTIVE"), ("s2", 2.0, 0.0, 0.0, "UNKNOWN")]
    found = spark.createDataFrame([("a", 1)], "id string, n int")
    fetched = spark.createDataFrame([("a", 9), ("b", 2)], "id string, n int")
    assert rows(lookup.fill_gaps(found, fetched, "id")) == [("a", 1), ("b", 2)]


def test_creative_bridge_keeps_rows(spark, rows):
    ads = spark.createDataFrame([("1",), ("2",), ("9",)], "ad_id string")
    bridge = spark.createDataFrame([(1, 7, 1), (2, 7, 1), (2, 8, 2)], "ad_id int, creative_id int, _ingested_at int")
    looks = spark.createDataFrame([("7", "old", 1), ("7", "new", 2), ("8", "eight", 1)],
                                  "creative_id string, headline string, _ingested_at int")
    one = lookup.with_creative(ads, bridge, looks, ["headline"])
    assert rows(one) == [("1", "new"), ("2", "eight"), ("9", None)]
    many = lookup.with_creative(ads, bridge, looks, ["headline"], fan_out=True)
    assert rows(many) == [("1", "new"), ("1", "old"), ("2", "eight"), ("2", "new"), ("2", "old"), ("9", None)]


def test_latest_status_is_computed_per_campaign(spark, rows):
    dim = spark.createDataFrame([(1, "on", 1), (1, "off", 2), (None, "x", 1)],
                                "campaign_id int, status string, _ingested_at int")
    states = lookup.campaign_states(dim, F.upper("status"))
    assert rows(states) == [("1", "OFF")]
    fact = spark.createDataFrame([("1", "raw"), ("2", "raw")], "campaign_id string, campaign_status string")
    assert rows(lookup.with_status(fact, states, "idle")) == [("1", "OFF"), ("2", "idle")]


# Editions -------------------------------------------------------------------

CAL = ("conference_editions string, event_start_date date, event_end_date date, seb_end_date date, eb_end_date date, "
       "advance_end_date date, fp_end_date date")
RULES = [EditionRule("X", ("% EXPO X",)), EditionRule("T", ("T%",), ("T UK%",)), EditionRule("TUK", ("%T UK%",))]


def edition(name, start, end, *ends):
    return (name, d(start), d(end) if end else None, *(ends or (None,) * 4))


def test_window_edges_and_unmatched_rows(spark, rows):
    cal = spark.createDataFrame([edition("2024 EXPO X", "2024-05-20", "2024-05-22"),
                                 edition("2025 EXPO X", "2025-05-20", "2025-05-22"),
                                 edition("open EXPO X", "2024-01-01", None)], CAL)
    ed = prepare_editions(cal, RULES)
    first = d("2024-05-22") - timedelta(days=400)
    fact = spark.createDataFrame([("X", d("2024-05-01")), ("X", d("2024-05-22")), ("X", first),
                                  ("X", first - timedelta(days=1)), ("X", d("2024-05-23")), ("Q", d("2024-05-01")),
                                  (None, d("2024-05-01"))], "event_name string, date date")
    got = {(r.event_name, r.date): r.conference_editions for r in nearest_edition(fact, ed).collect()}
    assert got == {("X", d("2024-05-01")): "2024 EXPO X", ("X", d("2024-05-22")): "2024 EXPO X",
                   ("X", first): "2024 EXPO X", ("X", first - timedelta(days=1)): None,
                   ("X", d("2024-05-23")): "2025 EXPO X", ("Q", d("2024-05-01")): None,
                   (None, d("2024-05-01")): None}


def test_patterns_with_exclusion(spark, rows):
    cal = spark.createDataFrame([edition(n, "2024-05-20", "2024-05-22") for n in
                                 ("2024 EXPO X", "T 2024", "T UK 2024", "other")], CAL)
    assert rows(match_series(cal, RULES), "series", "conference_editions") == [
        ("T", "T 2024"), ("TUK", "T UK 2024"), ("X", "2024 EXPO X")]


def brute_force(fact, calendar, window=400):
    """Literal reading: every in-window edition ranked by distance, start, name."""
    out = []
    for series, day in fact:
        hits = [(abs((day - start).days), start, name) for s, name, start, end in calendar
                if s == series and day <= end and day >= end - timedelta(days=window)]
        out.append((series, day, min(hits)[2] if hits else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [lookup.DEFAULT_BOUND, TIGHT])
def test_nearest_edition_equals_brute_force(spark, rows, bound):
    rng = random.Random(7)
    base = date(2022, 1, 1)
    cal = []
    for i in range(40):
        start = base + timedelta(days=rng.randrange(1200))
        cal.append((rng.choice(["X", "T 1"]), f"{i}", start, start + timedelta(days=rng.randrange(6))))
    named = [(f"{n} EXPO X" if s == "X" else f"T {n}", a, b, None, None, None, None) for s, n, a, b in cal]
    fact = [(rng.choice(["X", "T", "none"]), base + timedelta(days=rng.randrange(-100, 1500))) for _ in range(400)]
    truth = brute_force(fact, [("X" if n.endswith("EXPO X") else "T", n, a, b) for n, a, b, *_ in named])
    ed = prepare_editions(spark.createDataFrame(named, CAL), RULES, bound=bound)
    assert ed.small == (bound is lookup.DEFAULT_BOUND)
    got = nearest_edition(spark.createDataFrame(fact, "event_name string, date date"), ed)
    assert sorted((tuple(r) for r in got.select("event_name", "date", "conference_editions").collect()),
                  key=str) == truth


def test_edition_join_does_not_shuffle_the_fact(spark):
    cal = spark.createDataFrame([edition("2024 EXPO X", "2024-05-20", "2024-05-22")], CAL)
    fact = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "X").otherwise("T").alias("event_name"),
                                    F.date_add(F.lit(d("2024-05-01")), (F.col("id") % 9).cast("int")).alias("date"))
    text = plan(nearest_edition(fact, prepare_editions(cal, RULES)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "NestedLoop" not in text


def test_labels(spark):
    cal = spark.createDataFrame([edition("2024 EXPO X", "2024-05-20", "2024-05-22", d("2024-01-31"), d("2024-02-29"),
                                         None, d("2024-05-19"))], CAL)
    fact = spark.createDataFrame([("X", d("2024-03-05")), ("Q", d("2026-12-31"))], "event_name string, date date")
    got = {r.event_name: r for r in label_events(fact, prepare_editions(cal, RULES), d("2024-05-01")).collect()}
    x, q = got["X"], got["Q"]
    assert (x.event_edition, x.cut_off_rate, x.cut_off_rate_sort_order, x.week, x.week_number, x.weeks_left) == (
        "2024 EXPO X", "FP", 4, "Week 11", 11, "3")
    assert (q.event_edition, q.cut_off_rate, q.cut_off_rate_sort_order, q.week, q.weeks_left) == (
        "Q", "No Rate", 7, "Week -1", "34")


def test_edition_days_has_one_row_per_day(spark):
    cal = spark.createDataFrame([edition(f"{i} EXPO X", "2024-05-20", "2024-05-22") for i in range(5)], CAL)
    days = edition_days(match_series(cal, RULES), 10)
    assert days.count() == 11 and days.select("conference_editions").distinct().collect() == [("0 EXPO X",)]
    assert Editions(days, True).small


# Nested ---------------------------------------------------------------------

def exploded(spark, actions, values, **kwargs):
    df = spark.createDataFrame([(1, actions, values)], "id int, actions string, action_values string")
    return [tuple(r)[1:] for r in nested.explode_actions(df, **kwargs).collect()]


def test_explode_actions(spark):
    acts = '[{"action_type":"lead","value":"2"},{"action_type":"buy","value":"1"},{"value":"3"}]'
    vals = '[{"action_type":"buy","value":"9.5"}]'
    assert exploded(spark, acts, vals) == [("lead", 2.0, None), ("buy", 1.0, 9.5)]
    assert exploded(spark, acts, vals, missing=0.0) == [("lead", 2.0, 0.0), ("buy", 1.0, 9.5)]
    assert exploded(spark, "[]", vals) == [] and exploded(spark, None, vals) == []
    assert exploded(spark, acts, None, missing=0.0) == [("lead", 2.0, 0.0), ("buy", 1.0, 0.0)]
    twice = '[{"action_type":"buy","value":"1"},{"action_type":"buy","value":"2"}]'
    assert exploded(spark, '[{"action_type":"buy","value":"x"}]', twice) == [("buy", None, 1.0)]
    assert exploded(spark, '[{"action_type":"buy","value":"1"}]', twice, duplicate="last") == [("buy", 1.0, 2.0)]


def test_strict_numbers_raise(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        exploded(spark, '[{"action_type":"buy","value":"x"}]', "[]", strict=True)


def test_sum_actions(spark):
    df = spark.createDataFrame([('[{"action_type":"a","value":"1.5"},{"action_type":"b","value":"2"}]',), ("[]",), (None,)],
                               "actions string")
    got = df.select(nested.sum_actions(nested.parse_actions(df, "actions"))).collect()
    assert [r[0] for r in got] == [3.5, 0.0, 0.0]
    arr = spark.sql("SELECT array(struct('a' AS action_type, '1' AS value)) AS actions")
    assert arr.select(nested.actions_json("actions")).first()[0] == '[{"action_type":"a","value":"1"}]'


CREATIVE = ("url_tags string, call_to_action_type string, image_url string, thumbnail_url string, object_story_spec "
            "struct<link_data:struct<name:string,message:string,link:string,picture:string,"
            "call_to_action:struct<type:string>>,video_data:struct<title:string,message:string,image_url:string,"
            "call_to_action:struct<type:string>>>, asset_feed_spec struct<titles:array<struct<text:string>>,"
            "bodies:array<struct<text:string>>,link_urls:array<struct<website_url:string>>,"
            "images:array<struct<url:string>>>")


def test_creative_fallbacks(spark):
    def resolve(*row):
        out = nested.resolve_creative(spark.createDataFrame([row], CREATIVE)).first()
        return (out.headline, out.body, out.destination_url, out.call_to_action_type, out.image_url)
    video = ("v title", "", "v.png", ("PLAY",))
    link = ("", "l body", "l.com", "l.png", ("",))
    assert resolve("tags", "", "", None, (link, video), None) == ("v title", "l body", "l.com", "PLAY", "l.png")
    feed = ([("f title",)], [(None,)], [("f.com",)], [("f.png",)])
    assert resolve("tags", "BUY", "own.png", None, (link, video), feed) == ("f title", None, "f.com", "BUY", "own.png")
    assert resolve("tags", None, None, None, None, ([], None, None, [("f.png",)])) == (
        None, None, "tags", None, "f.png")


def test_flatten_report(spark):
    df = spark.createDataFrame([(("2024-05-01", 7), ("12", None))],
                               "a struct<day:string,id:int>, m struct<clicks:string,spend:string>")
    fields = [Field("a.day", "date", "date"), Field("a.id", "campaign_id"), Field("m.clicks", "clicks", "bigint", 0),
              Field("m.spend", "spend", "double", 0.0), Field("m.reach", "reach", "bigint", 0), Field("m.x", "x")]
    assert tuple(nested.flatten_report(df, fields).first()) == (d("2024-05-01"), "7", 12, 0.0, 0, None)


# Rollup and stack -----------------------------------------------------------

def test_rollup_sums_and_ratios(spark, rows):
    df = spark.createDataFrame([("c", "a", 10.0, 100, 4, 2), ("c", "b", 5.0, 50, 0, 1), ("z", "b", 5.0, 0, 0, 0)],
                               "k string, n string, cost double, impressions long, clicks long, unique_clicks long")
    out = rollup(df, ["k"], ["cost", "impressions", "clicks", "unique_clicks"], ["n"], DELIVERY_RATIOS)
    assert rows(out) == [("c", 15.0, 150, 4, 3, "b", 4 / 150, 3 / 150, 3.75), ("z", 5.0, 0, 0, 0, "b", None, None, None)]
    assert out.agg(F.sum("cost")).first()[0] == df.agg(F.sum("cost")).first()[0]


def test_top_phrases_of_a_hot_key(spark):
    data = [("hot", f"p{i:03d}", i % 50) for i in range(500)] + [("cold", "only", 1)]
    totals = phrase_totals(spark.createDataFrame(data, "w string, p string, n long"), ["w", "p"], "n", "t")
    got = {r.w: r.tops.split("\n") for r in top_phrases(totals, ["w"], "p", "t", 10, "tops").collect()}
    assert got["hot"] == [f"p{i:03d} (49)" for i in range(49, 500, 50)] and got["cold"] == ["only (1)"]


def test_align_stack_zero(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    out = align(a, [("s", "string"), ("n", "bigint"), ("z", "double"), ("k", "string")], {"k": "K"})
    assert out.dtypes == [("s", "string"), ("n", "bigint"), ("z", "double"), ("k", "string")]
    assert tuple(out.first()) == ("x", 1, None, "K")
    swapped = spark.createDataFrame([("y", 2)], "s string, n int")
    assert [tuple(r) for r in stack(a, swapped).collect()] == [(1, "x"), (2, "y")]
    assert zero_metrics(a, {"n": "double", "c": "bigint"}).dtypes == [("n", "double"), ("s", "string"), ("c", "bigint")]


def test_audience_allow_list(spark, rows):
    df = spark.createDataFrame([("1", "A", "g2"), ("1", "A", "g1"), ("2", "Z", "g1")],
                               "audience_criterion_id string, audience_type string, ad_group_id string")
    assert rows(nested.audience_dim(df, ["A"], ["ad_group_id"])) == [("1", "A", "g1")]
