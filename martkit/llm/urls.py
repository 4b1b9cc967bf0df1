"""URL filters from association rules.

Urls are sets of tokens: parts of the host between dots and hyphens, path segments, file endings and parameter names, digits
left out. Tokens that occur in the same labelled urls are one item. Spark's FP-growth mines the blocked urls; each set of
items that at least `least` of them hold is counted over all labelled urls, and those of enough confidence become rules,
however long, unless a part of them is a rule already. A rule is indexed under its rarest item; a url looks up its
items and is blocked if it holds all items of a rule. Written rules for hosts come first, the longest that fits wins.

Defined results: a NULL url, or one without "://", has an empty host and path and no tokens, and is allowed unless a
written rule fits; without labels there are no mined rules. Columns of the input stay, but for those that are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, salted_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Mining:
    """A rule holds for at least `least` blocked urls, and at least `confidence` of the labelled urls it fits are blocked."""

    least: int = 5
    confidence: float = 0.5


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and what follows the path."""
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path, F.substring(tail, F.length(path) + 1, F.length(tail))


def tokens(host: Column, path: Column, more: Column) -> Column:
    """Sorted distinct tokens of a url; parts of digits alone are left out."""
    def kind(prefix: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: (v != "") & ~v.rlike("^[0-9]+$")), lambda v: F.concat(F.lit(prefix), v))

    query = F.regexp_extract(more, r"^\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda v: F.substring_index(v, "=", 1))
    folders = F.split(F.regexp_replace(path, r"\.([A-Za-z]+)$", ""), "/")
    ending = F.array(F.regexp_extract(path, r"\.([A-Za-z]+)$", 1))
    every = F.concat(kind("host:", F.split(host, r"[.-]")), kind("path:", folders), kind("end:", ending), kind("name:", names))
    return F.array_sort(F.array_distinct(every))


def written(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (host/path) and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):
        own, _, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + start)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _same_items(sets: DataFrame) -> DataFrame:
    """(token, item) of the tokens of `sets` (tokens, n): those in the same rows share the item, the first of them."""
    rows = sets.select(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), "tokens").alias("b"), F.explode("tokens").alias("token"))
    # sums of hashes of the rows stand for the set of rows
    places = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in "ab"])
    first = places.groupBy("n", "a", "b").agg(F.min("token").alias("item"))
    return places.join(first, ["n", "a", "b"]).select("token", "item")


def _held(sets: DataFrame, index: DataFrame) -> DataFrame:
    """Each row of `sets` (items, ...) with each antecedent of `index` (item, antecedent, ...) that it holds."""
    rows = sets.withColumn("item", F.explode("items"))
    return salted_join(rows, index, "item").where(F.size(F.array_except("antecedent", "items")) == 0).drop("item")


def mine(labelled: DataFrame, mining: Mining = Mining()) -> tuple[DataFrame, DataFrame]:
    """Items (token, item) and rules (item, antecedent, confidence) from rows of (tokens, blocked).

    An antecedent is a sorted list of items, indexed under the rarest.
    """
    known = labelled.where("blocked is not null and size(tokens) > 0")
    sets = cut(known.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("n_blocked")))
    names = cut(_same_items(sets))
    coded = sets.select(F.xxhash64("tokens").alias("set"), "tokens", "n", "n_blocked")
    each = salted_join(coded.select("set", "tokens", "n", "n_blocked", F.explode("tokens").alias("token")), names, "token")
    coded = cut(each.groupBy("tokens", "n", "n_blocked").agg(F.array_sort(F.collect_set("item")).alias("items")))
    blocked = coded.where("n_blocked > 0").select("items", F.explode(F.sequence(F.lit(1).cast("long"), "n_blocked")).alias("copy"))
    count = blocked.count()
    if count < mining.least:
        empty = labelled.sparkSession.createDataFrame([], "item string, antecedent array<string>, confidence double")
        return names, empty
    # half a row less, so that rounding cannot ask for one more
    model = FPGrowth(itemsCol="items", minSupport=(mining.least - 0.5) / count).fit(blocked.select("items"))
    found = cut(model.freqItemsets.select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("n_blocked")))
    single = coded.select("n", F.explode("items").alias("item")).groupBy("item").agg(F.sum("n").alias("freq"))
    rare = found.withColumn("item", F.explode("antecedent")).join(single, "item").groupBy("antecedent", "n_blocked").agg(
        F.min(F.struct("freq", "item"))["item"].alias("item"))
    fits = _held(coded.select("items", "n"), rare.select("item", "antecedent")).groupBy("antecedent").agg(F.sum("n").alias("n"))
    sure = rare.join(fits, "antecedent").withColumn("confidence", F.col("n_blocked") / F.col("n"))
    sure = cut(sure.where(F.col("confidence") >= mining.confidence).select("item", "antecedent", "confidence"))
    longer = _held(sure.select(F.col("antecedent").alias("items")), sure).where("size(items) > size(antecedent)")
    minimal = sure.join(longer.select(F.col("items").alias("antecedent")).distinct(), "antecedent", "left_anti")
    return names, cut(minimal.select("item", "antecedent", "confidence"))


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]], mining: Mining = Mining()) -> DataFrame:
    """Adds host, path, rule, confidence (the best of the mined rules that fit) and verdict to pages with a url.

    `labelled` has url and blocked (boolean, or NULL where not known).
    """
    host, path, more = parts(F.col("url"))
    names, index = mine(labelled.select(tokens(host, path, more).alias("tokens"), "blocked"), mining)
    rows = pages.select(F.struct("*").alias("page"), host.alias("host"), path.alias("path"), tokens(host, path, more).alias("tokens"))
    name, verdict = written(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "says": verdict})
    sets = rows.where("rule is null and size(tokens) > 0").select("tokens").distinct()
    each = salted_join(sets.select("tokens", F.explode("tokens").alias("token")), names, "token")
    coded = each.groupBy("tokens").agg(F.collect_set("item").alias("items"))
    hits = _held(coded, index).groupBy("tokens").agg(F.max("confidence").alias("confidence"))
    joined = salted_join(rows, hits, "tokens", "left")
    mined = F.when(F.col("rule").isNull() & F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    added = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("rule"),
             "confidence": F.when(F.col("rule").isNull(), F.col("confidence")), "verdict": F.coalesce("says", mined)}
    kept = [F.col("page").getField(c).alias(c) for c in pages.columns if c.lower() not in added]
    return joined.select(*kept, *[c.alias(n) for n, c in added.items()])
