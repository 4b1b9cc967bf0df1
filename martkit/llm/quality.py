"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

Every rule's running time and rejections are estimated on a bounded sample of the documents that pass the base rule; rules
then run in the order of rejections per second, each only on documents that passed the rules before it. The order changes
the cost alone: a document is kept if no rule rejects it, whatever the order.

Defined results: a NULL text has no words; a document without words fails the base rule on word count.
"""

from __future__ import annotations

import statistics
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, blank_words, cut


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rule rejects documents for which `reject` holds; `reject` may use the columns of `measured`."""

    name: str
    reject: Column


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long).

    Repeated 3-word windows are found within the row: windows are hashed to 64 bits, and only rows in which a hash occurs
    twice sort (hash, position) to mark the words that such windows cover.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("_words", blank_words(F.col(text)))
    windows = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    rows = rows.withColumn("_hash", F.slice(windows, F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))))
    rows = rows.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_hash")) < F.size("_hash"),
        F.array_sort(F.transform("_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("_sorted", lambda e, j: (
        F.get("_sorted", j + 1)["h"].eqNullSafe(e["h"]) | F.get("_sorted", j - 1)["h"].eqNullSafe(e["h"])))
    rows = rows.withColumn("_at", F.transform(twice, lambda e: e["i"]))
    covered = F.array_distinct(F.concat("_at", F.transform("_at", lambda i: i + 1), F.transform("_at", lambda i: i + 2)))
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    rows = rows.withColumn("_lines", lines)
    counts = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("_sorted").isNotNull(), F.size(covered)), F.lit(0)).cast("long").alias("n_repeat_words"))
    # the generator keeps filters on the counts from being moved below, where they would repeat the work for each use
    rows = rows.withColumn("_counts", F.explode(F.array(counts)))
    return rows.select(*[c for c in docs.columns if c not in MEASURES], *[F.col(f"_counts.{c}") for c in MEASURES])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def rules(text: str = "text") -> list[Rule]:
    """Symbols, word length, repeated lines, capitals and letters, each with a mild threshold."""
    body, words = F.coalesce(F.col(text), F.lit("")), F.col("n_words")
    capitals = F.length(F.regexp_replace(body, r"\P{Lu}+", ""))
    letters = F.length(F.regexp_replace(body, r"\P{L}+", ""))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > words),
        Rule("word_length", (F.col("word_chars") < words * 2) | (F.col("word_chars") > words * 15)),
        Rule("repeated_lines", F.col("n_dup_lines") * 2
             > F.size(F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""))),
        Rule("capitals", capitals * 10 > F.col("word_chars") * 6),
        Rule("letters", letters * 2 < F.col("word_chars")),
    ]


def sampled(docs: DataFrame, rows: int, seed: int = 7) -> DataFrame:
    """At most `rows` rows spread over the whole table: each is taken by chance, with a share that follows from the count."""
    share = 1.25 * rows / max(docs.count(), 1)
    return docs.where(F.rand(seed) < share).limit(rows)


def ordered(rows: DataFrame, candidates: list[Rule], repeats: int = 5, rounds: int = 3) -> list[Rule]:
    """Rules in the order of rejections per second; `rows` is a bounded sample of measured rows that pass the base rule.

    A rule's cost is the median of its running times on the sample, each row judged `repeats` times, less that of no rule;
    the rules take turns, so that a slow moment meets all of them. Costs below the spread of the runs without a rule cannot
    be told apart and count as that spread. Rules are placed one by one: what counts is how many of the rows that the rules
    before it let pass a rule rejects. Ties keep the given order.
    """
    rows = cut(rows)
    many = rows.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    flags = {rule.name: F.coalesce(rule.reject, F.lit(False)) for rule in candidates}
    taken: dict[str | None, list[float]] = {name: [] for name in (None, *flags)}

    def seconds(flag: Column) -> float:
        began = time.perf_counter()
        many.agg(F.count_if(flag)).collect()
        return time.perf_counter() - began

    # the turn is read as well, so that no job can leave the rows out
    none = F.col("_turn") < 0
    seconds(none)
    for _ in range(rounds):
        for name in taken:
            taken[name].append(seconds(none if name is None else none | flags[name]))
    spread = max(max(taken[None]) - min(taken[None]), 1e-4)
    idle = statistics.median(taken[None])
    cost = {name: max(statistics.median(taken[name]) - idle, spread) for name in flags}
    left = rows.select(*[flag.alias(name) for name, flag in flags.items()]).collect()  # bounded by the sample
    return placed(candidates, cost, [r.asDict() for r in left])


def placed(candidates: list[Rule], cost: dict[str, float], verdicts: list[dict[str, bool]]) -> list[Rule]:
    """Rules by rejections per cost, each judged on the rows that those before it let pass."""
    chain, rest = [], list(candidates)
    while rest:
        best = max(rest, key=lambda rule: sum(v[rule.name] for v in verdicts) / cost[rule.name])
        chain.append(best)
        rest.remove(best)
        verdicts = [v for v in verdicts if not v[best.name]]
    return chain


def cascade(chain: list[Rule]) -> Column:
    """True if no rule rejects the row; a rule is only evaluated if those before it passed the row."""
    verdict = F.lit(True)
    for rule in reversed(chain):
        verdict = F.when(F.coalesce(rule.reject, F.lit(False)), F.lit(False)).otherwise(verdict)
    return verdict


def judge(docs: DataFrame, text: str = "text", sample_rows: int = 400) -> DataFrame:
    """Adds the measures, base_failed and kept to whole documents."""
    sample = measured(sampled(docs.select(text), sample_rows), text).where(~base_failed())
    chain = ordered(sample, rules(text))
    rows = measured(docs, text)
    return rows.withColumn("base_failed", base_failed()).withColumn(
        "kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(chain)))
