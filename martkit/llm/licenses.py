"""Licence scans by a positional index of rare words.

The index holds, for the rarest words of each licence template's key phrase, the template and the word's place in it;
rarity is the document frequency over all files. As the phrase is mandatory, no place is missed for want of votes. In a file, the occurrences of such words vote for (template, start): votes of different
words for one start agree on their relative positions. A start with enough votes is verified: the template's key phrase
must stand in its place. The score is the share of a verified template's words that stand in their places.

Everything happens inside the row but for the count of document frequencies, which has one row per template word.

Defined results: a NULL text is empty; a file without words has no labels and score 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE, VOTES = 3, 2  #: rare words per key phrase, votes that a start needs (fewer if the phrase has fewer)
SHIFT, MIDDLE = 1 << 40, 1 << 39


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        """The place of the key phrase's first word."""
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


# fixed values: phrases of well-known licence notices, lower-cased
TEMPLATES = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "free of charge to any person"),
    Template("apache", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("apache", "you may not use this file except in compliance with the license", "except in compliance"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    Template("gpl", "under the terms of the gnu general public license as published by", "gnu general public license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by", "licensed under the creative commons attribution 4 0 international license",
             "creative commons attribution"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
)
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def words(text: Column) -> Column:
    """Lower-cased words of letters, digits and non-ASCII characters.

    lower() also changes other letters; two of them would become ASCII and are set apart before.
    """
    body = F.coalesce(text, F.lit(""))
    for odd in ("K", "İ"):
        body = F.replace(body, F.lit(odd), F.lit("ǂ"))
    return F.array_remove(F.split(F.lower(body), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _rarest(docs: DataFrame, templates: tuple[Template, ...]) -> dict[str, float]:
    """Inverse document frequency of every template word, over all files."""
    vocabulary = sorted({w for t in templates for w in t.words})
    present = F.array_intersect(F.array(*map(F.lit, vocabulary)), "_words")
    seen = docs.select(F.explode(F.concat(present, F.array(F.lit("")))).alias("w")).groupBy("w").count()
    counts = dict(seen.collect())  # one row per template word, and the number of files
    files = counts.get("", 0)
    return {w: math.log((1 + files) / (1 + counts.get(w, 0))) for w in vocabulary}


def scan(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels and score."""
    rows = docs.withColumn("_words", words(F.col(text)))
    idf = _rarest(rows, templates)
    postings: dict[str, list[tuple[int, int]]] = {}
    need = []
    for number, t in enumerate(templates):
        rare = sorted(set(t.key.split()), key=lambda w: (-idf[w], w))[:RARE]
        need.append(min(VOTES, len(rare)))
        for place, w in enumerate(t.words):
            if w in rare:
                postings.setdefault(w, []).append((number, place))
    index = F.create_map(*[x for w, p in postings.items() for x in (
        F.lit(w), F.array(*[F.lit(t * SHIFT + MIDDLE - place).cast("long") for t, place in p]))])
    rare_words = F.array(*map(F.lit, postings))
    at = F.filter(F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.cast("long").alias("i"))),
                  lambda e: F.array_contains(rare_words, e["w"]))
    votes = F.flatten(F.transform(at, lambda e: F.transform(F.element_at(index, e["w"]), lambda p: p + e["i"])))
    rows = rows.withColumn("_votes", F.when(F.arrays_overlap(rare_words, "_words"), F.array_sort(votes)))
    needed = F.array(*map(F.lit, need))
    template = lambda v: F.shiftright(v, 40).cast("int")
    agreed = F.filter("_votes", lambda v, j: (
        F.get("_votes", j + F.get(needed, template(v)) - 1).eqNullSafe(v) & ~F.get("_votes", j - 1).eqNullSafe(v)))
    rows = rows.withColumn("_starts", F.transform(agreed, lambda v: F.struct(
        template(v).alias("t"), ((v % SHIFT) - MIDDLE).cast("int").alias("s"))))
    keys = F.array(*[F.array(*map(F.lit, t.key.split())) for t in templates])
    key_at = F.array(*[F.lit(t.key_at) for t in templates])
    bodies = F.array(*[F.array(*map(F.lit, t.words)) for t in templates])
    names = F.array(*[F.lit(t.label) for t in templates])

    def holds(e: Column) -> Column:
        key, first = F.get(keys, e["t"]), e["s"] + F.get(key_at, e["t"])
        return (first >= 0) & (F.slice("_words", F.greatest(first, F.lit(0)) + 1, F.size(key)) == key)

    def share(e: Column) -> Column:
        body = F.get(bodies, e["t"])
        there = F.filter(body, lambda w, k: F.get("_words", e["s"] + k).eqNullSafe(w))
        return F.size(there) / F.size(body)

    rows = rows.withColumn("_found", F.filter("_starts", holds))
    line = F.concat(F.lit(" "), F.array_join("_words", "  "), F.lit(" "))
    rows = rows.withColumn("_line", line)
    places, firsts, lasts, base = [], [], [], []
    for phrase, label in BASE:
        mark = " " + phrase.replace(" ", "  ") + " "
        count = ((F.length("_line") - F.length(F.replace("_line", F.lit(mark), F.lit("")))) / len(mark)).cast("long")

        def before(end: Column) -> Column:
            head = F.substring("_line", F.lit(1), end)
            return ((F.length(head) - F.length(F.replace(head, F.lit(" "), F.lit("")))) / 2).cast("long")

        start = F.instr("_line", F.lit(mark))
        back = F.instr(F.reverse("_line"), F.lit(mark[::-1]))
        places.append(count)
        firsts.append(F.when(start > 0, before(start - 1)))
        lasts.append(F.when(start > 0, before(F.length("_line") - back + 1 - len(mark))))
        base.append(F.when(start > 0, F.lit(label)))
    rows = rows.withColumn("_base", F.array_sort(F.array_compact(F.array(*base))))
    found = F.coalesce(F.transform("_found", lambda e: F.get(names, e["t"])), F.array().cast("array<string>"))
    result = {
        "n_words": F.size("_words").cast("long"), "n_base": sum(places[1:], places[0]), "first_word": F.least(*firsts),
        "last_word": F.greatest(*lasts), "base_labels": F.array_join("_base", ","),
        "labels": F.array_join(F.array_sort(F.array_distinct(F.concat("_base", found))), ","),
        "score": F.coalesce(F.array_max(F.transform("_found", share)), F.lit(0.0))}
    kept = [c for c in docs.columns if c not in result]
    return rows.select(*kept, *[c.alias(n) for n, c in result.items()])
