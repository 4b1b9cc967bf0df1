"""Ordered first-match rules compiled to one CASE expression.

Covers C2-C4 (naming), C13 (recodes), C21-C25 (conversion classes, metric
routing, value guard), C27-C29 (source platforms, paid media, flags). A rule
list is data owned by the caller; nothing here knows any business word.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .casts import as_col


@dataclass(frozen=True)
class Rule:
    """Gives ``label`` when any of the listed tests holds.

    ``column`` overrides the column the whole list is applied to, so that one
    list can test an action name first and a category afterwards. ``fold`` is
    ``None`` (case-sensitive), ``"lower"`` or ``"upper"``; folded rules compare
    folded column and folded pattern.
    """

    label: str | None = None
    equals: tuple[str, ...] = ()
    like: tuple[str, ...] = ()
    contains: tuple[str, ...] = ()
    column: str | None = None
    fold: str | None = None
    trim: bool = False


def _fold(text: str, fold: str | None) -> str:
    return {"lower": text.lower, "upper": text.upper, None: lambda: text}[fold]()


def matches(rule: Rule, column: str | Column | None = None) -> Column:
    """Boolean test of one rule; NULL input gives NULL, which no branch takes."""
    c = as_col(rule.column if rule.column is not None else column)
    if rule.trim:
        c = F.trim(c)
    if rule.fold is not None:
        c = F.lower(c) if rule.fold == "lower" else F.upper(c)
    tests = []
    if len(rule.equals) == 1:
        tests.append(c == F.lit(_fold(rule.equals[0], rule.fold)))
    elif rule.equals:
        tests.append(c.isin([_fold(v, rule.fold) for v in rule.equals]))
    tests += [c.like(_fold(p, rule.fold)) for p in rule.like]
    tests += [c.contains(_fold(p, rule.fold)) for p in rule.contains]
    if not tests:
        raise ValueError(f"rule {rule.label!r} has no test")
    return reduce(lambda a, b: a | b, tests)


def any_match(rules: Sequence[Rule], column: str | Column | None = None) -> Column:
    """True when at least one rule holds, else False (never NULL)."""
    if not rules:
        return F.lit(False)
    return F.coalesce(reduce(lambda a, b: a | b, [matches(r, column) for r in rules]), F.lit(False))


def first_match(column: str | Column | None, rules: Sequence[Rule], default: str | Column | None = None) -> Column:
    """Label of the first rule that holds, in list order, else ``default``."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    if not rules:
        return fallback
    chain = F
    for rule in rules:
        chain = chain.when(matches(rule, column), F.lit(rule.label))
    return chain.otherwise(fallback)


def with_first_match(df: DataFrame, name: str, column: str, rules: Sequence[Rule],
                     default: str | Column | None = None) -> DataFrame:
    """``df`` with :func:`first_match` as column ``name``.

    Folds the text once per row; inside one expression every rule would fold
    it again, which adds up for long keyword lists.
    """
    folds = {r.fold: f"_{r.fold}" for r in rules if r.fold and not r.trim and r.column is None}
    folded = df.withColumns({tmp: getattr(F, fold)(F.col(column)) for fold, tmp in folds.items()})
    plain = [replace(r, column=folds[r.fold], fold=None, equals=_folded(r.equals, r), like=_folded(r.like, r),
                     contains=_folded(r.contains, r)) if r.fold in folds and not r.trim and r.column is None else r
             for r in rules]
    return folded.withColumn(name, first_match(column, plain, default)).drop(*folds.values())


def _folded(patterns: Sequence[str], rule: Rule) -> tuple[str, ...]:
    return tuple(_fold(p, rule.fold) for p in patterns)


def recode(column: str | Column, mapping: Mapping[str, str], default: str | Column | None = None) -> Column:
    """Exact-value recode."""
    return first_match(column, [Rule(v, equals=(k,)) for k, v in mapping.items()], default)


def flag_in(column: str | Column, values: Sequence[str]) -> Column:
    """1 when the trimmed lower-cased value is listed, else 0."""
    return any_match([Rule(equals=tuple(values), fold="lower", trim=True)], column).cast("int")


def route_metric(secondary: Sequence[Rule], alternative: str | Column, base: str | Column,
                 column: str | Column | None = None) -> Column:
    """Secondary actions read ``alternative``, all others ``base``."""
    return F.when(any_match(secondary, column), as_col(alternative)).otherwise(as_col(base))


def guard_value(value: str | Column, allow: Sequence[Rule], deny: Sequence[Rule] = (),
                column: str | Column | None = None) -> Column:
    """Value for allowed rows, 0.0 for denied and all other rows."""
    return (F.when(any_match(deny, column), F.lit(0.0))
            .when(any_match(allow, column), as_col(value).cast("double"))
            .otherwise(F.lit(0.0)))


@dataclass(frozen=True)
class Keep:
    """Class filter of one platform: only the listed classes, or all but them."""

    only: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()


def keep_classes(df: DataFrame, platform_col: str, class_col: str, keeps: Mapping[str, Keep]) -> DataFrame:
    """Per-platform class filter after stacking (C25); other platforms go."""
    tests = []
    for platform, keep in keeps.items():
        test = F.col(platform_col) == F.lit(platform)
        if keep.only:
            test = test & F.col(class_col).isin(list(keep.only))
        if keep.drop:
            test = test & ~F.col(class_col).isin(list(keep.drop))
        tests.append(test)
    return df.where(reduce(lambda a, b: a | b, tests, F.lit(False)))


def paid_media(df: DataFrame, source_col: str, medium_col: str, explicit: Sequence[str],
               ambiguous: Sequence[str], paid_mediums: Sequence[str]) -> DataFrame:
    """Explicitly paid source, or ambiguous source with a paid medium."""
    source, medium = F.col(source_col), F.col(medium_col)
    return df.where(source.isin(list(explicit))
                    | (source.isin(list(ambiguous)) & medium.isin(list(paid_mediums)) & (source != "")))
