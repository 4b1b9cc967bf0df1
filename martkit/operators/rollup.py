"""Rollups with recomputed ratios."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.casts import ratio

DELIVERY_RATIOS = {"ctr": ("clicks", "impressions"), "unique_ctr": ("unique_clicks", "impressions"),
                   "average_cpc": ("cost", "clicks")}
_CODE = "_code"


def rollup(df: DataFrame, keys: Sequence[str], sums: Sequence[str], attrs: Sequence[str] = (),
           ratios: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """SUM measures, MAX dependent attributes, ratios from the sums.

    Sums combine before the shuffle, so hot keys cost one row per map task.
    MAX over text would sort every row; grouped with the attributes first, rows
    are hashed, and only the few groups per key are sorted.
    """
    if attrs:
        df = df.groupBy(*keys, *attrs).agg(*[F.sum(c).alias(c) for c in sums])
    return rollup_once(df, keys, sums, attrs, ratios)


def rollup_once(df: DataFrame, keys: Sequence[str], sums: Sequence[str], attrs: Sequence[str] = (),
                ratios: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """As :func:`rollup`, for keys of few rows each, which grouping with the attributes first would shuffle twice.

    Every task sorts its rows, so ``df`` should come out of a shuffle, whose
    parts are small.
    """
    out = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in attrs])
    return out.withColumns({name: ratio(n, d) for name, (n, d) in (ratios or {}).items()})


def rollup_direct(df: DataFrame, keys: Sequence[str], sums: Sequence[str], attrs: Sequence[str] = (),
                  ratios: Mapping[str, tuple[str, str]] | None = None, hot_rows: int = 100_000,
                  by: Sequence[str] | None = None, describe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """As :func:`rollup`, for rows as they come from a scan: nothing is sorted or combined before the one shuffle.

    Rows are dealt to tasks ``by`` some of the keys, by default all. Where more
    than ``hot_rows`` rows would go together, their hashes, counted first and at
    most one per ``hot_rows`` rows, leave them to :func:`rollup`. Adaptive
    execution drops that part where there are none. ``df`` is read twice, first
    in its keys only, and once more for hot keys.

    ``describe`` adds the ``attrs`` that ``df`` lacks, as they follow from keys
    and other attributes, to groups of rows; the shuffle is without them.
    """
    by = by or keys
    coded = df.withColumn(_CODE, F.xxhash64(*[F.col(k) for k in by]))
    hot = F.broadcast(coded.groupBy(_CODE).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(_CODE))
    own = [c for c in attrs if c in df.columns]

    def whole(rows: DataFrame) -> DataFrame:
        return describe(rows.groupBy(*keys, *own).agg(*[F.sum(c).alias(c) for c in sums])) if describe else rows

    direct = whole(coded.join(hot, _CODE, "left_anti").repartition(*[F.col(k) for k in by]))
    return rollup_once(direct, keys, sums, attrs, ratios).unionByName(
        rollup(whole(coded.join(hot, _CODE, "left_semi")), keys, sums, attrs, ratios))


def phrase_totals(stats: DataFrame, keys: Sequence[str], measure: str, total: str) -> DataFrame:
    """Totals over all dates."""
    return stats.groupBy(*keys).agg(F.sum(measure).alias(total))


def top_phrases(totals: DataFrame, keys: Sequence[str], phrase: str, total: str, k: int, out: str,
                separator: str = "\n", texts: DataFrame | None = None, text: str | None = None) -> DataFrame:
    """The ``k`` largest phrases per key as one ordered text.

    ``texts`` gives the chosen phrases their ``text`` where ``phrase`` is a key.

    Ranked first: the window limits each map task to ``k`` rows per key, and
    the list that is collected afterwards holds at most ``k`` entries.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(total).desc_nulls_last(), F.col(phrase).asc_nulls_last())
    ranked = totals.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    if texts is not None:
        ranked = ranked.join(texts, phrase, "left")
    entry = F.struct("_rank", F.concat(F.col(text or phrase), F.lit(" ("), F.col(total).cast("string"), F.lit(")")).alias("t"))
    listed = F.array_sort(F.collect_list(entry))
    return (ranked.groupBy(*keys).agg(listed.alias("_list"))
            .withColumn(out, F.array_join(F.transform("_list", lambda x: x["t"]), separator)).drop("_list"))
