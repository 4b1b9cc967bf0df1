"""Checks that return their findings as DataFrames (E9 and unique / not-null tests)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: how many NULLs it holds."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in cols]
    return counts.select(F.inline(F.array(*pairs)))


def check_labels(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    """Values outside the known list with their counts."""
    return (df.where(~F.coalesce(F.col(column).isin(list(known)), F.lit(False)))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))


def freshness(df: DataFrame, loaded_at: str = "_ingested_at") -> DataFrame:
    """Newest load time of a table."""
    return df.agg(F.max(loaded_at).alias("loaded_at"), F.count(F.lit(1)).alias("n_rows"))
