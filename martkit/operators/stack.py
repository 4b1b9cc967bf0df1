"""Schema alignment and stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def align(df: DataFrame, schema: Sequence[tuple[str, str]], fills: Mapping[str, object] | None = None) -> DataFrame:
    """Target columns in target order and type; absent ones take a fill or a typed NULL."""
    fills = fills or {}
    have = set(df.columns)
    cols = []
    for name, dtype in schema:
        if name in fills:
            c = fills[name] if isinstance(fills[name], Column) else F.lit(fills[name])
        else:
            c = F.col(name) if name in have else F.lit(None)
        cols.append(c.cast(dtype).alias(name))
    return df.select(*cols)


def stack(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name, so a swapped column order cannot mix values."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def zero_metrics(df: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """Typed zeros for delivery metrics on conversion-grain rows (C20)."""
    return df.withColumns({name: F.lit(0).cast(dtype) for name, dtype in metrics.items()})
