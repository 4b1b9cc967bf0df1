"""Joins of a large fact with a smaller side.

Building a plan starts no job for a derived side: Catalyst broadcasts by file
statistics, adaptive execution by the size of the shuffle it has just written,
and its skew handling splits a hot key's rows of the fact. A caller that has
counted a side once may ask for the broadcast. Sides of left lookups are cut to
one row per key, so the fact keeps its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, DataType, MapType, NumericType, StringType

from ..functions.casts import as_col
from .dedup import latest


@dataclass(frozen=True)
class Bound:
    """Largest counted side that is broadcast."""

    max_rows: int = 500_000
    max_bytes: int = 64 << 20


DEFAULT_BOUND = Bound()


def _width(name: str, dtype: DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(dtype, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)
    if isinstance(dtype, NumericType) or dtype.typeName() in ("date", "timestamp", "timestamp_ntz", "boolean"):
        return F.lit(16)
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(32)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a side, counted by one distributed aggregate."""
    width = F.lit(16)
    for field in df.schema:
        width = width + _width(field.name, field.dataType)
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()
    return row[0], row[1]


def fits(df: DataFrame, bound: Bound = DEFAULT_BOUND) -> bool:
    rows, size = measure(df)
    return rows <= bound.max_rows and size <= bound.max_bytes


def lookup(fact: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left", small: bool = False) -> DataFrame:
    """Join ``fact`` with ``side`` on equal column names.

    ``how`` is left, inner, left_anti or left_semi. ``small`` carries the
    answer of a size check; without one the join is left to statistics.
    """
    return fact.join(F.broadcast(side) if small else side, list(on), how)


def one_per_key(side: DataFrame, on: Sequence[str], order: str = "_ingested_at") -> DataFrame:
    """The newest row of every key; equal stamps, or a side without one, go by the remaining columns, largest first."""
    rest = [f.name for f in side.schema if f.name not in (*on, order) and not isinstance(f.dataType, MapType)]
    by = [c for c in (order, *rest) if c in side.columns] or list(on)
    return latest(side, list(on), by[0], by[1:])


def exclude_keys(df: DataFrame, keys: DataFrame, column: str, null_aware: bool = False) -> DataFrame:
    """Rows whose ``column`` is not among ``keys[column]``.

    By default NULL keys are ignored and NULL rows stay. ``null_aware`` follows
    SQL ``NOT IN``: a NULL key removes everything, and NULL rows go unless the
    key set is empty.
    """
    wanted = keys.select(column)
    kept = lookup(df, wanted.where(F.col(column).isNotNull()).distinct(), [column], "left_anti")
    if not null_aware:
        return kept
    seen = wanted.agg(F.count(F.lit(1)).alias("_keys"), F.count_if(F.col(column).isNull()).alias("_missing"))
    allowed = (F.col("_missing") == 0) & (F.col(column).isNotNull() | (F.col("_keys") == 0))
    return kept.join(F.broadcast(seen), allowed, "left_semi")  # one row


def missing_ids(needed: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """Distinct ids of ``needed`` that ``found`` lacks.

    Grouped with a mark instead of joined: a join may be moved below the
    DISTINCT, and then sorts every row of ``needed``.
    """
    there = F.col(column).isNotNull()
    if needed.schema[column].dataType != found.schema[column].dataType:  # compared as a join does
        return needed.select(column).where(there).distinct().join(found.select(column).distinct(), column, "left_anti")
    marked = needed.select(column, F.lit(False).alias("_found")).where(there).unionAll(
        found.select(column, F.lit(True).alias("_found")).where(there))
    return marked.groupBy(column).agg(F.max("_found").alias("_found")).where(~F.col("_found")).select(column)


def fill_gaps(found: DataFrame, fetched: DataFrame, column: str) -> DataFrame:
    """``found`` plus the ``fetched`` rows of ids it lacks (D12); those without an id stay out."""
    lacking = fetched.where(F.col(column).isNotNull()).join(found.select(column).distinct(), column, "left_anti")
    return found.unionByName(lacking.select(*fetched.columns))


def with_geo(df: DataFrame, targets: DataFrame, id_cols: Sequence[str], unknown: str = "Unknown",
             order: str = "_ingested_at") -> DataFrame:
    """Names of the first non-NULL geo id; ``unknown`` where it misses."""
    key = "_geo_key"
    names = {"region_name": "Name", "canonical_name": "Canonical Name",
             "country_code": "Country Code", "geo_target_type": "Target Type"}
    side = targets.select(F.col("`Criteria ID`").cast("string").alias(key), *[c for c in [order] if c in targets.columns],
                          *[F.col(f"`{src}`").alias(dst) for dst, src in names.items()])
    keyed = df.withColumn(key, F.coalesce(*[F.col(c).cast("string") for c in id_cols]))
    side = one_per_key(side.where(F.col(key).isNotNull()), [key], order).select(key, *names)
    joined = lookup(keyed, side, [key]).drop(key)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(unknown)) for c in names})


def with_country(df: DataFrame, countries: DataFrame, code: str = "country_code",
                 name: str = "country_name") -> DataFrame:
    """Country name, falling back to the code itself."""
    side = countries.select(F.col("country_code").alias(code), F.col("country_name").alias(name))
    return lookup(df, one_per_key(side, [code]), [code]).withColumn(name, F.coalesce(name, code))


def with_default(df: DataFrame, side: DataFrame, on: Sequence[str], defaults: dict[str, object],
                 order: str = "_ingested_at") -> DataFrame:
    """Left lookup whose misses take a default per column."""
    kept = one_per_key(side.select(*on, *defaults, *[c for c in [order] if c in side.columns and c not in defaults]), on, order)
    joined = lookup(df, kept.select(*on, *defaults), on)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def pacing(spend: DataFrame, budgets: DataFrame, key: str = "adset_id", order: str = "_ingested_at") -> DataFrame:
    """Spend rows with budget caps in units and the ad set status.

    ``budgets`` has caps in cents; the newest row of an ad set counts.
    """
    caps = budgets.select(
        key, *[c for c in [order] if c in budgets.columns],
        (F.coalesce(F.col("daily_budget").try_cast("double"), F.lit(0.0)) / 100.0).alias("daily_budget_cap"),
        (F.coalesce(F.col("lifetime_budget").try_cast("double"), F.lit(0.0)) / 100.0).alias("lifetime_budget_cap"),
        F.col("status").alias("adset_status"))
    return with_default(spend, caps, [key], {"daily_budget_cap": 0.0, "lifetime_budget_cap": 0.0,
                                             "adset_status": "UNKNOWN"}, order)


def with_creative(ads: DataFrame, bridge: DataFrame, creatives: DataFrame, columns: Sequence[str],
                  order: str | Column = "_ingested_at", tie: Sequence[str] | None = None, fan_out: bool = False) -> DataFrame:
    """Ad -> creative through the bridge.

    One bridge row per ad and one creative row per id, so the fact keeps its
    rows; ``fan_out`` joins the DISTINCT projections instead (N12).
    """
    pairs = bridge.select(F.col("ad_id").cast("string").alias("ad_id"),
                          F.col("creative_id").cast("string").alias("creative_id"), as_col(order).alias("_o"))
    looks = creatives.withColumn("creative_id", F.col("creative_id").cast("string"))
    if fan_out:
        pairs = pairs.drop("_o").distinct()
        looks = looks.select("creative_id", *columns).distinct()
    else:
        pairs = latest(pairs, ["ad_id"], "_o", ["creative_id"]).drop("_o")
        looks = latest(looks, ["creative_id"], order, tie).select("creative_id", *columns)
    pairs = pairs.where(F.col("ad_id").isNotNull())
    linked = lookup(pairs, looks, ["creative_id"]).drop("creative_id")
    if fan_out:
        linked = linked.distinct()
    return lookup(ads, linked, ["ad_id"])


def campaign_states(dim: DataFrame, status: Column, tie: Sequence[str] = ()) -> DataFrame:
    """(campaign_id, campaign_status) of the newest dimension row (F2).

    The status is computed here, once per campaign, not once per fact row.
    """
    keyed = dim.withColumn("campaign_id", F.col("campaign_id").cast("string"))
    newest = latest(keyed, ["campaign_id"], tie=[t for t in tie if t in dim.columns] or None)
    return newest.where(F.col("campaign_id").isNotNull()).select("campaign_id", status.alias("campaign_status"))


def with_status(fact: DataFrame, states: DataFrame, idle: str) -> DataFrame:
    """Fact with the status of its campaign, ``idle`` where the dim misses."""
    joined = lookup(fact.drop("campaign_status"), states, ["campaign_id"])
    return joined.withColumn("campaign_status", F.coalesce("campaign_status", F.lit(idle)))
