"""Finding and repairing the ranges where a landed table differs from its source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .load import repair


def row_digest(columns: Sequence[str]) -> Column:
    """64-bit hash of a row; NULL and empty text differ."""
    return F.xxhash64(*[F.struct(F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string")) for c in sorted(columns)])


def digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows and an order-free digest per key: sums of row hashes, so rows that come twice count twice."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                 F.sum(row_digest(columns).cast("decimal(38,0)")).alias("digest"))


def _differing(source: DataFrame, landed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, n_source, n_landed) where the digests differ; a NULL key is a key."""
    both = [digests(df, keys, columns).select(*keys, F.col("n").alias(f"n_{name}"), F.col("digest").alias(f"d_{name}"))
            for name, df in (("source", source), ("landed", landed))]
    sides = both[0].withColumns({"n_landed": F.lit(None).cast("long"), "d_landed": F.lit(None).cast("decimal(38,0)")}).unionByName(
        both[1].withColumns({"n_source": F.lit(None).cast("long"), "d_source": F.lit(None).cast("decimal(38,0)")}))
    met = sides.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("n_source", "n_landed", "d_source", "d_landed")])
    differs = ~F.col("d_source").eqNullSafe(F.col("d_landed")) | ~F.col("n_source").eqNullSafe(F.col("n_landed"))
    return met.where(differs).select(*keys, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_source", "n_landed")])


def discrepancies(source: DataFrame, landed: DataFrame, columns: Sequence[str] | None = None, account: str = "account_id",
                  day: str = "date") -> DataFrame:
    """(account, day, n_source, n_landed) of the days on which the two tables do not hold the same rows.

    Months are compared first; days only of the months that differ.
    ``columns`` are those compared, by default all that both sides have.
    """
    shared = [c for c in source.columns if c in landed.columns and c not in (account, day)]
    columns = list(columns or shared)
    sides = [df.select(account, F.col(day).cast("date").alias(day), *columns).withColumn("_month", F.trunc(day, "MM"))
             for df in (source, landed)]
    columns = [day, *columns]  # rows that moved to another day differ
    months = _differing(*sides, [account, "_month"], columns).select(F.col(account).alias("_a"), F.col("_month").alias("_m"))
    inside = [df.join(months, df[account].eqNullSafe(F.col("_a")) & df["_month"].eqNullSafe(F.col("_m")), "left_semi") for df in sides]
    return _differing(*inside, [account, day], columns)


def ranges(found: DataFrame, account: str = "account_id", day: str = "date", step: int = 1) -> DataFrame:
    """(account, start_date, end_date) of found days that lie at most ``step`` days apart."""
    w = Window.partitionBy(account).orderBy(day)
    new = F.coalesce((F.date_diff(F.col(day), F.lag(day).over(w)) > step).cast("int"), F.lit(1))
    runs = found.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(account, "_run").agg(F.min(day).alias("start_date"), F.max(day).alias("end_date")).drop("_run")


def repair_found(source: DataFrame, found: DataFrame, path: str, step: int = 1, **kwargs) -> int:
    """Reload every found range from the source; returns how many changed the table.

    The ranges, one per load that follows, go to the driver before the table
    changes. A range that the source has no rows of is left as it is, as an
    empty batch changes nothing.
    """
    done = 0
    for account, start, end in sorted(ranges(found, step=step).collect()):
        wanted = source.where((F.col("account_id") == account) & F.col("date").between(F.lit(start), F.lit(end)))
        done += repair(wanted, path, [account], start, end, **kwargs)
    return done
