"""Rows that break rules are set apart, with the rules they broke, in the pass that writes the others."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.casts import as_col

SIDE = "_side"
ACCEPTED, REJECTED = "accepted", "rejected"


@dataclass(frozen=True)
class Screened:
    """Both sides as written, and how many rows were seen, were rejected and broke each rule."""

    accepted: DataFrame
    rejected: DataFrame
    n_rows: int
    n_rejected: int
    broken: dict[str, int]

    def counts(self) -> DataFrame:
        """One row per rule: (rule, n_rows), rules that no row broke included."""
        return self.rejected.sparkSession.createDataFrame(list(self.broken.items()), "rule string, n_rows long")


def parses(column: str | Column, dtype: str) -> Column:
    """Rule: missing, or text that parses as the type."""
    c = as_col(column)
    return c.isNull() | c.try_cast(dtype).isNotNull()


def failed_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that do not hold, in their order; a rule that yields NULL does not hold."""
    names = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def screen(df: DataFrame, rules: Mapping[str, Column], path: str, failed: str = "failed") -> Screened:
    """Write accepted and rejected rows below ``path`` in one pass over ``df``.

    Rejected rows keep all their columns and gain ``failed``, the names of the
    rules they broke. The counters are observed by the same job.
    """
    taken = {c.lower() for c in df.columns} & {failed.lower(), SIDE}
    if taken:
        raise ValueError(f"columns of these names are needed: {sorted(taken)}")
    judged = df.withColumn(failed, failed_rules(rules))
    bad, seen = F.size(failed) > 0, Observation()
    broken = [F.count_if(F.array_contains(failed, name)).alias(f"rule{i}") for i, name in enumerate(rules)]
    (judged.withColumn(SIDE, F.when(bad, F.lit(REJECTED)).otherwise(F.lit(ACCEPTED)))
     .observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"), *broken)
     .write.mode("overwrite").partitionBy(SIDE).parquet(path))
    spark = df.sparkSession
    written = spark.read.schema(judged.withColumn(SIDE, F.lit("")).schema).parquet(path)
    sides = {side: written.where(F.col(SIDE) == side).drop(SIDE) for side in (ACCEPTED, REJECTED)}
    got = seen.get
    return Screened(sides[ACCEPTED].drop(failed), sides[REJECTED], got["n"], got["bad"],
                    {name: got[f"rule{i}"] for i, name in enumerate(rules)})
