"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space, the word separator of most operators.
BLANKS = " \t\n\x0b\f\r"
ROOT = str(Path(__file__).resolve().parents[2])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Let local Python workers import this package; on a cluster it is installed or sent with --py-files."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{paths}".rstrip(":")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, else one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows with a unique number, written to the shared folder once, so that every reader sees the same numbers."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/numbered-{uuid.uuid4().hex}"
    df.withColumn(name, F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder as compressed Parquet, and read from there."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered 0, 1, 2 ... in `order`, which should end in a unique column; no task holds more than a range.

    The rows are range-sorted and stored; a row's number is its place in its partition and the rows of those before.
    `df` is read twice, once for the bounds of the ranges.
    """
    count = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = df.select(F.struct("*").alias("row"), F.struct(*order).alias("by")).repartitionByRange(count, "by")
    rows = cut(rows.sortWithinPartitions("by").select("row", F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = F.broadcast(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    placed = rows.join(starts, part == F.col("part"))
    return placed.select("row.*", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def salted_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """Join on one column; rows of a key are dealt to `salts` tasks, to each of which the key's right rows are copied."""
    dealt = left.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))  # any salt will do
    copied = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(copied, [on, "_salt"], how).drop("_salt")


def blank_words(text: Column) -> Column:
    """Words between ASCII white space; NULL and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def n_blank_words(text: Column) -> Column:
    return F.size(blank_words(text)).cast("long")


def running_start(df: DataFrame, group: list[str], bucket: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Exclusive running sum of `value` within `group`, over (`bucket`, `order`), without one task per group.

    `bucket` is a column of bounded cardinality that is ascending in the intended order. Sums per (group, bucket) are
    small, so the window over them is cheap; the rows themselves are only windowed inside their bucket.
    """
    cells = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = df.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return own.join(offsets, [*group, bucket]).withColumn(name, F.col("_base") + F.col("_own")).drop("_base", "_own")
