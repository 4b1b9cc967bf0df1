"""Load semantics on date-partitioned Parquet tables.

A range reload claims the days it touches, writes the merged days to a staging
folder of its own beside the table, marks it complete, and only then swaps the
days one by one. A load that stops before the mark leaves the table as it was;
one that stops after it is finished by the next call (:func:`recover`), so no
account loses rows, and loads of other accounts may run at the same time. Whole
tables are replaced the same way. See :mod:`martkit.sources.claims`.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.stack import stack
from .claims import Folder as _Folder
from .claims import Load, recover, replace_table

log = logging.getLogger(__name__)


def stamp(df: DataFrame, at: datetime | None = None, column: str = "_ingested_at") -> DataFrame:
    """Ingestion time, by default that of this call, so a task that runs again writes the same."""
    return df.withColumn(column, F.lit(at or datetime.now(timezone.utc)).cast("timestamp"))


def open_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """The table at ``path``, or None before its first load.

    Give the declared ``schema``: without one the type of the partition column
    is guessed from its values, and text like ``007`` becomes a number.
    """
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_clustered(df: DataFrame, path: str, partition: str = "date", keys: Sequence[str] = (),
                    dynamic: bool = False) -> None:
    """Partition by ``partition``, sort by ``keys`` inside each file.

    The rebalance hint lets AQE merge small days into one task and split a day
    that is too large for one.
    """
    (df.hint("rebalance", partition).sortWithinPartitions(partition, *keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(partition).parquet(path))


def materialize(df: DataFrame, path: str, keys: Sequence[str] = (), partition: str = "date") -> DataFrame:
    """Rebuild a mart and read it back (B6); readers have the old one until the new one is whole."""
    replace_table(df.sparkSession, path, lambda folder: write_clustered(df, folder, partition, keys))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def full_refresh(df: DataFrame, path: str, wait: float = 0.0) -> bool:
    """Truncate and load; an empty batch changes nothing."""
    if df.isEmpty():
        return False
    replace_table(df.sparkSession, path, lambda folder: df.write.parquet(folder), wait)
    return True


def _days_of(folder: _Folder, day: str, start: date, end: date) -> set[str]:
    """Partition folders of the days of a range."""
    names = [n for n in folder.names() if n.startswith(f"{day}=")]
    return {n for n in names if f"{start}" <= n.removeprefix(f"{day}=") <= f"{end}"}


def reload_range(df: DataFrame, path: str, start: date, end: date, accounts: Sequence[str],
                 cluster: Sequence[str] = ("account_id", "campaign_id"), day: str = "date",
                 account: str = "account_id", wait: float = 0.0) -> bool:
    """Replace the rows of ``accounts`` between two dates by ``df``.

    Other accounts keep their rows; days that end up without any row go. An
    empty batch changes nothing. Rows outside the stated range or accounts are
    refused, since they would not replace what they claim to; so are columns
    whose names or types differ from the table's. While another load holds one
    of the days this one waits up to ``wait`` seconds, then raises ``Busy``.
    """
    spark = df.sparkSession
    recover(spark, path)
    batch = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mine = F.col(account).isin(list(accounts))
        inside = F.col(day).between(F.lit(start), F.lit(end))
        rows, valid = batch.agg(F.count(F.lit(1)), F.count(F.when(mine & inside, 1))).first()
        if rows == 0:
            return False
        if rows != valid:
            raise ValueError(f"{rows - valid} rows outside {start}..{end} or the listed accounts")
        # At most one value per day of the range reaches the driver.
        fresh = {f"{day}={r[0]}" for r in batch.select(day).distinct().collect()}
        with Load(spark, path, wait) as load:
            load.claim(fresh | _days_of(load.table, day, start, end))
            while more := _days_of(load.table, day, start, end) - load.held:  # written before they were claimed
                load.claim(more)
            old = open_table(spark, path)
            if old is None:
                before, merged = set(), batch
            else:
                # the day is a folder name, its type follows from the batch
                differing = {c for c, _ in set(old.drop(day).dtypes) ^ set(batch.drop(day).dtypes)}
                if differing or day not in old.columns:
                    raise ValueError(f"columns differ from the table: {sorted(differing)}")
                touched = open_table(spark, path, batch.schema).where(inside)
                kept = touched.where(~F.coalesce(mine, F.lit(False)))
                before = {f"{day}={r[0]}" for r in touched.select(day).distinct().collect()}
                merged = stack(kept, batch)
            write_clustered(merged, load.rows, day, cluster)
            after = {n for n in _Folder(spark, load.rows).names() if n.startswith(f"{day}=")}
            load.commit(sorted(after), before - after)
        return True
    finally:
        batch.unpersist()


def replace_days(df: DataFrame, path: str, days: Sequence[date], keys: Sequence[str] = (), day: str = "date",
                 wait: float = 0.0) -> None:
    """Replace the listed days by the rows of ``df``, which has no others; other days' files stay."""
    spark, names = df.sparkSession, {f"{day}={d}" for d in days}
    recover(spark, path)
    with Load(spark, path, wait) as load:
        load.claim(names)
        write_clustered(df.where(F.col(day).isin(list(days))), load.rows, day, keys)
        after = {n for n in _Folder(spark, load.rows).names() if n.startswith(f"{day}=")}
        load.commit(sorted(after), (names - after) & set(load.table.names()))


def reload_accounts(df: DataFrame, path: str, account: str = "account_id", keys: Sequence[str] = ()) -> bool:
    """Replace the snapshot of every account present in ``df`` (B2)."""
    if df.isEmpty():
        return False
    write_clustered(df, path, account, keys, dynamic=True)
    return True


def repair(df: DataFrame, path: str, accounts: Sequence[str], start: date, end: date, **kwargs) -> bool:
    """Forced range reload of listed accounts (B10); logs how many rows it left out."""
    wanted = F.coalesce(F.col("account_id").isin(list(accounts)) & F.col("date").between(start, end), F.lit(False))
    _log_left_out(df, wanted)
    return reload_range(df.where(wanted), path, start, end, accounts, **kwargs)


def _log_left_out(df: DataFrame, wanted: Column) -> None:
    count = df.where(~wanted).count()
    if count:
        log.warning("%d rows outside the stated range or accounts were left out", count)


def next_window(target: DataFrame | None, lookback: int, first: date, today: date,
                day: str = "date") -> tuple[date, date]:
    """Dates of the next load: newest day minus the lookback, or the first load."""
    newest = None if target is None else target.agg(F.max(day)).first()[0]
    return (first if newest is None else newest - timedelta(days=lookback)), today


def watermark(target: DataFrame, lookback: int, today: date, day: str = "date") -> DataFrame:
    """:func:`next_window` as a one-row DataFrame."""
    return target.agg(F.max(day).alias("last_date")).select(
        "last_date", F.date_sub("last_date", lookback).alias("start_date"), F.lit(today).alias("end_date"))


def date_chunks(ranges: DataFrame, n: int, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Consecutive chunks of ``n + 1`` days covering each range."""
    step = f"interval {n + 1} days"
    firsts = F.explode(F.sequence(F.col(start), F.col(end), F.expr(step)))
    return (ranges.where(F.col(start) <= F.col(end)).withColumn("chunk_start", firsts)
            .withColumn("chunk_end", F.least(F.date_add("chunk_start", n), F.col(end))))


def year_slices(first_year: int, today: date) -> list[tuple[date, date]]:
    """Year ranges of a backfill, the last one capped at ``today``."""
    return [(date(y, 1, 1), min(date(y, 12, 31), today)) for y in range(first_year, today.year + 1)]


def backfill(df: DataFrame, path: str, first_year: int, today: date, accounts: Sequence[str], **kwargs) -> int:
    """Range reload per year; returns the number of years that had rows, logs how many rows it left out."""
    done, slices = 0, year_slices(first_year, today)
    whole = df.persist(StorageLevel.MEMORY_AND_DISK)  # the source is read once, not once per year and for the count
    try:
        if slices:
            inside = F.col("date").between(F.lit(slices[0][0]), F.lit(slices[-1][1]))
            _log_left_out(whole, F.coalesce(inside, F.lit(False)))
        for start, end in slices:
            part = whole.where(F.col("date").between(F.lit(start), F.lit(end)))
            done += reload_range(part, path, start, end, accounts, **kwargs)
    finally:
        whole.unpersist()
    return done
