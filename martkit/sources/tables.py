"""Readers (A1, A3-A5) and view registration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .schemas import RAW, raw_schema

BOM = "﻿"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Landed table ``name`` below ``root`` with its declared schema (A1)."""
    reader = spark.read
    if name in RAW:
        reader = reader.schema(raw_schema(name))
    return reader.parquet(f"{root}/{name}")


def jdbc_options(url: str, query: str, properties: Mapping[str, str] | None = None, fetch_size: int = 10_000,
                 split: tuple[str, int, int, int] | None = None) -> dict[str, str]:
    """Options of a relational extract; ``split`` is (column, low, high, parts).

    The predicate travels inside ``query``, so the database filters. Without a
    split the extract is one connection; give one for large tables.
    """
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if split is None:
        return {**options, "query": query}
    column, low, high, parts = split
    return {**options, "dbtable": f"({query}) src", "partitionColumn": column, "lowerBound": str(low),
            "upperBound": str(high), "numPartitions": str(parts)}


def read_jdbc(spark: SparkSession, url: str, query: str, **kwargs) -> DataFrame:
    """Relational extract with a pushed-down query (A3)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **kwargs)).load()


def read_sheet(spark: SparkSession, path: str, columns: Sequence[str], header_marker: str | None = None) -> DataFrame:
    """Delimited seed or sheet, all columns text (A4).

    Takes a byte-order mark, lines that are quoted as a whole, and header rows
    repeated among the data (first column equal to ``header_marker``, by default
    its name). A record must not span lines.
    """
    marker = header_marker if header_marker is not None else columns[0]
    schema = ", ".join(f"`{c}` string" for c in columns)
    line = F.regexp_replace(F.col("value"), f"^{BOM}|\\r$", "")
    whole = line.rlike(r'^"[^"]*"$') & line.contains(",")
    line = F.when(whole, F.substring(line, 2, F.length(line) - 2)).otherwise(line)
    rows = spark.read.text(path).select(F.from_csv(line, schema).alias("r")).select("r.*")
    return rows.where(F.col(f"`{columns[0]}`") != F.lit(marker))


def seed(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Static reference rows (A5)."""
    return spark.createDataFrame(list(rows), schema)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a silver model as a logical view."""
    df.createOrReplaceTempView(name)
    return df
