"""Tables bucketed by the key that dedup and lookups share, so that neither shuffles the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = (),
                   path: str | None = None) -> DataFrame:
    """Save ``df`` as ``table`` of the session's catalog in ``buckets`` buckets of ``keys``, and read it.

    Rows are dealt by the same hash first, so that each bucket is one file. A
    window or an aggregate whose keys include ``keys``, and a join on them with
    a table of as many buckets, then need no exchange. A bucket is read by one
    task: choose keys whose largest group fits one (not a campaign that holds a
    third of all rows), and buckets of some hundred MB.
    """
    spark = df.sparkSession
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    writer = writer.sortBy(*(sort or keys))
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return spark.table(table)
