"""Report measures over marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.casts import ratio


def financials(roi: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Spend, revenue, sales, ROAS, ROI, CTR % and CPC per ``dims``."""
    sums = ["cost", "impressions", "clicks", "revenue", "total_sales", "new_customers_count"]
    out = roi.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in sums])
    return out.withColumns({
        "roas": ratio("revenue", "cost"),
        "roi": ratio(F.col("revenue") - F.col("cost"), "cost"),
        "ctr_pct": ratio(F.col("clicks") * 100, "impressions"),
        "cpc": ratio("cost", "clicks"),
    })


def year_over_year(yearly: DataFrame, dims: Sequence[str], measures: Sequence[str], year: str = "year") -> DataFrame:
    """Each measure with its value one year earlier and the relative change.

    ``yearly`` has one row per year and dimension values, so the year before is
    the row before, if it is there. NULL dimension values compare as equal.
    """
    w = Window.partitionBy(*dims).orderBy(year)
    there = F.lag(year).over(w) == F.col(year) - 1
    joined = yearly.withColumns({f"{m}_prev": F.when(there, F.lag(m).over(w)) for m in measures})
    return joined.withColumns({
        f"{m}_yoy": ratio(F.col(m) - F.col(f"{m}_prev"), f"{m}_prev") for m in measures})


def year_to_date(mart: DataFrame, dims: Sequence[str], measures: Sequence[str], day: str = "date") -> DataFrame:
    """Daily sums and their running total within the year.

    Aggregated first, so a window holds at most one row per day of a year.
    """
    daily = mart.groupBy(*dims, day).agg(*[F.sum(m).alias(m) for m in measures])
    w = (Window.partitionBy(*dims, F.year(day)).orderBy(day)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.withColumns({f"{m}_ytd": F.sum(m).over(w) for m in measures})
