"""Delivery status of a campaign."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from .casts import as_col
from .text import initcap_words

# Status words of the two ad interfaces and the shown labels.
ENDED, PAUSED, REMOVED, ENABLED, SERVING, ACTIVE = (
    "ENDED", "PAUSED", "REMOVED", "ENABLED", "SERVING", "ACTIVE")
COMPLETED, OFF, DELETED, RUNNING, IDLE = (
    "Completed", "Off", "Deleted", "Active", "Not delivering")


def delivery_status_a(status: str | Column, serving: str | Column, end: str | Column, as_of: date) -> Column:
    s, v, e = as_col(status), as_col(serving), as_col(end)
    return (F.when((v == ENDED) | (e < F.lit(as_of)), F.lit(COMPLETED))
            .when(s == PAUSED, F.lit(OFF))
            .when(s == REMOVED, F.lit(DELETED))
            .when((s == ENABLED) & (v == SERVING), F.lit(RUNNING))
            .otherwise(F.coalesce(initcap_words(v), initcap_words(s), F.lit(IDLE))))


def delivery_status_b(status: str | Column, stop: str | Column, as_of: date) -> Column:
    s = as_col(status)
    return (F.when(F.to_date(as_col(stop)) < F.lit(as_of), F.lit(COMPLETED))
            .when(s == PAUSED, F.lit(OFF))
            .when(s == ACTIVE, F.lit(RUNNING))
            .otherwise(F.coalesce(initcap_words(s), F.lit(IDLE))))
