"""The run parameter of all step and snapshot queries: the period they build.

By default it is the last period of the data, found by one aggregation over
the table: the last day of ``events`` and the last order year. A run for an
earlier period names it in ``DIMFORGE_RUN_DAY`` (YYYY-MM-DD) or
``DIMFORGE_RUN_YEAR``. ``DAY``, ``MONTH`` and ``YEAR`` say the same in the
oracle SQL.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.sources import tables as tb

RUN_DAY = os.environ.get("DIMFORGE_RUN_DAY")
RUN_YEAR = os.environ.get("DIMFORGE_RUN_YEAR")
# what an empty table counts as
NO_DAY, NO_YEAR = "1970-01-01", 1970

DAY = f"DATE '{RUN_DAY}'" if RUN_DAY else f"(SELECT coalesce(CAST(max(ts) AS DATE), DATE '{NO_DAY}') FROM events)"
MONTH = f"CAST(date_trunc('month', {DAY}) AS DATE)"
YEAR = RUN_YEAR or f"(SELECT CAST(coalesce(max(year(o_orderdate)), {NO_YEAR}) AS INTEGER) FROM orders)"


def last_day(events: DataFrame, ts: str = "ts") -> str:
    found = events.agg(F.to_date(F.max(ts))).first()[0]
    return found.isoformat() if found else NO_DAY


def day(spark: SparkSession, sf: str, shift: int = 0) -> str:
    """The run's day, ``shift`` days on."""
    at = RUN_DAY or last_day(tb.read(spark, sf, "events"))
    return (dt.date.fromisoformat(at) + dt.timedelta(days=shift)).isoformat()


def month(spark: SparkSession, sf: str) -> str:
    """First day of the run's month."""
    return day(spark, sf)[:8] + "01"


def year(spark: SparkSession, sf: str) -> int:
    """The run's year."""
    if RUN_YEAR:
        return int(RUN_YEAR)
    return tb.read(spark, sf, "orders").agg(F.year(F.max("o_orderdate"))).first()[0] or NO_YEAR
