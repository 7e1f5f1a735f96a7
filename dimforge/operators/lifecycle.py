"""Life cycle of a stored fact table: aged days move, old days go.

Tables are partitioned by day in the catalog. Which days are due is read from
the partition list, so no data of other days is touched; files of the days
that stay are left as they are. Every step can be run again after a stop.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.loads import insert_overwrite


def create_by_day(spark: SparkSession, df: DataFrame, table: str, day: str) -> str:
    """``df`` as a catalog table with one partition per ``day``."""
    df.hint("rebalance", day).write.partitionBy(day).saveAsTable(table)
    return table


def days_of(spark: SparkSession, table: str) -> list[dt.date]:
    """Days that have a partition; a null day has none here."""
    names = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return sorted(dt.date.fromisoformat(n) for n in names if n[:1].isdigit())


def drop_days(spark: SparkSession, table: str, day: str, days: Sequence[dt.date]) -> None:
    for d in days:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({day} = '{d.isoformat()}')")


def retain(spark: SparkSession, table: str, day: str, as_of: str, keep_days: int) -> list[dt.date]:
    """Drop all but the last ``keep_days`` days up to ``as_of``; the days
    dropped. Rows without a day are in no dated partition and stay."""
    first = dt.date.fromisoformat(as_of) - dt.timedelta(days=keep_days - 1)
    gone = [d for d in days_of(spark, table) if d < first]
    drop_days(spark, table, day, gone)
    return gone


def strip_aged(spark: SparkSession, table: str, stripped: str, day: str, as_of: str, keep_days: int,
               pii: Sequence[str]) -> list[dt.date]:
    """Move the days older than ``keep_days`` before ``as_of`` into ``stripped``,
    a SHA-256 in place of each column of ``pii``; the days moved.

    The days are written there whole (a day already there is replaced) before
    they are dropped here, so a stop in between repeats the write and no row
    is lost or stands twice in the end.
    """
    first = dt.date.fromisoformat(as_of) - dt.timedelta(days=keep_days)
    aged = [d for d in days_of(spark, table) if d < first]
    if not aged:
        return aged
    rows = spark.table(table).filter(F.col(day).isin(*aged))
    for c in pii:
        rows = rows.withColumn(f"{c}_hash", F.sha2(F.col(c).cast("string"), 256)).drop(c)
    if not spark.catalog.tableExists(stripped):
        create_by_day(spark, rows.limit(0), stripped, day)
    insert_overwrite(rows.hint("rebalance", day), stripped)
    drop_days(spark, table, day, aged)
    return aged
