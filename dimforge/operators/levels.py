"""Stored merge levels: an hourly load merges with the levels it completes.

A binary counter of tables: an hour lands on the lowest free level, taking
with it all levels below, which it empties. After n loads there are at most
log2(n) + 1 levels, each row was rewritten that often, and no load reads the
whole day. Every load writes one level and publishes it together with the
emptied ones, so a load that stops half-way has changed nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.common import cols
from dimforge.operators.published import PublishedTable

LEVEL = "level"


class MergeLevels:
    """``merge`` turns rows of several levels into one row per key; it must not
    matter in which groups rows are merged. Hours are loaded in ascending
    order; one that was loaded before is left as it is."""

    def __init__(self, spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame]):
        self.table, self.merge = PublishedTable(spark, root, LEVEL), merge

    def load(self, hour: int, rows: DataFrame) -> None:
        now = self.table.manifest()
        if now["token"] is not None and hour <= now["token"]:
            return
        held = {int(v) for v, p in now["partitions"].items() if p["rows"]}
        level = 0
        while level in held:
            level += 1
        if level:
            rows = rows.unionByName(self.table.read(range(level)).drop(LEVEL))
        self.table.load(self.merge(rows).withColumn(LEVEL, F.lit(level)), range(level + 1), token=hour)

    def read(self) -> DataFrame:
        """All hours loaded so far, one row per key."""
        return self.merge(self.table.read().drop(LEVEL))


def first_copies(keys: str | Sequence[str], values: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge for dedupe: of ``first_seen, n_copies`` rows of a key, the values
    of the first copy and the number of all."""
    keys = cols(keys)

    def merge(rows: DataFrame) -> DataFrame:
        first = F.min(F.struct("first_seen", *values)).alias("_f")
        g = rows.groupBy(*keys).agg(first, F.sum("n_copies").alias("n_copies"))
        return g.select(*keys, *[f"_f.{v}" for v in values], "_f.first_seen", "n_copies")

    return merge
