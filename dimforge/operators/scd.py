"""Slowly changing dimensions: type 2 backfill / incremental, point-in-time lookup, types 0/1/3."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.operators.common import streak_id

OPEN_END = 9999


def scd2_backfill(df: DataFrame, key: str, period: str, tracked: Sequence[str],
                  start: str = "start_season", end: str = "end_season",
                  current: int | None = None, current_col: str = "current_season") -> DataFrame:
    """Gaps-and-islands over the tracked attributes (null-safe change test).

    One shuffle on ``key``: the lag/running-sum windows and the collapse to
    one row per streak share the key partitioning. ``current`` stamps the run
    period as a literal (the reference took ``max(period)`` through a cross
    join; the run period is a parameter of the job instead).
    """
    s = streak_id(df.select(key, period, *tracked), key, period, tracked)
    out = (s.groupBy(key, "streak_id", *tracked)
            .agg(F.min(period).alias(start), F.max(period).alias(end))
            .drop("streak_id"))
    if current is not None:
        out = out.withColumn(current_col, F.lit(current))
    return out


def scd2_incremental(scd: DataFrame, today: DataFrame, key: str, tracked: Sequence[str],
                     prev_p: int, p: int, today_period: str, start: str = "start_season",
                     end: str = "end_season", current_col: str = "current_season",
                     extend_absent: bool = False) -> DataFrame:
    """Yesterday's SCD + today's snapshot -> today's SCD.

    Branches: historical (closed before ``prev_p``) pass through; for the
    open rows one FULL OUTER JOIN with today decides unchanged (extend end),
    changed (close old + open new: one row exploded to two), new, and absent
    today (kept closed, or -- ``extend_absent`` -- extended to ``p``).
    """
    at_prev = scd.filter(F.col(current_col) == prev_p)
    hist = at_prev.filter(F.col(end) < prev_p).select(key, *tracked, start, end)
    last = at_prev.filter(F.col(end) == prev_p).select(key, *tracked, start, end).alias("l")
    t = today.filter(F.col(today_period) == p).select(key, *tracked).alias("t")
    j = last.join(t, F.col(f"l.{key}") == F.col(f"t.{key}"), "full_outer")
    has_l, has_t = F.col(f"l.{start}").isNotNull(), F.col(f"t.{key}").isNotNull()
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"t.{c}"))

    def rec(side: str, s, e):
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in tracked], s.alias(start), e.alias(end))
    absent_end = F.lit(p) if extend_absent else F.col(f"l.{end}")
    recs = (F.when(has_l & has_t & same, F.array(rec("t", F.col(f"l.{start}"), F.lit(p))))
             .when(has_l & has_t, F.array(rec("l", F.col(f"l.{start}"), F.col(f"l.{end}")),
                                          rec("t", F.lit(p), F.lit(p))))
             .when(has_t, F.array(rec("t", F.lit(p), F.lit(p))))
             .otherwise(F.array(rec("l", F.col(f"l.{start}"), absent_end))))
    cur = j.select(F.coalesce(F.col(f"t.{key}"), F.col(f"l.{key}")).alias(key),
                   F.inline(recs))
    return hist.unionByName(cur).withColumn(current_col, F.lit(p))


CHUNK_PERIODS = 64      # periods (years, days) that one task looks through for a key
SALTS = 8               # tasks that may share the facts of one key and chunk


def _chunk(period: Column, kind: T.DataType) -> Column:
    """A coarse number that grows with the period."""
    days = F.datediff(period, F.lit("1970-01-01").cast("date")) if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else period
    return F.floor(days / CHUNK_PERIODS).cast("bigint")


def scd_asof_join(facts: DataFrame, scd: DataFrame, fact_key: str, scd_key: str, fact_period: str,
                  start: str = "start_season", end: str = "end_season",
                  current_end: int | None = None) -> DataFrame:
    """Point-in-time lookup: the version of the entity with ``start <= fact_period <= end``.

    No range join: facts and versions are one stream of rows, ordered by
    period, in which each fact takes the last version before it. The stream is
    cut into (key, chunk of periods); the version a chunk begins with comes
    from an aggregate of the versions per chunk. Facts are salted, versions
    stand in every salt, so neither a key with many versions nor one with many
    facts is one task's work, and both are read once. Versions of a key do not
    overlap (where they did, the last to begin would count). ``current_end``
    marks the still-open rows (``end == current_end``), which hold on. Facts
    with a null key or period, and those that no version covers, have nulls.
    """
    vals = [c for c in scd.columns if c != scd_key]
    until = F.col(end) if current_end is None else F.when(F.col(end) == current_end, F.lit(OPEN_END)).otherwise(F.col(end))
    kind = facts.schema[fact_period].dataType
    s = (scd.withColumn(end, until).select(F.col(scd_key).alias("_k"), F.col(start).cast(kind).alias("_p"), F.struct(*vals).alias("_v"))
            .withColumn("_c", _chunk(F.col("_p"), kind)))
    f = facts.select(F.col(fact_key).alias("_k"), F.col(fact_period).alias("_p"), F.struct(*facts.columns).alias("_f"))
    f = f.withColumn("_c", _chunk(F.col("_p"), kind)).withColumn("_s", F.pmod(F.xxhash64("_f"), F.lit(SALTS)).cast("int"))
    # what every chunk with rows begins with: a running last over one row per (key, chunk)
    last = s.groupBy("_k", "_c").agg(F.max_by("_v", "_p").alias("_last"))
    chunks = (last.unionByName(f.select("_k", "_c").distinct(), allowMissingColumns=True)
                  .groupBy("_k", "_c").agg(F.first("_last", ignorenulls=True).alias("_last")))
    before = Window.partitionBy("_k").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    heads = chunks.select("_k", "_c", F.last("_last", ignorenulls=True).over(before).alias("_v")).filter("_v IS NOT NULL")
    versions = heads.withColumn("_p", F.lit(None).cast(kind)).unionByName(s.select("_k", "_c", "_v", "_p"))
    versions = versions.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("_n", F.lit(0))
    rows = versions.unionByName(f.withColumn("_n", F.lit(1)), allowMissingColumns=True)
    # heads (no period) first, then versions before the facts of their period
    order = Window.partitionBy("_k", "_c", "_s").orderBy(F.col("_p").asc_nulls_first(), "_n")
    found = (rows.withColumn("_v", F.last("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
                 .filter("_f IS NOT NULL"))
    holds = F.col("_p") <= F.col(f"_v.{end}").cast(kind)
    return found.select("_f.*", F.when(holds, F.col("_v")).alias("_v")).select(*facts.columns, *[F.col(f"_v.{c}").alias(c) for c in vals])


def scd2_history(df: DataFrame, key: str, period: str, tracked: Sequence[str], start: str = "start_season",
                 end: str = "end_season", periods: str = "periods") -> DataFrame:
    """``scd2_backfill`` with the periods each streak was seen in, as
    ``scd2_splice`` needs them (at most one per period of the table)."""
    s = streak_id(df.select(key, period, *tracked), key, period, tracked)
    return (s.groupBy(key, "streak_id", *tracked)
             .agg(F.min(period).alias(start), F.max(period).alias(end), F.array_sort(F.collect_list(period)).alias(periods))
             .drop("streak_id"))


def scd2_splice(scd: DataFrame, changes: DataFrame, key: str, period: str, tracked: Sequence[str],
                start: str = "start_season", end: str = "end_season", periods: str = "periods") -> DataFrame:
    """Put values of any periods, past ones too, into stored streaks.

    ``changes`` has one row per (key, period). A streak that holds the period
    with other values is split around it, the value becomes a streak of its
    own, and neighbours with equal values grow together. Keys whose stored
    value is the same already, or that do not occur, come out as they are.
    Loading all periods in any order ends in ``scd2_backfill``'s streaks. Null
    keys match no other: their stored streaks stay.

    Streaks are taken apart into their periods, beside the changes, and built
    again; rows move once, by key.
    """
    known = F.col(key).isNotNull()
    stored = scd.filter(known).select(key, F.explode_outer(periods).alias(period), *tracked, F.lit(False).alias("_new"))
    rows = stored.unionByName(changes.select(key, period, *tracked, F.lit(True).alias("_new"))).repartition(F.col(key))
    rows = rows.withColumn("_replaced", F.max("_new").over(Window.partitionBy(key, period)))
    again = scd2_history(rows.filter(F.col("_new") | ~F.col("_replaced")), key, period, tracked, start, end, periods)
    # their own few partitions, or each splice would add those of the one before
    return again.unionByName(scd.filter(~known).select(*again.columns).hint("rebalance"))


def scd_type1(df: DataFrame, key: str, order: str, attrs: Sequence[str]) -> DataFrame:
    """Overwrite with the newest value; history lost."""
    return (df.groupBy(key).agg(F.max_by(F.struct(*attrs), F.col(order)).alias("_v"))
              .select(key, *[F.col(f"_v.{a}").alias(a) for a in attrs]))


def scd_type0(df: DataFrame, key: str, order: str, attrs: Sequence[str]) -> DataFrame:
    """Fixed value: the first one seen is kept, later changes ignored."""
    return (df.groupBy(key).agg(F.min_by(F.struct(*attrs), F.col(order)).alias("_v"))
              .select(key, *[F.col(f"_v.{a}").alias(a) for a in attrs]))


def scd_type3(df: DataFrame, key: str, order: str, attr: str) -> DataFrame:
    """Original, current and previous (value before the last change) per entity.

    Two aggregations, no per-row window over raw history: consecutive
    duplicates are collapsed by the streak ids first, so the window only
    sees one row per change.
    """
    s = streak_id(df.select(key, order, attr), key, order, [attr])
    changes = s.groupBy(key, "streak_id", attr).agg(F.min(order).alias("_from"))
    w = Window.partitionBy(key).orderBy("_from")
    changes = changes.withColumn("_prev", F.lag(attr).over(w))
    return (changes.groupBy(key)
                   .agg(F.min_by(F.col(attr), F.col("_from")).alias(f"original_{attr}"),
                        F.max_by(F.col(attr), F.col("_from")).alias(f"current_{attr}"),
                        F.max_by(F.col("_prev"), F.col("_from")).alias(f"previous_{attr}")))


def daily_snapshot(scd: DataFrame, key: str, attrs: Sequence[str], period: str = "snapshot_period",
                   start: str = "start_season", end: str = "end_season") -> DataFrame:
    """Full dimension copy per period, rebuilt from the SCD rows (``sequence`` explode, no join)."""
    return scd.select(key, *attrs, F.explode(F.sequence(F.col(start), F.col(end))).alias(period))


def scd_vs_snapshot(snapshot: DataFrame, scd: DataFrame) -> DataFrame:
    """Rows a daily snapshot needs vs rows the SCD needs, and the compaction ratio."""
    u = (snapshot.select(F.lit(1).alias("_s"), F.lit(0).alias("_c"))
                 .unionByName(scd.select(F.lit(0).alias("_s"), F.lit(1).alias("_c"))))
    a = u.agg(F.sum("_s").cast("bigint").alias("snapshot_rows"), F.sum("_c").cast("bigint").alias("scd_rows"))
    return a.withColumn("compaction_ratio", F.round(F.try_divide(F.col("snapshot_rows"), F.col("scd_rows")), 6))
