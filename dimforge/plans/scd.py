"""§2.2 slowly changing dimensions, bound to the `seasons` cumulative snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.operators import cumulation as cu
from dimforge.operators import scd
from dimforge.operators.common import fold_steps
from dimforge.operators.loads import load_partition_overwrite
from dimforge.plans import query
from dimforge.plans.cumulation import _BACKFILL_SQL, _TIER_SQL, season_backfill
from dimforge.plans.periods import YEAR, year
from dimforge.session import scratch_path
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views


def streak_sql(src: str, key: str, period: str, tracked: list[str], extra: str = "") -> str:
    """DuckDB gaps-and-islands: one row per (key, streak) with start/end."""
    same = " AND ".join(f"lag({c}) OVER w IS NOT DISTINCT FROM {c}" for c in tracked)
    tl = ", ".join(tracked)
    return f"""
SELECT {key}, {tl}, min({period}) AS start_season, max({period}) AS end_season{extra}
FROM (SELECT *, sum(c) OVER (PARTITION BY {key} ORDER BY {period} ROWS UNBOUNDED PRECEDING) AS sid
      FROM (SELECT {key}, {period}, {tl},
                   CASE WHEN row_number() OVER w > 1 AND {same} THEN 0 ELSE 1 END AS c
            FROM {src} WINDOW w AS (PARTITION BY {key} ORDER BY {period})) a) b
GROUP BY {key}, sid, {tl}"""


def snapshot(spark, sf, shift=0) -> DataFrame:
    return season_backfill(spark, sf, shift).select("player_id", "scoring_class", "is_active", "current_season")


def raw_tiers(spark, sf) -> DataFrame:
    s = tb.seasons(spark, sf)
    return s.select("player_id", "season", cu.tier(F.col("pts"), tb.SEASON_TIERS, cu.LABELS).alias("scoring_class"))


_RAW_SQL = with_views("seasons") + f""", raw AS (
SELECT player_id, season, {_TIER_SQL.format(c='pts')} AS scoring_class FROM seasons)
"""


@query("scd2_backfill", _BACKFILL_SQL + streak_sql("snap", "player_id", "current_season", ["scoring_class"]))
def q_scd2_backfill(spark, sf):
    return scd.scd2_backfill(snapshot(spark, sf), "player_id", "current_season", ["scoring_class"])


_MULTI_SQL = _BACKFILL_SQL + streak_sql("snap", "player_id", "current_season", ["scoring_class", "is_active"],
                                        extra=f", {YEAR} AS current_season")


@query("scd2_backfill_multi", _MULTI_SQL)
def q_scd2_backfill_multi(spark, sf):
    return scd.scd2_backfill(snapshot(spark, sf), "player_id", "current_season",
                             ["scoring_class", "is_active"], current=year(spark, sf))


@query("scd2_incremental", _MULTI_SQL)
def q_scd2_incremental(spark, sf):
    hi = year(spark, sf)
    prev = scd.scd2_backfill(snapshot(spark, sf, -1), "player_id", "current_season",
                             ["scoring_class", "is_active"], current=hi - 1)
    return scd.scd2_incremental(prev, snapshot(spark, sf), "player_id", ["scoring_class", "is_active"],
                                hi - 1, hi, "current_season")


@query("scd2_out_of_order", _MULTI_SQL)
def q_scd2_out_of_order(spark, sf):
    """Every year is loaded once, the last ones first and each second one late."""
    tracked = ["scoring_class", "is_active"]
    made = snapshot(spark, sf)
    # the snapshots are made once; a load reads its year's partition
    at = load_partition_overwrite(made, scratch_path(spark, "snapshots"), ["current_season"])
    snap = spark.read.schema(made.schema).parquet(at)
    hi = year(spark, sf)
    low = snap.agg(F.min("current_season")).first()[0]
    years = list(range(hi, (hi if low is None else low) - 1, -1))

    def load(stored: DataFrame, y: int) -> DataFrame:
        return scd.scd2_splice(stored, snap.filter(F.col("current_season") == y), "player_id", "current_season", tracked)

    first = scd.scd2_history(snap.limit(0), "player_id", "current_season", tracked)
    return fold_steps(first, years[::2] + years[1::2], load).drop("periods").withColumn("current_season", F.lit(hi))


def extend_open(s: DataFrame, key: str, p: int) -> DataFrame:
    """Chain semantics of the inactive variant: absence extends the open streak,
    so each streak ends the period before the next one starts, the newest at ``p``.
    The window holds one row per streak of one entity."""
    w = Window.partitionBy(key).orderBy("start_season")
    return s.withColumn("end_season", F.coalesce(F.lead("start_season").over(w) - 1, F.lit(p)))


@query("scd2_incremental_inactive", _RAW_SQL + f""", st AS ({streak_sql("raw", "player_id", "season", ["scoring_class"])})
SELECT player_id, scoring_class, start_season,
       coalesce(lead(start_season) OVER (PARTITION BY player_id ORDER BY start_season) - 1, {YEAR})
         AS end_season, {YEAR} AS current_season
FROM st""")
def q_scd2_incremental_inactive(spark, sf):
    hi = year(spark, sf)
    raw = raw_tiers(spark, sf)
    prev = scd.scd2_backfill(raw.filter(F.col("season") <= hi - 1), "player_id", "season", ["scoring_class"],
                             current=hi - 1)
    prev = extend_open(prev, "player_id", hi - 1)
    return scd.scd2_incremental(prev, raw, "player_id", ["scoring_class"], hi - 1, hi, "season",
                                extend_absent=True)


@query("scd_asof_join", _BACKFILL_SQL + """
SELECT o.o_orderkey, o.o_custkey, CAST(year(o.o_orderdate) AS INTEGER) AS order_year, s.scoring_class
FROM orders o LEFT JOIN snap s ON s.player_id = o.o_custkey AND s.current_season = year(o.o_orderdate)""")
def q_scd_asof_join(spark, sf):
    sc = scd.scd2_backfill(snapshot(spark, sf), "player_id", "current_season", ["scoring_class"])
    facts = tb.read(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                                 F.year("o_orderdate").alias("order_year"))
    j = scd.scd_asof_join(facts, sc, "o_custkey", "player_id", "order_year", current_end=year(spark, sf))
    return j.select("o_orderkey", "o_custkey", "order_year", "scoring_class")


@query("scd_type1", _RAW_SQL + """
SELECT player_id, arg_max(scoring_class, season) AS scoring_class FROM raw GROUP BY player_id""")
def q_scd_type1(spark, sf):
    return scd.scd_type1(raw_tiers(spark, sf), "player_id", "season", ["scoring_class"])


@query("scd_type0", _RAW_SQL + """
SELECT player_id, arg_min(scoring_class, season) AS scoring_class FROM raw GROUP BY player_id""")
def q_scd_type0(spark, sf):
    return scd.scd_type0(raw_tiers(spark, sf), "player_id", "season", ["scoring_class"])


@query("scd_type3", _RAW_SQL + f""", st AS ({streak_sql("raw", "player_id", "season", ["scoring_class"])}),
ch AS (SELECT *, lag(scoring_class) OVER (PARTITION BY player_id ORDER BY start_season) AS prev FROM st)
SELECT player_id, arg_min(scoring_class, start_season) AS original_scoring_class,
       arg_max(scoring_class, start_season) AS current_scoring_class,
       arg_max(prev, start_season) AS previous_scoring_class
FROM ch GROUP BY player_id""")
def q_scd_type3(spark, sf):
    return scd.scd_type3(raw_tiers(spark, sf), "player_id", "season", "scoring_class")


@query("daily_snapshot", _BACKFILL_SQL + """
SELECT player_id, scoring_class, current_season AS snapshot_period FROM snap""")
def q_daily_snapshot(spark, sf):
    sc = scd.scd2_backfill(snapshot(spark, sf), "player_id", "current_season", ["scoring_class"])
    return scd.daily_snapshot(sc, "player_id", ["scoring_class"])


@query("scd_vs_snapshot", _BACKFILL_SQL + f""", st AS ({streak_sql("snap", "player_id", "current_season", ["scoring_class"])})
SELECT (SELECT count(*) FROM snap) AS snapshot_rows, (SELECT count(*) FROM st) AS scd_rows,
       round((SELECT count(*) FROM snap) / (SELECT count(*) FROM st), 6) AS compaction_ratio""")
def q_scd_vs_snapshot(spark, sf):
    snap = snapshot(spark, sf)
    sc = scd.scd2_backfill(snap, "player_id", "current_season", ["scoring_class"])
    return scd.scd_vs_snapshot(snap, sc)
