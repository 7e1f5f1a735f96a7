"""Invariants on the driver tables (sf0.001): chains equal one-pass backfills, trees equal one-shot
aggregates, reduced facts reconcile with raw facts."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from conftest import SF_SMALL
from dimforge.operators import activity as ac
from dimforge.operators import cumulation as cu
from dimforge.operators import experiments as ex
from dimforge.operators import facts as fa
from dimforge.operators import patterns as pa
from dimforge.operators import scd
from dimforge.operators.common import fold_steps
from dimforge.plans.cumulation import S_STATIC, S_STRUCT, season_backfill
from dimforge.sources import tables as tb


def _flat(df):
    return df.select("player_id", F.to_json("seasons").alias("seasons"), "scoring_class",
                     "years_since_last_active", "is_active", "current_season")


def test_step_chain_equals_backfill(spark):
    seasons = tb.seasons(spark, SF_SMALL)
    snap = cu.empty_snapshot(seasons, "player_id", "season", S_STRUCT, S_STATIC).withColumn(
        "current_season", F.lit(1994))
    snap = fold_steps(snap, range(1995, 1999),
                      lambda s, yr: cu.cumulate_step(s, seasons, "player_id", "season", yr, S_STRUCT, S_STATIC,
                                                     "pts", tb.SEASON_TIERS))
    back = season_backfill(spark, SF_SMALL, 1998).filter(F.col("current_season") == 1998)
    assertDataFrameEqual(_flat(snap), _flat(back))


def test_scd_intervals_partition_the_periods(spark):
    snap = season_backfill(spark, SF_SMALL).select("player_id", "scoring_class", "is_active", "current_season")
    s = scd.scd2_backfill(snap, "player_id", "current_season", ["scoring_class", "is_active"])
    w = Window.partitionBy("player_id").orderBy("start_season")
    gaps = s.withColumn("prev_end", F.lag("end_season").over(w)).filter(
        F.col("prev_end").isNotNull() & (F.col("start_season") != F.col("prev_end") + 1))
    assert gaps.count() == 0
    covered = s.select(F.sum(F.col("end_season") - F.col("start_season") + 1)).collect()[0][0]
    assert covered == snap.count()


def test_incremental_scd_equals_backfill(spark):
    snap = season_backfill(spark, SF_SMALL).select("player_id", "scoring_class", "is_active", "current_season")
    tracked = ["scoring_class", "is_active"]
    prev = scd.scd2_backfill(snap.filter("current_season <= 2000"), "player_id", "current_season", tracked,
                             current=2000)
    inc = scd.scd2_incremental(prev, snap, "player_id", tracked, 2000, 2001, "current_season")
    full = scd.scd2_backfill(snap, "player_id", "current_season", tracked, current=2001)
    assertDataFrameEqual(inc.select(*full.columns), full)


def test_hourly_tree_equals_one_shot_dedupe(spark):
    raw = tb.web_events_raw(spark, SF_SMALL)
    tree = fa.fact_dedup_hourly_tree(raw, ["event_id"], "ingested_at", ["user_id", "url"])
    one = raw.groupBy("event_id").agg(F.min(F.struct("ingested_at", "user_id", "url")).alias("f"),
                                      F.count(F.lit(1)).alias("n_copies"))
    one = one.select("event_id", "f.user_id", "f.url", F.col("f.ingested_at").alias("first_seen"), "n_copies")
    assertDataFrameEqual(tree, one)


def test_bitmap_counts_dates_in_window(spark):
    ev = tb.web_events(spark, SF_SMALL)
    b = ac.dates_active_backfill(ev, "user_id", "event_time", "2024-01-30")
    d0 = F.lit("2024-01-30").cast("date")
    in_win = F.size(F.filter("dates_active", lambda d: F.datediff(d0, d).between(0, 31)))
    bad = b.filter(F.bit_count(ac.datelist_bits(F.col("dates_active"), "2024-01-30")) != in_win)
    assert bad.count() == 0


def test_reduced_array_sums_to_raw_count(spark):
    ev = tb.web_events(spark, SF_SMALL)
    arr = ac.metric_array_backfill(ev, "user_id", "event_time", "2024-01-30")
    total = arr.select(F.sum(F.aggregate("metric_array", F.lit(0).cast("bigint"), lambda a, x: a + x))).collect()[0][0]
    raw = ev.filter(F.col("user_id").isNotNull()).count()
    assert total == raw


def test_growth_chain_equals_one_pass(spark):
    ev = tb.web_events(spark, SF_SMALL)
    days = [f"2024-01-{d:02d}" for d in range(1, 9)]
    empty = spark.createDataFrame([], "user_id bigint, first_active_date date, last_active_date date, "
                                      "daily_active_state string, weekly_active_state string, "
                                      "dates_active array<date>, date date")
    state = fold_steps(empty, days, lambda s, ds: pa.growth_accounting_step(s, ev, "user_id", "event_time", ds))
    one = pa.growth_accounting(ev, "user_id", "event_time", days[-1]).filter(F.col("date") == F.lit(days[-1]).cast("date"))
    chain = state.select("user_id", "first_active_date", "last_active_date", "daily_active_state",
                         "weekly_active_state", F.size("dates_active").alias("n_dates"), "date")
    assertDataFrameEqual(chain, one.select(*chain.columns))


def test_unit_profit_reconciles_with_aggregate(spark):
    lines = ex.line_profit(tb.read(spark, SF_SMALL, "lineitem"), tb.read(spark, SF_SMALL, "part"))
    unit = lines.groupBy("l_orderkey").agg(F.sum("profit").alias("p")).agg(F.sum("p")).collect()[0][0]
    agg = lines.groupBy(F.trunc(F.to_date("l_shipdate"), "month")).agg(F.sum("profit").alias("p")) \
               .agg(F.sum("p")).collect()[0][0]
    assert unit == agg


def test_dedup_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "b"), (1, dt.datetime(2024, 1, 1), "a"),
                                (1, dt.datetime(2024, 1, 2), "0")], "k int, t timestamp_ntz, v string")
    from dimforge.operators.common import dedup_first
    assert dedup_first(df, ["k"], ["t"]).collect()[0].v == "a"
