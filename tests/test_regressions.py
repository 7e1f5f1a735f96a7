"""One test per reference defect that the rebuild fixes or keeps on purpose."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from dimforge.operators import activity as ac
from dimforge.operators import cumulation as cu
from dimforge.operators import layout as lo
from dimforge.operators import patterns as pa
from dimforge.operators import scd

D = dt.date
TS = dt.datetime


def test_null_safe_change_detection(spark):
    # rows 1-2: a NULL attribute must still open / close streaks
    src = spark.createDataFrame([(1, 2000, "a"), (1, 2001, None), (1, 2002, None), (1, 2003, "a")],
                                "k int, p int, c string")
    got = scd.scd2_backfill(src, "k", "p", ["c"]).orderBy("start_season").collect()
    assert [(r.c, r.start_season, r.end_season) for r in got] == [("a", 2000, 2000), (None, 2001, 2002),
                                                                 ("a", 2003, 2003)]


def test_incremental_changed_row_explodes_to_two(spark):
    prev = spark.createDataFrame([(1, "a", 1999, 2000, 2000), (2, "b", 1998, 1998, 2000), (3, None, 2000, 2000, 2000)],
                                 "k int, c string, start_season int, end_season int, current_season int")
    today = spark.createDataFrame([(1, "z", 2001), (3, None, 2001), (4, "n", 2001)], "k int, c string, p int")
    got = scd.scd2_incremental(prev, today, "k", ["c"], 2000, 2001, "p")
    exp = spark.createDataFrame([(2, "b", 1998, 1998, 2001), (1, "a", 1999, 2000, 2001), (1, "z", 2001, 2001, 2001),
                                 (3, None, 2000, 2001, 2001), (4, "n", 2001, 2001, 2001)],
                                "k int, c string, start_season int, end_season int, current_season int")
    assertDataFrameEqual(got.select(*exp.columns), exp)


def test_tier_thresholds_are_parameters(spark):
    df = spark.createDataFrame([(8.5,), (7.5,), (6.5,), (5.0,)], "r double")
    got = [r[0] for r in df.select(cu.tier(F.col("r"), (8.0, 7.0, 6.0))).collect()]
    assert got == ["star", "good", "average", "bad"]


def test_step_fills_years_since_last_active(spark):
    today = spark.createDataFrame([(1, 2000, 1, 10.0, "n")], "player_id bigint, season int, gp bigint, pts double, "
                                                            "player_name string")
    snap = cu.empty_snapshot(today, "player_id", "season", ["season", "gp", "pts"], ["player_name"])
    s1 = cu.cumulate_step(snap.withColumn("current_season", F.lit(1999)), today, "player_id", "season", 2000,
                          ["season", "gp", "pts"], ["player_name"], "pts", (20, 15, 10))
    s2 = cu.cumulate_step(s1, today, "player_id", "season", 2001, ["season", "gp", "pts"], ["player_name"],
                          "pts", (20, 15, 10))
    r1, r2 = s1.collect()[0], s2.collect()[0]
    assert (r1.years_since_last_active, r1.is_active) == (0, True)
    assert (r2.years_since_last_active, r2.is_active, r2.scoring_class) == (1, False, "bad")
    # named struct fields: history element exposes .pts, not a shifted position
    assert r2.seasons[0].pts == 10.0 and r2.seasons[0].season == 2000


@pytest.mark.parametrize("days_ago,bit", [(0, 31), (31, 0), (7, 24), (32, None)])
def test_datelist_bit_positions(spark, days_ago, bit):
    ds = D(2024, 1, 31)
    df = spark.createDataFrame([([ds - dt.timedelta(days=days_ago)],)], "d array<date>")
    v = df.select(ac.datelist_bits(F.col("d"), "2024-01-31").alias("b")).collect()[0].b
    assert v == (0 if bit is None else 1 << bit)


def test_weekly_masks(spark):
    ds = D(2024, 1, 31)
    dates = [ds - dt.timedelta(days=i) for i in (0, 6, 7, 13, 14)]
    df = spark.createDataFrame([(dates,)], "d array<date>").select(
        ac.datelist_bits(F.col("d"), "2024-01-31").alias("datelist_int"))
    r = ac.datelist_flags(df).collect()[0]
    assert (r.l32, r.l7, r.dim_is_weekly_active, r.dim_is_weekly_active_previous_week) == (5, 2, True, True)


def test_first_found_date_kept_when_absent(spark):
    ev = spark.createDataFrame([(1, TS(2024, 1, 2, 10)), (2, TS(2024, 1, 3, 9))], "user_id bigint, event_time timestamp_ntz")
    prev = ac.hit_array_backfill(ev, "user_id", "event_time", "2024-01-02")
    cur = {r.user_id: r for r in ac.hit_array_step(prev, ev, "user_id", "event_time", "2024-01-03").collect()}
    assert cur[1].first_found_date == D(2024, 1, 2) and cur[1].hit_array == [None, 1, None]
    assert cur[2].first_found_date == D(2024, 1, 3) and cur[2].hit_array == [None, None, 1]


def test_previous_week_frame_does_not_overlap(spark):
    rows = [("r", "u", D(2024, 1, 1) + dt.timedelta(days=i), 1) for i in range(20) if i != 10]
    daily = spark.createDataFrame(rows, "referrer string, url string, event_date date, n bigint")
    got = {r.event_date: r for r in pa.window_trend(daily, ["referrer", "url"], "event_date", "n", 0).collect()}
    last = got[D(2024, 1, 20)]
    assert last.weekly_rolling_count == 7 and last.previous_weekly_rolling_count == 7
    # calendar days: 2024-01-11 is missing, so the 7-day RANGE frame ending 01-17 holds 6 rows
    assert got[D(2024, 1, 17)].weekly_range_count == 6 and got[D(2024, 1, 17)].weekly_rolling_count == 7


def test_referrer_on_host_not_substring(spark):
    df = spark.createDataFrame([("https://www.pinterest.com/pin/1",), ("https://t.co/x",), ("https://lnkd.in/a",),
                                ("https://host2/x",), (None,)], "referrer string")
    got = [r.b for r in pa.with_referrer_bucket(df, "referrer", "b").collect()]
    assert got == ["https://www.pinterest.com/pin/1", "Twitter", "Linkedin", "On Site", None]


def test_funnel_inner_and_left_variants(spark):
    t = TS(2024, 1, 1, 10)
    ev = spark.createDataFrame([
        (1, t, "/a"), (1, t + dt.timedelta(minutes=5), "/buy"),      # converts
        (2, t, "/a"),                                                # single event: inner drops it
        (3, t, "/a"), (3, t + dt.timedelta(minutes=1), "/b"),        # later event, no target
    ], "user_id bigint, event_time timestamp_ntz, url string")
    inner = {r.url: r for r in pa.funnel_conversion(ev, "user_id", "event_time", "url", "/buy", 0).collect()}
    left = {r.url: r for r in pa.funnel_conversion(ev, "user_id", "event_time", "url", "/buy", 0,
                                                   inner=False).collect()}
    assert (inner["/a"].n_events, inner["/a"].conversion_rate) == (2, 0.5)
    assert (left["/a"].n_events, left["/a"].conversion_rate) == (3, round(1 / 3, 6))


def test_users_and_devices_from_aggregate_only(spark):
    ev = spark.createDataFrame([(1, 7, "h1"), (1, 7, "h2"), (1, 8, "h1")], "user_id bigint, device_id bigint, host string")
    agg = lo.events_aggregated(ev)
    r = lo.users_and_devices(agg).collect()[0]
    assert (r.max_event_counts, r.n_devices, r.total_events) == (2, 2, 3)


def test_enum_enforcement_fails_the_write(spark):
    df = spark.createDataFrame([("star",), ("legend",)], "c string")
    assert cu.enum_violations(df, "c", ["star"]).count() == 1
    with pytest.raises(Exception, match="outside allowed"):
        cu.enforce_enum(df, "c", ["star"]).collect()


def test_islands_cross_chunk_boundaries(spark):
    from dimforge.operators import layout as lo
    from dimforge.streaming import jobs as st
    t = TS(2024, 1, 1, 10, 58)
    ev = spark.createDataFrame([("ip", "h", t), ("ip", "h", t + dt.timedelta(minutes=4)),       # spans 11:00
                                ("ip", "h", t + dt.timedelta(minutes=9)),                       # 5 min later: same
                                ("ip", "h", t + dt.timedelta(hours=3)),                         # new session
                                ("ip", "h", t + dt.timedelta(hours=3, minutes=5, seconds=1))],  # > 5 min: new
                               "ip string, host string, event_time timestamp_ntz")
    got = sorted((r.session_start, r.num_events) for r in st.stream_session(ev, ["ip", "host"]).collect())
    assert [n for _, n in got] == [3, 1, 1]
    runs = spark.createDataFrame([("h", TS(2024, 1, 1, 10, 59), 1, "a"), ("h", TS(2024, 1, 1, 11, 1), 2, "a"),
                                  ("h", TS(2024, 1, 1, 13, 0), 3, "a"), ("h", TS(2024, 1, 1, 13, 1), 4, "b")],
                                 "host string, ts timestamp_ntz, id int, v string")
    r = lo.rle_runs(runs, ["host"], ["ts", "id"], "v", F.date_trunc("hour", "ts"))
    assert sorted((x.v, x.run_length) for x in r.collect()) == [("a", 3), ("b", 1)]


def test_asof_join_open_row_matches_later_facts(spark):
    s = spark.createDataFrame([(1, "a", 2000, 2001), (1, "b", 2002, 2003)],
                              "k int, c string, start_season int, end_season int")
    facts = spark.createDataFrame([(1, 2000), (1, 2002), (1, 2010), (2, 2002)], "fk int, yr int")
    got = {(r.fk, r.yr): r.c for r in scd.scd_asof_join(facts, s, "fk", "k", "yr", current_end=2003).collect()}
    # point in time, never "latest"; the open row (end = current period) stays valid for later facts
    assert got == {(1, 2000): "a", (1, 2002): "b", (1, 2010): "b", (2, 2002): None}
