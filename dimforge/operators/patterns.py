"""Analytical patterns: growth accounting, retention, funnels, grouping sets, windowed trends, streaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.functions.columns import referrer_host
from dimforge.operators.common import sequence_positions

# fixed values: growth-accounting states, player league states, referrer labels
from dimforge.operators.published import PublishedTable, previous
GROWTH_STATES = ("New", "Retained", "Resurrected", "Churned", "Stale")
PLAYER_STATES = ("New", "Retired", "Continued Playing", "Returned from Retirement", "Stayed Retired")
REFERRER_LABELS = ("Linkedin", "Twitter", "Google", "On Site")
ACTIVE_STATES = ("Retained", "Resurrected", "New")
OWN_HOST_PATTERN = "^host[0-9]+$"     # our own web hosts -> 'On Site'

NEW, RETAINED, RESURRECTED, CHURNED, STALE = GROWTH_STATES


def _daily_state(y_exists: Column, y_last: Column, y_date: Column, today: Column) -> Column:
    return (F.when(~y_exists, F.lit(NEW))
             .when(y_last == F.date_sub(today, 1), F.lit(RETAINED))
             .when(y_last < F.date_sub(today, 1), F.lit(RESURRECTED))
             .when(today.isNull() & (y_last == y_date), F.lit(CHURNED))
             .otherwise(F.lit(STALE)))


def _weekly_state(y_exists: Column, y_last: Column, y_date: Column, today: Column) -> Column:
    return (F.when(~y_exists, F.lit(NEW))
             .when(y_last < F.date_sub(today, 7), F.lit(RESURRECTED))
             .when(today.isNull() & (y_last == F.date_sub(y_date, 7)), F.lit(CHURNED))
             .when(F.date_add(F.coalesce(today, y_last), 7) >= y_date, F.lit(RETAINED))
             .otherwise(F.lit(STALE)))


def growth_accounting_step(prev: DataFrame | PublishedTable, events: DataFrame, key: str, ts: str, ds: str) -> DataFrame:
    """One day of the growth-accounting state table (yesterday FULL OUTER today).

    The CASE order is the contract: ``today`` is NULL for absent users, so
    the Retained/Resurrected tests fall through to Churned/Stale for them. A
    published chain (``prev``) that has no yesterday is refused.
    """
    d0 = F.lit(ds).cast("date")
    y = previous(prev, "date", ds).alias("y")
    t = (events.filter(F.col(key).isNotNull() & (F.col(ts) >= d0.cast("timestamp_ntz")) &
                       (F.col(ts) < F.date_add(d0, 1).cast("timestamp_ntz")))
               .select(key).distinct().withColumn("today_date", d0).alias("t"))
    j = y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full_outer")
    ye, yl, yd, td = (F.col(f"y.{key}").isNotNull(), F.col("y.last_active_date"), F.col("y.date"),
                      F.col("t.today_date"))
    empty = F.array().cast("array<date>")
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.coalesce(F.col("y.first_active_date"), td).alias("first_active_date"),
        F.coalesce(td, yl).alias("last_active_date"),
        _daily_state(ye, yl, yd, td).alias("daily_active_state"),
        _weekly_state(ye, yl, yd, td).alias("weekly_active_state"),
        F.concat(F.coalesce(F.col("y.dates_active"), empty),
                 F.when(td.isNotNull(), F.array(td)).otherwise(empty)).alias("dates_active"),
        F.coalesce(td, F.date_add(yd, 1)).alias("date"))


def growth_accounting(events: DataFrame, key: str, ts: str, ds: str) -> DataFrame:
    """All days of the growth-accounting table up to ``ds`` in one pass.

    Spine (entity x day from first activity to ``ds``) by ``sequence`` explode,
    joined to the distinct active days; yesterday's row is read with window
    functions over the entity's days instead of an N-step join chain. Same
    rows as folding ``growth_accounting_step`` day by day.
    """
    d0 = F.lit(ds).cast("date")
    act = (events.filter(F.col(key).isNotNull() & (F.col(ts) < F.date_add(d0, 1).cast("timestamp_ntz")))
                 .select(key, F.to_date(ts).alias("active_day")).distinct())
    first = act.groupBy(key).agg(F.min("active_day").alias("first_active_date"))
    spine = first.select(key, "first_active_date",
                         F.explode(F.sequence("first_active_date", d0)).alias("date"))
    g = spine.join(act.withColumnRenamed("active_day", "date").withColumn("_on", F.lit(True)),
                   [key, "date"], "left")
    w = Window.partitionBy(key).orderBy("date")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    today = F.when(F.col("_on"), F.col("date"))
    g = (g.withColumn("_today", today)
          .withColumn("last_active_date", F.max("_today").over(upto))
          .withColumn("_y_last", F.max("_today").over(before))
          .withColumn("n_dates", F.count("_today").over(upto).cast("int")))
    ye = F.col("date") > F.col("first_active_date")
    yd = F.date_sub(F.col("date"), 1)
    return g.select(
        key, "first_active_date", "last_active_date",
        _daily_state(ye, F.col("_y_last"), yd, F.col("_today")).alias("daily_active_state"),
        _weekly_state(ye, F.col("_y_last"), yd, F.col("_today")).alias("weekly_active_state"),
        "n_dates", "date")


def retention_curve(growth: DataFrame) -> DataFrame:
    """Share of entities in an active state by days since first activity (the J curve)."""
    return (growth.groupBy(F.datediff("date", "first_active_date").alias("days_since_first_active"))
                  .agg(F.round(F.count_if(F.col("daily_active_state").isin(*ACTIVE_STATES)) / F.count(F.lit(1)), 6)
                       .alias("pct_active"),
                       F.count(F.lit(1)).alias("n_users")))


def state_change(snapshots: DataFrame, key: str, period: str, active: str = "is_active") -> DataFrame:
    """New / Retired / Continued Playing / Returned from Retirement / Stayed Retired."""
    w = Window.partitionBy(key).orderBy(period)
    prev = F.lag(active).over(w)
    new, retired, playing, returned, stayed = PLAYER_STATES
    st = (F.when(prev.isNull() & F.col(active), F.lit(new))
           .when(prev.isNull(), F.lit(stayed))
           .when(prev & ~F.col(active), F.lit(retired))
           .when(prev & F.col(active), F.lit(playing))
           .when(~prev & F.col(active), F.lit(returned))
           .otherwise(F.lit(stayed)))
    return snapshots.select(key, period, st.alias("player_state"))


def funnel_conversion(events: DataFrame, key: str, ts: str, step: str, target: str,
                      min_events: int, inner: bool = True) -> DataFrame:
    """Per step value: share of (entity, time, step) events followed the same day by ``target``.

    Linear rewrite of the quadratic self join: per (entity, day) the last
    event time and the last target time are aggregates; an event converts
    when a target comes strictly later that day. ``inner=True`` keeps the
    self-join's denominator (events with at least one later event that
    day); ``inner=False`` counts every event.
    """
    e = (events.filter(F.col(key).isNotNull())
               .select(key, ts, step).distinct()
               .withColumn("_day", F.to_date(ts)))
    per_day = e.groupBy(key, "_day").agg(F.max(ts).alias("_last"),
                                         F.max(F.when(F.col(step) == target, F.col(ts))).alias("_last_t"))
    j = e.join(per_day, [key, "_day"])
    if inner:
        j = j.filter(F.col(ts) < F.col("_last"))
    conv = F.coalesce(F.col(ts) < F.col("_last_t"), F.lit(False)).cast("int")
    out = (j.groupBy(step).agg(F.count(F.lit(1)).alias("n_events"), F.sum(conv).alias("_c"))
            .withColumn("conversion_rate", F.round(F.col("_c") / F.col("n_events"), 6)))
    return (out.filter((F.col("conversion_rate") > 0) & (F.col("n_events") > min_events))
               .select(step, "n_events", "conversion_rate"))


def dashboard_grouping_sets(df: DataFrame, dims: Sequence[str], unknown: str = "unknown",
                            overall: str = "(overall)") -> DataFrame:
    """Hits for all dims together and each dim alone (one Expand + one aggregation).

    Missing attribute values become ``unknown`` *before* grouping, so a real
    NULL never mixes with a rolled-up one; the level label comes from
    ``grouping()``.
    """
    d = df.select(*[F.coalesce(F.col(c), F.lit(unknown)).alias(c) for c in dims])
    d = d.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"))  # so that Expand copies groups, not rows
    sets = [list(dims)] + [[c] for c in dims]
    g = d.groupingSets(sets, *dims).agg(
        F.sum("_n").alias("number_of_hits"),
        *[F.grouping(c).alias(f"_g_{c}") for c in dims])
    level = F.when(sum(F.col(f"_g_{c}") for c in dims) == 0, F.lit("__".join(dims)))
    for c in dims:
        level = level.when(F.col(f"_g_{c}") == 0, F.lit(c))
    return g.select(level.alias("aggregation_level"),
                    *[F.coalesce(F.col(c), F.lit(overall)).alias(c) for c in dims], "number_of_hits")


def with_referrer_bucket(df: DataFrame, col: str, name: str) -> DataFrame:
    """Normalise a referrer URL on its parsed host (not a substring of the whole URL,
    which would send pinterest.com to Twitter via 't.co')."""
    h = F.col("_ref_host")
    linkedin, twitter, google, on_site = REFERRER_LABELS
    rule = (F.when((h == "lnkd.in") | h.endswith("linkedin.com"), F.lit(linkedin))
             .when(h == "t.co", F.lit(twitter))
             .when(h.contains("google."), F.lit(google))
             .when(h.rlike(OWN_HOST_PATTERN), F.lit(on_site))
             .otherwise(F.col(col)))
    return df.withColumn("_ref_host", referrer_host(col)).withColumn(name, rule).drop("_ref_host")


def window_trend(daily: DataFrame, part: Sequence[str], date: str, count: str, min_total: int) -> DataFrame:
    """Five sums over one partitioning (month, running, whole, last 7 rows, the 7 rows before).

    All specs share ``part`` (the month spec adds the month), so they are
    computed after one shuffle. The previous-week frame is rows -13..-7
    (the lecture's -13..-6 overlaps the current week); a calendar-day
    variant uses a RANGE frame over the day number.
    """
    base = Window.partitionBy(*part).orderBy(date)
    month = Window.partitionBy(*part, F.trunc(date, "month")).orderBy(date)
    allrows = (Window.unboundedPreceding, Window.unboundedFollowing)
    dayno = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    by_day = Window.partitionBy(*part).orderBy(dayno)
    w = (daily
         .withColumn("monthly_cumulative_sum", F.sum(count).over(month.rowsBetween(*allrows)))
         .withColumn("rolling_cumulative_sum", F.sum(count).over(base))
         .withColumn("total_cumulative_sum", F.sum(count).over(base.rowsBetween(*allrows)))
         .withColumn("weekly_rolling_count", F.sum(count).over(base.rowsBetween(-6, 0)))
         .withColumn("previous_weekly_rolling_count", F.sum(count).over(base.rowsBetween(-13, -7)))
         .withColumn("weekly_range_count", F.sum(count).over(by_day.rangeBetween(-6, 0))))
    return (w.filter(F.col("total_cumulative_sum") > min_total)
             .select(*part, date, count, "weekly_rolling_count", "previous_weekly_rolling_count",
                     "weekly_range_count", "rolling_cumulative_sum",
                     F.round(F.col(count) / F.col("monthly_cumulative_sum"), 6).alias("pct_of_month"),
                     F.round(F.col(count) / F.col("total_cumulative_sum"), 6).alias("pct_of_total")))


def rolling_max_wins(team_games: DataFrame, team: str, date: str, game: str, win: str, n: int) -> DataFrame:
    """Most wins in any ``n`` consecutive games per team, without a per-team window over all games.

    Wins in games (i-n, i] = prefix(i) - prefix(i-n); positions and prefix
    counts come from ``sequence_positions`` and the lagged prefix is found by
    an equi-join on (team, position - n).
    """
    pref = sequence_positions(team_games, team, date, [game], win).select(
        team, F.col("_pos").alias("_i"), F.col("_cnt").alias("_W"))
    back = pref.select(team, (F.col("_i") + n).alias("_i"), F.col("_W").alias("_Wb"))
    r = pref.join(back, [team, "_i"], "left")
    return r.groupBy(team).agg(F.max(F.col("_W") - F.coalesce(F.col("_Wb"), F.lit(0))).cast("bigint")
                               .alias(f"max_wins_{n}"))


def longest_streak(df: DataFrame, key: str, day: str, tie: Sequence[str], cond: Column) -> DataFrame:
    """Longest run of consecutive rows meeting ``cond`` per entity (gaps and islands).

    Island id = position - running count of qualifying rows; both come from
    ``sequence_positions`` (no window over all of an entity's rows).
    """
    d = sequence_positions(df.withColumn("_ok", cond.cast("int")), key, day, tie, "_ok")
    # rows that do not qualify fall into one (key, NULL) group of length 0, so every entity is
    # kept without a second pass over the input
    ok = F.col("_ok") == 1
    island = F.when(ok, F.col("_pos") - F.col("_cnt"))
    runs = d.groupBy(key, island.alias("_island")).agg(F.count_if(ok).alias("_len"))
    return runs.groupBy(key).agg(F.max("_len").alias("longest_streak"))
