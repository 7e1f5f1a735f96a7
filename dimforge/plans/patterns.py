"""§2.6 analytical patterns, bound to `web_events`, `web_devices`, `seasons`, `games`, `game_details`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.operators import patterns as pa
from dimforge.plans import query
from dimforge.plans.activity import chained
from dimforge.plans.periods import DAY, day
from dimforge.plans.cumulation import _BACKFILL_SQL, season_backfill
from dimforge.plans.facts import _CONFORM_SQL, conform
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views

FUNNEL_TARGET = "/purchase"
FUNNEL_MIN = 100
TREND_MIN_TOTAL = 250
STRETCH = 90
STREAK_PTS = 10


def growth(spark, sf) -> DataFrame:
    return pa.growth_accounting(tb.web_events(spark, sf), "user_id", "event_time", day(spark, sf))


_GROWTH_SQL = with_views("web_events") + f""",
act AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS d FROM web_events
        WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= {DAY}),
fst AS (SELECT user_id, min(d) AS fa FROM act GROUP BY user_id),
spine AS (SELECT user_id, fa, CAST(unnest(generate_series(fa, {DAY}, INTERVAL 1 DAY)) AS DATE) AS date FROM fst),
g AS (SELECT s.user_id, s.fa, s.date, CASE WHEN a.d IS NOT NULL THEN s.date END AS today
      FROM spine s LEFT JOIN act a ON a.user_id = s.user_id AND a.d = s.date),
h AS (SELECT *, max(today) OVER (PARTITION BY user_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS last_active_date,
             max(today) OVER (PARTITION BY user_id ORDER BY date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS y_last,
             count(today) OVER (PARTITION BY user_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS n
      FROM g),
growth AS (
SELECT user_id, fa AS first_active_date, last_active_date,
       CASE WHEN NOT (date > fa) THEN 'New'
            WHEN y_last = today - 1 THEN 'Retained'
            WHEN y_last < today - 1 THEN 'Resurrected'
            WHEN today IS NULL AND y_last = date - 1 THEN 'Churned'
            ELSE 'Stale' END AS daily_active_state,
       CASE WHEN NOT (date > fa) THEN 'New'
            WHEN y_last < today - 7 THEN 'Resurrected'
            WHEN today IS NULL AND y_last = (date - 1) - 7 THEN 'Churned'
            WHEN coalesce(today, y_last) + 7 >= date - 1 THEN 'Retained'
            ELSE 'Stale' END AS weekly_active_state,
       CAST(n AS INTEGER) AS n_dates, date
FROM h)
"""


@query("growth_accounting", _GROWTH_SQL + "SELECT * FROM growth")
def q_growth_accounting(spark, sf):
    return growth(spark, sf)


@query("growth_accounting_step", _GROWTH_SQL + f""",
days AS (SELECT user_id, string_agg(DISTINCT CAST(CAST(event_time AS DATE) AS VARCHAR), ','
                                    ORDER BY CAST(CAST(event_time AS DATE) AS VARCHAR)) AS date_list
         FROM web_events WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= {DAY} GROUP BY user_id)
SELECT g.user_id, g.first_active_date, g.last_active_date, g.daily_active_state, g.weekly_active_state, d.date_list, g.date
FROM growth g JOIN days d ON d.user_id = g.user_id WHERE g.date = {DAY}""")
def q_growth_accounting_step(spark, sf):
    """The table of the day before, with its date lists, taken one day on."""
    e = tb.web_events(spark, sf)
    before = F.date_sub(F.lit(day(spark, sf)).cast("date"), 1)
    lists = (e.filter(F.col("user_id").isNotNull() & (F.to_date("event_time") <= before))
              .groupBy("user_id").agg(F.array_sort(F.collect_set(F.to_date("event_time"))).alias("dates_active")))
    prev = growth(spark, sf).filter(F.col("date") == before).join(lists, "user_id")
    step = chained(spark, sf, prev, "user_id", lambda chain, ds: pa.growth_accounting_step(
        chain, e, "user_id", "event_time", ds))
    return step.select("user_id", "first_active_date", "last_active_date", "daily_active_state", "weekly_active_state",
                       F.array_join(F.transform("dates_active", lambda d: d.cast("string")), ",").alias("date_list"),
                       "date")


@query("retention_curve", _GROWTH_SQL + """
SELECT CAST(date_diff('day', first_active_date, date) AS INTEGER) AS days_since_first_active,
       round(count(*) FILTER (WHERE daily_active_state IN ('Retained', 'Resurrected', 'New')) / count(*), 6)
         AS pct_active, count(*) AS n_users
FROM growth GROUP BY 1""")
def q_retention_curve(spark, sf):
    return pa.retention_curve(growth(spark, sf))


@query("state_change", _BACKFILL_SQL + """
SELECT player_id, current_season,
       CASE WHEN lag(is_active) OVER w IS NULL AND is_active THEN 'New'
            WHEN lag(is_active) OVER w IS NULL THEN 'Stayed Retired'
            WHEN lag(is_active) OVER w AND NOT is_active THEN 'Retired'
            WHEN lag(is_active) OVER w AND is_active THEN 'Continued Playing'
            WHEN NOT lag(is_active) OVER w AND is_active THEN 'Returned from Retirement'
            ELSE 'Stayed Retired' END AS player_state
FROM snap WINDOW w AS (PARTITION BY player_id ORDER BY current_season)""")
def q_state_change(spark, sf):
    snap = season_backfill(spark, sf)
    return pa.state_change(snap, "player_id", "current_season")


@query("funnel_conversion", with_views("web_events") + f""",
seen AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS d, event_time AS t, host, url
         FROM web_events WHERE user_id IS NOT NULL),
day AS (SELECT user_id, d, max(t) AS day_end, max(t) FILTER (WHERE url = '{FUNNEL_TARGET}') AS target_end
        FROM seen GROUP BY user_id, d),
flag AS (SELECT DISTINCT s.user_id, s.t, s.url, coalesce(s.t < day.target_end, false) AS hit
         FROM seen s JOIN day ON day.user_id = s.user_id AND day.d = s.d WHERE s.t < day.day_end),
rate AS (SELECT url, count(*) AS n_events, count(*) FILTER (WHERE hit) AS hits FROM flag GROUP BY url)
SELECT url, n_events, round(hits / n_events, 6) AS conversion_rate FROM rate
WHERE hits > 0 AND n_events > {FUNNEL_MIN}""")
def q_funnel_conversion(spark, sf):
    return pa.funnel_conversion(tb.web_events(spark, sf), "user_id", "event_time", "url", FUNNEL_TARGET,
                                FUNNEL_MIN)


@query("funnel_conversion_all", with_views("web_events") + f""",
seen AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS d, event_time AS t, url
         FROM web_events WHERE user_id IS NOT NULL),
target AS (SELECT user_id, d, max(t) AS target_end FROM seen WHERE url = '{FUNNEL_TARGET}' GROUP BY user_id, d),
rate AS (SELECT url, count(*) AS n_events, count(*) FILTER (WHERE t < target_end) AS hits
         FROM seen LEFT JOIN target USING (user_id, d) GROUP BY url)
SELECT url, n_events, round(hits / n_events, 6) AS conversion_rate FROM rate
WHERE hits > 0 AND n_events > {FUNNEL_MIN}""")
def q_funnel_conversion_all(spark, sf):
    """The funnel whose denominator counts every event."""
    return pa.funnel_conversion(tb.web_events(spark, sf), "user_id", "event_time", "url", FUNNEL_TARGET,
                                FUNNEL_MIN, inner=False)


def events_dev(spark, sf, how="inner") -> DataFrame:
    return tb.web_events(spark, sf).join(tb.web_devices(spark, sf), "device_id", how)


_ONE_DIM_SQL = """SELECT '{c}' AS aggregation_level, {os} AS os_type, {dev} AS device_type, {br} AS browser_type,
       count(*) AS number_of_hits FROM joined GROUP BY {by}"""
_DIMS_SQL = {"os": "ifnull(os_type, 'unknown')", "dev": "ifnull(device_type, 'unknown')",
             "br": "ifnull(browser_type, 'unknown')"}
_ALL_SQL = dict.fromkeys(_DIMS_SQL, "'(overall)'")


@query("dashboard_grouping_sets", with_views("web_events", "web_devices") + """,
joined AS (SELECT os_type, device_type, browser_type FROM web_devices JOIN web_events USING (device_id))
""" + " UNION ALL ".join(
    [_ONE_DIM_SQL.format(c="os_type__device_type__browser_type", by="2, 3, 4", **_DIMS_SQL)]
    + [_ONE_DIM_SQL.format(c=c, by=by, **_ALL_SQL | {k: _DIMS_SQL[k]})
       for c, k, by in (("os_type", "os", 2), ("device_type", "dev", 3), ("browser_type", "br", 4))]))
def q_dashboard_grouping_sets(spark, sf):
    return pa.dashboard_grouping_sets(events_dev(spark, sf), ["os_type", "device_type", "browser_type"])


GAME_OUTCOME = ("home_team_id", "visitor_team_id", "home_team_wins")


def details_grouping_sets(fct: DataFrame) -> DataFrame:
    """Points and wins for (player, team), (player, season), (team); then the top row of each.

    ``fct`` carries ``GAME_OUTCOME`` from the game dimension. Wins are distinct
    games won, not joined rows. A player has one row per game, so the player
    levels sum a won flag; for the team level one row per (team, game) carries
    the flag, so a plain sum counts distinct games -- no distinct aggregate.
    The facts are summed to (player, team, season) first: the grouping sets
    expand those groups, not the facts. The top row per level is a ``max_by``
    aggregation (partial-aggregated), not a window over a level.
    """
    won = (((F.col("dim_team_id") == F.col("home_team_id")) & (F.col("home_team_wins") == 1)) |
           ((F.col("dim_team_id") == F.col("visitor_team_id")) & (F.col("home_team_wins") == 0)))
    first_of_team_game = F.row_number().over(
        Window.partitionBy("dim_team_id", "dim_game_id").orderBy("dim_player_id")) == 1
    f = fct.select(F.col("dim_player_id").alias("player_id"), F.col("dim_team_id").alias("team_id"),
                   F.col("dim_season").alias("season"), "m_pts", won.cast("int").alias("_won"),
                   (won & first_of_team_game).cast("int").alias("_team_won"))
    base = (f.groupBy("player_id", "team_id", "season")
             .agg(F.sum("m_pts").alias("_pts"), F.sum("_won").alias("_won"), F.sum("_team_won").alias("_team_won")))
    agg = (base.groupingSets([["player_id", "team_id"], ["player_id", "season"], ["team_id"]],
                             "player_id", "team_id", "season")
               .agg(F.sum("_pts").alias("total_points"), F.sum("_won").alias("_pw"), F.sum("_team_won").alias("_tw"),
                    F.grouping_id().alias("_gid")))
    # grouping_id bits over (player_id, team_id, season): 1 = rolled up
    level = (F.when(F.col("_gid") == 1, F.lit("player_team"))
              .when(F.col("_gid") == 2, F.lit("player_season"))
              .otherwise(F.lit("team")))
    agg = (agg.withColumn("aggregation_level", level)
              .withColumn("total_wins", F.when(F.col("_gid") == 5, F.col("_tw")).otherwise(F.col("_pw"))))
    metric = F.when(F.col("aggregation_level") == "team", F.col("total_wins")).otherwise(F.col("total_points"))
    rank_key = F.struct(metric.alias("m"), (-F.coalesce(F.col("player_id"), F.lit(0))).alias("p"),
                        (-F.coalesce(F.col("team_id"), F.lit(0))).alias("t"),
                        (-F.coalesce(F.col("season"), F.lit(0))).alias("s"))
    cols = ["player_id", "team_id", "season", "total_points", "total_wins"]
    top = agg.groupBy("aggregation_level").agg(F.max_by(F.struct(*cols), rank_key).alias("_top"))
    return top.select("aggregation_level", *[F.col(f"_top.{c}").alias(c) for c in cols])


@query("details_grouping_sets", _CONFORM_SQL + """,
f AS (SELECT x.dim_player_id AS player_id, x.dim_team_id AS team_id, x.dim_season AS season, x.m_pts,
             CASE WHEN (x.dim_team_id = g.home_team_id AND g.home_team_wins = 1)
                    OR (x.dim_team_id = g.visitor_team_id AND g.home_team_wins = 0) THEN x.dim_game_id END AS won
      FROM fct x JOIN games g ON g.game_id = x.dim_game_id),
pt AS (SELECT 'player_team' AS aggregation_level, player_id, team_id, CAST(NULL AS INTEGER) AS season,
              CAST(sum(m_pts) AS BIGINT) AS total_points, count(DISTINCT won) AS total_wins
       FROM f GROUP BY player_id, team_id ORDER BY total_points DESC, player_id, team_id LIMIT 1),
ps AS (SELECT 'player_season' AS aggregation_level, player_id, CAST(NULL AS INTEGER) AS team_id, season,
              CAST(sum(m_pts) AS BIGINT) AS total_points, count(DISTINCT won) AS total_wins
       FROM f GROUP BY player_id, season ORDER BY total_points DESC, player_id, season LIMIT 1),
tm AS (SELECT 'team' AS aggregation_level, CAST(NULL AS BIGINT) AS player_id, team_id, CAST(NULL AS INTEGER) AS season,
              CAST(sum(m_pts) AS BIGINT) AS total_points, count(DISTINCT won) AS total_wins
       FROM f GROUP BY team_id ORDER BY total_wins DESC, team_id LIMIT 1)
SELECT * FROM pt UNION ALL SELECT * FROM ps UNION ALL SELECT * FROM tm""")
def q_details_grouping_sets(spark, sf):
    return details_grouping_sets(conform(spark, sf, GAME_OUTCOME))


_BUCKET_SQL = """CASE WHEN h = 'lnkd.in' OR h LIKE '%linkedin.com' THEN 'Linkedin'
            WHEN h = 't.co' THEN 'Twitter'
            WHEN h LIKE '%google.%' THEN 'Google'
            WHEN regexp_matches(h, '^host[0-9]+$') THEN 'On Site'
            ELSE referrer END"""
_HOST_SQL = "regexp_extract(referrer, '^[a-z]+://([^/:?#]+)', 1)"


@query("referrer_bucket", with_views("web_events") + f"""
SELECT event_id, referrer, {_BUCKET_SQL} AS referrer_bucket
FROM (SELECT *, {_HOST_SQL} AS h FROM web_events) e""")
def q_referrer_bucket(spark, sf):
    e = tb.web_events(spark, sf).select("event_id", "referrer")
    return pa.with_referrer_bucket(e, "referrer", "referrer_bucket")


@query("window_trend", with_views("web_events", "web_devices") + f""",
hits AS (SELECT {_BUCKET_SQL} AS referrer, url, day, count(*) AS n
         FROM (SELECT referrer, {_HOST_SQL} AS h, url, CAST(event_time AS DATE) AS day
               FROM web_events WHERE device_id IN (SELECT device_id FROM web_devices)) e GROUP BY ALL),
placed AS (SELECT *, count(*) OVER (PARTITION BY referrer, url ORDER BY day) AS k FROM hits WHERE referrer IS NOT NULL)
SELECT a.referrer, a.url, a.day AS event_date, a.n AS n_hits,
       CAST(sum(b.n) FILTER (WHERE b.k BETWEEN a.k - 6 AND a.k) AS BIGINT) AS weekly_rolling_count,
       CAST(sum(b.n) FILTER (WHERE b.k BETWEEN a.k - 13 AND a.k - 7) AS BIGINT) AS previous_weekly_rolling_count,
       CAST(sum(b.n) FILTER (WHERE b.day BETWEEN a.day - 6 AND a.day) AS BIGINT) AS weekly_range_count,
       CAST(sum(b.n) FILTER (WHERE b.day <= a.day) AS BIGINT) AS rolling_cumulative_sum,
       round(a.n / sum(b.n) FILTER (WHERE date_trunc('month', b.day) = date_trunc('month', a.day)), 6) AS pct_of_month,
       round(a.n / sum(b.n), 6) AS pct_of_total
FROM placed a JOIN placed b ON b.referrer = a.referrer AND b.url = a.url
GROUP BY a.referrer, a.url, a.day, a.n, a.k HAVING sum(b.n) > {TREND_MIN_TOTAL}""")
def q_window_trend(spark, sf):
    # the bucket is NULL exactly when the raw referrer is: filter the raw column up front, so the
    # optimizer does not push a copy of the whole URL-parsing expression down into the scan filter
    ev = events_dev(spark, sf).filter(F.col("referrer").isNotNull())
    e = pa.with_referrer_bucket(ev, "referrer", "referrer_b")
    daily = (e.groupBy("url", F.col("referrer_b").alias("referrer"), F.to_date("event_time").alias("event_date"))
              .agg(F.count(F.lit(1)).alias("n_hits")))
    return pa.window_trend(daily, ["referrer", "url"], "event_date", "n_hits", TREND_MIN_TOTAL)


def team_games(games: DataFrame) -> DataFrame:
    home = games.select(F.col("home_team_id").alias("team_id"), "game_date_est", "game_id",
                        F.col("home_team_wins").alias("win"))
    away = games.select(F.col("visitor_team_id").alias("team_id"), "game_date_est", "game_id",
                        (1 - F.col("home_team_wins")).alias("win"))
    return home.unionByName(away)


@query("rolling_wins", with_views("games") + f""",
tg AS (SELECT home_team_id AS team_id, game_date_est, game_id, home_team_wins AS win FROM games
       UNION ALL SELECT visitor_team_id, game_date_est, game_id, 1 - home_team_wins FROM games)
SELECT team_id, CAST(max(s) AS BIGINT) AS max_wins_{STRETCH} FROM
  (SELECT team_id, sum(win) OVER (PARTITION BY team_id ORDER BY game_date_est, game_id
                                  ROWS BETWEEN {STRETCH - 1} PRECEDING AND CURRENT ROW) AS s FROM tg) x
GROUP BY team_id""")
def q_rolling_wins(spark, sf):
    tg = team_games(tb.games(spark, sf))
    return pa.rolling_max_wins(tg, "team_id", "game_date_est", "game_id", "win", STRETCH)


@query("longest_streak", _CONFORM_SQL + f""",
o AS (SELECT dim_player_id, m_pts > {STREAK_PTS} AS ok,
             row_number() OVER (PARTITION BY dim_player_id ORDER BY dim_game_date, dim_game_id) AS i
      FROM fct),
r AS (SELECT dim_player_id, i - sum(CAST(ok AS INTEGER)) OVER (PARTITION BY dim_player_id ORDER BY i
                                                              ROWS UNBOUNDED PRECEDING) AS isl, ok FROM o)
SELECT p.dim_player_id, coalesce(max(c), 0) AS longest_streak
FROM (SELECT DISTINCT dim_player_id FROM fct) p
LEFT JOIN (SELECT dim_player_id, isl, count(*) AS c FROM r WHERE ok GROUP BY 1, 2) s USING (dim_player_id)
GROUP BY p.dim_player_id""")
def q_longest_streak(spark, sf):
    f = conform(spark, sf)
    return pa.longest_streak(f.select("dim_player_id", "dim_game_date", "dim_game_id", "m_pts"), "dim_player_id",
                             "dim_game_date", ["dim_game_id"], F.col("m_pts") > STREAK_PTS)
