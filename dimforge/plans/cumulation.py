"""§2.1 cumulative dimensions, bound to `seasons` (orders by customer-year) and `films`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.operators import cumulation as cu
from dimforge.operators import loads as ld
from dimforge.operators.common import fold_steps
from dimforge.operators.published import PublishedTable, one_row_per
from dimforge.plans import query
from dimforge.plans.periods import NO_YEAR, YEAR, year
from dimforge.session import scratch_path
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views

S_STRUCT = ("season", "gp", "pts")
S_STATIC = ("player_name", "country", "college")
F_STRUCT = ("filmid", "film", "votes", "rating")

_TIER_SQL = ("CASE WHEN {c} > 650000 THEN 'star' WHEN {c} > 400000 THEN 'good' "
             "WHEN {c} > 200000 THEN 'average' ELSE 'bad' END")
_FTIER_SQL = ("CASE WHEN {c} > 8 THEN 'star' WHEN {c} > 7 THEN 'good' "
              "WHEN {c} > 6 THEN 'average' ELSE 'bad' END")


def season_backfill(spark, sf, shift=0) -> DataFrame:
    """All snapshots up to the run's year, ``shift`` years on."""
    return cu.cumulate_backfill(tb.seasons(spark, sf), "player_id", "season", year(spark, sf) + shift, S_STRUCT, S_STATIC,
                                "pts", tb.SEASON_TIERS)


def season_snapshot(spark, sf, period: int) -> DataFrame:
    """The snapshot of one year, each player's history collected once."""
    return cu.cumulate_snapshot(tb.seasons(spark, sf), "player_id", "season", period, S_STRUCT, S_STATIC,
                                "pts", tb.SEASON_TIERS)


def flat_seasons(snap: DataFrame) -> DataFrame:
    """Snapshot with the history array flattened to scalars (for comparison)."""
    return snap.select(
        "player_id", *S_STATIC,
        F.size("seasons").alias("n_seasons"),
        F.array_join(F.transform("seasons", lambda s: s["season"].cast("string")), ",").alias("season_list"),
        F.try_element_at("seasons", F.lit(-1))["pts"].alias("last_pts"),
        "scoring_class", "years_since_last_active", "is_active", "current_season")


_BACKFILL_SQL = with_views("seasons") + f""",
first AS (SELECT player_id, min(season) AS first_season, max(player_name) AS player_name,
                 max(country) AS country, max(college) AS college
          FROM seasons WHERE season <= {YEAR} GROUP BY player_id),
spine AS (SELECT player_id, player_name, country, college,
                 CAST(unnest(range(first_season, {YEAR} + 1)) AS INTEGER) AS current_season FROM first),
hist AS (SELECT s.player_id, s.current_season, CAST(count(*) AS INTEGER) AS n_seasons,
                string_agg(CAST(p.season AS VARCHAR), ',' ORDER BY p.season) AS season_list,
                max(p.season) AS last_season, arg_max(p.pts, p.season) AS last_pts
         FROM spine s JOIN seasons p ON p.player_id = s.player_id AND p.season <= s.current_season
         GROUP BY s.player_id, s.current_season),
snap AS (
SELECT s.player_id, s.player_name, s.country, s.college, h.n_seasons, h.season_list, h.last_pts,
       {_TIER_SQL.format(c='h.last_pts')} AS scoring_class,
       s.current_season - h.last_season AS years_since_last_active,
       h.last_season = s.current_season AS is_active, s.current_season
FROM spine s JOIN hist h ON s.player_id = h.player_id AND s.current_season = h.current_season)
"""


@query("cumulate_backfill", _BACKFILL_SQL + "SELECT * FROM snap")
def q_cumulate_backfill(spark, sf):
    return flat_seasons(season_backfill(spark, sf))


def season_step(spark, sf, prev: DataFrame) -> DataFrame:
    return cu.cumulate_step(prev, tb.seasons(spark, sf), "player_id", "season", year(spark, sf), S_STRUCT,
                            S_STATIC, "pts", tb.SEASON_TIERS)


@query("cumulate_step", _BACKFILL_SQL + f"SELECT * FROM snap WHERE current_season = {YEAR}")
def q_cumulate_step(spark, sf):
    """The step reads the stored snapshot of the year before."""
    before = season_snapshot(spark, sf, year(spark, sf) - 1)
    stored = spark.read.parquet(ld.replace_table(spark, before, "season-snapshot"))
    return flat_seasons(season_step(spark, sf, stored))


@query("cumulate_chain_guard", _BACKFILL_SQL + f"""
SELECT *, (SELECT count(*) FROM snap WHERE current_season = {YEAR} - 1) AS n_before
FROM snap WHERE current_season = {YEAR}""")
def q_cumulate_chain_guard(spark, sf):
    """The guarded chain of published years: the rows of the year before come
    from the manifest, as the guard's answer does."""
    last = year(spark, sf)
    chain = PublishedTable(spark, scratch_path(spark, "season-chain"), "current_season")
    checks = {"one row per player": one_row_per("player_id")}
    chain.load(season_snapshot(spark, sf, last - 1), [last - 1], checks)
    cu.cumulate_chain_guard(chain, last, first_period=NO_YEAR)
    chain.load(season_step(spark, sf, chain.read([last - 1])), [last], checks)
    return flat_seasons(chain.read([last])).withColumn("n_before", F.lit(chain.partitions()[str(last - 1)]).cast("bigint"))


@query("tier_classify", with_views("seasons") + f"""
SELECT player_id, season, pts, {_TIER_SQL.format(c='pts')} AS scoring_class FROM seasons""")
def q_tier_classify(spark, sf):
    s = tb.seasons(spark, sf)
    return s.select("player_id", "season", "pts",
                    cu.tier(F.col("pts"), tb.SEASON_TIERS, cu.LABELS).alias("scoring_class"))


@query("tier_classify_avg", with_views("films") + f"""
SELECT actorid, year, round(avg(rating), 6) AS avg_rating, {_FTIER_SQL.format(c='avg(rating)')} AS quality_class
FROM films GROUP BY actorid, year""")
def q_tier_classify_avg(spark, sf):
    f = tb.films(spark, sf).groupBy("actorid", "year").agg(F.avg("rating").alias("_a"))
    return f.select("actorid", "year", F.round("_a", 6).alias("avg_rating"),
                    cu.tier(F.col("_a"), tb.FILM_TIERS, cu.LABELS).alias("quality_class"))


@query("first_last_ratio", with_views("seasons") + f"""
SELECT player_id, round(arg_max(pts, season) / CASE WHEN arg_min(pts, season) = 0 THEN 1
                                                    ELSE arg_min(pts, season) END, 6) AS ratio
FROM seasons WHERE season <= {YEAR} GROUP BY player_id""")
def q_first_last_ratio(spark, sf):
    snap = season_snapshot(spark, sf, year(spark, sf))
    r = cu.first_last_ratio(snap, "seasons", "pts")
    return r.select("player_id", F.round("ratio", 6).alias("ratio"))


@query("history_explode", with_views("seasons") + f"""
SELECT player_id, season, gp, pts FROM seasons WHERE season <= {YEAR}""")
def q_history_explode(spark, sf):
    snap = season_snapshot(spark, sf, year(spark, sf))
    return cu.history_explode(snap, ["player_id"], "seasons")


@query("latest_state", with_views("seasons") + """
SELECT player_id, season, gp, pts, player_name, country, college FROM seasons
QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY season DESC) = 1""")
def q_latest_state(spark, sf):
    return cu.latest_state(tb.seasons(spark, sf), "player_id", "season")


@query("enum_check", with_views("seasons") + f"""
SELECT scoring_class, count(*) AS n_rows FROM
  (SELECT {_TIER_SQL.format(c='pts')} AS scoring_class FROM seasons) s
WHERE scoring_class NOT IN ('bad', 'average', 'good') GROUP BY scoring_class""")
def q_enum_check(spark, sf):
    s = tb.seasons(spark, sf).select(cu.tier(F.col("pts"), tb.SEASON_TIERS, cu.LABELS).alias("scoring_class"))
    bad = cu.enum_violations(s, "scoring_class", ["bad", "average", "good"])
    return bad.groupBy("scoring_class").agg(F.count(F.lit(1)).alias("n_rows"))


def films_chain(spark, sf, first: int | None = None, last: int | None = None) -> DataFrame:
    """All steps from the first year there is (or ``first``) to ``last`` (or the run's year)."""
    fl = tb.films(spark, sf)
    last = year(spark, sf) if last is None else last
    if first is None:
        first = fl.agg(F.min("year")).first()[0] or last
    snap = cu.empty_multi_snapshot(fl, "actorid", "year", F_STRUCT, ["actor"])
    return fold_steps(snap, range(first, last + 1),
                      lambda s, yr: cu.cumulate_step_multi(s, fl, "actorid", "year", yr, "filmid", F_STRUCT,
                                                           ["actor"], "rating", tb.FILM_TIERS))


@query("cumulate_step_multi", with_views("films") + f"""
, win AS (SELECT * FROM films WHERE year <= {YEAR}),
newest AS (SELECT actorid, max(year) AS y FROM win GROUP BY actorid),
rated AS (SELECT w.actorid, n.y, avg(w.rating) AS a FROM win w JOIN newest n ON n.actorid = w.actorid AND n.y = w.year
          GROUP BY w.actorid, n.y)
SELECT w.actorid, max(w.actor) AS actor, CAST(count(*) AS INTEGER) AS n_films,
       string_agg(CAST(w.filmid AS VARCHAR), ',' ORDER BY w.year, w.filmid) AS film_ids,
       {_FTIER_SQL.format(c='max(r.a)')} AS quality_class,
       max(r.y) = {YEAR} AS is_active, {YEAR} AS current_year
FROM win w JOIN rated r ON r.actorid = w.actorid
GROUP BY w.actorid""")
def q_cumulate_step_multi(spark, sf):
    snap = films_chain(spark, sf)
    return snap.select("actorid", "actor", F.size("films").alias("n_films"),
                       F.array_join(F.transform("films", lambda s: s["filmid"].cast("string")), ",")
                        .alias("film_ids"),
                       "quality_class", "is_active", "current_year")
