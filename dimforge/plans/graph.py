"""§2.4 graph tables, bound to `games`, `game_details`, `teams`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.operators import graph as gr
from dimforge.operators.graph import props_json
from dimforge.plans import query
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views


@query("vertex_event", with_views("games") + """
SELECT game_id AS identifier, 'game' AS type,
       json_object('pts_home', pts_home, 'pts_away', pts_away,
                   'winning_team', CASE WHEN home_team_wins = 1 THEN home_team_id ELSE visitor_team_id END)::VARCHAR
         AS properties
FROM games""")
def q_vertex_event(spark, sf):
    return gr.vertex_event(tb.games(spark, sf))


@query("vertex_agg", with_views("game_details") + """
SELECT player_id AS identifier, 'player' AS type,
       json_object('player_name', max(player_name), 'number_of_games', count(*),
                   'total_points', CAST(sum(pts) AS BIGINT),
                   'teams', list_sort(list(DISTINCT team_id)))::VARCHAR AS properties
FROM game_details GROUP BY player_id""")
def q_vertex_agg(spark, sf):
    return gr.vertex_agg(tb.game_details(spark, sf))


@query("vertex_dedup", with_views("teams") + """
SELECT team_id AS identifier, 'team' AS type, abbreviation, nickname, city, arena,
       CAST(yearfounded AS VARCHAR) AS year_founded
FROM teams QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY load_seq, abbreviation, nickname) = 1""")
def q_vertex_dedup(spark, sf):
    v = gr.vertex_dedup(tb.teams(spark, sf), "load_seq")
    return v.select("identifier", "type", *[F.col("properties")[k].alias(k) for k in
                                            ("abbreviation", "nickname", "city", "arena", "year_founded")])


_PLAYS_IN_SQL = with_views("game_details") + """,
pin AS (SELECT player_id AS subject_identifier, 'player' AS subject_type, game_id AS object_identifier,
               'game' AS object_type, 'plays_in' AS edge_type,
               json_object('start_position', start_position, 'pts', pts, 'team_id', team_id)::VARCHAR AS properties
        FROM game_details
        QUALIFY row_number() OVER (PARTITION BY player_id, game_id ORDER BY loaded_at, start_position, pts, team_id) = 1)
"""


def plays_in(spark, sf) -> DataFrame:
    return gr.edge_entity_event(tb.game_details(spark, sf), "loaded_at")


@query("edge_entity_event", _PLAYS_IN_SQL + "SELECT * FROM pin")
def q_edge_entity_event(spark, sf):
    return plays_in(spark, sf)


@query("edge_member_of", with_views("game_details") + """
SELECT player_id AS subject_identifier, 'player' AS subject_type, team_id AS object_identifier,
       'team' AS object_type, 'plays_on' AS edge_type,
       json_object('num_games', count(DISTINCT game_id))::VARCHAR AS properties
FROM game_details GROUP BY player_id, team_id""")
def q_edge_member_of(spark, sf):
    return gr.edge_member_of(tb.game_details(spark, sf))


_TEAM_EDGE_SQL = with_views("games") + """,
tt AS (SELECT least(home_team_id, visitor_team_id) AS a, greatest(home_team_id, visitor_team_id) AS b,
              CASE WHEN home_team_wins = 1 THEN home_team_id ELSE visitor_team_id END AS w FROM games),
te AS (SELECT a AS subject_identifier, 'team' AS subject_type, b AS object_identifier, 'team' AS object_type,
              'plays_against' AS edge_type, count(*) AS num_games,
              count(*) FILTER (WHERE w = a) AS subject_wins, count(*) FILTER (WHERE w = b) AS object_wins
       FROM tt GROUP BY a, b)
"""


@query("edge_team_team", _TEAM_EDGE_SQL + """
SELECT subject_identifier, subject_type, object_identifier, object_type, edge_type,
       json_object('num_games', num_games, 'subject_wins', subject_wins, 'object_wins', object_wins)::VARCHAR
         AS properties FROM te""")
def q_edge_team_team(spark, sf):
    return gr.edge_team_team(tb.games(spark, sf))


@query("graph_max_property", with_views("game_details") + """,
pin AS (SELECT player_id, pts FROM game_details
        QUALIFY row_number() OVER (PARTITION BY player_id, game_id ORDER BY loaded_at, start_position, pts, team_id) = 1)
SELECT g.player_name, max(p.pts) AS max_pts
FROM (SELECT player_id, max(player_name) AS player_name FROM game_details GROUP BY player_id) g
JOIN pin p ON p.player_id = g.player_id GROUP BY g.player_name""")
def q_graph_max_property(spark, sf):
    v = gr.vertex_agg(tb.game_details(spark, sf))
    e = plays_in(spark, sf)
    return gr.graph_max_property(v, e, "player_name", "pts").withColumn("max_pts", F.col("max_pts").cast("int"))


def team_stat_vertices(games: DataFrame) -> DataFrame:
    home = games.select(F.col("home_team_id").alias("t"), F.col("pts_home").alias("p"))
    away = games.select(F.col("visitor_team_id").alias("t"), F.col("pts_away").alias("p"))
    a = home.unionByName(away).groupBy("t").agg(F.count(F.lit(1)).alias("number_of_games"),
                                                F.sum("p").alias("total_points"))
    return a.select(F.col("t").alias("identifier"), F.lit("team").alias("type"),
                    props_json(total_points=F.col("total_points"),
                               number_of_games=F.col("number_of_games")).alias("properties"))


@query("graph_pair_ratio", _TEAM_EDGE_SQL + """,
ts AS (SELECT t, count(*) AS n, sum(p) AS pts FROM
         (SELECT home_team_id AS t, pts_home AS p FROM games UNION ALL SELECT visitor_team_id, pts_away FROM games) x
       GROUP BY t)
SELECT te.subject_identifier, te.object_identifier,
       round(CAST(ts.pts AS DOUBLE) / CASE WHEN ts.n = 0 THEN 1 ELSE ts.n END, 6) AS total_points_per_number_of_games,
       te.num_games, te.subject_wins
FROM te JOIN ts ON ts.t = te.subject_identifier""")
def q_graph_pair_ratio(spark, sf):
    g = tb.games(spark, sf)
    return gr.graph_pair_ratio(team_stat_vertices(g), gr.edge_team_team(g), "total_points", "number_of_games",
                               ["num_games", "subject_wins"])
