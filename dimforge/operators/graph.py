"""Property-graph tables: vertices and edges with JSON / MAP properties.

Vertex schema: (identifier, type, properties). Edge schema: (subject_identifier,
subject_type, object_identifier, object_type, edge_type, properties).
Co-occurrence edges between every pair of entities sharing an event are not
built: their size is quadratic in the entities per event (see README).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.operators.common import dedup_first

# fixed values: vertex types and edge types
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")

PLAYER, TEAM, GAME = VERTEX_TYPES
PLAYS_AGAINST, _SHARES_TEAM, PLAYS_IN, PLAYS_ON = EDGE_TYPES


def props_json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def vertex_event(games: DataFrame) -> DataFrame:
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return games.select(F.col("game_id").alias("identifier"), F.lit(GAME).alias("type"),
                        props_json(pts_home=F.col("pts_home"), pts_away=F.col("pts_away"),
                                   winning_team=winner).alias("properties"))


def vertex_agg(details: DataFrame) -> DataFrame:
    """Player vertices: name, games, points and the sorted distinct team list."""
    a = details.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"), F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"), F.array_sort(F.collect_set("team_id")).alias("teams"))
    return a.select(F.col("player_id").alias("identifier"), F.lit(PLAYER).alias("type"),
                    props_json(player_name=F.col("player_name"), number_of_games=F.col("number_of_games"),
                               total_points=F.col("total_points"), teams=F.col("teams")).alias("properties"))


def vertex_dedup(teams: DataFrame, order: str) -> DataFrame:
    """Team vertices: first row per team (by ``order``), properties as MAP<STRING, STRING>."""
    t = dedup_first(teams, ["team_id"], [order])
    props = F.create_map(F.lit("abbreviation"), F.col("abbreviation"), F.lit("nickname"), F.col("nickname"),
                         F.lit("city"), F.col("city"), F.lit("arena"), F.col("arena"),
                         F.lit("year_founded"), F.col("yearfounded").cast("string"))
    return t.select(F.col("team_id").alias("identifier"), F.lit(TEAM).alias("type"), props.alias("properties"))


def edge_entity_event(details: DataFrame, order: str) -> DataFrame:
    """``plays_in``: one edge per (player, game), duplicates collapsed first."""
    d = dedup_first(details.select("player_id", "game_id", "start_position", "pts", "team_id", order),
                    ["player_id", "game_id"], [order, "start_position"])
    return d.select(F.col("player_id").alias("subject_identifier"), F.lit(PLAYER).alias("subject_type"),
                    F.col("game_id").alias("object_identifier"), F.lit(GAME).alias("object_type"),
                    F.lit(PLAYS_IN).alias("edge_type"),
                    props_json(start_position=F.col("start_position"), pts=F.col("pts"),
                               team_id=F.col("team_id")).alias("properties"))


def edge_member_of(details: DataFrame) -> DataFrame:
    """``plays_on``: distinct (player, team) with the number of distinct games together."""
    a = details.groupBy("player_id", "team_id").agg(F.countDistinct("game_id").alias("num_games"))
    return a.select(F.col("player_id").alias("subject_identifier"), F.lit(PLAYER).alias("subject_type"),
                    F.col("team_id").alias("object_identifier"), F.lit(TEAM).alias("object_type"),
                    F.lit(PLAYS_ON).alias("edge_type"),
                    props_json(num_games=F.col("num_games")).alias("properties"))


def edge_team_team(games: DataFrame) -> DataFrame:
    """``plays_against`` between the two teams of each game (one pair per game), unordered."""
    lo, hi = F.least("home_team_id", "visitor_team_id"), F.greatest("home_team_id", "visitor_team_id")
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    g = games.select(lo.alias("a"), hi.alias("b"), winner.alias("w"))
    a = g.groupBy("a", "b").agg(F.count(F.lit(1)).alias("num_games"),
                                F.count_if(F.col("w") == F.col("a")).alias("subject_wins"),
                                F.count_if(F.col("w") == F.col("b")).alias("object_wins"))
    return a.select(F.col("a").alias("subject_identifier"), F.lit(TEAM).alias("subject_type"),
                    F.col("b").alias("object_identifier"), F.lit(TEAM).alias("object_type"),
                    F.lit(PLAYS_AGAINST).alias("edge_type"),
                    props_json(num_games=F.col("num_games"), subject_wins=F.col("subject_wins"),
                               object_wins=F.col("object_wins")).alias("properties"))


def json_num(props: str, field: str, typ: str = "bigint") -> Column:
    return F.get_json_object(F.col(props), f"$.{field}").try_cast(typ)


def graph_max_property(vertices: DataFrame, edges: DataFrame, label_field: str, edge_field: str) -> DataFrame:
    """Vertex JOIN edge on (identifier, type); max of a numeric edge property per vertex label.

    The maximum per subject comes first, with a map-side half, so the join
    moves one row per subject however many edges it has.
    """
    v = vertices.select(F.col("identifier").alias("_id"), F.col("type").alias("_t"),
                        F.get_json_object("properties", f"$.{label_field}").alias(label_field))
    e = (edges.groupBy("subject_identifier", "subject_type")
              .agg(F.max(json_num("properties", edge_field)).alias("_p")))
    j = v.join(e, (F.col("_id") == F.col("subject_identifier")) & (F.col("_t") == F.col("subject_type")))
    return j.groupBy(label_field).agg(F.max("_p").alias(f"max_{edge_field}"))


def graph_pair_ratio(vertices: DataFrame, edges: DataFrame, num: str, den: str,
                     pair_fields: Sequence[str]) -> DataFrame:
    """Per edge: the subject's ``num / den`` (zero denominator -> 1) beside edge properties."""
    v = vertices.select(F.col("identifier").alias("_id"), F.col("type").alias("_t"),
                        json_num("properties", num, "double").alias("_n"),
                        json_num("properties", den, "double").alias("_d"))
    e = edges.select("subject_identifier", "subject_type", "object_identifier",
                     *[json_num("properties", f).alias(f) for f in pair_fields])
    j = e.join(v, (F.col("_id") == F.col("subject_identifier")) & (F.col("_t") == F.col("subject_type")))
    ratio = F.col("_n") / F.when(F.col("_d") == 0, F.lit(1.0)).otherwise(F.col("_d"))
    return j.select("subject_identifier", "object_identifier", F.round(ratio, 6).alias(f"{num}_per_{den}"),
                    *pair_fields)
