"""Fact modeling: conform, dedupe, rates, grains, sampling, retention, anonymisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.functions.columns import flag_in, md5_bucket, minutes_of  # noqa: F401
from dimforge.operators.common import cols, dedup_first

# fixed values: comment codes for did-not-play, did-not-dress, not-with-team
COMMENT_FLAGS = ("DNP", "DND", "NWT")


def fact_conform(details: DataFrame, games: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Deduped player-game facts joined to the game dimension, ``dim_*`` / ``m_*`` naming.

    Rows are shuffled once, by game: dedupe (``row_number() == 1``) and join
    both run on that partitioning, and nothing is sorted in the scan's tasks,
    which may hold a whole file. One row per (game, team, player), earliest
    load wins; a game without a number joins nothing. ``carry`` names further
    columns of ``games`` that come along unchanged, so that no later step joins
    ``games`` again.
    """
    played = details.filter(F.col("game_id").isNotNull()).repartition("game_id")
    d = dedup_first(played, ["game_id", "team_id", "player_id"], ["loaded_at", "start_position"])
    g = games.select("game_id", "game_date_est", "season", "home_team_id",
                     *[c for c in carry if c != "home_team_id"])
    j = d.join(g, "game_id")
    return j.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        *[flag_in("comment", code).alias(name) for code, name in
          zip(COMMENT_FLAGS, ("dim_did_not_play", "dim_did_not_dress", "dim_not_with_team"))],
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        F.round(minutes_of("min"), 4).alias("m_minutes"),
        F.col("pts").alias("m_pts"),
        F.col("game_id").alias("dim_game_id"),
        *carry)


def fact_rate(fct: DataFrame) -> DataFrame:
    """Games, points, bailed-out count and rate per player."""
    return (fct.groupBy("dim_player_id", "dim_player_name")
               .agg(F.count(F.lit(1)).alias("number_of_games"),
                    F.sum("m_pts").alias("total_points"),
                    F.count_if(F.col("dim_not_with_team")).alias("bailed_num"))
               .withColumn("bailed_out_rate", F.round(F.col("bailed_num") / F.col("number_of_games"), 6)))


def fact_dup_distribution(df: DataFrame, keys: Sequence[str], ts: str, unit: str = "hour") -> DataFrame:
    """Copies per key inside each ``unit`` window, then how many keys have k copies."""
    w = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("window_start")
    per_key = df.groupBy(w, *cols(keys)).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy("window_start", "copies").agg(F.count(F.lit(1)).alias("n_keys"))


def fact_dedup_hourly_tree(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str],
                           levels: int = 5) -> DataFrame:
    """Dedupe per hour, then merge neighbouring hours pairwise up a binary tree.

    Level 0 collapses copies inside each hour (what an hourly micro-batch
    lands); level l merges buckets ``hour // 2**l``. Each merge is an
    aggregation of the two halves (the FULL OUTER JOIN of the lecture,
    written as a union-then-group so it stays a single partial+final
    aggregate). After ``levels`` merges (2**5 = 32 > 24 hours) one row per
    key and day remains; a last merge across days gives the one-shot answer.
    Two exchanges in all: the hourly aggregation, then one hash on the key
    that every later level reuses.
    """
    keys = cols(keys)
    hour = (F.unix_timestamp(F.col(ts).cast("timestamp")) / 3600).cast("bigint")
    first = F.min(F.struct(F.col(ts).alias("first_seen"), *[F.col(v) for v in values]))
    cur = (df.withColumn("_b", hour)
             .groupBy("_b", *keys).agg(first.alias("_f"), F.count(F.lit(1)).alias("n_copies")))
    # after the hourly level a key has at most one row per hour; hash it by key once so every
    # merge level (grouped by bucket + key) runs in place with no further exchange
    cur = cur.repartition(*keys)
    for _ in range(levels):
        cur = (cur.withColumn("_b", F.floor(F.col("_b") / 2).cast("bigint"))
                  .groupBy("_b", *keys).agg(F.min("_f").alias("_f"), F.sum("n_copies").alias("n_copies")))
    out = cur.groupBy(*keys).agg(F.min("_f").alias("_f"), F.sum("n_copies").alias("n_copies"))
    return out.select(*keys, *[F.col(f"_f.{v}").alias(v) for v in values],
                      F.col("_f.first_seen").alias("first_seen"), "n_copies")


def fact_sample(df: DataFrame, key: str, pct: int) -> DataFrame:
    """Deterministic ``pct``% sample by key hash: every row of a sampled key is kept."""
    return df.filter(md5_bucket(key) < pct)


def fact_anonymize(df: DataFrame, ts: str, as_of: str, keep_days: int, pii: Sequence[str]) -> DataFrame:
    """Rows older than ``keep_days`` before ``as_of`` keep a sha256 of each PII column, not the value."""
    old = F.col(ts) < F.date_sub(F.lit(as_of).cast("date"), keep_days).cast("timestamp_ntz")
    out = df.withColumn("is_anonymized", old)
    for c in pii:
        out = (out.withColumn(f"{c}_hash", F.when(old, F.sha2(F.col(c).cast("string"), 256)))
                  .withColumn(c, F.when(~old, F.col(c))))
    return out


def fact_retention(df: DataFrame, ts: str, as_of: str, keep_days: int) -> DataFrame:
    """Keep only the last ``keep_days`` daily partitions up to ``as_of`` (a prunable range filter)."""
    lo = F.date_sub(F.lit(as_of).cast("date"), keep_days - 1).cast("timestamp_ntz")
    hi = F.date_add(F.lit(as_of).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def fact_denormalize(fact: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Copy dimension attributes onto the fact so later reads skip the join.

    No hint: the planner broadcasts the dimension when its size estimate is
    under ``autoBroadcastJoinThreshold`` and AQE re-checks with real sizes;
    otherwise it is a shuffle join on ``key``.
    """
    return fact.join(dim.select(key, *attrs), key, "left")


def grain_snapshot(df: DataFrame, key: str, ts: str, state: Sequence[str], tie: str) -> DataFrame:
    """End-of-day state per entity: last row of each day, plus the day's row count."""
    day = F.to_date(F.col(ts)).alias("snapshot_date")
    last = F.max_by(F.struct(*[F.col(c) for c in state]), F.struct(F.col(ts), F.col(tie)))
    return (df.groupBy(key, day).agg(last.alias("_l"), F.count(F.lit(1)).alias("n_events"))
              .select(key, "snapshot_date", *[F.col(f"_l.{c}").alias(f"last_{c}") for c in state], "n_events"))


def grain_accumulating(df: DataFrame, key: str, ts: str, stage_col: str, stages: Sequence[str]) -> DataFrame:
    """One lifecycle row per entity: first time each milestone was reached."""
    return df.groupBy(key).agg(
        F.min(ts).alias("first_seen_at"),
        *[F.min(F.when(F.col(stage_col) == s, F.col(ts))).alias(f"{s}_at") for s in stages])
