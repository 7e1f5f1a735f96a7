"""Readers for the driver parquet tables and the binding views built on them.

The reference jobs run on tables (players, games, events, devices, ...) that
are not shipped; each is re-bound here to a driver table with plain DataFrame
expressions. ``dimforge.sources.oracle_views`` holds the same definitions in
DuckDB SQL; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- fixed values of the bindings -------------------------------------------
# referrer strings chosen by k % 7 (index 6 -> NULL referrer)
REFERRERS = (
    "https://www.google.com/search?q=spark",
    "https://t.co/a1b2",
    "https://www.linkedin.com/feed/",
    "https://lnkd.in/xyz",
    "https://www.pinterest.com/pin/42",
    "https://host1/home",
)
SEASON_TIERS = (650000.0, 400000.0, 200000.0)   # star / good / average on yearly totals
FILM_TIERS = (8.0, 7.0, 6.0)                     # star / good / average on avg rating
MEDAL_NAME = "Killing Spree"                     # medal name given to p_type 'PROMO'


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` re-bound to the web-traffic shape (url, referrer, host, device)."""
    return web_events_of(read(spark, sf_dir, "events"))


def web_events_of(ev: DataFrame) -> DataFrame:
    """The web-events projection of an `events`-shaped frame (batch or streaming)."""
    # every derived column reads ``k`` once (the optimizer copies derived expressions into pushed
    # filters, so a CASE with one branch per referrer would re-parse the JSON per branch)
    k = F.col("k")
    ref = F.get(F.array(*[F.lit(r) for r in REFERRERS]), k % 7)     # index 6 (or negative) -> NULL
    return (ev.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
              .select(
                  "event_id",
                  F.col("ts").alias("event_time"),
                  F.when(F.col("user_id") != 0, F.col("user_id")).alias("user_id"),
                  F.concat(F.lit("/"), "event_type").alias("url"),
                  F.col("k").cast("bigint").alias("device_id"),
                  F.concat(F.lit("host"), (F.col("k") % 4).cast("string")).alias("host"),
                  ref.alias("referrer"),
                  "event_type",
                  "value"))


def web_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """web_events plus a late re-delivery of every click/view (duplicate facts)."""
    base = web_events(spark, sf_dir).withColumn("ingested_at", F.col("event_time"))
    again = (base.filter(F.col("event_type").isin("click", "view"))
                 .withColumn("ingested_at", F.col("event_time") + F.expr("INTERVAL 30 MINUTES")))
    return base.unionByName(again)


def web_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("device_id"),
                    F.col("p_brand").alias("browser_type"),
                    F.when(F.col("p_type") != "ECONOMY", F.col("p_type")).alias("device_type"),
                    F.concat(F.lit("os"), (F.col("p_size") % 4).cast("string")).alias("os_type"))


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`player_seasons`: one row per (customer, order year)."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer")
    agg = (o.groupBy(F.col("o_custkey").alias("player_id"),
                     F.year("o_orderdate").alias("season"))
            .agg(F.count(F.lit(1)).alias("gp"),
                 F.round(F.sum("o_totalprice"), 2).alias("pts")))
    cust = c.select(F.col("c_custkey").alias("player_id"),
                    F.col("c_name").alias("player_name"),
                    F.col("c_nationkey").alias("country"),
                    F.col("c_mktsegment").alias("college"))
    return agg.join(cust, "player_id", "left")


def films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`actor_films`: one row per order; several per (actor, year)."""
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("actorid"),
                    F.concat(F.lit("actor"), F.col("o_custkey").cast("string")).alias("actor"),
                    F.year("o_orderdate").alias("year"),
                    F.col("o_orderkey").alias("filmid"),
                    F.concat(F.lit("film"), F.col("o_orderkey").cast("string")).alias("film"),
                    (F.col("o_orderkey") % 1000).alias("votes"),
                    F.round(F.col("o_totalprice") / 50000.0, 3).alias("rating"))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").alias("season"),
        F.col("c_nationkey").alias("home_team_id"),
        ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("int").alias("visitor_team_id"),
        (F.col("o_orderkey") % 41 + 80).cast("int").alias("pts_home"),
        (F.col("o_custkey") % 37 + 80).cast("int").alias("pts_away"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("home_team_wins"))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`game_details`: one row per lineitem; (game, player) is duplicated."""
    li = read(spark, sf_dir, "lineitem")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey, "inner")
    qty = F.col("l_quantity").cast("int").cast("string")
    ln = F.col("l_linenumber")
    comment = (F.when(F.col("l_returnflag") == "R", F.lit("DNP - COACH DECISION"))
                .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit("DND - INJURY"))
                .when(F.col("l_returnflag") == "A", F.lit("NWT - NOT WITH TEAM")))
    minutes = (F.when(ln == 1, F.lit(None).cast("string"))
                .when(ln == 2, F.lit(""))
                .when(ln == 3, qty)
                .when(ln == 7, F.concat(F.lit("x:"), qty))
                .otherwise(F.concat(qty, F.lit(":"), F.lpad(((ln * 7) % 60).cast("string"), 2, "0"))))
    return j.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("s_nationkey").alias("team_id"),
        F.col("l_suppkey").alias("player_id"),
        F.col("s_name").alias("player_name"),
        F.col("l_linenumber").alias("start_position"),
        comment.alias("comment"),
        minutes.alias("min"),
        F.col("l_quantity").cast("int").alias("pts"),
        F.col("l_partkey").alias("ast"),
        F.col("l_shipdate").alias("loaded_at"))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")

    def one(prefix: str, seq: int) -> DataFrame:
        return n.select(F.col("n_nationkey").alias("team_id"),
                        F.upper(F.substring("n_name", 1, 3)).alias("abbreviation"),
                        F.concat(F.lit(prefix), F.col("n_name")).alias("nickname"),
                        F.concat(F.lit("City of "), F.col("n_name")).alias("city"),
                        F.concat(F.col("n_name"), F.lit(" Arena")).alias("arena"),
                        (F.col("n_nationkey") + 1900).alias("yearfounded"),
                        F.lit(seq).alias("load_seq"))
    return one("", 0).unionByName(one("Bad ", 1))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .select(F.col("o_orderkey").alias("match_id"),
                     F.col("o_orderpriority").alias("playlist_id"),
                     F.col("c_nationkey").alias("mapid"),
                     (F.col("o_orderstatus") != "P").alias("is_team_game"),
                     F.col("o_orderdate").alias("completion_date")))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("match_id"),
                       F.concat(F.lit("player"), F.col("l_suppkey").cast("string")).alias("player_gamertag"))
              .agg(F.sum("l_quantity").cast("bigint").alias("player_total_kills"),
                   F.count(F.lit(1)).alias("player_total_deaths")))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("medal_id"),
                    F.when(F.col("p_type") == "PROMO", F.lit(MEDAL_NAME))
                     .otherwise(F.col("p_type")).alias("name"))


def medal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("match_id"),
                     F.concat(F.lit("player"), F.col("l_suppkey").cast("string")).alias("player_gamertag"),
                     F.col("l_partkey").alias("medal_id"),
                     F.col("l_linenumber").cast("bigint").alias("count"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("name"))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geo dimension over the visitor numbers: a wide range per nation, every
    third with its last quarter left out, and within the first four fifths a
    narrow one per part, of a width by the part's size. Ranges overlap.
    """
    top = read(spark, sf_dir, "events").agg(F.max("user_id")).first()[0]
    top = max(0, top or 0) + 1
    span = max(1, top // 25)
    geo = (read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("n_nationkey").cast("bigint").alias("n"), F.col("n_name").alias("country"), F.col("r_name").alias("state")))
    wide = geo.select(F.col("n").alias("range_no"), (F.col("n") * span).alias("ip_lo"),
                      (F.col("n") * span + span - 1 - F.when(F.col("n") % 3 == 2, span // 4).otherwise(0)).alias("ip_hi"),
                      "country", "state", F.concat(F.lit("all of "), F.col("country")).alias("city"))
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("k"), F.col("p_size").cast("bigint").alias("w"))
    narrow = p.join(geo, F.col("k") % 25 == F.col("n")).select(
        (F.col("k") + 100).alias("range_no"), (F.col("k") * 7919 % (top * 4 // 5 + 1)).alias("ip_lo"), "w",
        "country", "state", F.concat(F.lit("city"), F.col("k").cast("string")).alias("city"))
    narrow = narrow.withColumn("ip_hi", F.col("ip_lo") + F.floor(F.col("w") * top / 2000)).drop("w")
    return wide.unionByName(narrow)
