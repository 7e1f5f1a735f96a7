"""§2.3 idempotent loads, bound to `seasons`, `web_events` and `orders`; tables land under the
shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimforge.operators import activity as ac
from dimforge.operators import cumulation as cu
from dimforge.operators import loads as ld
from dimforge.plans import query
from dimforge.plans.activity import _DAILY_SQL, _METRIC_OUT, flat_metric, metric_arrays
from dimforge.plans.periods import DAY, YEAR, day, year
from dimforge.session import scratch_path
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views

LO, HI = "1996-01-01", "1998-12-31"


@query("load_partition_overwrite", with_views("web_events") + """
SELECT user_id, url, count(*) AS n_events, CAST(event_time AS DATE) AS date
FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2, 4""")
def q_load_partition_overwrite(spark, sf):
    daily = ac.daily_activity(tb.web_events(spark, sf), ["user_id", "url"], "event_time")
    path = scratch_path(spark, "daily-user-url")
    ld.load_partition_overwrite(daily, path, ["date"])
    # rerun of the last day only: its partition is replaced, the others are untouched
    ld.load_partition_overwrite(daily.filter(F.col("date") == F.lit(day(spark, sf)).cast("date")), path, ["date"])
    return spark.read.parquet(path).select("user_id", "url", "n_events", F.col("date").cast("date").alias("date"))


@query("load_merge_upsert", with_views("seasons") + f"""
SELECT player_id, season, pts FROM seasons WHERE season <= {YEAR}
QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY season DESC) = 1""")
def q_load_merge_upsert(spark, sf):
    s = tb.seasons(spark, sf).select("player_id", "season", "pts")
    target = cu.latest_state(s.filter(F.col("season") < year(spark, sf)), "player_id", "season")
    source = s.filter(F.col("season") == year(spark, sf))
    return ld.load_merge_upsert(target, source, "player_id")


@query("load_upsert_array", _DAILY_SQL + _METRIC_OUT)
def q_load_upsert_array(spark, sf):
    target = metric_arrays(spark, sf, -1)
    step = ac.metric_array_step(target, tb.web_events(spark, sf), "user_id", "event_time", day(spark, sf))
    merged = ld.load_merge_upsert(target.select(*step.columns), step, ["user_id", "month_start", "metric_name"])
    return flat_metric(merged)


@query("load_insert_absent", with_views("seasons") + f"""
SELECT player_id, season, CASE WHEN season < {YEAR} THEN pts ELSE -1.0 END AS pts FROM seasons""")
def q_load_insert_absent(spark, sf):
    s = tb.seasons(spark, sf).select("player_id", "season", "pts")
    target = s.filter(F.col("season") < year(spark, sf))
    source = s.withColumn("pts", F.lit(-1.0))
    return ld.load_insert_absent(target, source, ["player_id", "season"])


@query("load_bounded_range", f"""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '{LO}' AND o_orderdate <= TIMESTAMP '{HI}'""")
def q_load_bounded_range(spark, sf):
    o = tb.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ld.load_bounded_range(o, "o_orderdate", LO, HI)


@query("partition_completeness", f"""
SELECT CAST(ts AS DATE) AS event_date, count(*) AS expected_rows,
       count(*) FILTER (WHERE ts < ({DAY} + INTERVAL 12 HOUR)) AS actual_rows,
       count(*) FILTER (WHERE NOT ts < ({DAY} + INTERVAL 12 HOUR)) = 0 AS is_complete FROM events GROUP BY 1""")
def q_partition_completeness(spark, sf):
    """A load that stopped at noon of the last day, held against the source's own counts per day."""
    control = (tb.read(spark, sf, "events").groupBy(F.to_date("ts").alias("event_date"))
               .agg(F.count(F.lit(1)).alias("n")))
    e = tb.web_events(spark, sf).withColumn("event_date", F.to_date("event_time"))
    e = e.filter(F.col("event_time") < F.lit(f"{day(spark, sf)} 12:00:00").cast("timestamp_ntz"))
    path = ld.load_partition_overwrite(e, scratch_path(spark, "events-by-day"), ["event_date"])
    actual = spark.read.parquet(path).withColumn("event_date", F.col("event_date").cast("date"))
    return ld.partition_completeness(actual, control, "event_date", "n")
