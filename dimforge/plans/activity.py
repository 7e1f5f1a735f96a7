"""§2.5 (second half) cumulated activity, bound to `web_events` as of the last driver day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.operators import activity as ac
from dimforge.operators import scd
from dimforge.operators.loads import replace_table
from dimforge.operators.published import PublishedTable, one_row_per, previous
from dimforge.plans import query
from dimforge.plans.periods import DAY, MONTH, day
from dimforge.session import scratch_path
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views



def _dates_str(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda d: d.cast("string")), ",")


def flat_dates(df: DataFrame, key: str, dates: str = "dates_active") -> DataFrame:
    return df.select(key, F.size(dates).alias("n_dates"), _dates_str(dates).alias("dates_list"), "date")


def _ints_str(c: str, null: str | None = None) -> F.Column:
    s = F.transform(c, lambda x: x.cast("string"))
    return F.array_join(s, ",", null) if null is not None else F.array_join(s, ",")


def events(spark, sf) -> DataFrame:
    return tb.web_events(spark, sf)


def events_dev(spark, sf) -> DataFrame:
    return events(spark, sf).join(tb.web_devices(spark, sf), "device_id", "left")


def chained(spark, sf, prev: DataFrame, key: str, step) -> DataFrame:
    """The run's day of a published chain: yesterday is published, the step
    reads it there, and its audited result is published as today."""
    chain = PublishedTable(spark, scratch_path(spark, "chain"), "date")
    checks = {"one row per key": one_row_per(key)}
    chain.load(prev, [day(spark, sf, -1)], checks)
    chain.load(step(chain, day(spark, sf)), [day(spark, sf)], checks)
    return chain.read([day(spark, sf)])


_DATES_SQL = with_views("web_events") + f""",
ud AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS d FROM web_events
       WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= {DAY})
"""
_DATES_OUT = f"""
SELECT user_id, CAST(count(*) AS INTEGER) AS n_dates, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates_list,
       {DAY} AS date FROM ud GROUP BY user_id"""


@query("dates_active_backfill", _DATES_SQL + _DATES_OUT)
def q_dates_active_backfill(spark, sf):
    return flat_dates(ac.dates_active_backfill(events(spark, sf), "user_id", "event_time", day(spark, sf)), "user_id")


@query("dates_active_step", _DATES_SQL + _DATES_OUT)
def q_dates_active_step(spark, sf):
    e = events(spark, sf)
    prev = ac.dates_active_backfill(e, "user_id", "event_time", day(spark, sf, -1))
    return flat_dates(chained(spark, sf, prev, "user_id", lambda chain, ds: ac.dates_active_step(
        chain, e, "user_id", "event_time", ds)), "user_id")


@query("host_dates_step", with_views("web_events") + f"""
, hd AS (SELECT DISTINCT host, CAST(event_time AS DATE) AS d FROM web_events
         WHERE CAST(event_time AS DATE) <= {DAY})
SELECT host, CAST(count(*) AS INTEGER) AS n_dates, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates_list,
       {DAY} AS date FROM hd GROUP BY host""")
def q_host_dates_step(spark, sf):
    e = events(spark, sf)
    prev = ac.dates_active_backfill(e, "host", "event_time", day(spark, sf, -1))
    return flat_dates(chained(spark, sf, prev, "host", lambda chain, ds: ac.dates_active_step(
        chain, e, "host", "event_time", ds)), "host")


def user_device_dates_backfill(e: DataFrame, ds: str) -> DataFrame:
    per = ac.dates_active_backfill(e, ["user_id", "browser_type"], "event_time", ds, dates="dates")
    return (per.groupBy("user_id")
               .agg(F.map_from_entries(F.collect_list(F.struct("browser_type", "dates"))).alias("device_activity"))
               .withColumn("date", F.lit(ds).cast("date")))


def user_device_dates_step(prev: DataFrame | PublishedTable, e: DataFrame, ds: str) -> DataFrame:
    """Cumulative MAP<browser, ARRAY<DATE>>: yesterday's map merged key-wise with today's dates."""
    today = (ac.daily_activity(e, ["user_id", "browser_type"], "event_time", ds)
               .groupBy("user_id")
               .agg(F.map_from_entries(F.collect_list(F.struct("browser_type", F.array("date")))).alias("m")))
    y = previous(prev, "date", ds).alias("y")
    j = y.join(today.alias("t"), F.col("y.user_id") == F.col("t.user_id"), "full_outer")
    empty = F.create_map().cast("map<string,array<date>>")
    merged = F.map_zip_with(F.coalesce(F.col("y.device_activity"), empty), F.coalesce(F.col("t.m"), empty),
                            lambda k, a, b: F.concat(F.coalesce(a, F.array().cast("array<date>")),
                                                     F.coalesce(b, F.array().cast("array<date>"))))
    return j.select(F.coalesce(F.col("t.user_id"), F.col("y.user_id")).alias("user_id"),
                    merged.alias("device_activity"), F.lit(ds).cast("date").alias("date"))


_UDD_SQL = with_views("web_events", "web_devices") + f""",
ubd AS (SELECT DISTINCT e.user_id, d.browser_type, CAST(e.event_time AS DATE) AS d
        FROM web_events e LEFT JOIN web_devices d ON e.device_id = d.device_id
        WHERE e.user_id IS NOT NULL AND d.browser_type IS NOT NULL AND CAST(e.event_time AS DATE) <= {DAY})
"""


@query("user_device_dates", _UDD_SQL + """
SELECT user_id, browser_type, CAST(count(*) AS INTEGER) AS n_dates,
       string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates_list FROM ubd GROUP BY user_id, browser_type""")
def q_user_device_dates(spark, sf):
    e = events_dev(spark, sf)
    prev = user_device_dates_backfill(e, day(spark, sf, -1))
    cur = chained(spark, sf, prev, "user_id", lambda chain, ds: user_device_dates_step(chain, e, ds))
    return cur.select("user_id", F.explode("device_activity").alias("browser_type", "dates")).select(
        "user_id", "browser_type", F.size("dates").alias("n_dates"), _dates_str("dates").alias("dates_list"))


_BITS_SQL = f"""CAST(coalesce(sum(CASE WHEN date_diff('day', d, {DAY}) BETWEEN 0 AND 31
                              THEN (CAST(1 AS BIGINT) << (31 - date_diff('day', d, {DAY}))) END), 0) AS BIGINT)"""


@query("datelist_int", _DATES_SQL + f"SELECT user_id, {_BITS_SQL} AS datelist_int FROM ud GROUP BY user_id")
def q_datelist_int(spark, sf):
    b = ac.dates_active_backfill(events(spark, sf), "user_id", "event_time", day(spark, sf))
    return b.select("user_id", ac.datelist_bits(F.col("dates_active"), day(spark, sf)).alias("datelist_int"))


@query("device_datelist_int", _UDD_SQL + f"""
SELECT user_id, browser_type, {_BITS_SQL} AS datelist_int FROM ubd GROUP BY user_id, browser_type""")
def q_device_datelist_int(spark, sf):
    m = user_device_dates_backfill(events_dev(spark, sf), day(spark, sf))
    bits = m.select("user_id", F.transform_values("device_activity", lambda k, v: ac.datelist_bits(v, day(spark, sf))).alias("b"))
    return bits.select("user_id", F.explode("b").alias("browser_type", "datelist_int"))


@query("datelist_flags", _DATES_SQL + f""", b AS (SELECT user_id, {_BITS_SQL} AS x FROM ud GROUP BY user_id)
SELECT user_id, x AS datelist_int, bit_count(x) > 0 AS dim_is_monthly_active, CAST(bit_count(x) AS INTEGER) AS l32,
       bit_count(x & {ac.MASK_LAST_7}) > 0 AS dim_is_weekly_active,
       CAST(bit_count(x & {ac.MASK_LAST_7}) AS INTEGER) AS l7,
       bit_count(x & {ac.MASK_PREV_7}) > 0 AS dim_is_weekly_active_previous_week
FROM b""")
def q_datelist_flags(spark, sf):
    return ac.datelist_flags(q_datelist_int(spark, sf))


# ---- reduced monthly arrays --------------------------------------------------

_DAILY_BODY = f""",
days AS (SELECT CAST(unnest(range(0, date_diff('day', {MONTH}, {DAY}) + 1)) AS INTEGER) AS pos),
dc AS (SELECT user_id, date_diff('day', {MONTH}, CAST(event_time AS DATE)) AS pos, count(*) AS n,
              sum(value) AS v
       FROM web_events WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) BETWEEN {MONTH} AND {DAY}
       GROUP BY 1, 2),
users AS (SELECT DISTINCT user_id FROM dc),
grid AS (SELECT u.user_id, d.pos, dc.n, dc.v FROM users u CROSS JOIN days d
         LEFT JOIN dc ON dc.user_id = u.user_id AND dc.pos = d.pos)
"""
_DAILY_SQL = with_views("web_events") + _DAILY_BODY


def metric_arrays(spark, sf, shift=0) -> DataFrame:
    return (ac.metric_array_backfill(events(spark, sf), "user_id", "event_time", day(spark, sf, shift))
              .withColumn("metric_name", F.lit("site_hits")))


def flat_metric(df: DataFrame) -> DataFrame:
    return df.select("user_id", "month_start", "metric_name", F.size("metric_array").alias("n_days"),
                     _ints_str("metric_array").alias("metric_list"),
                     F.aggregate("metric_array", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


_METRIC_OUT = f"""
SELECT user_id, {MONTH} AS month_start, 'site_hits' AS metric_name, CAST(count(*) AS INTEGER) AS n_days,
       string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY pos) AS metric_list,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS total
FROM grid GROUP BY user_id"""


@query("metric_array_step", _DAILY_SQL + _METRIC_OUT)
def q_metric_array_step(spark, sf):
    prev = metric_arrays(spark, sf, -1)
    return flat_metric(ac.metric_array_step(prev, events(spark, sf), "user_id", "event_time", day(spark, sf)))


def hit_arrays(spark, sf, shift=0) -> DataFrame:
    return ac.hit_array_backfill(events(spark, sf), "user_id", "event_time", day(spark, sf, shift))


@query("hit_array_step", _DAILY_SQL + f"""
SELECT user_id, string_agg(coalesce(CAST(n AS VARCHAR), 'N'), ',' ORDER BY pos) AS hit_list,
       {MONTH} AS month_start,
       CAST({MONTH} + CAST(min(pos) FILTER (WHERE n IS NOT NULL) AS INTEGER) AS DATE) AS first_found_date,
       {DAY} AS date_partition
FROM grid GROUP BY user_id""")
def q_hit_array_step(spark, sf):
    prev = hit_arrays(spark, sf, -1)
    cur = ac.hit_array_step(prev, events(spark, sf), "user_id", "event_time", day(spark, sf))
    return cur.select("user_id", _ints_str("hit_array", "N").alias("hit_list"), "month_start",
                      "first_found_date", "date_partition")


@query("metric_array_unpivot", _DAILY_SQL + f"""
SELECT 'site_hits' AS metric_name, CAST({MONTH} + pos AS DATE) AS adjusted_date,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS value FROM grid GROUP BY pos""")
def q_metric_array_unpivot(spark, sf):
    return ac.metric_array_unpivot(metric_arrays(spark, sf))


@query("metric_array_pick", _DAILY_SQL + f"""
SELECT {MONTH} AS month_start,
       CAST(coalesce(sum(n) FILTER (WHERE pos = 0), 0) AS BIGINT) AS num_hits_first_day,
       CAST(coalesce(sum(n) FILTER (WHERE pos = 1), 0) AS BIGINT) AS num_hits_second_day,
       CAST(coalesce(sum(n) FILTER (WHERE pos = 2), 0) AS BIGINT) AS num_hits_third_day
FROM grid""")
def q_metric_array_pick(spark, sf):
    return ac.metric_array_pick(hit_arrays(spark, sf), "hit_array", [0, 1, 2],
                                ["num_hits_first_day", "num_hits_second_day", "num_hits_third_day"], ds=day(spark, sf))


@query("metric_array_cardinality", _DAILY_SQL + """
SELECT CAST((SELECT count(*) FROM days) AS INTEGER) AS cardinality, count(*) AS n_rows FROM users""")
def q_metric_array_cardinality(spark, sf):
    return ac.metric_array_cardinality(metric_arrays(spark, sf))


@query("array_metric_correlation", _DAILY_SQL + """
SELECT user_id, round(corr(coalesce(n, 0), coalesce(v, 0)), 6) AS hits_value_corr FROM grid GROUP BY user_id""")
def q_array_metric_correlation(spark, sf):
    e = events(spark, sf)
    hits = ac.metric_array_backfill(e, "user_id", "event_time", day(spark, sf), name="hits")
    vals = ac.metric_array_backfill(e, "user_id", "event_time", day(spark, sf), metric=F.sum("value"),
                                    fill=F.lit(0.0), name="vals")
    z = hits.join(vals, ["user_id", "month_start"])
    rows = z.select("user_id", F.inline(F.arrays_zip("hits", "vals")))
    return rows.groupBy("user_id").agg(F.round(F.corr(F.col("hits").cast("double"), "vals"), 6)
                                       .alias("hits_value_corr"))


def host_reduced_backfill(e: DataFrame, ds: str) -> DataFrame:
    hits = ac.metric_array_backfill(e, "host", "event_time", ds, name="hit_array")
    vis = ac.metric_array_backfill(e, "host", "event_time", ds, metric=F.countDistinct("user_id"),
                                   name="unique_visitors")
    return hits.join(vis, ["host", "month_start"])


def host_reduced_step(prev: DataFrame, e: DataFrame, ds: str) -> DataFrame:
    """Day-by-day load of (month, host) -> hit_array, unique_visitors arrays."""
    ms = ac.month_start_of(ds)
    d0 = F.lit(ds).cast("date")
    today = (e.filter((F.col("event_time") >= d0.cast("timestamp_ntz")) &
                      (F.col("event_time") < F.date_add(d0, 1).cast("timestamp_ntz")))
              .groupBy("host").agg(F.count(F.lit(1)).alias("hits"), F.countDistinct("user_id").alias("visitors")))
    y = prev.filter(F.col("month_start") == ms).alias("y")
    j = y.join(today.alias("t"), F.col("y.host") == F.col("t.host"), "full_outer")
    n = F.datediff(d0, ms)

    def grow(arr: str, v: str):
        item = F.array(F.coalesce(F.col(f"t.{v}"), F.lit(0)).cast("bigint"))
        return F.concat(ac.until_day(F.col(f"y.{arr}"), n, F.lit(0)), item)
    return j.select(F.coalesce(F.col("t.host"), F.col("y.host")).alias("host"), ms.alias("month_start"),
                    grow("hit_array", "hits").alias("hit_array"),
                    grow("unique_visitors", "visitors").alias("unique_visitors"))


@query("host_reduced_step", with_views("web_events") + f""",
days AS (SELECT CAST(unnest(range(0, date_diff('day', {MONTH}, {DAY}) + 1)) AS INTEGER) AS pos),
hc AS (SELECT host, date_diff('day', {MONTH}, CAST(event_time AS DATE)) AS pos, count(*) AS n,
              count(DISTINCT user_id) AS u
       FROM web_events WHERE CAST(event_time AS DATE) BETWEEN {MONTH} AND {DAY} GROUP BY 1, 2),
hosts AS (SELECT DISTINCT host FROM hc)
SELECT h.host, {MONTH} AS month_start,
       string_agg(CAST(coalesce(hc.n, 0) AS VARCHAR), ',' ORDER BY d.pos) AS hit_list,
       string_agg(CAST(coalesce(hc.u, 0) AS VARCHAR), ',' ORDER BY d.pos) AS visitors_list
FROM hosts h CROSS JOIN days d LEFT JOIN hc ON hc.host = h.host AND hc.pos = d.pos GROUP BY h.host""")
def q_host_reduced_step(spark, sf):
    e = events(spark, sf)
    cur = host_reduced_step(host_reduced_backfill(e, day(spark, sf, -1)), e, day(spark, sf))
    return cur.select("host", "month_start", _ints_str("hit_array").alias("hit_list"),
                      _ints_str("unique_visitors").alias("visitors_list"))


_VISITORS_SQL = with_views("web_events") + """,
v AS (SELECT host, CAST(event_time AS DATE) AS date, user_id FROM web_events WHERE user_id IS NOT NULL)
SELECT 'host day' AS grain, host, date AS since, count(DISTINCT user_id) AS visitors FROM v GROUP BY host, date
UNION ALL
SELECT 'host week', host, CAST(date_trunc('week', date) AS DATE), count(DISTINCT user_id) FROM v GROUP BY ALL
UNION ALL
SELECT 'day', NULL, date, count(DISTINCT user_id) FROM v GROUP BY date
UNION ALL
SELECT 'month', NULL, CAST(date_trunc('month', date) AS DATE), count(DISTINCT user_id) FROM v GROUP BY ALL"""


@query("host_visitors_rollup", _VISITORS_SQL)
def q_host_visitors_rollup(spark, sf):
    """Weekly, all-host and monthly visitors from the stored sets of (host, day)."""
    sets = ac.visitor_bitmaps(events(spark, sf), ["host"], "event_time", "user_id")
    stored = spark.read.parquet(replace_table(spark, sets, "visitor-bitmaps"))
    grains = {"host day": ["host", F.col("date").alias("since")],
              "host week": ["host", F.to_date(F.date_trunc("week", "date")).alias("since")],
              "day": [F.lit(None).cast("string").alias("host"), F.col("date").alias("since")],
              "month": [F.lit(None).cast("string").alias("host"), F.trunc("date", "month").alias("since")]}
    out = [ac.visitors(stored, by).select(F.lit(g).alias("grain"), "host", "since", "visitors") for g, by in grains.items()]
    return reduce(DataFrame.unionByName, out)


@query("daily_aggregate", with_views("web_events") + """
SELECT user_id, url, CAST(event_time AS DATE) AS date, count(*) AS n_events
FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2, 3""")
def q_daily_aggregate(spark, sf):
    return ac.daily_activity(events(spark, sf), ["user_id", "url"], "event_time")


@query("array_snapshot_join", with_views("web_events", "web_devices") + _DAILY_BODY + f""",
first_day AS (
  SELECT e.user_id, arg_min(d.browser_type, (e.event_time, e.event_id)) AS browser_type
  FROM web_events e LEFT JOIN web_devices d ON e.device_id = d.device_id
  WHERE e.user_id IS NOT NULL AND CAST(e.event_time AS DATE) = {MONTH} GROUP BY e.user_id)
SELECT g.user_id, {MONTH} AS month_start, f.browser_type, CAST(coalesce(sum(g.n), 0) AS BIGINT) AS total_hits
FROM grid g LEFT JOIN first_day f ON f.user_id = g.user_id GROUP BY g.user_id, f.browser_type""")
def q_array_snapshot_join(spark, sf):
    e = events_dev(spark, sf).filter(F.col("user_id").isNotNull())
    daily = (e.groupBy("user_id", F.to_date("event_time").alias("date"))
              .agg(F.min_by("browser_type", F.struct("event_time", "event_id")).alias("browser_type")))
    dim = scd.scd2_backfill(daily, "user_id", "date", ["browser_type"], start="start_date", end="end_date")
    red = metric_arrays(spark, sf).select(
        "user_id", "month_start", F.aggregate("metric_array", F.lit(0).cast("bigint"), lambda a, x: a + x)
        .alias("total_hits"))
    j = scd.scd_asof_join(red, dim, "user_id", "user_id", "month_start", start="start_date", end="end_date")
    return j.select("user_id", "month_start", "browser_type", "total_hits")


@query("dim_ever_flags", with_views("web_events") + f"""
SELECT user_id, bool_or(event_type = 'signup') AS has_ever_signup, bool_or(event_type = 'purchase') AS has_ever_purchase,
       CAST(date_diff('day', max(CAST(event_time AS DATE)), {DAY}) AS INTEGER) AS days_since_last_active,
       CAST(date_diff('day', min(CAST(event_time AS DATE)) FILTER (WHERE event_type = 'signup'), {DAY})
            AS INTEGER) AS days_since_signup
FROM web_events WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= {DAY} GROUP BY user_id""")
def q_dim_ever_flags(spark, sf):
    return ac.dim_ever_flags(events(spark, sf), "user_id", "event_time", day(spark, sf), "event_type", ["signup", "purchase"])


@query("dim_state_vs_activity", with_views("web_events") + """,
ud AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS d FROM web_events WHERE user_id IS NOT NULL),
f AS (SELECT user_id, min(d) AS fd FROM ud GROUP BY user_id)
SELECT d AS date, count(*) AS active_users,
       (SELECT count(*) FROM f WHERE f.fd <= x.d) AS activated_users
FROM ud x GROUP BY d""")
def q_dim_state_vs_activity(spark, sf):
    return ac.dim_state_vs_activity(events(spark, sf), "user_id", "event_time")


@query("additivity_check", with_views("web_events", "web_devices") + """,
p AS (SELECT DISTINCT d.browser_type, e.user_id FROM web_events e LEFT JOIN web_devices d ON e.device_id = d.device_id
      WHERE e.user_id IS NOT NULL)
SELECT count(*) AS sum_group_distinct, count(DISTINCT user_id) AS overall_distinct,
       count(*) = count(DISTINCT user_id) AS is_additive FROM p""")
def q_additivity_check(spark, sf):
    return ac.additivity_check(events_dev(spark, sf), "browser_type", "user_id")
