"""§2.8 experiments and KPIs, bound to `web_events`, `lineitem`, `part`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.operators import experiments as ex
from dimforge.plans import query
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views

SALT = "signup-flow-2024"
SPLIT = 50
EXPOSURE, OUTCOME = "view", "signup"
WITHIN_HOURS = 24

_BUCKET_SQL = f"CAST(('0x' || substr(md5('{SALT}' || CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100"
_ASSIGN_SQL = with_views("web_events") + f""",
assign AS (SELECT user_id, {_BUCKET_SQL} AS bucket,
                  CASE WHEN {_BUCKET_SQL} < {SPLIT} THEN 'treatment' ELSE 'control' END AS cell
           FROM (SELECT DISTINCT user_id FROM web_events WHERE user_id IS NOT NULL) u),
expo AS (SELECT f.user_id, f.exposed_at, min(o.event_time) AS {OUTCOME}_at
         FROM (SELECT user_id, min(event_time) AS exposed_at FROM web_events
               WHERE user_id IS NOT NULL AND event_type = '{EXPOSURE}' GROUP BY user_id) f
         LEFT JOIN web_events o ON o.user_id = f.user_id AND o.event_type = '{OUTCOME}' AND o.event_time > f.exposed_at
                                   AND o.event_time <= f.exposed_at + INTERVAL {WITHIN_HOURS} HOUR
         GROUP BY f.user_id, f.exposed_at)
"""


def users(spark, sf) -> DataFrame:
    return tb.web_events(spark, sf).filter(F.col("user_id").isNotNull()).select("user_id").distinct()


def exposures(spark, sf) -> DataFrame:
    return ex.experiment_exposure_log(tb.web_events(spark, sf), "user_id", "event_time", "event_type",
                                      EXPOSURE, OUTCOME, WITHIN_HOURS)


@query("experiment_assign", _ASSIGN_SQL + "SELECT * FROM assign")
def q_experiment_assign(spark, sf):
    return ex.experiment_assign(users(spark, sf), "user_id", SALT, SPLIT)


@query("experiment_exposure_log", _ASSIGN_SQL + "SELECT * FROM expo")
def q_experiment_exposure_log(spark, sf):
    return exposures(spark, sf)


@query("experiment_readout", _ASSIGN_SQL + """,
j AS (SELECT a.cell, e.signup_at IS NOT NULL AS conv FROM expo e JOIN assign a ON a.user_id = e.user_id),
c AS (SELECT count(*) FILTER (WHERE cell = 'control') AS n_control,
             count(*) FILTER (WHERE cell = 'control' AND conv) AS conv_control,
             count(*) FILTER (WHERE cell = 'treatment') AS n_treatment,
             count(*) FILTER (WHERE cell = 'treatment' AND conv) AS conv_treatment FROM j),
r AS (SELECT *, conv_control / n_control AS pc, conv_treatment / n_treatment AS pt,
             (conv_control + conv_treatment) / (n_control + n_treatment) AS p FROM c)
SELECT n_control, conv_control, n_treatment, conv_treatment, round(pc, 6) AS rate_control,
       round(pt, 6) AS rate_treatment, round((pt - pc) / pc, 6) AS lift,
       round(CASE WHEN p * (1 - p) > 0
                  THEN (pt - pc) / sqrt(p * (1 - p) * (1.0 / n_control + 1.0 / n_treatment)) END, 6) AS z_score
FROM r""")
def q_experiment_readout(spark, sf):
    assign = ex.experiment_assign(users(spark, sf), "user_id", SALT, SPLIT)
    return ex.experiment_readout(assign, exposures(spark, sf), "user_id", f"{OUTCOME}_at")


_PROFIT_SQL = f""",
lp AS (SELECT l.*, CAST(l.l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l.l_discount AS DECIMAL(4, 2)))
                   - CAST(coalesce(p.p_retailprice, 0) AS DECIMAL(18, 2)) * CAST({ex.COST_SHARE} AS DECIMAL(3, 2))
                     * CAST(l.l_quantity AS DECIMAL(18, 2)) AS profit
       FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey)
"""


def lines(spark, sf) -> DataFrame:
    return ex.line_profit(tb.read(spark, sf, "lineitem"), tb.read(spark, sf, "part"))


@query("kpi_unit_profit", "WITH x AS (SELECT 1)" + _PROFIT_SQL + """
SELECT l_orderkey, round(sum(l_quantity), 2) AS units, CAST(round(sum(profit), 2) AS DOUBLE) AS profit,
       CAST(sum(profit) AS DOUBLE) / sum(l_quantity) AS unit_profit FROM lp GROUP BY l_orderkey""")
def q_kpi_unit_profit(spark, sf):
    return ex.kpi_unit_profit(lines(spark, sf), ["l_orderkey"])


@query("kpi_aggregate_profit", "WITH x AS (SELECT 1)" + _PROFIT_SQL + """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(round(sum(profit), 2) AS DOUBLE) AS total_profit,
       round(sum(l_quantity), 2) AS total_units FROM lp GROUP BY 1""")
def q_kpi_aggregate_profit(spark, sf):
    return ex.kpi_aggregate_profit(lines(spark, sf), "l_shipdate")


_GROWTH_SQL = with_views("web_events") + """,
e AS (SELECT user_id, CAST(event_time AS DATE) AS d FROM web_events WHERE user_id IS NOT NULL),
daily AS (SELECT a.d AS date, a.active_users, coalesce(n.new_users, 0) AS new_users
          FROM (SELECT d, count(DISTINCT user_id) AS active_users FROM e GROUP BY d) a
          LEFT JOIN (SELECT fd AS d, count(*) AS new_users FROM (SELECT user_id, min(d) AS fd FROM e GROUP BY user_id) f
                     GROUP BY fd) n ON n.d = a.d)
"""


def daily_growth(spark, sf) -> DataFrame:
    return ex.kpi_daily_growth(tb.web_events(spark, sf), "user_id", "event_time")


@query("kpi_daily_growth", _GROWTH_SQL + "SELECT date, active_users, new_users FROM daily")
def q_kpi_daily_growth(spark, sf):
    return daily_growth(spark, sf)


@query("kpi_aggregate_growth", _GROWTH_SQL + """
SELECT CAST(sum(new_users) AS BIGINT) AS total_new_users, CAST(sum(active_users) AS BIGINT) AS total_active_user_days,
       round(avg(active_users), 6) AS avg_daily_active_users FROM daily""")
def q_kpi_aggregate_growth(spark, sf):
    return ex.kpi_aggregate_growth(daily_growth(spark, sf))


@query("kpi_engagement", with_views("web_events") + """
SELECT CAST(event_time AS DATE) AS date, count(*) AS events, count(DISTINCT user_id) AS active_users,
       round(count(*) / count(DISTINCT user_id), 6) AS events_per_user
FROM web_events WHERE user_id IS NOT NULL GROUP BY 1""")
def q_kpi_engagement(spark, sf):
    return ex.kpi_engagement(tb.web_events(spark, sf), "user_id", "event_time")


@query("dash_filtered_facts", with_views("web_events", "web_devices") + """,
x AS (SELECT coalesce(CAST(CAST(e.event_time AS DATE) AS VARCHAR), 'unknown') AS event_date,
             coalesce(e.url, 'unknown') AS url, coalesce(d.browser_type, 'unknown') AS browser_type, e.value
      FROM web_events e LEFT JOIN web_devices d ON e.device_id = d.device_id)
SELECT coalesce(event_date, '(all)') AS event_date, coalesce(url, '(all)') AS url,
       coalesce(browser_type, '(all)') AS browser_type, count(*) AS hits, round(sum(value), 2) AS total_value
FROM x GROUP BY CUBE (event_date, url, browser_type)""")
def q_dash_filtered_facts(spark, sf):
    e = (tb.web_events(spark, sf).join(tb.web_devices(spark, sf), "device_id", "left")
           .withColumn("event_date", F.to_date("event_time")))
    return ex.dash_filtered_facts(e, ["event_date", "url", "browser_type"], "value")
