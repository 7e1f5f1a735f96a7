"""§2.9 streaming. The stateful jobs run as streams: `web_events` arrives in slices of event time
and each slice is an ``availableNow`` run on one checkpoint, with state store and watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.plans import query
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views
from dimforge.streaming import jobs as st

WIDE_GAP = "2 hours"

_IP_SQL = ("CASE WHEN user_id IS NOT NULL THEN CAST(10 + user_id // 16777216 AS VARCHAR) || '.' || CAST((user_id // 65536) % 256 AS VARCHAR) || '.' || "
           "CAST((user_id // 256) % 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) END")
_EV_SQL = with_views("web_events", "ip_ranges") + f""",
ev AS (SELECT *, {_IP_SQL} AS ip FROM web_events),
located AS (SELECT u.user_id, arg_min({{'country': country, 'state': state, 'city': city}}, (ip_hi - ip_lo, ip_lo, range_no)) AS r
            FROM (SELECT DISTINCT user_id FROM web_events) u JOIN ip_ranges ON u.user_id BETWEEN ip_lo AND ip_hi GROUP BY u.user_id),
geo AS (SELECT ev.*, CASE WHEN l.r IS NOT NULL
                          THEN json_object('country', l.r.country, 'state', l.r.state, 'city', l.r.city)::VARCHAR
                          ELSE '{{}}' END AS geodata
        FROM ev LEFT JOIN located l ON l.user_id = ev.user_id)
"""


def raw(spark, sf) -> DataFrame:
    return st.to_raw_json(tb.web_events(spark, sf))


def with_ip(spark, sf) -> DataFrame:
    return tb.web_events(spark, sf).withColumn("ip", st.ip_of(F.col("user_id")))


@query("stream_parse", _EV_SQL + """
SELECT url, referrer, host, ip, date_trunc('millisecond', event_time) AS event_time FROM ev""")
def q_stream_parse(spark, sf):
    p = st.stream_parse(raw(spark, sf))
    return p.select("url", "referrer", "host", "ip", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


@query("stream_process", _EV_SQL + """
SELECT ip, date_trunc('millisecond', event_time) AS event_time, referrer, host, url, geodata FROM geo""")
def q_stream_process(spark, sf):
    p = st.stream_process(raw(spark, sf), tb.ip_ranges(spark, sf))
    return p.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("stream_geo_enrich", _EV_SQL + "SELECT event_id, ip, geodata FROM geo")
def q_stream_geo_enrich(spark, sf):
    e = with_ip(spark, sf).select("event_id", "ip")
    return st.stream_geo_enrich(e, tb.ip_ranges(spark, sf))


def replayed(spark, name: str, rows: DataFrame, build, **how) -> DataFrame:
    """Rows that the stream ``build`` over ``rows`` has appended to its sink."""
    run = st.replay(spark, name, rows, build, **how)
    return run.result(build(rows).schema)


def tumbled(spark, sf, keys) -> DataFrame:
    rows = tb.web_events(spark, sf).select("event_time", *keys).withColumn("event_time", F.col("event_time").cast("timestamp"))
    return replayed(spark, "tumble", rows, lambda s: st.stream_tumble(s, keys), closing={})


@query("stream_tumble_host", with_views("web_events") + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host, count(host) AS num_hits
FROM web_events GROUP BY 1, 2""")
def q_stream_tumble_host(spark, sf):
    return tumbled(spark, sf, ["host"])


@query("stream_tumble_host_referrer", with_views("web_events") + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host, referrer, count(host) AS num_hits
FROM web_events GROUP BY 1, 2, 3""")
def q_stream_tumble_host_referrer(spark, sf):
    return tumbled(spark, sf, ["host", "referrer"])


def _session_sql(gap: str) -> str:
    return _EV_SQL + f""",
s AS (SELECT ip, host, event_time,
             CASE WHEN lag(event_time) OVER w IS NULL OR event_time - lag(event_time) OVER w > INTERVAL {gap}
                  THEN 1 ELSE 0 END AS new
      FROM ev WINDOW w AS (PARTITION BY ip, host ORDER BY event_time)),
g AS (SELECT *, sum(new) OVER (PARTITION BY ip, host ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS sid FROM s),
sessions AS (SELECT ip, host, min(event_time) AS session_start, max(event_time) + INTERVAL {gap} AS session_end,
                    count(*) AS num_events FROM g GROUP BY ip, host, sid)
"""


def sessions(spark, sf, gap=st.SESSION_GAP) -> DataFrame:
    return st.stream_session(with_ip(spark, sf), ["ip", "host"], gap=gap)


@query("stream_session", _session_sql("5 MINUTE") + "SELECT * FROM sessions")
def q_stream_session(spark, sf):
    rows = with_ip(spark, sf).select("event_time", "ip", "host").withColumn("event_time", F.col("event_time").cast("timestamp"))
    return replayed(spark, "session", rows, lambda s: st.stream_session(s, ["ip", "host"]), closing={})


@query("session_avg_events", _session_sql("5 MINUTE") + """
SELECT host, count(*) AS n_sessions, round(avg(num_events), 6) AS avg_events FROM sessions GROUP BY host""")
def q_session_avg_events(spark, sf):
    return st.session_avg_events(sessions(spark, sf), ["host"])


@query("session_avg_events_wide_gap", _session_sql("2 HOUR") + """
SELECT host, count(*) AS n_sessions, round(avg(num_events), 6) AS avg_events FROM sessions GROUP BY host""")
def q_session_avg_events_wide(spark, sf):
    return st.session_avg_events(sessions(spark, sf, WIDE_GAP), ["host"])


@query("stream_sink_batch", with_views("web_events") + """
SELECT event_id, url, host, event_time FROM web_events""")
def q_stream_sink_batch(spark, sf):
    s = tb.web_events_of(st.events_stream(spark, sf)).select("event_id", "url", "host", "event_time")
    out = st.run_available_now(s, spark, "processed-events")
    return spark.read.parquet(out).select("event_id", "url", "host", "event_time")


@query("stream_sink_upsert", with_views("web_events") + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS event_hour, host, count(host) AS num_hits,
       CAST(time_bucket(INTERVAL 5 MINUTE, event_time) AS DATE) AS day
FROM web_events WHERE host IS NOT NULL GROUP BY 1, 2""")
def q_stream_sink_upsert(spark, sf):
    """Windows as they grow (update mode), merged into a published table by (window, host)."""
    rows = (tb.web_events(spark, sf).filter("host IS NOT NULL").select("event_time", "host")
              .withColumn("event_time", F.col("event_time").cast("timestamp")))
    run = st.StreamRun(spark, "aggregated")
    sink = st.KeyedSink(spark, run.sink, ["event_hour", "host"], "day")
    st.replay(spark, run.name, rows, lambda s: st.stream_tumble(s, ["host"]).withColumn("day", F.to_date("event_hour")),
              mode="update", write=sink, run=run)
    return sink.table.read()


@query("stream_dedup", with_views("web_events_raw") + """
SELECT DISTINCT event_id, user_id, url, event_time FROM web_events_raw""")
def q_stream_dedup(spark, sf):
    """Re-deliveries come 30 minutes after the fact; a key is remembered for an hour of arrival time."""
    e = (tb.web_events_raw(spark, sf).select("event_id", "user_id", "url", "event_time", "ingested_at")
           .withColumn("ingested_at", F.col("ingested_at").cast("timestamp")))
    d = replayed(spark, "dedup", e, lambda s: st.stream_dedup(s, ["event_id"], ts="ingested_at"), ts="ingested_at")
    return d.drop("ingested_at")
