"""§2.7 physical layout and batch Spark jobs, bound to `web_events`, `web_devices`, `orders`, `lineitem`
and the match tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.operators import layout as lo
from dimforge.operators.loads import replace_table
from dimforge.plans import query
from dimforge.plans.periods import DAY, YEAR, day, year
from dimforge.session import scratch_path
from dimforge.sources import tables as tb
from dimforge.sources.oracle_views import with_views

RENAMES = {"browser_type": "browser", "os_type": "os", "device_type": "device"}


@query("enrich_left_join", with_views("web_events", "web_devices") + """
SELECT e.device_id, e.event_id, e.event_time, e.user_id, e.url, e.host, e.referrer, e.event_type, e.value,
       d.browser_type AS browser, d.os_type AS os, d.device_type AS device
FROM web_events e LEFT JOIN web_devices d ON e.device_id = d.device_id""")
def q_enrich_left_join(spark, sf):
    return lo.enrich_left_join(tb.web_events(spark, sf), tb.web_devices(spark, sf), RENAMES)


@query("enrich_typed", with_views("web_events", "web_devices") + f"""
SELECT e.user_id, d.device_id, upper(d.browser_type) AS browser_type, d.os_type, d.device_type,
       coalesce(e.referrer, '{lo.MISSING_REFERRER}') AS referrer, e.host, e.url, e.event_time
FROM web_events e JOIN web_devices d ON e.device_id = d.device_id
WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""")
def q_enrich_typed(spark, sf):
    return lo.enrich_typed(tb.web_events(spark, sf), tb.web_devices(spark, sf))


_AGG_SQL = with_views("web_events", "web_devices") + """,
agg AS (SELECT user_id, device_id, count(*) AS event_counts,
               string_agg(DISTINCT host, ',' ORDER BY host) AS hosts
        FROM web_events WHERE user_id IS NOT NULL GROUP BY user_id, device_id)
"""


@query("events_aggregated_cached", _AGG_SQL + "SELECT * FROM agg")
def q_events_aggregated_cached(spark, sf):
    a = lo.events_aggregated(tb.web_events(spark, sf))
    return a.select("user_id", "device_id", "event_counts", F.array_join("host_array", ",").alias("hosts"))


@query("users_and_devices", _AGG_SQL + """
SELECT user_id, max(event_counts) AS max_event_counts, count(*) AS n_devices,
       CAST(sum(event_counts) AS BIGINT) AS total_events FROM agg GROUP BY user_id""")
def q_users_and_devices(spark, sf):
    return lo.users_and_devices(lo.events_aggregated(tb.web_events(spark, sf)))


@query("devices_on_events", _AGG_SQL + """
SELECT a.device_id, d.device_type, a.user_id, a.event_counts FROM agg a JOIN web_devices d ON a.device_id = d.device_id""")
def q_devices_on_events(spark, sf):
    return lo.devices_on_events(lo.events_aggregated(tb.web_events(spark, sf)), tb.web_devices(spark, sf))


def n_parts(spark) -> int:
    """Partitions of a layout: what the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_buckets(spark) -> int:
    """Buckets of a bucketed table: ``dimforge.buckets`` of the session, else 16; set it to the
    table's size divided by what one task should sort."""
    return int(spark.conf.get("dimforge.buckets", "16"))


def _dated(spark, sf) -> DataFrame:
    return tb.web_events(spark, sf).select("event_id", F.to_date("event_time").alias("event_date"), "host", "url",
                                           "user_id")


_DATED_SQL = with_views("web_events") + """
SELECT event_id, CAST(event_time AS DATE) AS event_date, host, url, user_id FROM web_events"""


@query("layout_global_sort", _DATED_SQL)
def q_layout_global_sort(spark, sf):
    return lo.layout_global_sort(_dated(spark, sf), n_parts(spark), ["event_date", "host"], ["event_date", "host", "url"])


@query("layout_local_sort", _DATED_SQL)
def q_layout_local_sort(spark, sf):
    return lo.layout_local_sort(_dated(spark, sf), n_parts(spark), ["event_date", "host"], ["event_date", "host", "url"])


@query("layout_size_report")
def q_layout_size_report(spark, sf):
    d = _dated(spark, sf)
    return lo.layout_size_report(spark, {
        "unsorted": d.repartition(n_parts(spark), "event_date", "host"),
        "sorted": lo.layout_local_sort(d, n_parts(spark), ["event_date", "host"], ["event_date", "host", "url"])})


@query("layout_size_check", with_views("web_events") + """,
t AS (SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT CAST(event_time AS DATE), host FROM web_events)) AS n_groups
      FROM web_events)
SELECT layout, n_rows, n_groups, true AS group_in_one_file, true AS not_larger
FROM t, (VALUES ('unsorted'), ('sorted')) v(layout)""")
def q_layout_size_check(spark, sf):
    d, keys = _dated(spark, sf), ["event_date", "host"]
    return lo.layout_size_check(spark, {
        "unsorted": d.repartition(n_parts(spark), *keys),
        "sorted": lo.layout_local_sort(d, n_parts(spark), keys, [*keys, "url"])}, keys)


@query("rle_runs", with_views("web_events") + """,
x AS (SELECT host, CAST(event_time AS DATE) AS event_date, event_time, url,
             lag(url) OVER w AS prev FROM web_events
      WINDOW w AS (PARTITION BY host, CAST(event_time AS DATE) ORDER BY event_time, event_id)),
y AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> url THEN 1 ELSE 0 END)
                  OVER (PARTITION BY host, event_date ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS run FROM x)
SELECT host, event_date, url, min(event_time) AS run_start, count(*) AS run_length
FROM y GROUP BY host, event_date, run, url""")
def q_rle_runs(spark, sf):
    d = tb.web_events(spark, sf).withColumn("event_date", F.to_date("event_time"))
    return lo.rle_runs(d, ["host", "event_date"], ["event_time", "event_id"], "url",
                       chunk=F.date_trunc("hour", "event_time"))


@query("write_time_partitioned", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS n_rows FROM lineitem GROUP BY 1""")
def q_write_time_partitioned(spark, sf):
    li = tb.read(spark, sf, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    p = lo.write_parquet(li, scratch_path(spark, "lineitem-by-year"), ["ship_year"])
    return spark.read.parquet(p).groupBy("ship_year").agg(F.count(F.lit(1)).alias("n_rows"))


@query("write_ds_partitioned", with_views("web_events") + f"""
SELECT CAST({DAY} AS VARCHAR) AS ds, user_id, device_id, count(*) AS event_counts
FROM web_events WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) = {DAY} GROUP BY user_id, device_id""")
def q_write_ds_partitioned(spark, sf):
    d0 = F.lit(day(spark, sf)).cast("date")
    e = tb.web_events(spark, sf).filter((F.col("event_time") >= d0.cast("timestamp_ntz")) &
                                        (F.col("event_time") < F.date_add(d0, 1).cast("timestamp_ntz")))
    a = (e.filter(F.col("user_id").isNotNull()).groupBy("user_id", "device_id")
          .agg(F.count(F.lit(1)).alias("event_counts")).withColumn("ds", F.lit(day(spark, sf))))
    p = lo.write_parquet(a, scratch_path(spark, "events-agg-ds"), ["ds"])
    back = spark.read.parquet(p).filter(F.col("ds") == day(spark, sf))
    return back.select(F.col("ds").cast("string").alias("ds"), "user_id", "device_id", "event_counts")


@query("write_bucketed", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def q_write_bucketed(spark, sf):
    o = tb.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return spark.table(lo.write_bucketed(spark, o, n_buckets(spark), "o_orderkey", "orders_bucketed"))


_JOIN_SQL = """
SELECT o.o_orderkey, o.o_orderpriority, count(*) AS n_lines, round(sum(l.l_quantity), 2) AS sum_qty
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey, o.o_orderpriority"""


def _order_lines(o: DataFrame, li: DataFrame) -> DataFrame:
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    return (j.groupBy("o_orderkey", "o_orderpriority")
             .agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("sum_qty")))


def bucketed_table(spark, sf, table: str, cols: list[str], key: str) -> DataFrame:
    """A new version of the bucketed copy; a load step writes it, the joins of the run read it."""
    return spark.table(lo.write_bucketed(spark, tb.read(spark, sf, table).select(*cols), n_buckets(spark), key,
                                         f"{table}_b"))


def bucketed_order_lines(spark, sf) -> DataFrame:
    """Both sides bucketed on the order key into the same bucket count: the join and the
    per-order aggregation need no exchange."""
    to = bucketed_table(spark, sf, "orders", ["o_orderkey", "o_orderpriority"], "o_orderkey")
    tl = bucketed_table(spark, sf, "lineitem", ["l_orderkey", "l_quantity"], "l_orderkey")
    # merge hint: at small scale the planner would broadcast a side instead of using the buckets
    return _order_lines(to.hint("merge"), tl)


@query("join_bucketed", _JOIN_SQL)
def q_join_bucketed(spark, sf):
    return bucketed_order_lines(spark, sf)


def pruned_order_lines(spark, sf) -> DataFrame:
    """Both sides partitioned by the order's year and bucketed on its key. The years asked for come
    from a small calendar, so neither side's list of partitions is known before the run: both scans
    are pruned dynamically, and the join itself needs no exchange."""
    o = tb.read(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("o_year"))
    li = (tb.read(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
            .join(o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_year").alias("l_year")), "l_orderkey"))
    to = spark.table(lo.write_bucketed(spark, o, n_buckets(spark), "o_orderkey", "orders_y", ["o_year"]))
    tl = spark.table(lo.write_bucketed(spark, li, n_buckets(spark), "l_orderkey", "lineitem_y", ["l_year"]))
    era = F.when(F.col("o_year") >= year(spark, sf) - 1, F.lit("recent")).otherwise(F.lit("past"))
    calendar = o.select(F.col("o_year").alias("year"), era.alias("era")).distinct()
    recent = lo.checked_broadcast(spark.read.parquet(replace_table(spark, calendar, "calendar")).filter("era = 'recent'"))
    to = to.join(recent, F.col("o_year") == F.col("year")).select("o_orderkey", "o_orderpriority")
    tl = tl.join(recent, F.col("l_year") == F.col("year")).select("l_orderkey", "l_quantity")
    return _order_lines(to.hint("merge"), tl)


@query("join_bucketed_pruned", f"""
SELECT o.o_orderkey, o.o_orderpriority, count(*) AS n_lines, round(sum(l.l_quantity), 2) AS sum_qty
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE year(o_orderdate) >= {YEAR} - 1 GROUP BY o.o_orderkey, o.o_orderpriority""")
def q_join_bucketed_pruned(spark, sf):
    return pruned_order_lines(spark, sf)


@query("join_shuffle", _JOIN_SQL)
def q_join_shuffle(spark, sf):
    o = tb.read(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    li = tb.read(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    return _order_lines(o.hint("shuffle_merge"), li)


@query("join_broadcast", """
SELECT n.n_name, round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name""")
def q_join_broadcast(spark, sf):
    li = tb.read(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice", "l_discount")
    s = tb.read(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = lo.checked_broadcast(tb.read(spark, sf, "nation").select("n_nationkey", "n_name"))
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
                                   .alias("revenue"))


def top1(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """Top row by ``metric`` (ties: smallest ``tie``) -- a distributed take-ordered, not a global sort."""
    return df.orderBy(F.col(metric).desc(), F.col(tie).asc()).limit(1)


@query("match_avg_kills", with_views("match_details") + """
SELECT player_gamertag, round(avg(player_total_kills), 6) AS avg_kills FROM match_details
GROUP BY player_gamertag ORDER BY avg_kills DESC, player_gamertag LIMIT 1""")
def q_match_avg_kills(spark, sf):
    a = (tb.match_details(spark, sf).groupBy("player_gamertag")
           .agg(F.round(F.avg("player_total_kills"), 6).alias("avg_kills")))
    return top1(a, "avg_kills", "player_gamertag")


@query("match_top_playlist", with_views("matches") + """
SELECT playlist_id, count(DISTINCT match_id) AS n_matches FROM matches
GROUP BY playlist_id ORDER BY n_matches DESC, playlist_id LIMIT 1""")
def q_match_top_playlist(spark, sf):
    a = tb.matches(spark, sf).groupBy("playlist_id").agg(F.countDistinct("match_id").alias("n_matches"))
    return top1(a, "n_matches", "playlist_id")


@query("match_top_map", with_views("matches", "maps") + """
SELECT m.mapid, p.name, count(DISTINCT m.match_id) AS n_matches FROM matches m JOIN maps p ON m.mapid = p.mapid
GROUP BY m.mapid, p.name ORDER BY n_matches DESC, p.name LIMIT 1""")
def q_match_top_map(spark, sf):
    a = tb.matches(spark, sf).groupBy("mapid").agg(F.countDistinct("match_id").alias("n_matches"))
    j = a.join(lo.checked_broadcast(tb.maps(spark, sf)), "mapid")
    return top1(j.select("mapid", "name", "n_matches"), "n_matches", "name")


@query("match_top_medal_map", with_views("matches", "maps", "medals", "medal_rows") + f"""
SELECT m.mapid, p.name, CAST(sum(r."count") AS BIGINT) AS killing_sprees
FROM medal_rows r JOIN medals d ON r.medal_id = d.medal_id JOIN matches m ON r.match_id = m.match_id
JOIN maps p ON m.mapid = p.mapid
WHERE d.name = '{tb.MEDAL_NAME}'
GROUP BY m.mapid, p.name ORDER BY killing_sprees DESC, p.name LIMIT 1""")
def q_match_top_medal_map(spark, sf):
    md = tb.medals(spark, sf).filter(F.col("name") == tb.MEDAL_NAME).select("medal_id")
    r = tb.medal_rows(spark, sf).join(md, "medal_id")
    per_match = r.groupBy("match_id").agg(F.sum("count").alias("_k"))
    j = per_match.join(tb.matches(spark, sf).select("match_id", "mapid"), "match_id")
    a = j.groupBy("mapid").agg(F.sum("_k").alias("killing_sprees"))
    return top1(a.join(lo.checked_broadcast(tb.maps(spark, sf)), "mapid").select("mapid", "name", "killing_sprees"),
                "killing_sprees", "name")


@query("cached_reuse", _AGG_SQL + """
SELECT 'users' AS report, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total_events
FROM (SELECT user_id, sum(event_counts) AS n FROM agg GROUP BY user_id) u
UNION ALL
SELECT 'devices', count(*), CAST(sum(a.event_counts) AS BIGINT) FROM agg a JOIN web_devices d ON a.device_id = d.device_id""")
def q_cached_reuse(spark, sf):
    """One persisted aggregate feeds two written reports; what was written is counted."""
    users, devices = scratch_path(spark, "users-report"), scratch_path(spark, "devices-report")
    lo.cached_reuse(tb.web_events(spark, sf), tb.web_devices(spark, sf),
                    lambda df: df.write.parquet(users), lambda df: df.write.parquet(devices))
    out = [spark.read.parquet(p).agg(F.lit(n).alias("report"), F.count(F.lit(1)).alias("n_rows"),
                                     F.sum(c).alias("total_events"))
           for n, p, c in (("users", users, "total_events"), ("devices", devices, "event_counts"))]
    return out[0].unionByName(out[1])


@query("match_bucket_join", with_views("matches", "match_details", "medals", "medal_rows", "maps") + """,
won AS (SELECT match_id, player_gamertag, CAST(sum("count") AS BIGINT) AS n FROM medal_rows
        WHERE medal_id IN (SELECT medal_id FROM medals) GROUP BY ALL)
SELECT m.playlist_id, p.name AS map_name, count(*) AS n_players, CAST(sum(d.player_total_kills) AS BIGINT) AS kills,
       CAST(coalesce(sum(w.n), 0) AS BIGINT) AS n_medals
FROM match_details d JOIN matches m ON m.match_id = d.match_id JOIN maps p ON p.mapid = m.mapid
LEFT JOIN won w ON w.match_id = d.match_id AND w.player_gamertag = d.player_gamertag
GROUP BY m.playlist_id, p.name""")
def q_match_bucket_join(spark, sf):
    """Three match tables bucketed on the match joined without an exchange, small dimensions broadcast."""
    def bucketed(name: str, df: DataFrame) -> DataFrame:
        return spark.table(lo.write_bucketed(spark, df, n_buckets(spark), "match_id", f"{name}_b"))

    return match_join(bucketed("matches", tb.matches(spark, sf)), bucketed("details", tb.match_details(spark, sf)),
                      bucketed("medal_rows", tb.medal_rows(spark, sf)), tb.medals(spark, sf), tb.maps(spark, sf))


def match_join(matches: DataFrame, details: DataFrame, medal_rows: DataFrame, medals: DataFrame,
               maps: DataFrame) -> DataFrame:
    known = lo.checked_broadcast(medals.select("medal_id").distinct())
    won = (medal_rows.join(known, "medal_id", "left_semi")
           .groupBy("match_id", "player_gamertag").agg(F.sum("count").alias("n")))
    j = (details.join(matches.hint("merge"), "match_id").join(won.hint("merge"), ["match_id", "player_gamertag"], "left")
         .join(lo.checked_broadcast(maps), "mapid"))
    return j.groupBy("playlist_id", F.col("name").alias("map_name")).agg(
        F.count(F.lit(1)).alias("n_players"), F.sum("player_total_kills").alias("kills"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_medals"))


@query("layout_sort_check", with_views("web_events") + """
SELECT l.layout, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order
FROM web_events, (VALUES ('by_time'), ('by_host'), ('global')) l(layout) GROUP BY l.layout""")
def q_layout_sort_check(spark, sf):
    """Three sort orders written and read back: rows, and rows that stand before their predecessor in a file."""
    d, n = _dated(spark, sf), n_parts(spark)
    orders = {"by_time": ["event_date", "host", "url"], "by_host": ["host", "url", "event_date"],
              "global": ["event_date", "host", "url"]}
    out = None
    for name, order in orders.items():
        laid = (lo.layout_global_sort if name == "global" else lo.layout_local_sort)(d, n, ["event_date", "host"], order)
        r = lo.out_of_order(spark.read.parquet(lo.write_parquet(laid, scratch_path(spark, f"sorted-{name}"))), order)
        r = r.select(F.lit(name).alias("layout"), "n_rows", "n_out_of_order")
        out = r if out is None else out.unionByName(r)
    return out
