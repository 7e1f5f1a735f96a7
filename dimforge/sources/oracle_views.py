"""DuckDB SQL of the binding views in ``dimforge.sources.tables``.

Used only to build the oracle SQL strings: each oracle query starts with
``WITH <views>`` so it runs on the driver's base tables alone.
"""

from __future__ import annotations

from dimforge.sources.tables import MEDAL_NAME, REFERRERS

_REF_CASE = "CASE k % 7 " + " ".join(
    f"WHEN {i} THEN '{r}'" for i, r in enumerate(REFERRERS)) + " ELSE NULL END"

VIEWS: dict[str, str] = {
    "web_events": f"""
        SELECT event_id, ts AS event_time, NULLIF(user_id, 0) AS user_id,
               '/' || event_type AS url, CAST(k AS BIGINT) AS device_id,
               'host' || CAST(k % 4 AS VARCHAR) AS host, {_REF_CASE} AS referrer,
               event_type, value
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e""",
    "web_events_raw": """
        SELECT *, event_time AS ingested_at FROM web_events
        UNION ALL
        SELECT *, event_time + INTERVAL 30 MINUTE AS ingested_at FROM web_events
        WHERE event_type IN ('click', 'view')""",
    "web_devices": """
        SELECT p_partkey AS device_id, p_brand AS browser_type,
               NULLIF(p_type, 'ECONOMY') AS device_type, 'os' || CAST(p_size % 4 AS VARCHAR) AS os_type
        FROM part""",
    "seasons": """
        SELECT a.*, c.c_name AS player_name, c.c_nationkey AS country, c.c_mktsegment AS college
        FROM (SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS INTEGER) AS season,
                     COUNT(*) AS gp, ROUND(SUM(o_totalprice), 2) AS pts
              FROM orders GROUP BY 1, 2) a
        LEFT JOIN customer c ON a.player_id = c.c_custkey""",
    "films": """
        SELECT o_custkey AS actorid, 'actor' || CAST(o_custkey AS VARCHAR) AS actor,
               CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS filmid,
               'film' || CAST(o_orderkey AS VARCHAR) AS film, o_orderkey % 1000 AS votes,
               ROUND(o_totalprice / 50000.0, 3) AS rating
        FROM orders""",
    "games": """
        SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date_est,
               CAST(year(o_orderdate) AS INTEGER) AS season, c_nationkey AS home_team_id,
               CAST((c_nationkey + 1 + o_orderkey % 24) % 25 AS INTEGER) AS visitor_team_id,
               CAST(o_orderkey % 41 + 80 AS INTEGER) AS pts_home,
               CAST(o_custkey % 37 + 80 AS INTEGER) AS pts_away,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "game_details": """
        SELECT l_orderkey AS game_id, s_nationkey AS team_id, l_suppkey AS player_id,
               s_name AS player_name, l_linenumber AS start_position,
               CASE WHEN l_returnflag = 'R' THEN 'DNP - COACH DECISION'
                    WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'DND - INJURY'
                    WHEN l_returnflag = 'A' THEN 'NWT - NOT WITH TEAM' END AS comment,
               CASE WHEN l_linenumber = 1 THEN NULL
                    WHEN l_linenumber = 2 THEN ''
                    WHEN l_linenumber = 3 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
                    WHEN l_linenumber = 7 THEN 'x:' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
                    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ':'
                         || lpad(CAST((l_linenumber * 7) % 60 AS VARCHAR), 2, '0') END AS "min",
               CAST(l_quantity AS INTEGER) AS pts, l_partkey AS ast, l_shipdate AS loaded_at
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "teams": """
        SELECT n_nationkey AS team_id, upper(substr(n_name, 1, 3)) AS abbreviation, n_name AS nickname,
               'City of ' || n_name AS city, n_name || ' Arena' AS arena, n_nationkey + 1900 AS yearfounded,
               0 AS load_seq FROM nation
        UNION ALL
        SELECT n_nationkey, upper(substr(n_name, 1, 3)), 'Bad ' || n_name, 'City of ' || n_name,
               n_name || ' Arena', n_nationkey + 1900, 1 FROM nation""",
    "matches": """
        SELECT o_orderkey AS match_id, o_orderpriority AS playlist_id, c_nationkey AS mapid,
               o_orderstatus <> 'P' AS is_team_game, o_orderdate AS completion_date
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "match_details": """
        SELECT l_orderkey AS match_id, 'player' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
               CAST(SUM(l_quantity) AS BIGINT) AS player_total_kills, COUNT(*) AS player_total_deaths
        FROM lineitem GROUP BY 1, 2""",
    "medals": f"""
        SELECT p_partkey AS medal_id, CASE WHEN p_type = 'PROMO' THEN '{MEDAL_NAME}' ELSE p_type END AS name
        FROM part""",
    "medal_rows": """
        SELECT l_orderkey AS match_id, 'player' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
               l_partkey AS medal_id, CAST(l_linenumber AS BIGINT) AS "count" FROM lineitem""",
    "maps": "SELECT n_nationkey AS mapid, n_name AS name FROM nation",
    "ip_ranges": """
        SELECT CAST(n_nationkey AS BIGINT) AS range_no, n_nationkey * span AS ip_lo,
               n_nationkey * span + span - 1 - CASE WHEN n_nationkey % 3 = 2 THEN span // 4 ELSE 0 END AS ip_hi,
               n_name AS country, r_name AS state, 'all of ' || n_name AS city
        FROM nation JOIN region ON n_regionkey = r_regionkey, ip_space
        UNION ALL
        SELECT p_partkey + 100, p_partkey * 7919 % (top * 4 // 5 + 1),
               p_partkey * 7919 % (top * 4 // 5 + 1) + p_size * top // 2000, n_name, r_name, 'city' || p_partkey
        FROM part JOIN nation ON n_nationkey = p_partkey % 25 JOIN region ON n_regionkey = r_regionkey, ip_space""",
    "ip_space": """
        SELECT top, greatest(1, top // 25) AS span
        FROM (SELECT CAST(greatest(0, coalesce(max(user_id), 0)) + 1 AS BIGINT) AS top FROM events) s""",
}

# views that read other views
_DEPS = {"web_events_raw": ["web_events"], "ip_ranges": ["ip_space"]}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named binding views (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order) + "\n"
