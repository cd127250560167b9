"""DuckDB oracle SQL for every registered query.

Only the supplied tables are registered in the oracle, so the derived
inputs (``log``, ``csv``, ``jsonin``, ``log_geo``, ``cells``, ``places``,
``dict``) are inlined as CTEs.  Column aliases match the Spark queries.
"""

from __future__ import annotations

_LOG = """SELECT event_id AS seq, ts,
       concat('u', CAST(user_id AS VARCHAR(20))) AS uid,
       concat('act', CAST(user_id % 5 AS VARCHAR(20))) AS event_name,
       substr(CAST(ts AS VARCHAR(40)), 1, 19) AS time,
       substr(CAST(ts AS VARCHAR(40)), 1, 10) AS dt,
       event_type,
       CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'purchase' THEN '3'
                       WHEN 'signup' THEN '4' ELSE '5' END AS type_id,
       CASE event_type WHEN 'click' THEN 'flow_click' WHEN 'view' THEN 'flow_view'
                       WHEN 'purchase' THEN 'acitiv_purchase' WHEN 'signup' THEN 'activity_signup'
                       ELSE 'error' END AS route_type,
       concat('p', CAST(user_id % 7 AS VARCHAR(20))) AS province,
       73e0 + CAST((user_id * 37) % 620 AS DOUBLE) / 10e0 AS lon,
       18e0 + CAST((user_id * 53 + event_id % 3) % 350 AS DOUBLE) / 10e0 AS lat
FROM events"""

_CSV = """SELECT seq, CASE WHEN seq % 11 = 0 THEN concat(uid, ',', event_name, ',', time, ',', type_id, ',')
            WHEN seq % 13 = 0 THEN concat(uid, ',', event_name, ',', time)
            WHEN seq % 17 = 0 THEN concat(uid, ',', event_name, ',', time, ',', type_id, ',', province, ',x')
            ELSE concat(uid, ',', event_name, ',', time, ',', type_id, ',', province) END AS line
FROM log"""


def _digit(terms: list[tuple[str, int]]) -> str:
    weights = (16, 8, 4, 2, 1)
    parts = " + ".join(f"(({v} >> {b}) & 1) * {w}" for (v, b), w in zip(terms, weights))
    return f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(1 + {parts} AS INT), 1)"


def _geohash_sql() -> str:
    # Interleave 13 longitude bits (x) with 12 latitude bits (y), x first.
    stream, xi, yi = [], 12, 11
    for pos in range(25):
        if pos % 2 == 0:
            stream.append(("x", xi))
            xi -= 1
        else:
            stream.append(("y", yi))
            yi -= 1
    digits = [_digit(stream[5 * c:5 * c + 5]) for c in range(5)]
    return "concat(" + ",\n              ".join(digits) + ")"


def _geo_select(cols: str, src: str) -> str:
    """``cols`` of ``src`` plus the geohash5 of its ``lon``/``lat`` columns."""
    return f"""SELECT {cols},
       {_geohash_sql()} AS geohash5
FROM (SELECT *, least(8191, greatest(0, CAST(floor((lon + 180e0) * 8192e0 / 360e0) AS BIGINT))) AS x,
                least(4095, greatest(0, CAST(floor((lat + 90e0) * 4096e0 / 180e0) AS BIGINT))) AS y FROM {src}) t"""


_LOG_GEO = _geo_select("seq, uid, event_name, time, dt, event_type, type_id, route_type, province, lon, lat", "log")

_CELLS = "SELECT geohash5, MIN(seq) AS first_seq FROM log_geo GROUP BY geohash5"

_PLACES = """SELECT c.geohash5, r_name AS province, n_name AS city,
       concat('d', CAST(first_seq % 7 AS VARCHAR(20))) AS district
FROM cells c JOIN nation ON n_nationkey = first_seq % 25 JOIN region ON r_regionkey = n_regionkey
WHERE first_seq % 2 = 0"""

_ALL_PLACES = """SELECT c.geohash5, r_name AS province,
       CASE WHEN first_seq % 5 NOT IN (1, 2) THEN n_name END AS city,
       CASE WHEN first_seq % 7 <> 3 THEN concat('d', CAST(first_seq % 7 AS VARCHAR(20))) END AS district
FROM cells c JOIN nation ON n_nationkey = first_seq % 25 JOIN region ON r_regionkey = n_regionkey"""

_DICT = """SELECT DISTINCT type_id AS event_id, concat(event_type, '_v', substr(dt, 9, 2)) AS event_name,
       dt AS last_update
FROM log"""

_JSONIN = """SELECT seq, CASE WHEN seq % 11 = 0 THEN concat('{"uid":"', uid)
            WHEN seq % 13 = 0 THEN concat('{"uid":"', uid, '","jd":"abc"}')
            WHEN seq % 17 = 0 THEN concat('{"uid":"', uid, '","time":"', time, '","eventType":"', route_type,
                                          '","wd":', CAST(lat AS VARCHAR(20)), '}')
            ELSE concat('{"uid":"', uid, '","time":"', time, '","eventType":"', route_type, '","jd":"',
                        CAST(lon AS VARCHAR(20)), '","wd":', CAST(lat AS VARCHAR(20)), '}') END AS line
FROM log"""

_VIEWS = {
    "log": ((), _LOG),
    "csv": (("log",), _CSV),
    "jsonin": (("log",), _JSONIN),
    "log_geo": (("log",), _LOG_GEO),
    "cells": (("log_geo",), _CELLS),
    "places": (("cells",), _PLACES),
    "all_places": (("cells",), _ALL_PLACES),
    "dict": (("log",), _DICT),
}


_NAME_VERSIONS = """SELECT event_id, event_name AS type_name,
       CAST(last_update AS TIMESTAMP) + to_hours(CAST(event_id AS INTEGER)) AS valid_from
FROM dict WHERE (CAST(substr(last_update, 9, 2) AS INTEGER) + CAST(event_id AS INTEGER)) % 3 = 1"""

_ARRIVALS = """SELECT *, epoch_us(ts) AS t, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT)
       + CASE WHEN seq % 7 = 0 THEN 1 + seq % 3 ELSE 0 END AS batch
FROM log"""

_VIEWS |= {"name_versions": (("dict",), _NAME_VERSIONS), "arrivals": (("log",), _ARRIVALS)}


def _windowed(key: str, width: int, slide: int, delay: int) -> str:
    """Counts of all windows by a range join with the grid of their starts; late by the earlier batches' greatest time."""
    return f""", marks AS (SELECT batch, max(max(t)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay} AS mark
              FROM arrivals GROUP BY batch),
grid AS (SELECT unnest(generate_series((SELECT min(t) // {slide} * {slide} - {width} FROM arrivals),
                                       (SELECT max(t) FROM arrivals), {slide})) AS start),
held AS (SELECT {key}, start, coalesce(start + {width} <= mark, FALSE) AS late
         FROM arrivals JOIN marks USING (batch) JOIN grid ON start <= t AND t < start + {width})
SELECT {key}, start AS window_start, COUNT(*) FILTER (NOT late) AS n, COUNT(*) FILTER (late) AS n_late
FROM held GROUP BY {key}, start"""


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _VIEWS[n][0]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{_VIEWS[n][1]}\n)" for n in order) + "\n"


_HOUR = 3_600_000_000

ORACLE: dict[str, str] = {
    "decode_log_batches": _with("log") + """SELECT uid, type_id AS event_id, event_name, province,
       '' AS city, '' AS district, lon AS longitude, lat AS latitude FROM log""",
    "parse_csv_events": _with("log") + """SELECT seq, uid, event_name, time, type_id, province, 1 AS cnt
FROM log WHERE seq % 11 <> 0 AND seq % 13 <> 0""",
    "parse_json_events": _with("log") + """SELECT seq, uid, time, route_type AS event_type,
       CASE WHEN seq % 17 = 0 THEN 0e0 ELSE lon END AS jd, lat AS wd
FROM log WHERE seq % 11 <> 0 AND seq % 13 <> 0""",
    "parse_csv_line_ends": _with("csv") + """, ended AS (
  SELECT seq, string_split(regexp_replace(concat(line, CASE WHEN seq % 5 = 0 THEN chr(10) WHEN seq % 7 = 0 THEN chr(13)
                                                            ELSE '' END), ',+$', ''), ',') AS f FROM csv)
SELECT seq, f[1] AS uid, f[2] AS event_name, f[3] AS time, f[4] AS type_id, f[5] AS province, 1 AS cnt
FROM ended WHERE len(f) >= 5""",
    "parse_json_trailing": _with("log") + """SELECT seq, uid, time, route_type AS event_type,
       CASE WHEN seq % 17 = 0 OR seq % 37 = 0 THEN 0e0 ELSE lon END AS jd, lat AS wd
FROM log WHERE seq % 11 <> 0 AND seq % 13 <> 0
  AND (seq % 5 = 0 OR (seq % 7 <> 0 AND seq % 19 <> 0 AND seq % 23 <> 0 AND seq % 29 <> 0 AND seq % 31 <> 0))""",
    "encode_json_events": _with("log") + """SELECT seq, concat('{"eventType":"', route_type, '","jd":',
       CAST(lon AS VARCHAR), ',"time":"', time, '","uid":"', uid, '","wd":', CAST(lat AS VARCHAR), '}') AS json
FROM log""",
    "geohash5": _with("log_geo") + "SELECT seq, geohash5 FROM log_geo",
    "place_enrich": _with("log_geo", "places") + """SELECT seq, l.geohash5, province_p AS province, city, district
FROM log_geo l LEFT JOIN (SELECT geohash5, province AS province_p, city, district FROM places) p
  ON l.geohash5 = p.geohash5""",
    "place_cache_fill": _with("log_geo", "places") + """, miss AS (
  SELECT l.geohash5, arg_min(lon, seq) AS lon, arg_min(lat, seq) AS lat FROM log_geo l
  WHERE l.geohash5 NOT IN (SELECT geohash5 FROM places) GROUP BY l.geohash5)
SELECT geohash5, province, city, district FROM places
UNION ALL
SELECT geohash5, r_name AS province, n_name AS city, 'd_new' AS district
FROM miss JOIN nation ON n_nationkey = CAST(floor(lon + lat) AS BIGINT) % 25
JOIN region ON r_regionkey = n_regionkey""",
    "place_parse_response": _with("all_places") + "SELECT geohash5, province, city, district FROM all_places",
    "place_dict_codec": _with("all_places") + "SELECT geohash5, province, city, district FROM all_places",
    "event_name_lookup": _with("dict") + """SELECT seq, type_id, event_type_name
FROM log LEFT JOIN (SELECT event_id, arg_max(event_name, last_update) AS event_type_name
                    FROM dict GROUP BY event_id) d ON type_id = event_id""",
    "dict_latest": _with("dict") + """SELECT event_id, arg_max(event_name, last_update) AS event_name
FROM dict GROUP BY event_id""",
    "dict_poll_order": _with("dict") + """SELECT event_id, arg_min(event_name, last_update) AS event_name
FROM dict GROUP BY event_id""",
    "dict_incremental_poll": _with("dict") + """SELECT event_id, event_name, last_update
FROM dict WHERE last_update > '2024-01-10'""",
    "dict_after_polls": _with("dict") + """SELECT event_id, arg_max(event_name, last_update) AS event_name,
       MAX(last_update) AS last_update
FROM dict WHERE last_update > '2024-01-10' GROUP BY event_id""",
    "running_count_unknown_type": _with("dict") + """, names AS (
  SELECT event_id, arg_max(event_name, last_update) AS type_name FROM dict WHERE event_id <> '2' GROUP BY event_id),
named AS (SELECT seq, l.event_name, type_name AS event_type, uid, dt FROM log l LEFT JOIN names ON type_id = event_id)
SELECT seq, event_name, event_type, uid,
       FIRST_VALUE(dt) OVER (PARTITION BY event_name, event_type, uid ORDER BY seq) AS first_dt,
       ROW_NUMBER() OVER (PARTITION BY event_name, event_type, uid ORDER BY seq) AS cnt FROM named""",
    "running_user_count": _with("log") + """SELECT seq, event_name, event_type, uid,
       FIRST_VALUE(dt) OVER (PARTITION BY event_name, event_type, uid ORDER BY seq) AS first_dt,
       ROW_NUMBER() OVER (PARTITION BY event_name, event_type, uid ORDER BY seq) AS cnt FROM log""",
    "activity_pv": _with("log") + """SELECT event_name, event_type, uid, COUNT(*) AS pv
FROM log GROUP BY event_name, event_type, uid""",
    "activity_uv": _with("log") + """SELECT event_name, dt, event_type, COUNT(DISTINCT uid) AS uv
FROM log GROUP BY event_name, dt, event_type""",
    "activity_scoreboard": _with("log") + """, r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_name, event_type, uid ORDER BY seq) AS cnt,
         FIRST_VALUE(dt) OVER (PARTITION BY event_name, event_type, uid ORDER BY seq) AS dt0 FROM log),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_name, dt0, event_type ORDER BY seq DESC) AS rn FROM r)
SELECT concat(event_name, '|', dt0) AS board_key, event_type, CAST(cnt AS VARCHAR(20)) AS value
FROM k WHERE rn = 1""",
    "route_events": _with("log") + """SELECT seq, route_type, 'main' AS route FROM log
UNION ALL
SELECT seq, route_type, CASE WHEN starts_with(route_type, 'flow') THEN 'flow' ELSE 'acitiv' END AS route
FROM log WHERE starts_with(route_type, 'flow') OR starts_with(route_type, 'acitiv')""",
    "route_counts": _with("log") + """SELECT CASE WHEN starts_with(route_type, 'flow') THEN 'flow' ELSE 'acitiv' END AS route,
       COUNT(*) AS n FROM log
WHERE starts_with(route_type, 'flow') OR starts_with(route_type, 'acitiv') GROUP BY 1
UNION ALL SELECT 'main' AS route, COUNT(*) AS n FROM log""",
    "scoreboard_from_changes": _with("log") + """, w AS (
  SELECT concat(event_name, '|', dt) AS board_key, event_type, uid AS value,
         ROW_NUMBER() OVER (PARTITION BY event_name, dt, event_type ORDER BY seq * 7 % 3 DESC, seq DESC) AS rn FROM log)
SELECT board_key, event_type, value FROM w WHERE rn = 1""",
    "archive_compacted": """SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d--%H') AS bucket, COUNT(*) AS n,
       MIN(event_id) AS first_seq, MAX(event_id) AS last_seq
FROM events GROUP BY 1""",
    "archive_hourly": """SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d--%H') AS bucket, COUNT(*) AS n,
       MIN(event_id) AS first_seq, MAX(event_id) AS last_seq
FROM events GROUP BY 1""",
    "kv_latest": _with("log") + """SELECT concat(event_name, '|', dt) AS board_key, event_type, arg_max(uid, seq) AS value
FROM log GROUP BY 1, event_type""",
    "activity_count_job": _with("csv", "dict") + """, fields AS (
  SELECT seq, string_split(regexp_replace(line, ',+$', ''), ',') AS f FROM csv),
parsed AS (
  SELECT seq, f[1] AS uid, f[2] AS event_name, f[3] AS time, f[4] AS type_id FROM fields WHERE len(f) >= 5),
names AS (SELECT event_id, arg_max(event_name, last_update) AS type_name FROM dict GROUP BY event_id),
named AS (SELECT p.seq, p.uid, p.event_name, n.type_name AS event_type, substr(p.time, 1, 10) AS dt
          FROM parsed p LEFT JOIN names n ON p.type_id = n.event_id),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_name, event_type, uid ORDER BY seq) AS cnt,
             FIRST_VALUE(dt) OVER (PARTITION BY event_name, event_type, uid ORDER BY seq) AS dt0 FROM named),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_name, dt0, event_type ORDER BY seq DESC) AS rn FROM r)
SELECT concat(event_name, '|', dt0) AS board_key, event_type, CAST(cnt AS VARCHAR(20)) AS value
FROM k WHERE rn = 1""",
    "enrich_job": _with("log_geo", "places", "dict") + """, miss AS (
  SELECT l.geohash5, arg_min(lon, seq) AS lon, arg_min(lat, seq) AS lat FROM log_geo l
  WHERE l.geohash5 NOT IN (SELECT geohash5 FROM places) GROUP BY l.geohash5),
grown AS (
  SELECT geohash5, province, city, district FROM places
  UNION ALL
  SELECT geohash5, r_name AS province, n_name AS city, 'd_new' AS district
  FROM miss JOIN nation ON n_nationkey = CAST(floor(lon + lat) AS BIGINT) % 25
  JOIN region ON r_regionkey = n_regionkey),
names AS (SELECT event_id, arg_max(event_name, last_update) AS type_name FROM dict GROUP BY event_id)
SELECT l.uid, l.type_id AS event_id, n.type_name AS event_name, g.province, g.city, g.district,
       l.lon AS longitude, l.lat AS latitude
FROM log_geo l LEFT JOIN grown g ON l.geohash5 = g.geohash5 LEFT JOIN names n ON l.type_id = n.event_id""",
    "split_job": _with("log_geo", "places") + """, parsed AS (
  SELECT seq, uid, time, route_type AS event_type, CASE WHEN seq % 17 = 0 THEN 0e0 ELSE lon END AS lon, lat
  FROM log WHERE seq % 11 <> 0 AND seq % 13 <> 0),
pgeo AS (
""" + _geo_select("seq, uid, time, event_type, lon, lat", "parsed") + """),
miss AS (
  SELECT geohash5, arg_min(lon, seq) AS lon, arg_min(lat, seq) AS lat FROM pgeo
  WHERE geohash5 NOT IN (SELECT geohash5 FROM places) GROUP BY geohash5),
grown AS (
  SELECT geohash5, province, city, district FROM places
  UNION ALL
  SELECT geohash5, r_name AS province, n_name AS city, 'd_new' AS district
  FROM miss JOIN nation ON n_nationkey = CAST(floor(lon + lat) AS BIGINT) % 25
  JOIN region ON r_regionkey = n_regionkey),
coded AS (
  SELECT p.seq, p.event_type,
         concat('{"area":"', g.district, '","city":"', g.city, '","eventType":"', p.event_type,
                '","jd":', CAST(p.lon AS VARCHAR), ',"province":"', g.province, '","time":"', p.time,
                '","uid":"', p.uid, '","wd":', CAST(p.lat AS VARCHAR), '}') AS json
  FROM pgeo p LEFT JOIN grown g ON p.geohash5 = g.geohash5)
SELECT seq, 'main' AS route, json FROM coded
UNION ALL
SELECT seq, CASE WHEN starts_with(event_type, 'flow') THEN 'flow' ELSE 'acitiv' END AS route, json FROM coded
WHERE starts_with(event_type, 'flow') OR starts_with(event_type, 'acitiv')""",
    "event_name_asof": _with("name_versions") + """SELECT seq, type_id AS event_id, type_name
FROM log ASOF LEFT JOIN name_versions v ON type_id = v.event_id AND ts >= valid_from""",
    "last_view_before_purchase": _with("log") + """, seen AS (
  SELECT uid, ts AS view_ts, MAX(seq) AS view_seq FROM log WHERE event_type = 'view' GROUP BY uid, ts)
SELECT seq, p.uid, view_seq, epoch_us(ts) - epoch_us(view_ts) AS since_us
FROM (SELECT * FROM log WHERE event_type = 'purchase') p ASOF LEFT JOIN seen ON p.uid = seen.uid AND p.ts >= seen.view_ts""",
    "view_purchase_pairs": _with("log") + """SELECT v.uid, v.seq AS view_seq, p.seq AS purchase_seq,
       epoch_us(p.ts) - epoch_us(v.ts) AS gap_us
FROM log v JOIN log p ON v.uid = p.uid AND v.event_type = 'view' AND p.event_type = 'purchase'
  AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 2 HOUR""",
    "user_sessions": _with("log") + f""", steps AS (
  SELECT uid, epoch_us(ts) AS t, t - LAG(t) OVER (PARTITION BY uid ORDER BY t) AS gap FROM log),
numbered AS (SELECT uid, t, SUM(CASE WHEN gap <= {8 * _HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY uid ORDER BY t) AS s FROM steps)
SELECT uid, MIN(t) AS session_start, MAX(t) AS session_end, COUNT(*) AS n_events FROM numbered GROUP BY uid, s""",
    "tumbling_counts_late": _with("arrivals") + _windowed("event_type", 6 * _HOUR, 6 * _HOUR, 12 * _HOUR),
    "sliding_counts_late": _with("arrivals") + _windowed("event_name", 24 * _HOUR, 6 * _HOUR, 24 * _HOUR),
    "weekly_users_sketch": _with("log") + """SELECT event_name, CAST(CAST(date_trunc('week', CAST(dt AS DATE)) AS DATE) AS VARCHAR) AS week,
       COUNT(*) AS n_events, COUNT(DISTINCT uid) AS users_exact, TRUE AS estimate_close
FROM log GROUP BY 1, 2""",
    "activity_cube": _with("log") + """SELECT event_name, dt, event_type, CAST(GROUPING_ID(event_name, dt, event_type) AS BIGINT) AS grouping_id,
       COUNT(*) AS pv, COUNT(DISTINCT uid) AS uv FROM log GROUP BY CUBE (event_name, dt, event_type)""",
    "activity_rollup": _with("log") + """SELECT event_type, event_name, dt, CAST(GROUPING_ID(event_type, event_name, dt) AS BIGINT) AS grouping_id,
       COUNT(*) AS pv, COUNT(DISTINCT uid) AS uv FROM log GROUP BY ROLLUP (event_type, event_name, dt)""",
    "top_users": _with("log") + """SELECT event_name, dt, uid, COUNT(*) AS pv,
       CAST(ROW_NUMBER() OVER (PARTITION BY event_name, dt ORDER BY COUNT(*) DESC, uid) AS INTEGER) AS rank
FROM log GROUP BY event_name, dt, uid QUALIFY rank <= 3""",
    "heavy_activities": _with("log") + """SELECT concat_ws('|', event_name, event_type) AS activity_type, COUNT(*) AS n
FROM log GROUP BY 1 HAVING COUNT(*) > 0.04e0 * (SELECT COUNT(*) FROM log)""",
    "expiring_counts": _with("log") + f""", steps AS (
  SELECT seq, uid, event_type, epoch_us(ts) AS t,
         t - LAG(t) OVER (PARTITION BY uid, event_type ORDER BY t, seq) AS gap FROM log),
numbered AS (SELECT *, SUM(CASE WHEN gap <= {6 * _HOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY uid, event_type ORDER BY t, seq) AS s
             FROM steps)
SELECT seq, uid, event_type, ROW_NUMBER() OVER (PARTITION BY uid, event_type, s ORDER BY t, seq) AS cnt FROM numbered""",
    "named_when_known": _with("name_versions") + """, named AS (
  SELECT event_id, arg_min(type_name, valid_from) AS name, MIN(valid_from) AS since FROM name_versions GROUP BY event_id)
SELECT seq, type_id AS event_id, CASE WHEN since <= ts + INTERVAL 2 DAY THEN name END AS type_name
FROM log LEFT JOIN named ON type_id = event_id""",
    "first_copies": _with("log") + "SELECT seq, uid, event_type FROM log",
}
ORACLE["user_sessions_stream"] = ORACLE["user_sessions"]
