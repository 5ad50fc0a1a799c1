"""DuckDB SQL for the oracle check: the same workload written independently
as plain SQL over the driver's tables (``nation``, ``orders``).

Scalar formulas (fixture layout, UTM projection, noise rules) are shared
text from :mod:`headway.sources.fixtures` and :mod:`headway.functions.geo`;
everything relational (joins, windows, the map-matching fold as a
recursive CTE, the ladder, the scoring) is written here in DuckDB's
dialect. CTEs are declared with their dependencies and assembled per query.
"""

from __future__ import annotations

from ..functions import geo
from ..sources import fixtures as fx

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    _CTES[name] = (sql, deps)


def with_ctes(body: str, *roots: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)
    for r in roots:
        visit(r)
    if not order:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in order) + "\n" + body


# ---- fixtures ---------------------------------------------------------------------
cte("fx_stops", f"""
SELECT CAST({fx.STOP_ID_SQL} AS VARCHAR) AS stop_id, {fx.STOP_LAT_SQL} AS stop_lat, {fx.STOP_LON_SQL} AS stop_lon
FROM (SELECT n_nationkey AS n, k FROM nation CROSS JOIN range(12) t(k))""")
cte("fx_route_stops", f"""
SELECT CAST(r AS BIGINT) AS route_id, CAST(k AS INTEGER) AS pos, CAST({fx.ROUTE_STOP_SQL} AS VARCHAR) AS stop_id
FROM (SELECT n_nationkey AS r, k FROM nation CROSS JOIN range(12) t(k))""")
cte("fx_seqs", """
SELECT route_id, list(stop_id ORDER BY pos) AS stop_id_list FROM fx_route_stops GROUP BY route_id""",
    "fx_route_stops")
cte("route_geo", """
SELECT rs.route_id, rs.pos, rs.stop_id, s.stop_lat AS lat, s.stop_lon AS lon
FROM fx_route_stops rs JOIN fx_stops s USING (stop_id)""", "fx_route_stops", "fx_stops")
_z0, _s0 = geo.zone_sql("f_lon"), geo.south_sql("f_lat")
_x, _y = geo.utm_sql("lat", "lon", _z0, _s0)
cte("stop_xy0", f"""
SELECT route_id, pos, stop_id, {_x} AS x, {_y} AS y FROM (
  SELECT g.*, first_value(lon) OVER (PARTITION BY route_id ORDER BY pos) AS f_lon,
         first_value(lat) OVER (PARTITION BY route_id ORDER BY pos) AS f_lat FROM route_geo g)""", "route_geo")
cte("seq_dists", """
SELECT route_id, list(stop_id ORDER BY pos) AS stop_id_list, list(d ORDER BY pos) AS next_stop_distances FROM (
  SELECT route_id, pos, stop_id,
         round_even(sqrt(power(coalesce(lead(x) OVER w, x) - x, 2) + power(coalesce(lead(y) OVER w, y) - y, 2)) * 1e1, 0) / 1e1 AS d
  FROM stop_xy0 WINDOW w AS (PARTITION BY route_id ORDER BY pos)) GROUP BY route_id""", "stop_xy0")
cte("routes_info", """
SELECT d.route_id, d.stop_id_list AS ids, d.next_stop_distances AS dists, len(d.stop_id_list) AS n,
       g.lats, g.lons
FROM seq_dists d JOIN (SELECT route_id, list(lat ORDER BY pos) AS lats, list(lon ORDER BY pos) AS lons
                       FROM route_geo GROUP BY route_id) g USING (route_id)""", "seq_dists", "route_geo")

cte("fx_b3", f"""
SELECT CAST(c % 25 AS VARCHAR) AS route_id, CAST(o AS VARCHAR) AS trip_id, CAST(c AS VARCHAR) AS vehicle_id,
       a.stop_id, CAST(k AS INTEGER) AS seq, od + to_seconds({fx.OFFSET_S_SQL}) AS ts,
       a.lat + (b.lat - a.lat) * fr + jit AS latitude, a.lon + (b.lon - a.lon) * fr - jit AS longitude,
       {fx.BEARING_SQL} AS bearing, 'SCHEDULED' AS schedule_relationship
FROM (SELECT *, prog - i AS fr FROM (
        SELECT o, c, od, k, prog, least(CAST(floor(prog) AS INTEGER), 10) AS i, {fx.JIT_SQL} AS jit FROM (
          SELECT o_orderkey AS o, o_custkey AS c, o_orderdate AS od, k, {fx.PROG_SQL} AS prog
          FROM orders CROSS JOIN range(40) t(k)))) x
JOIN route_geo a ON a.route_id = x.c % 25 AND a.pos = x.i
JOIN route_geo b ON b.route_id = x.c % 25 AND b.pos = x.i + 1""", "route_geo")
cte("fx_raw", f"""
SELECT {fx.RAW_ROUTE_SQL} AS route_id, {fx.RAW_TRIP_SQL} AS trip_id, vehicle_id, stop_id, seq,
       {fx.RAW_EPOCH_SQL} AS vehicle_timestamp, {fx.RAW_LAT_SQL} AS latitude, {fx.RAW_LON_SQL} AS longitude,
       bearing, {fx.RAW_SCHED_SQL} AS schedule_relationship, CAST(ts AS DATE) AS date
FROM (SELECT *, CAST(epoch(ts) AS BIGINT) AS epoch_s FROM fx_b3)""", "fx_b3")


def clean_sql(src: str) -> str:
    """P6 over a raw ping relation."""
    return f"""
SELECT replace(route_id, '"', '') AS route_id, replace(trip_id, '"', '') AS trip_id,
       replace(vehicle_id, '"', '') AS vehicle_id, replace(stop_id, '"', '') AS stop_id, seq,
       secs AS vehicle_timestamp, make_timestamp(CAST(round(secs * 1e6) AS BIGINT)) AS ts,
       latitude, longitude, bearing, schedule_relationship, date
FROM (SELECT *, TRY_CAST(replace(vehicle_timestamp, '"', '') AS DOUBLE) AS secs FROM {src})
WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
  AND schedule_relationship IN ('"ADDED"', '"SCHEDULED"', 'ADDED', 'SCHEDULED')
  AND secs IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"""


cte("clean", clean_sql("fx_raw"), "fx_raw")
cte("hist", f"SELECT * FROM clean WHERE date < DATE '{fx.QUERY_FROM_DATE}'", "clean")
cte("live", f"SELECT * FROM clean WHERE date >= DATE '{fx.QUERY_FROM_DATE}'", "clean")


# ---- map-matching (per ping projection, open segments, recursive fold) -----------
def mm_ctes(prefix: str, src: str) -> str:
    """Declare ``{prefix}_mm``: ``src`` pings with route columns and position."""
    z, s = geo.zone_sql("longitude"), geo.south_sql("latitude")
    cte(f"{prefix}_pz", f"""
SELECT p.*, r.n, r.ids, r.dists, r.lats, r.lons, {z} AS pzone, {s} AS psouth
FROM {src} p JOIN routes_info r ON r.route_id = TRY_CAST(p.route_id AS BIGINT)""", src, "routes_info")
    px, py = geo.utm_sql("latitude", "longitude", "pzone", "psouth")
    cte(f"{prefix}_pxy", f"SELECT *, {px} AS px, {py} AS py FROM {prefix}_pz", f"{prefix}_pz")
    sx, sy = geo.utm_sql("g.lat", "g.lon", "z.pzone", "z.psouth")
    cte(f"{prefix}_zstops", f"""
SELECT z.route_id, z.pzone, z.psouth, g.pos, {sx} AS x, {sy} AS y
FROM (SELECT DISTINCT TRY_CAST(route_id AS BIGINT) AS route_id, pzone, psouth FROM {prefix}_pz) z
JOIN route_geo g ON g.route_id = z.route_id""", f"{prefix}_pz", "route_geo")
    cte(f"{prefix}_zsegs", f"""
SELECT a.route_id, a.pzone, a.psouth, a.pos AS i, a.x AS ax, a.y AS ay, b.x - a.x AS dx, b.y - a.y AS dy,
       power(b.x - a.x, 2) + power(b.y - a.y, 2) AS l2
FROM {prefix}_zstops a JOIN {prefix}_zstops b
  ON a.route_id = b.route_id AND a.pzone = b.pzone AND a.psouth = b.psouth AND b.pos = a.pos + 1""",
        f"{prefix}_zstops")
    cte(f"{prefix}_open", f"""
SELECT p.date, p.route_id, p.trip_id, p.seq,
       list(s.i ORDER BY s.i) FILTER (WHERE s.l2 > 0 AND NOT ((p.px - s.ax) * s.dx + (p.py - s.ay) * s.dy > s.l2)) AS open
FROM {prefix}_pxy p JOIN {prefix}_zsegs s
  ON s.route_id = TRY_CAST(p.route_id AS BIGINT) AND s.pzone = p.pzone AND s.psouth = p.psouth
GROUP BY p.date, p.route_id, p.trip_id, p.seq""", f"{prefix}_pxy", f"{prefix}_zsegs")
    cte(f"{prefix}_ord", f"""
SELECT p.*, o.open, row_number() OVER (PARTITION BY p.date, p.route_id, p.trip_id ORDER BY p.ts, p.seq) AS r
FROM {prefix}_pxy p LEFT JOIN {prefix}_open o USING (date, route_id, trip_id, seq)""",
        f"{prefix}_pxy", f"{prefix}_open")
    cte(f"{prefix}_fold", f"""
SELECT date, route_id, trip_id, r, coalesce(list_min(list_filter(open, lambda i: i >= 0)), n - 1) AS m
FROM {prefix}_ord WHERE r = 1
UNION ALL
SELECT b.date, b.route_id, b.trip_id, b.r, coalesce(list_min(list_filter(b.open, lambda i: i >= f.m)), b.n - 1)
FROM {prefix}_fold f JOIN {prefix}_ord b
  ON b.date = f.date AND b.route_id = f.route_id AND b.trip_id = f.trip_id AND b.r = f.r + 1""",
        f"{prefix}_ord")
    cte(f"{prefix}_mm", f"""
SELECT o.*, f.m AS route_position FROM {prefix}_ord o JOIN {prefix}_fold f USING (date, route_id, trip_id, r)""",
        f"{prefix}_ord", f"{prefix}_fold")
    return f"{prefix}_mm"


mm_ctes("h", "clean")
mm_ctes("l", "live")

_D_NEXT_STOP = geo.distance_sql("latitude", "longitude", "lats[np + 1]", "lons[np + 1]")


def ctx_ctes(prefix: str) -> str:
    """``{prefix}_ctx``: W1 + R1-R5 + A9 over ``{prefix}_mm``."""
    cte(f"{prefix}_fa", f"""
SELECT date, route_id, trip_id, stop_id, min(ts) AS first_ts FROM (
  SELECT date, route_id, trip_id, ids[route_position + 1] AS stop_id, ts FROM {prefix}_mm)
GROUP BY ALL""", f"{prefix}_mm")
    cte(f"{prefix}_ctx0", f"""
SELECT *, CASE WHEN route_position + 1 < n THEN route_position + 1 ELSE route_position END AS np
FROM (SELECT m.*,
        coalesce(lead(latitude) OVER w, latitude) AS next_lat,
        coalesce(lead(longitude) OVER w, longitude) AS next_lon,
        coalesce(lead(ts) OVER w, ts) AS next_timestamp
      FROM {prefix}_mm m WINDOW w AS (PARTITION BY date, route_id, trip_id ORDER BY ts, seq))""",
        f"{prefix}_mm")
    cte(f"{prefix}_ctx1", f"""
SELECT *, n AS total_route_stops, ids[route_position + 1] AS current_stop_id, ids[np + 1] AS next_stop_id,
  CASE WHEN route_position + 1 < n THEN list_slice(ids, route_position + 2, n)
       ELSE list_slice(ids, route_position + 1, n) END AS future_stop_ids,
  CASE WHEN route_position + 1 < len(dists) THEN list_slice(dists, route_position + 2, len(dists))
       ELSE list_slice(dists, route_position + 1, len(dists)) END AS future_segment_distances,
  CASE WHEN route_position + 1 < len(dists) THEN
       list_reduce(list_prepend(0e0, list_slice(dists, route_position + 2, len(dists))), lambda a, x: a + x)
       ELSE 0e0 END AS distance_remaining_after_next_stop,
  {_D_NEXT_STOP} AS distance_to_next_route_stop
FROM {prefix}_ctx0""", f"{prefix}_ctx0")
    cte(f"{prefix}_dur", f"""
SELECT c.date, c.route_id, c.trip_id, c.seq,
       list((epoch_us(fa.first_ts) - epoch_us(c.ts)) / 1e6 ORDER BY u.i) FILTER (WHERE fa.first_ts IS NOT NULL) AS d
FROM {prefix}_ctx1 c CROSS JOIN LATERAL unnest(c.future_stop_ids) WITH ORDINALITY AS u(s, i)
LEFT JOIN {prefix}_fa fa ON fa.date = c.date AND fa.route_id = c.route_id AND fa.trip_id = c.trip_id AND fa.stop_id = u.s
GROUP BY ALL""", f"{prefix}_ctx1", f"{prefix}_fa")
    cte(f"{prefix}_ctx2", f"""
SELECT *, distance_to_next_route_stop + distance_remaining_after_next_stop AS distance_remaining
FROM {prefix}_ctx1""", f"{prefix}_ctx1")
    cte(f"{prefix}_ctx", f"""
SELECT c.*, coalesce(d.d, []::DOUBLE[]) AS duration_to_future_stops
FROM {prefix}_ctx2 c LEFT JOIN {prefix}_dur d USING (date, route_id, trip_id, seq)""",
        f"{prefix}_ctx2", f"{prefix}_dur")
    return f"{prefix}_ctx"


ctx_ctes("h")
ctx_ctes("l")

_D_SEG = geo.distance_sql("latitude", "longitude", "next_lat", "next_lon")


def feat_ctes(prefix: str) -> str:
    """``{prefix}_feat``: F1-F3, V1-V3, W3-W5 (trip scope) over ``{prefix}_ctx2``
    (features need no durations to future stops)."""
    cte(f"{prefix}_f1", f"""
SELECT *, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, day(ts) AS day_of_month, month(ts) AS month,
       week(ts) AS week_of_year, {_D_SEG} AS segment_distance,
       greatest((epoch_us(next_timestamp) - epoch_us(ts)) / 1e6, 0e0) AS segment_duration
FROM {prefix}_ctx2""", f"{prefix}_ctx2")
    cte(f"{prefix}_f2", f"""
SELECT *, day_of_week IN (5, 6) AS is_weekend, hour IN (7, 8, 9, 17, 18, 19) AS is_rush_hour,
  hour IN (7, 8, 9) AS is_morning_peak, hour IN (17, 18, 19) AS is_evening_peak,
  hour IN (12, 13, 14) AS is_lunch_hour, hour IN (22, 23, 0, 1, 2, 3, 4, 5) AS is_night,
  sin({geo.lit(6.283185307179586)} * hour / 24e0) AS hour_sin, cos({geo.lit(6.283185307179586)} * hour / 24e0) AS hour_cos,
  sin({geo.lit(6.283185307179586)} * day_of_week / 7e0) AS day_sin, cos({geo.lit(6.283185307179586)} * day_of_week / 7e0) AS day_cos,
  sin({geo.lit(6.283185307179586)} * month / 12e0) AS month_sin, cos({geo.lit(6.283185307179586)} * month / 12e0) AS month_cos,
  coalesce(bearing - lead(bearing) OVER w, 0e0) AS bearing_change,
  CASE WHEN segment_duration > 0 THEN segment_distance / segment_duration ELSE 0e0 END AS speed
FROM {prefix}_f1 WINDOW w AS (PARTITION BY date, route_id, trip_id ORDER BY ts, seq)""", f"{prefix}_f1")
    cte(f"{prefix}_feat", f"""
SELECT *,
  CASE WHEN segment_distance > 0 THEN bearing_change / segment_distance ELSE 0e0 END AS bearing_change_per_meter,
  CASE WHEN segment_duration > 0 THEN bearing_change / segment_duration ELSE 0e0 END AS bearing_change_per_second,
  CASE WHEN segment_duration > 0 THEN (speed - lead(speed) OVER w) / segment_duration ELSE 0e0 END AS acceleration,
  CASE WHEN row_number() OVER w >= 5 THEN avg(abs(bearing_change)) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END
    AS direction_consistency
FROM {prefix}_f2 WINDOW w AS (PARTITION BY date, route_id, trip_id ORDER BY ts, seq)""", f"{prefix}_f2")
    cte(f"{prefix}_rstats", f"""
SELECT date, route_id, avg_trip_length, stop_density, avg_speed,
       CASE WHEN v < 0 THEN 0e0 WHEN v > 5 THEN 5e0 ELSE v END AS complexity_score
FROM (SELECT date, route_id,
  sum(segment_distance) / count(DISTINCT trip_id) AS avg_trip_length,
  CASE WHEN sum(segment_distance) <> 0 THEN count(DISTINCT stop_id) / sum(segment_distance) END AS stop_density,
  avg(speed) AS avg_speed,
  4e-1 * (avg(abs(bearing_change_per_meter)) FILTER (WHERE segment_distance > 0)
          / (median(abs(bearing_change_per_meter)) FILTER (WHERE segment_distance > 0) + 1e-6))
  + 4e-1 * (avg(abs(bearing_change_per_second)) FILTER (WHERE segment_duration > 0)
          / (median(abs(bearing_change_per_second)) FILTER (WHERE segment_duration > 0) + 1e-6))
  + 2e-1 * avg(CASE WHEN abs(bearing_change) > 45 THEN 1e0 ELSE 0e0 END) AS v
FROM {prefix}_feat GROUP BY date, route_id)""", f"{prefix}_feat")
    cte(f"{prefix}_rfirst", f"""
SELECT s.* EXCLUDE (date) FROM {prefix}_rstats s
JOIN (SELECT route_id, min(date) AS date FROM {prefix}_rstats GROUP BY route_id) f USING (route_id, date)""",
        f"{prefix}_rstats")
    cte(f"{prefix}_full", f"""
SELECT f.*, r.avg_trip_length AS route_length, r.complexity_score AS route_complexity,
       r.stop_density AS route_stop_density, r.avg_speed AS route_avg_speed,
       f.total_route_stops AS stops_remaining, 0e0 AS progress_ratio
FROM {prefix}_feat f LEFT JOIN {prefix}_rfirst r USING (route_id)""", f"{prefix}_feat", f"{prefix}_rfirst")
    return f"{prefix}_full"


feat_ctes("h")

# the default feature run: the five busiest routes of every date
cte("top_routes", """
SELECT date, route_id FROM (
  SELECT date, route_id, row_number() OVER (PARTITION BY date ORDER BY n DESC, route_id) AS rk
  FROM (SELECT date, route_id, count(*) AS n FROM clean GROUP BY ALL)) WHERE rk <= 5""", "clean")
cte("top_full", """
SELECT f.*, r.avg_trip_length AS route_length, r.complexity_score AS route_complexity,
       r.stop_density AS route_stop_density, r.avg_speed AS route_avg_speed,
       f.total_route_stops AS stops_remaining, 0e0 AS progress_ratio
FROM h_feat f JOIN top_routes t USING (date, route_id)
LEFT JOIN (SELECT s.* EXCLUDE (date) FROM h_rstats s
           JOIN (SELECT route_id, min(date) AS date FROM top_routes GROUP BY route_id) m USING (route_id, date)) r
  USING (route_id)""", "h_feat", "h_rstats", "top_routes")

cte("patterns", f"""
SELECT current_stop_id, hour, day_of_week, avg(segment_duration) AS dur_mean, stddev_samp(segment_duration) AS dur_std,
       count(segment_duration) AS dur_count, avg(speed) AS speed_mean, stddev_samp(speed) AS speed_std,
       avg(segment_distance) AS dist_mean
FROM h_feat WHERE date < DATE '{fx.QUERY_FROM_DATE}' AND segment_duration > 0 AND current_stop_id IS NOT NULL AND hour IS NOT NULL AND day_of_week IS NOT NULL
GROUP BY current_stop_id, hour, day_of_week""", "h_feat")

# ---- queries, locate, ladder, predictions ---------------------------------------
cte("q_raw", f"""
SELECT *, replace(trip_id, '"', '') AS query_id FROM fx_raw
WHERE date >= DATE '{fx.QUERY_FROM_DATE}'
  AND seq <= {fx.QUERY_CUT_SQL.replace("o", "TRY_CAST(replace(trip_id, '\"', '') AS BIGINT)")}""", "fx_raw")
cte("q_clean", clean_sql("q_raw").replace("schedule_relationship, date", "schedule_relationship, date, query_id"),
    "q_raw")
cte("q_latest", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ts DESC, seq DESC) AS rk FROM q_clean)
WHERE rk = 1""", "q_clean")
mm_ctes("q", "q_latest")  # declares q_pz, q_pxy, q_zstops, q_zsegs (the fold part is unused)
cte("q_loc", """
SELECT p.query_id, coalesce(min(s.i) FILTER (WHERE s.l2 > 0
    AND ((p.px - s.ax) * s.dx + (p.py - s.ay) * s.dy) / s.l2 BETWEEN 0e0 AND 1e0
    AND sqrt(power((p.px - s.ax) - ((p.px - s.ax) * s.dx + (p.py - s.ay) * s.dy) / s.l2 * s.dx, 2)
           + power((p.py - s.ay) - ((p.px - s.ax) * s.dx + (p.py - s.ay) * s.dy) / s.l2 * s.dy, 2))
        <= greatest(1e2, sqrt(s.l2) * 5e-1)
    AND sqrt(power(p.px - s.ax, 2) + power(p.py - s.ay, 2)) <= sqrt(s.l2) * 1.5e0), min(p.n) - 1) AS route_position
FROM q_pxy p LEFT JOIN q_zsegs s
  ON s.route_id = TRY_CAST(p.route_id AS BIGINT) AND s.pzone = p.pzone AND s.psouth = p.psouth
GROUP BY p.query_id""", "q_pxy", "q_zsegs")
_D_Q = geo.distance_sql("latitude", "longitude", "lats[route_position + 2]", "lons[route_position + 2]")
cte("q_state", f"""
SELECT p.query_id, p.route_id, p.ts, p.latitude, p.longitude, l.route_position, p.n AS total_route_stops,
       p.ids[l.route_position + 1] AS current_stop_id, p.ids[l.route_position + 2] AS next_stop_id,
       list_slice(p.ids, l.route_position + 2, p.n) AS future_stop_ids,
       list_slice(p.dists, l.route_position + 2, len(p.dists)) AS future_segment_distances,
       {_D_Q.replace('lats[', 'p.lats[').replace('lons[', 'p.lons[').replace('route_position', 'l.route_position')}
         AS distance_to_next_route_stop,
       hour(p.ts) AS hour, isodow(p.ts) - 1 AS day_of_week
FROM q_pxy p JOIN q_loc l USING (query_id) WHERE l.route_position < p.n - 1""", "q_pxy", "q_loc")
cte("q_rows", """
SELECT s.query_id, s.route_id, s.ts, s.hour, s.day_of_week, CAST(u.i - 1 AS INTEGER) AS i, u.stop_id,
       CASE WHEN u.i = 1 THEN s.current_stop_id ELSE s.future_stop_ids[u.i - 1] END AS key_stop,
       CASE WHEN u.i = 1 THEN s.distance_to_next_route_stop ELSE s.future_segment_distances[u.i - 1] END AS distance_m
FROM q_state s CROSS JOIN LATERAL unnest(s.future_stop_ids) WITH ORDINALITY AS u(stop_id, i)""", "q_state")
cte("lv2", """SELECT current_stop_id AS s, hour, avg(speed_mean) AS m, sum(speed_mean) AS sm, count(*) AS c
FROM patterns GROUP BY ALL""", "patterns")
cte("q_lvl", """
SELECT r.*,
  (SELECT avg(speed_mean) FROM patterns) AS g,
  p1.speed_mean AS l1, p1.current_stop_id IS NOT NULL AS has1,
  v2.m AS l2, v2.c AS c2,
  (coalesce(lo.sm, 0e0) + coalesce(hi.sm, 0e0)) / nullif(coalesce(lo.c, 0) + coalesce(hi.c, 0), 0) AS l3,
  coalesce(lo.c, 0) + coalesce(hi.c, 0) AS c3,
  v4.m AS l4, v4.c AS c4, v5.m AS l5, v5.c AS c5
FROM q_rows r
LEFT JOIN patterns p1 ON p1.current_stop_id = r.key_stop AND p1.hour = r.hour AND p1.day_of_week = r.day_of_week
LEFT JOIN lv2 v2 ON v2.s = r.key_stop AND v2.hour = r.hour
LEFT JOIN lv2 lo ON lo.s = r.key_stop AND lo.hour = r.hour - 1
LEFT JOIN lv2 hi ON hi.s = r.key_stop AND hi.hour = r.hour + 1
LEFT JOIN (SELECT hour, day_of_week, avg(speed_mean) AS m, count(*) AS c FROM patterns GROUP BY ALL) v4
  ON v4.hour = r.hour AND v4.day_of_week = r.day_of_week
LEFT JOIN (SELECT current_stop_id AS s, avg(speed_mean) AS m, count(*) AS c FROM patterns GROUP BY ALL) v5
  ON v5.s = r.key_stop""", "q_rows", "patterns", "lv2")
cte("q_pick", """
SELECT *, CASE WHEN lvl = 1 THEN l1 WHEN lvl = 2 THEN l2 WHEN lvl = 3 THEN l3 WHEN lvl = 4 THEN l4
               WHEN lvl = 5 THEN l5 END AS chosen FROM (
  SELECT *, CASE WHEN has1 THEN 1 WHEN c2 > 0 THEN 2 WHEN c3 > 0 THEN 3 WHEN c4 > 0 THEN 4 WHEN c5 > 0 THEN 5 END AS lvl
  FROM q_lvl)""", "q_lvl")
cte("q_speed", f"""
SELECT *,
  CASE WHEN chosen IS NOT NULL AND NOT isnan(chosen) AND chosen <> 0 THEN chosen
       WHEN g IS NOT NULL AND NOT isnan(g) AND g <> 0 THEN g ELSE {geo.lit(20.0 / 3.6)} END AS speed_mps,
  CASE WHEN chosen IS NOT NULL AND NOT isnan(chosen) AND chosen <> 0 THEN lvl
       WHEN g IS NOT NULL AND NOT isnan(g) AND g <> 0 THEN 6 ELSE 7 END AS level
FROM q_pick""", "q_pick")
cte("q_pred0", """
SELECT query_id, route_id, i, stop_id, key_stop, level, speed_mps, distance_m, duration_s,
       make_timestamp(CAST(epoch_us(ts) + sum(CAST(round_even(duration_s * 1e6, 0) AS BIGINT))
         OVER (PARTITION BY query_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)) AS arrival_ts
FROM (SELECT *, coalesce(CASE WHEN isnan(distance_m / speed_mps) THEN NULL ELSE distance_m / speed_mps END, 6e1)
        AS duration_s FROM q_speed)""", "q_speed")
cte("predictions", """
SELECT p.* FROM q_pred0 p JOIN (SELECT query_id, stop_id, max(i) AS i FROM q_pred0 GROUP BY ALL) m
  USING (query_id, stop_id, i)""", "q_pred0")

# ---- actuals and evaluation -----------------------------------------------------
cte("q_time", "SELECT query_id, max(ts) AS qts FROM q_clean GROUP BY query_id", "q_clean")
cte("actuals", """
SELECT a.query_id, a.stop_id, strftime(a.a, '%Y-%m-%d %H:%M:%S') AS arrival FROM (
  SELECT c.trip_id AS query_id, c.current_stop_id AS stop_id, min(c.ts) AS a
  FROM l_ctx2 c JOIN q_time t ON t.query_id = c.trip_id WHERE c.ts > t.qts GROUP BY ALL) a
UNION ALL
SELECT t.query_id, NULL, NULL FROM q_time t
WHERE NOT EXISTS (SELECT 1 FROM l_ctx2 c WHERE c.trip_id = t.query_id AND c.ts > t.qts)""", "l_ctx2", "q_time")
cte("pred_text", """
SELECT query_id, stop_id, strftime(arrival_ts, '%Y-%m-%d %H:%M:%S') AS arrival FROM predictions""", "predictions")
cte("stop_err", """
SELECT a.query_id, a.stop_id, k.query_id IS NOT NULL AS key_predicted,
  CASE WHEN k.query_id IS NULL THEN 1e2 WHEN a.stop_id IS NULL THEN NULL WHEN p.arrival IS NULL THEN 1e1
       WHEN try_strptime(a.arrival, '%Y-%m-%d %H:%M:%S') IS NULL OR try_strptime(p.arrival, '%Y-%m-%d %H:%M:%S') IS NULL THEN 1e1
       ELSE abs((epoch_us(strptime(p.arrival, '%Y-%m-%d %H:%M:%S')) - epoch_us(strptime(a.arrival, '%Y-%m-%d %H:%M:%S'))) / 1e6 / 6e1)
  END AS abs_min,
  CASE WHEN p.arrival IS NOT NULL THEN (epoch_us(strptime(p.arrival, '%Y-%m-%d %H:%M:%S'))
       - epoch_us(strptime(a.arrival, '%Y-%m-%d %H:%M:%S'))) / 1e6 END AS diff_s
FROM actuals a LEFT JOIN (SELECT DISTINCT query_id FROM pred_text) k USING (query_id)
LEFT JOIN pred_text p ON p.query_id = a.query_id AND p.stop_id = a.stop_id""", "actuals", "pred_text")
cte("scores", """
SELECT query_id, CASE WHEN NOT bool_or(key_predicted) THEN 1e2 ELSE coalesce(avg(abs_min), 0e0) END AS eta_score_minutes
FROM stop_err GROUP BY query_id""", "stop_err")
