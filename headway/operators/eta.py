"""Arrival-time prediction (W8, R9, W7, U3 and the E4 core).

All queries are answered in one plan: latest ping per query (W8), stateless
locate (G8) against the broadcast route table, expansion to one row per
remaining stop, the speed ladder (J6), and a running sum of stop durations
per query (W7). No per-query Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, timeparts
from .mapmatch import locate
from .patterns import DEFAULT_SEGMENT_SECONDS, ladder_speed


def latest_ping(pings: DataFrame, query_col: str = "query_id") -> DataFrame:
    """The last ping of each query by (ts, seq): one row per query.

    ``max_by`` is a hash aggregate with a partial stage, so a query
    holding a third of all pings still reduces on the map side.
    """
    order = F.struct("ts", "seq") if "seq" in pings.columns else F.col("ts")
    cols = [c for c in pings.columns if c != query_col]
    latest = pings.groupBy(query_col).agg(F.max_by(F.struct(*cols), order).alias("_l"))
    return latest.select(query_col, "_l.*")


def query_state(latest: DataFrame, routes: DataFrame) -> DataFrame:
    """Locate the latest ping and build the one-row query state.

    A query whose position is the last stop has no next stop: the reference
    raises and skips the file, so such queries are dropped here (M7).
    """
    q = locate(latest, routes)
    q = q.where(F.col("route_position") < F.col("n") - 1)
    q = q.withColumn("pos", F.col("route_position"))
    q = q.withColumns({
        "total_route_stops": F.col("n"),
        "current_stop_id": F.expr("ids[pos]"),
        "next_stop_id": F.expr("ids[pos + 1]"),
        "future_stop_ids": F.expr("slice(ids, pos + 2, n - pos - 1)"),
        "_ns": F.expr("stops[pos + 1]"),
        "future_segment_distances": F.expr("slice(dists, pos + 2, size(dists) - pos - 1)"),
    })
    q = q.withColumns({"_ns_lat": F.col("_ns.lat"), "_ns_lon": F.col("_ns.lon")})
    q = geo.with_distance(q, "latitude", "longitude", "_ns_lat", "_ns_lon", "distance_to_next_route_stop")
    return q.drop("pos", "_ns", "_ns_lat", "_ns_lon", "ids", "dists", "stops", "n", "_rk", "pzone", "psouth", "px", "py",
                  "pts", "segs")


def predict_rows(state: DataFrame, patterns: DataFrame, query_col: str = "query_id") -> DataFrame:
    """E4 core: one row per (query, remaining stop) with the ladder speed,
    ``duration_s`` and the cumulative ``arrival_ts`` (W7).

    The key stop of the i-th remaining stop is the current stop (i = 0) or
    the previous remaining stop; its distance is the distance to the next
    stop (i = 0) or the previous segment length. Each duration is added to
    the clock rounded to the microsecond, as ``timedelta`` does.
    """
    s = timeparts.time_parts(state, "ts")
    rows = s.select(query_col, "route_id", "ts", "hour", "day_of_week", "current_stop_id",
                    "distance_to_next_route_stop", "future_segment_distances",
                    F.posexplode("future_stop_ids").alias("i", "stop_id"),
                    F.col("future_stop_ids").alias("_f"))
    rows = rows.withColumns({
        "key_stop": F.expr("CASE WHEN i = 0 THEN current_stop_id ELSE _f[i - 1] END"),
        "distance_m": F.expr("CASE WHEN i = 0 THEN distance_to_next_route_stop "
                             "ELSE try_element_at(future_segment_distances, i) END"),
    })
    rows = ladder_speed(rows, patterns, "key_stop", "hour", "day_of_week")
    est = F.col("distance_m") / F.col("speed")
    rows = rows.withColumn("duration_s", F.when(est.isNull() | F.isnan(est), F.lit(DEFAULT_SEGMENT_SECONDS))
                           .otherwise(est))
    w = Window.partitionBy(query_col).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_cum_us", F.sum(F.expr("CAST(rint(duration_s * 1e6) AS BIGINT)")).over(w))
    rows = rows.withColumn("arrival_ts", F.expr("timestamp_micros(unix_micros(ts) + _cum_us)"))
    return rows.select(query_col, "route_id", "i", "stop_id", "key_stop", "level", "speed",
                       "distance_m", "duration_s", "arrival_ts").withColumnRenamed("speed", "speed_mps")


def dedupe_repeated_stops(pred: DataFrame, query_col: str = "query_id") -> DataFrame:
    """A stop that appears twice in a query keeps its later prediction."""
    w = Window.partitionBy(query_col, "stop_id")
    return pred.withColumn("_last", F.max("i").over(w)).where(F.col("i") == F.col("_last")).drop("_last")


def latest_per_route(pred: DataFrame, order_col: str = "manifest_pos",
                     query_col: str = "query_id") -> DataFrame:
    """Several queries on one route -> the later manifest entry replaces
    the whole route (among queries that produced predictions)."""
    last = pred.groupBy("route_id").agg(F.max(order_col).alias(order_col))
    # one row per route of the static network: broadcast, so a busy route is
    # never gathered into one shuffle partition
    return pred.join(F.broadcast(last), ["route_id", order_col])
