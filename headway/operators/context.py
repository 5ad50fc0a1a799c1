"""Per-ping trip context after map-matching.

All expressions are array built-ins over the broadcast route row, plus
window functions over the trip. The input comes from
:func:`headway.operators.mapmatch.map_match`, already hash-partitioned by
(date, route, trip), so the trip windows add only a local sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from .mapmatch import CHUNK_KEYS, TRIP_KEYS, attach_route, map_match


def trip_window(keys=TRIP_KEYS) -> Window:
    return Window.partitionBy(*keys).orderBy("ts", "seq")


def chunked(df: DataFrame) -> bool:
    """True when rows carry the chunk-boundary columns of the fold."""
    return "_prev_tails" in df.columns


def lead_or_carry(df: DataFrame, col: str, keys=TRIP_KEYS) -> F.Column:
    """The next ping's ``col`` within the trip.

    On chunked rows the window covers one chunk of the trip and the last
    ping of a chunk reads the first ping after it from ``_next_heads``.
    """
    if not chunked(df):
        return F.lead(col).over(trip_window(keys))
    w = trip_window(CHUNK_KEYS)
    return F.when(F.lead("ts").over(w).isNotNull(), F.lead(col).over(w)).otherwise(
        F.expr(f"try_element_at(_next_heads, 1).{col}"))


def next_ping(df: DataFrame, keys=TRIP_KEYS) -> DataFrame:
    """``next_lat, next_lon, next_timestamp`` = next ping of the trip by
    time; the last ping gets its own values. On chunked rows the next bearing
    comes from the same window, as ``_next_bearing`` (null at the end of the
    trip), and the heads of the chunks after them, read out, are dropped."""
    cols = {
        "next_lat": F.coalesce(lead_or_carry(df, "latitude", keys), F.col("latitude")),
        "next_lon": F.coalesce(lead_or_carry(df, "longitude", keys), F.col("longitude")),
        "next_timestamp": F.coalesce(lead_or_carry(df, "ts", keys), F.col("ts")),
    }
    if not chunked(df):
        return df.withColumns(cols)
    return df.withColumns(cols | {"_next_bearing": lead_or_carry(df, "bearing", keys)}).drop("_next_heads")


# R1-R4 and A9 as SQL over route columns ids, dists, stops, n and pos.
CURRENT_STOP_SQL = "ids[pos]"
NEXT_POS_SQL = "CASE WHEN pos + 1 < n THEN pos + 1 ELSE pos END"
NEXT_STOP_SQL = f"ids[{NEXT_POS_SQL}]"
FUTURE_STOPS_SQL = "CASE WHEN pos + 1 < n THEN slice(ids, pos + 2, n - pos - 1) ELSE slice(ids, pos + 1, n - pos) END"
FUTURE_DISTS_SQL = ("CASE WHEN pos + 1 < size(dists) THEN slice(dists, pos + 2, size(dists) - pos - 1) "
                    "ELSE slice(dists, pos + 1, size(dists) - pos) END")
REMAINING_AFTER_SQL = ("CASE WHEN pos + 1 < size(dists) THEN "
                       "aggregate(slice(dists, pos + 2, size(dists) - pos - 1), 0e0, (a, x) -> a + x) ELSE 0e0 END")


def with_rests(routes: DataFrame) -> DataFrame:
    """Adds ``rests``: A9 of every position, summed once per route."""
    return routes.withColumn("rests", F.expr(f"transform(sequence(0, n - 1), pos -> {REMAINING_AFTER_SQL})"))


def route_context(df: DataFrame, pos_col: str = "route_position", lists: bool = True) -> DataFrame:
    """R1-R4 + A9 (batch semantics: clamp at the end of the route).

    Needs the route columns (``ids, dists, stops, n``) and the ping position;
    ``rests`` (see :func:`with_rests`) is used where it is there.
    Without ``lists`` the future stops and distances are left to :func:`with_lists`.
    """
    d = df.withColumn("pos", F.col(pos_col))
    d = d.withColumns({
        "total_route_stops": F.col("n"),
        "current_stop_id": F.expr(CURRENT_STOP_SQL),
        "next_stop_id": F.expr(NEXT_STOP_SQL),
        **({"future_stop_ids": F.expr(FUTURE_STOPS_SQL)} if lists else {}),
        "_ns": F.expr(f"stops[{NEXT_POS_SQL}]"),
        **({"future_segment_distances": F.expr(FUTURE_DISTS_SQL)} if lists else {}),
        "distance_remaining_after_next_stop": F.expr("rests[pos]" if "rests" in df.columns else REMAINING_AFTER_SQL),
    })
    d = d.withColumns({"_ns_lat": F.col("_ns.lat"), "_ns_lon": F.col("_ns.lon")})
    d = geo.with_distance(d, "latitude", "longitude", "_ns_lat", "_ns_lon", "distance_to_next_route_stop")
    d = d.withColumn("distance_remaining",
                     F.col("distance_to_next_route_stop") + F.col("distance_remaining_after_next_stop"))
    return d.drop("pos", "_ns", "_ns_lat", "_ns_lon")


# the arrivals at the stops that FUTURE_STOPS_SQL lists
FUTURE_ARRIVALS_SQL = ("filter(CASE WHEN pos + 1 < n THEN slice(_arrivals, pos + 2, n - pos - 1) ELSE slice(_arrivals, pos + 1, n - pos) END, "
                       "a -> a IS NOT NULL)").replace("pos", "route_position")
DURATIONS_SQL = f"transform({FUTURE_ARRIVALS_SQL}, a -> (unix_micros(a) - unix_micros(ts)) / 1e6)"
ARRIVALS_SQL = FUTURE_ARRIVALS_SQL


def durations_to_future_stops(df: DataFrame) -> DataFrame:
    """Seconds from each ping to the trip's first arrival at each future
    stop (stops never reached are omitted). Uses the first arrivals by route
    position produced by the map-matching fold (J5)."""
    return df.withColumn("duration_to_future_stops", F.expr(DURATIONS_SQL))


def arrival_times_to_future_stops(df: DataFrame) -> DataFrame:
    """The same first arrivals as timestamps (the stated intent)."""
    return df.withColumn("arrival_time_to_future_stops", F.expr(ARRIVALS_SQL))


def with_lists(df: DataFrame, routes: DataFrame) -> DataFrame:
    """R2, R3, R5 for rows of :func:`process_trips` without ``lists``: future
    stops, their distances and the seconds to them, from the route's row and
    the arrivals by position that the rows carry."""
    d = attach_route(df, routes).drop("_rk").withColumn("pos", F.col("route_position"))
    d = d.withColumns({"future_stop_ids": F.expr(FUTURE_STOPS_SQL), "future_segment_distances": F.expr(FUTURE_DISTS_SQL)})
    return durations_to_future_stops(d).drop("pos", "ids", "dists", "stops", "n", "_arrivals")


def process_trips(pings: DataFrame, routes: DataFrame, chunk_seconds: int | None = None, lists: bool = True) -> DataFrame:
    """All trips of all routes in one plan: sort, W1, W6, R1-R5, A9.

    ``pings`` are cleaned pings; ``routes`` is :func:`static.route_table`.
    Without ``lists`` the rows carry the arrivals by position for
    :func:`with_lists`, so that later windows move narrow rows.
    """
    # a chunk length asked for holds for all trips
    kw = {} if chunk_seconds is None else {"chunk_seconds": chunk_seconds, "whole_rows": 0}
    m = map_match(pings, routes, **kw)
    # the trip windows hold narrow rows: the route's arrays come after them
    m = next_ping(m.drop("n", "first_arrival"))
    m = attach_route(m, with_rests(routes), ["rests"]).drop("_rk")
    m = route_context(m, lists=lists).drop("ids", "dists", "stops", "rests")
    return durations_to_future_stops(m).drop("n", "_arrivals") if lists else m.drop("n")
