"""Feature operators: calendar (F1-F3), movement (V1-V4, W3-W5), route
statistics (A4, A5) joined back to pings (J7), and the full extract (V5).

Trip windows run on data already partitioned by (date, route, trip, chunk).
Route statistics are hash aggregates per (date, route) over the few columns that
they need, which are stored; they are stored as well and joined back, and the
planner broadcasts them while their bytes allow it. A plan that may not read
them can leave them unstored: then they are worked out with the rows, or not
at all where no column of theirs is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, timeparts
from .context import chunked, lead_or_carry, with_lists
from .mapmatch import CHUNK_KEYS, TRIP_KEYS
from .quantiles import exact_medians
from .static import materialize

# --- fixed values: complexity score weights and thresholds -----------------
COMPLEXITY_W_SPATIAL = 0.4
COMPLEXITY_W_TEMPORAL = 0.4
COMPLEXITY_W_SHARP = 0.2
SHARP_TURN_DEG = 45.0
MEDIAN_EPS = 1e-6
COMPLEXITY_MAX = 5.0
COMPLEXITY_DEFAULT = 1.0
ROLLING_ROWS = 5
# ---------------------------------------------------------------------------


def temporal_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """F1-F3 (UTC clock)."""
    return timeparts.with_time_features(df, ts)


def segment_metrics(df: DataFrame) -> DataFrame:
    """V1: ``segment_distance`` (UTM metres, zone of the ping) to the next ping
    and ``segment_duration = max(0, next_ts - ts)`` seconds."""
    d = geo.with_distance(df, "latitude", "longitude", "next_lat", "next_lon", "segment_distance")
    dur = (F.unix_micros("next_timestamp") - F.unix_micros("ts")) / F.lit(1e6)
    return d.withColumn("segment_duration", F.when(dur < 0, F.lit(0.0)).otherwise(dur))


def _div_if_pos(num: str, den: str) -> F.Column:
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))


def movement_patterns(df: DataFrame, keys=TRIP_KEYS, rolling_scope: str = "trip") -> DataFrame:
    """V2-V3, W3-W5.

    ``bearing_change = bearing - next bearing`` in the trip (0 at the end, no
    360 wrap); turn rates per metre / second; ``speed`` in m/s;
    ``acceleration = (speed - next speed) / duration``;
    ``direction_consistency`` = mean of the last five |bearing_change|
    (NULL until five rows exist). ``rolling_scope='route'`` reproduces the
    reference, whose rolling window runs across trips of a route (trips in
    order of first ping, then trip id).
    """
    return direction_consistency(_rates(bearing_change(df, keys), keys), keys, rolling_scope)


def _speeds(d: DataFrame) -> DataFrame:
    """V2-V3: turn rates and speed, of a row's own columns alone."""
    return d.withColumns({
        "bearing_change_per_meter": _div_if_pos("bearing_change", "segment_distance"),
        "bearing_change_per_second": _div_if_pos("bearing_change", "segment_duration"),
        "speed": _div_if_pos("segment_distance", "segment_duration"),
    })


def _rates(d: DataFrame, keys=TRIP_KEYS) -> DataFrame:
    """Turn rates, speed and acceleration of rows with ``bearing_change``."""
    d = _speeds(d)
    if chunked(d):
        w = Window.partitionBy(*CHUNK_KEYS).orderBy("ts", "seq")
        nxt = F.when(F.lead("ts").over(w).isNotNull(), F.lead("speed").over(w)).otherwise(F.col("_next_speed0"))
    else:
        nxt = F.lead("speed").over(Window.partitionBy(*keys).orderBy("ts", "seq"))
    d = d.withColumn("acceleration", F.when(
        F.col("segment_duration") > 0,
        (F.col("speed") - nxt) / F.col("segment_duration")).otherwise(F.lit(0.0)))
    return d


def bearing_change(df: DataFrame, keys=TRIP_KEYS) -> DataFrame:
    """``bearing - next bearing`` in the trip; 0 at the end (no 360 wrap)."""
    nxt = F.col("_next_bearing") if "_next_bearing" in df.columns else lead_or_carry(df, "bearing", keys)
    return df.withColumn("bearing_change", F.coalesce(F.col("bearing") - nxt, F.lit(0.0)))


def direction_consistency(df: DataFrame, keys=TRIP_KEYS, scope: str = "trip") -> DataFrame:
    """Rolling mean of |bearing_change| over the last five rows.

    ``scope='trip'``: within each trip. ``scope='route'``: across the trips
    of a (date, route) in order of their first ping. The route scope is
    computed without a route-wide sort: each trip's first four rows take
    their missing predecessors from the tails of the preceding trips,
    found by a window over one summary row per trip.
    """
    abs_bc = F.abs(F.col("bearing_change"))
    if scope not in ("trip", "route"):
        raise ValueError("scope must be 'trip' or 'route'")
    if scope == "trip" and chunked(df):
        # window over one chunk; the first rows of a chunk complete it with the
        # |bearing change| tails of the preceding chunks
        w = Window.partitionBy(*CHUNK_KEYS).orderBy("ts", "seq")
        roll = w.rowsBetween(-(ROLLING_ROWS - 1), 0)
        d = df.withColumns({"_roll_sum": F.sum(abs_bc).over(roll), "_roll_n": F.count(abs_bc).over(roll),
                            "_rn": F.row_number().over(w)})
        need = f"({ROLLING_ROWS} - _rn)"
        tail = f"slice(_prev_tails, greatest(size(_prev_tails) - {need} + 1, 1), greatest(least({need}, size(_prev_tails)), 0))"
        full = (f"CASE WHEN _rows_before + _rn < {ROLLING_ROWS} THEN NULL "
                f"WHEN _rn >= {ROLLING_ROWS} THEN _roll_sum / _roll_n "
                f"ELSE (_roll_sum + aggregate({tail}, 0e0, (a, x) -> a + x)) / {ROLLING_ROWS}e0 END")
        return d.withColumn("direction_consistency", F.expr(full)).drop("_roll_sum", "_roll_n", "_rn")
    w = Window.partitionBy(*keys).orderBy("ts", "seq")
    roll = w.rowsBetween(-(ROLLING_ROWS - 1), 0)
    d = df.withColumns({
        "_roll_sum": F.sum(abs_bc).over(roll),
        "_roll_n": F.count(abs_bc).over(roll),
        "_rn": F.row_number().over(w),
    })
    if scope == "trip":
        return d.withColumn("direction_consistency", F.when(
            F.col("_rn") >= ROLLING_ROWS, F.col("_roll_sum") / F.col("_roll_n"))).drop("_roll_sum", "_roll_n", "_rn")
    if chunked(df):
        return _route_consistency(df, abs_bc)
    route_keys = [k for k in keys if k != "trip_id"]
    # one summary row per trip: first ts and the |bc| of its last four rows
    tail = (d.withColumn("_rev", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.col("ts").desc(), F.col("seq").desc())))
        .where(F.col("_rev") <= ROLLING_ROWS - 1))
    trips = (tail.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_rev"), abs_bc.alias("v")))).alias("_t")))
    firsts = d.groupBy(*keys).agg(F.min("ts").alias("_first_ts"))
    trips = trips.join(firsts, keys)
    # tails of up to four preceding trips (route order), newest last
    tw = Window.partitionBy(*route_keys).orderBy("_first_ts", "trip_id").rowsBetween(-(ROLLING_ROWS - 1), -1)
    trips = trips.withColumn("_prev", F.collect_list(
        F.expr("reverse(transform(_t, x -> x.v))")).over(tw))
    trips = trips.withColumn("_prev", F.flatten("_prev"))
    trips = trips.select(*keys, F.expr(
        f"CASE WHEN size(_prev) = 0 THEN _prev ELSE slice(_prev, -least({ROLLING_ROWS - 1}, size(_prev)), "
        f"least({ROLLING_ROWS - 1}, size(_prev))) END").alias("_carry"))
    d = d.join(trips, keys, "left")
    # rows 1..4 of a trip complete their window with the carried values
    need = f"({ROLLING_ROWS} - _rn)"
    carry_tail = f"slice(_carry, greatest(size(_carry) - {need} + 1, 1), greatest(least({need}, size(_carry)), 0))"
    full = (f"CASE WHEN _rn >= {ROLLING_ROWS} THEN _roll_sum / _roll_n "
            f"WHEN size(_carry) >= {need} THEN "
            f"(_roll_sum + aggregate({carry_tail}, 0e0, (a, x) -> a + x)) / {ROLLING_ROWS}e0 END")
    return d.withColumn("direction_consistency", F.expr(full)).drop("_roll_sum", "_roll_n", "_rn", "_carry")


def _route_consistency(df: DataFrame, abs_bc: F.Column) -> DataFrame:
    """W5 across the trips of a (date, route), on chunked rows: the window
    covers a chunk, and the values before it (of the trip's chunks before, then
    of the trips before) come from one summary row per chunk. The pings stay
    where they are; only summaries are shuffled."""
    k = ROLLING_ROWS - 1
    last = lambda x: f"CASE WHEN size({x}) = 0 THEN {x} ELSE slice({x}, -least({k}, size({x})), least({k}, size({x}))) END"
    chunks = df.groupBy(*CHUNK_KEYS).agg(F.min("ts").alias("_t0"), F.array_sort(F.collect_list(F.struct("ts", "seq", abs_bc.alias("v")))).alias("_l"))
    chunks = chunks.select(*CHUNK_KEYS, "_t0", F.expr(f"transform({last('_l')}, x -> x.v)").alias("_tail"))
    trips = chunks.groupBy(*TRIP_KEYS).agg(F.min("_t0").alias("_t0"), F.array_sort(F.collect_list(F.struct("bucket", "_tail"))).alias("_l"))
    trips = trips.withColumn("_l", F.expr(f"flatten(transform({last('_l')}, x -> x._tail))")).select(*TRIP_KEYS, "_t0", F.expr(last("_l")).alias("_tail"))
    before = Window.partitionBy(*[c for c in TRIP_KEYS if c != "trip_id"]).orderBy("_t0", "trip_id").rowsBetween(-k, -1)
    trips = trips.select(*TRIP_KEYS, F.flatten(F.collect_list("_tail").over(before)).alias("_carry"))
    carry = chunks.select(*CHUNK_KEYS).join(trips, TRIP_KEYS)
    w = Window.partitionBy(*CHUNK_KEYS).orderBy("ts", "seq")
    roll = w.rowsBetween(-k, 0)
    d = df.withColumns({"_roll_sum": F.sum(abs_bc).over(roll), "_roll_n": F.count(abs_bc).over(roll), "_rn": F.row_number().over(w)}).join(carry, CHUNK_KEYS)
    d = d.withColumn("_carry", F.concat("_carry", F.coalesce("_prev_tails", F.array().cast("array<double>"))))
    need = f"({ROLLING_ROWS} - _rn)"
    tail = f"slice(_carry, greatest(size(_carry) - {need} + 1, 1), greatest(least({need}, size(_carry)), 0))"
    full = (f"CASE WHEN _rn >= {ROLLING_ROWS} THEN _roll_sum / _roll_n WHEN size(_carry) >= {need} THEN "
            f"(_roll_sum + aggregate({tail}, 0e0, (a, x) -> a + x)) / {ROLLING_ROWS}e0 END")
    return d.withColumn("direction_consistency", F.expr(full)).drop("_roll_sum", "_roll_n", "_rn", "_carry")


def spatial_features(df: DataFrame, keys=TRIP_KEYS, rolling_scope: str = "trip") -> DataFrame:
    """V1-V3, W3-W5. The bearings' window comes first: it parts the segment's
    projections from those before it, which in one generated method are too
    much to be compiled well."""
    d = direction_consistency(bearing_change(df, keys), keys, rolling_scope)
    return _rates(segment_metrics(d), keys)


#: What the route statistics read of a ping.
STAT_COLS = ["trip_id", "stop_id", "segment_distance", "segment_duration", "speed", "bearing_change",
             "bearing_change_per_meter", "bearing_change_per_second"]


def route_characteristics(df: DataFrame, route_keys=("date", "route_id"), stored: bool = True) -> DataFrame:
    """A4 + A5 per (date, route): avg trip length, stop density, mean speed and
    the clipped complexity score; rows without turn rates get the default score.
    Division by zero gives NULL (pandas: inf). Three aggregates read the pings:
    ``stored``, from a table of the columns that they need."""
    rk = list(route_keys)
    if stored:
        df = materialize(df.select(*rk, *[c for c in STAT_COLS if c in df.columns and c not in rk]), "zstd")
    if not {"bearing_change_per_meter", "bearing_change_per_second"} <= set(df.columns):
        agg = df.groupBy(*rk).agg(F.sum("segment_distance").alias("_dist"), F.countDistinct("trip_id").alias("_trips"),
                                  F.countDistinct("stop_id").alias("_stops"), F.avg("speed").alias("avg_speed"))
        return _characteristics(agg, rk, F.lit(COMPLEXITY_DEFAULT))
    dist_m = F.col("segment_distance") > 0
    dur_m = F.col("segment_duration") > 0
    abs_m = F.abs("bearing_change_per_meter")
    abs_s = F.abs("bearing_change_per_second")
    agg = df.groupBy(*rk).agg(
        F.sum("segment_distance").alias("_dist"),
        F.countDistinct("trip_id").alias("_trips"),
        F.countDistinct("stop_id").alias("_stops"),
        F.avg("speed").alias("avg_speed"),
        F.avg(F.when(dist_m, abs_m)).alias("_mean_m"),
        F.avg(F.when(dur_m, abs_s)).alias("_mean_s"),
        F.avg((F.abs("bearing_change") > SHARP_TURN_DEG).cast("double")).alias("_sharp"),
    )
    # exact medians of both measures together (a route never gathered in one task)
    meds = exact_medians(df, rk, {"_med_m": F.when(dist_m, abs_m), "_med_s": F.when(dur_m, abs_s)})
    agg = agg.join(meds, rk, "left")
    score = (F.lit(COMPLEXITY_W_SPATIAL) * (F.col("_mean_m") / (F.col("_med_m") + F.lit(MEDIAN_EPS)))
             + F.lit(COMPLEXITY_W_TEMPORAL) * (F.col("_mean_s") / (F.col("_med_s") + F.lit(MEDIAN_EPS)))
             + F.lit(COMPLEXITY_W_SHARP) * F.col("_sharp"))
    score = F.when(score < 0, F.lit(0.0)).when(score > COMPLEXITY_MAX, F.lit(COMPLEXITY_MAX)).otherwise(score)
    return _characteristics(agg, rk, score)


def _characteristics(agg: DataFrame, rk: list[str], score: F.Column) -> DataFrame:
    return agg.select(
        *rk,
        F.expr("try_divide(_dist, _trips)").alias("avg_trip_length"),
        score.alias("complexity_score"),
        F.expr("CASE WHEN _dist <> 0 THEN _stops / _dist END").alias("stop_density"),
        "avg_speed",
    )


def _processed(dates) -> F.Column:
    """A date's place in the order in which dates are processed."""
    order = list(dict.fromkeys(str(d).replace("date=", "") for d in dates or ()))
    if not order:
        return F.struct("date")
    place = F.array_position(F.array(*map(F.lit, order)), F.col("date").cast("string"))
    return F.struct(F.when(place > 0, place).otherwise(len(order) + 1), "date")


def attach_route_characteristics(df: DataFrame, stats: DataFrame, stats_scope: str = "first_date",
                                 position_col: str | None = None, dates=None) -> DataFrame:
    """J7 + V4: broadcast route statistics back to each ping.

    ``stats_scope='first_date'`` (the reference): a route keeps the
    statistics of the date processed first for every later one: the first of
    ``dates`` that has the route, in that list's order (dates not listed come
    after it, the earliest first); ``'per_date'``: each date uses its own. ``position_col=None``
    reproduces the reference, whose position column never exists
    (``stops_remaining = total_route_stops``, ``progress_ratio = 0``).
    """
    if stats_scope == "first_date":
        s = stats.groupBy("route_id").agg(F.min_by(F.struct(*[c for c in stats.columns if c != "route_id"]), _processed(dates)).alias("_s"))
        s = s.select("route_id", "_s.*").drop("date")
        keys = ["route_id"]
    elif stats_scope == "per_date":
        s, keys = stats, ["date", "route_id"]
    else:
        raise ValueError("stats_scope must be 'first_date' or 'per_date'")
    s = s.select(*keys, F.col("avg_trip_length").alias("route_length"),
                 F.col("complexity_score").alias("route_complexity"),
                 F.col("stop_density").alias("route_stop_density"),
                 F.col("avg_speed").alias("route_avg_speed"))
    d = df.join(s, keys, "left")
    pos = F.lit(0) if position_col is None else F.col(position_col)
    return d.withColumns({
        "stops_remaining": F.col("total_route_stops") - pos,
        "progress_ratio": pos / F.col("total_route_stops"),
    })


def extract_all(df: DataFrame, rolling_scope: str = "trip", stats_scope: str = "first_date",
                position_col: str | None = None, dates=None, routes: DataFrame | None = None, stored: bool = True) -> DataFrame:
    """V5: temporal -> spatial -> route features over processed trips. Trips
    without their lists get them from ``routes``. The rows are not kept: with
    ``stored`` statistics the trips are worked out once for these and once for
    the rows; see :func:`route_characteristics`."""
    d = spatial_features(df, rolling_scope=rolling_scope).drop(*CARRY_COLS)
    if stored:      # turn rates and speed are worked out again from the columns that they come of
        of = ["date", "route_id", "trip_id", "stop_id", "segment_distance", "segment_duration", "bearing_change"]
        stats = materialize(route_characteristics(_speeds(materialize(d.select(*of), "zstd")), stored=False))
    else:
        stats = route_characteristics(d, stored=False)
    out = attach_route_characteristics(d, stats, stats_scope, position_col, dates)
    # the calendar needs the time alone: after the windows, which are narrower
    # for it, and out of their generated code, which was too long to compile
    if routes is not None:
        df, out = with_lists(df, routes), with_lists(out, routes)
    first = temporal_features(df.drop(*CARRY_COLS)).columns
    return temporal_features(out).select(*first, *[c for c in out.columns if c not in first])


# chunk-boundary columns added by the map-matching fold, dropped from the final output
CARRY_COLS = ["bucket", "_rows_before", "_next_bearing", "_prev_tails", "_next_speed0"]
