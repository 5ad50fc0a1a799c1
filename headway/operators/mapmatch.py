"""Monotone map-matching of GPS pings onto a route's stop sequence.

Per ping (row-parallel, static route side broadcast) we project the ping
and test it against every segment of its route: ``open`` is the list of
segment indexes the ping has not passed (segment length > 0 and projection
scalar t <= 1).

The reference then folds over the trip in time order with state ``m``:
``pos = min{i in open, i >= m}`` else ``n - 1``; ``m = pos``. That fold is
not a running max. Each ping's step ``m -> pos(m)`` is a monotone map on
``0..n-1``, and composing maps is associative. So a trip is cut into
time buckets (chunks) and folded in parallel:

1. chunk: sort its pings, compose their maps into ``F`` (an n-array); the
   trip's first chunk only needs the fold from ``m = 0``;
2. trip: the maps of all chunks before each one are composed by doubling (of
   each chunk with the one 1, 2, 4, ... before it), which gives its entry state;
3. chunk: fold from the entry state, keeping only *transitions* (<= n per
   chunk), and read each ping's position from them.

A chunk is a quarter of an hour of a trip; one with more than CHUNK_ROWS pings
is cut again at quantiles of (ts, seq). So event arrays are bounded by
CHUNK_ROWS, maps by the stop count, and a trip holds one narrow row per chunk.
The pings are shuffled once, by (date, route, trip, chunk); later steps reuse
that.

Only trips of more than WHOLE_ROWS pings are cut (:func:`fold_positions`). The
others are folded as a whole by windows over the trip (:func:`fold_trips`):
nothing is kept or joined back, and the one shuffle has no more columns than
the plan above it reads.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..session import keep
from .static import SEGS_SQL, materialize, stop_zones

TRIP_KEYS = ["date", "route_id", "trip_id"]
CHUNK_KEYS = TRIP_KEYS + ["bucket"]
# --- fixed values: chunk length of the parallel fold -----------------------
CHUNK_SECONDS = 900
CHUNK_ROWS = 8192
MAX_CUTS = 1023          # cuts of one chunk
SEGMENT_CELLS = 1 << 20  # zone rows x segments up to which the segments are broadcast (40 MB)
WHOLE_ROWS = 2048        # pings up to which a trip is folded as a whole
COUNTERS = 1 << 22       # counters that find the trips with more
WORD = 63                # segments in a mask
# ---------------------------------------------------------------------------

_ROUTE_COLS = ["ids", "dists", "stops", "n"]


def attach_route(pings: DataFrame, routes: DataFrame, more=()) -> DataFrame:
    """Pings -> their route row (``int(route_id)`` match, inner join), with
    the columns ``more``, too.

    Pings of a route without a sequence are dropped (training behaviour).
    """
    r = routes.select(F.col("route_id").alias("_rid"), *_ROUTE_COLS, *more)
    p = pings.withColumn("_rk", F.expr("try_cast(route_id AS BIGINT)"))
    return p.join(r, p["_rk"] == r["_rid"]).drop("_rid")


def apart(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, of which no more are made: what
    follows is generated as methods of its own. With the cleaning of the pings
    the projection exceeds 8,000 bytes, above which the JVM compiles no method."""
    return df.coalesce(1 << 24)


def projected(df: DataFrame) -> DataFrame:
    """Adds ``pzone, psouth, px, py``: each ping in its own UTM zone."""
    df = df.withColumns({"pzone": F.expr(geo.zone_sql("longitude")),
                         "psouth": F.expr(geo.south_sql("latitude"))})
    return geo.with_utm(df, "latitude", "longitude", "px", "py", zone="pzone", south="psouth")


def with_projection(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Project each ping in its own UTM zone and attach the route's stops and
    segments projected in that same zone (pre-computed per route and zone;
    computed on the fly only for a ping outside its route's zones)."""
    df = projected(df)
    z = stop_zones(routes).select(F.col("route_id").alias("_zr"), F.col("zone").alias("_zz"),
                                  F.col("south").alias("_zs"), F.col("pts").alias("_zpts"),
                                  F.col("segs").alias("_zsegs"))
    df = df.join(z, (df["_rk"] == z["_zr"]) & (df["pzone"] == z["_zz"]) & (df["psouth"] == z["_zs"]),
                 "left").drop("_zr", "_zz", "_zs")
    df = df.withColumn("pts", F.expr(
        f"coalesce(_zpts, {geo.utm_array_sql('stops', 'lat', 'lon', 'pzone', 'psouth')})"))
    df = df.withColumn("segs", F.expr(f"CASE WHEN _zsegs IS NOT NULL THEN _zsegs ELSE {SEGS_SQL} END"))
    return df.drop("_zpts", "_zsegs")


OPEN_SQL = ("filter(transform(segs, (s, i) -> CASE WHEN s.l2 > 0 AND NOT "
            "((px - s.ax) * s.dx + (py - s.ay) * s.dy > s.l2) THEN i END), i -> i IS NOT NULL)")


#: A ping's step as an array over the states: to each the first open segment at or after it.
STEP_SQL = ("concat(flatten(transform(open, (o, k) -> array_repeat(o, o - CASE WHEN k > 0 THEN open[k - 1] ELSE -1 END))), "
            "array_repeat(n - 1, n - 1 - coalesce(array_max(open), -1)))")


T_SQL = "((px - s.ax) * s.dx + (py - s.ay) * s.dy) / s.l2"
#: What the route's segments say of a ping, one element per segment (``open``: their indexes).
SEGMENT_SQL = {
    "open": OPEN_SQL,
    "t": f"transform(segs, s -> CASE WHEN s.l2 > 0 THEN {T_SQL} END)",
    "perp": (f"transform(segs, s -> CASE WHEN s.l2 > 0 THEN sqrt(power((px - s.ax) - {T_SQL} * s.dx, 2) + "
             f"power((py - s.ay) - {T_SQL} * s.dy, 2)) END)"),
    "gps_len": "transform(segs, s -> sqrt(power(px - s.ax, 2) + power(py - s.ay, 2)))",
}


class Segments(NamedTuple):
    """Rows of :func:`static.stop_zones` by their ascending ``zone_row``: their
    segments' values, filled up with segments of no length, and their number."""
    zone_row: np.ndarray
    size: np.ndarray
    ax: np.ndarray
    ay: np.ndarray
    dx: np.ndarray
    dy: np.ndarray
    l2: np.ndarray


def _segments(zones: DataFrame) -> Segments | None:
    """None where there are none, or more than :data:`SEGMENT_CELLS`."""
    rows, most = zones.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("segs")), F.lit(0))).first()
    if not 0 < rows * max(most, 1) <= SEGMENT_CELLS:
        return None
    got = sorted(zones.select("zone_row", "segs").collect())
    values = np.zeros((5, rows, max(most, 1)))
    for i, (_, segs) in enumerate(got):
        if segs:
            values[:, i, :len(segs)] = np.array([tuple(s) for s in segs], dtype=np.float64).T
    return Segments(np.array([r for r, _ in got], dtype=np.int64), np.array([len(s) for _, s in got], dtype=np.int64), *values)


def _lists(values: np.ndarray, held: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """The values of each row that it holds, null where not valid."""
    off = np.zeros(len(held) + 1, dtype=np.int32)
    np.cumsum(held.sum(axis=1), out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values[held], mask=None if valid is None else ~valid[held]))


def by_segment(x: Segments, names: tuple[str, ...], zone_row: np.ndarray, px: np.ndarray, py: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """STEP_SQL (``step``), SEGMENT_SQL and masks (see :func:`mask_sql`) of a
    batch of pings, all segments at once."""
    at = np.minimum(np.searchsorted(x.zone_row, zone_row), len(x.zone_row) - 1)
    l2, states = x.l2[at], x.l2.shape[1] + 1
    dx, dy = px[:, None] - x.ax[at], py[:, None] - x.ay[at]
    along = dx * x.dx[at] + dy * x.dy[at]
    held = np.arange(states - 1) < x.size[at][:, None]
    opened = (l2 > 0) & ~((along > l2) | np.isnan(along))    # SQL's NaN is above all
    long = ~(l2 <= 0)
    out = []
    for name in names:
        if name == "step":
            first = np.full((len(at), states), states, dtype=np.int32)
            first[:, :-1] = np.where(opened, np.arange(states - 1), states)
            first = np.minimum.accumulate(first[:, ::-1], axis=1)[:, ::-1]
            first = np.where(first == states, n[:, None] - 1, first).astype(np.int32)
            out.append(_lists(first, np.arange(states) < n[:, None]))
        elif name == "open":
            out.append(_lists(np.broadcast_to(np.arange(states - 1, dtype=np.int32), opened.shape), opened))
        elif name.startswith("mask"):
            bits = opened[:, WORD * int(name[4:]):][:, :WORD]
            out.append(pa.array((bits * (1 << np.arange(WORD - 1, WORD - 1 - bits.shape[1], -1, dtype=np.int64))).sum(axis=1, dtype=np.int64)))
        elif name == "gps_len":
            out.append(_lists(np.sqrt(dx * dx + dy * dy), held))
        else:
            t = along / np.where(long, l2, 1)
            if name == "perp":
                off_x, off_y = dx - t * x.dx[at], dy - t * x.dy[at]
                t = np.sqrt(off_x * off_x + off_y * off_y)
            out.append(_lists(t, held, long))
    return out


def _by_segment(table: Broadcast, names: tuple[str, ...]):
    types = {"step": "array<int>", "open": "array<int>", "mask": "bigint"}

    @F.arrow_udf("struct<" + ", ".join(f"{name}: {types.get(name.rstrip('0123456789'), 'array<double>')}" for name in names) + ">")
    def of(zone_row: pa.Array, px: pa.Array, py: pa.Array, n: pa.Array) -> pa.Array:
        px, py, n = (c.to_numpy(zero_copy_only=False) for c in (px, py, n))
        return pa.StructArray.from_arrays(by_segment(table.value, names, zone_row.fill_null(0).to_numpy(zero_copy_only=False), px, py, n), list(names))
    return of


def with_segments(df: DataFrame, routes: DataFrame, *names: str) -> DataFrame:
    """Adds columns of SEGMENT_SQL, ``step`` (see STEP_SQL) and masks (see
    :func:`mask_sql`) to pings with their route's columns; those of the route
    but ``n`` go.

    The segments of all routes and zones are broadcast and tested by batch; a
    ping outside its route's zones has them projected on the fly. Of a network
    with too many segments to broadcast, they are joined to the pings."""
    masks = [name for name in names if name.startswith("mask")]
    expressions = {k: F.expr(v) for k, v in SEGMENT_SQL.items() if k in names or k == "open" and ("step" in names or masks)}
    zones = materialize(stop_zones(routes).withColumn("zone_row", F.monotonically_increasing_id()))
    table = _segments(zones)
    if table is None:
        df = with_projection(df, routes).withColumns(expressions)
        df = df.withColumn("step", F.expr(STEP_SQL)) if "step" in names else df
        df = df.withColumns({name: F.expr(mask_sql(name)) for name in masks})
        return df.drop("ids", "dists", "stops", "pts", "segs", *(set(expressions) - set(names)))
    z = zones.select(F.col("route_id").alias("_zr"), F.col("zone").alias("_zz"), F.col("south").alias("_zs"), "zone_row")
    df = projected(apart(df))
    df = df.join(z, (df["_rk"] == z["_zr"]) & (df["pzone"] == z["_zz"]) & (df["psouth"] == z["_zs"]), "left").drop("_zr", "_zz", "_zs")
    # on the fly, before the batches, which then go without the route's stops
    for name, sql in (("pts", geo.utm_array_sql("stops", "lat", "lon", "pzone", "psouth")), ("segs", SEGS_SQL)):
        df = df.withColumn(name, F.expr(f"CASE WHEN zone_row IS NULL THEN {sql} END"))
    df = df.drop("ids", "dists", "stops", "pts")
    df = df.withColumn("_by", _by_segment(df.sparkSession.sparkContext.broadcast(table), names)("zone_row", "px", "py", "n"))
    # segs twice, so that the planner doesn't work them out here, above the batches
    own = {k: f"CASE WHEN zone_row IS NOT NULL THEN {f'_by.{k}' if k in names else 'NULL'} WHEN segs IS NOT NULL THEN {SEGMENT_SQL[k]} END" for k in expressions}
    df = df.withColumns({k: F.expr(v) for k, v in own.items()})
    if "step" in names:
        df = df.withColumn("step", F.expr(f"CASE WHEN zone_row IS NULL THEN {STEP_SQL} ELSE _by.step END"))
    df = df.withColumns({name: F.expr(f"CASE WHEN zone_row IS NULL THEN {mask_sql(name)} ELSE _by.{name} END") for name in masks})
    return df.drop("zone_row", "_by", "segs", *(set(expressions) - set(names)))


def mask_sql(name: str) -> str:
    """``open`` as bits, the first segment highest, so that of two steps the
    smaller has the greater mask: ``mask0`` has the first WORD segments, ``mask1`` the next."""
    k = int(name[4:])
    bit = f"CASE WHEN i DIV {WORD} = {k} THEN shiftleft(1L, cast({WORD - 1} - i % {WORD} AS INT)) ELSE 0L END"
    return f"coalesce(aggregate(open, 0L, (a, i) -> a | {bit}), 0L)"


def with_masks(df: DataFrame, routes: DataFrame) -> tuple[DataFrame, list[str]]:
    """Adds as many masks as the longest route needs, and their names."""
    most = routes.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    names = [f"mask{k}" for k in range(max(1, -(-(most - 1) // WORD)))]
    return with_segments(df, routes, *names), names


def with_steps(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Adds ``step`` (see STEP_SQL) to pings with their route's columns."""
    return with_segments(df, routes, "step")


def fold_sql(events: str, m0: str) -> str:
    """Fold from ``m0`` over sorted events, keeping transitions (j, pos, ts).

    The step is evaluated once per event: a one-element inner ``aggregate``
    binds it to ``p``.
    """
    empty = "CAST(array() AS ARRAY<STRUCT<j: INT, pos: INT, ts: TIMESTAMP>>)"
    return (f"aggregate({events}, named_struct('m', {m0}, 'j', 0, 'tr', {empty}), (acc, e) -> "
            f"aggregate(array(e.step[acc.m]), acc, (a, p) -> named_struct('m', p, 'j', a.j + 1, 'tr', "
            f"CASE WHEN a.j = 0 OR p <> a.m THEN concat(a.tr, array(named_struct('j', a.j, 'pos', p, 'ts', e.ts))) "
            f"ELSE a.tr END)))")


COMPOSE_SQL = "aggregate(ev, sequence(0, n - 1), (acc, e) -> transform(acc, v -> e.step[v]))"


def with_chunks(pings: DataFrame, chunk_seconds: int = CHUNK_SECONDS, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, int]:
    """Adds ``bucket``: the ping's chunk within its trip, ascending by (ts, seq);
    and the number of doublings that reach over the chunks of any trip.

    The chunks' sizes are counted first, from the keys alone. Those above
    ``chunk_rows`` are cut at quantiles of the place of (ts, seq) between their
    first and last ping, so a trip with a large part of all rows in a few
    seconds spreads as well; rows alike in both stay together."""
    own = [*TRIP_KEYS, "bucket"]
    pings = pings.withColumn("bucket", F.expr(f"unix_micros(ts) div {int(chunk_seconds) * 1_000_000}"))
    sizes = materialize(pings.where("trip_id IS NOT NULL").groupBy(*own).agg(F.count(F.lit(1)).alias("rows"), F.min("seq").alias("lo"), F.max("seq").alias("hi")))
    pieces = F.least(F.ceil(F.col("rows") / chunk_rows), F.lit(MAX_CUTS + 1))
    most = sizes.groupBy(*TRIP_KEYS).agg(F.sum(pieces).alias("k")).agg(F.coalesce(F.max("k"), F.lit(1))).first()[0]
    rounds = max(0, int(most) - 1).bit_length()
    large = sizes.where(F.col("rows") > chunk_rows).select(*own, "lo", "hi", pieces.alias("pieces"))
    if large.isEmpty():
        return pings, rounds
    # monotone in (ts, seq): microseconds into the chunk, and between them the place among the seqs
    place = F.expr(f"unix_micros(ts) - bucket * {int(chunk_seconds) * 1_000_000}") + (F.col("seq").cast("double") - F.col("lo")) / (F.col("hi").cast("double") - F.col("lo") + 1) * (1 - 2.0**-20)
    shares = F.array(*[F.lit(i / (MAX_CUTS + 1)) for i in range(1, MAX_CUTS + 1)])
    cuts = (pings.select(*own, "ts", "seq").join(large, own).withColumn("place", place)
            .groupBy(*own).agg(F.percentile_approx("place", shares, 100_000).alias("at"), F.first("pieces").alias("pieces"), F.first("lo").alias("lo"), F.first("hi").alias("hi")))
    at = F.expr(f"transform(sequence(1, cast(pieces as int) - 1), i -> at[cast(i * {MAX_CUTS + 1} / pieces as int) - 1])")
    cuts = materialize(cuts.select(*own, "lo", "hi", at.alias("cuts")))
    pings = pings.join(cuts, own, "left").withColumn("_place", place)
    part = F.coalesce(F.expr("size(filter(cuts, c -> c < _place))"), F.lit(0))
    return pings.withColumn("bucket", F.col("bucket") * (MAX_CUTS + 1) + F.when(F.col("cuts").isNull(), 0).otherwise(part)).drop("lo", "hi", "cuts", "_place"), rounds


def map_match(pings: DataFrame, routes: DataFrame, chunk_seconds: int = CHUNK_SECONDS, chunk_rows: int = CHUNK_ROWS, whole_rows: int = WHOLE_ROWS) -> DataFrame:
    """Add ``route_position`` (INT) to every ping; drops pings without a route.

    Output keeps the input columns plus ``n`` and ``route_position`` and is
    hash-partitioned by (date, route_id, trip_id), unless there are trips of
    more than ``whole_rows`` pings: those are folded by chunk.
    """
    if "date" not in pings.columns:
        pings = pings.withColumn("date", F.to_date("ts"))
    pings = with_order(pings)
    base_cols = pings.columns
    pings = pings.where("trip_id IS NOT NULL")
    large = large_trips(pings, whole_rows)
    whole = pings if large is None else pings.join(large, TRIP_KEYS, "left_anti")
    whole, masks = with_masks(attach_route(whole, routes), routes)
    # only the pings' own columns, the masks and n are shuffled
    out = fold_trips(whole.select(*base_cols, "n", *masks), base_cols, routes, masks)
    if large is None:
        return out
    cut, rounds = with_chunks(pings.join(large, TRIP_KEYS, "left_semi"), chunk_seconds, chunk_rows)
    cut = with_steps(attach_route(cut, routes), routes).select(*base_cols, "bucket", "n", "step")
    return out.unionByName(fold_positions(cut, base_cols, routes=routes, rounds=rounds))


def large_trips(pings: DataFrame, rows: int, counters: int = COUNTERS) -> DataFrame | None:
    """The keys of the trips with more than ``rows`` pings, stored; None without any.

    Trips are counted together where their hashes meet, by a short key; those of
    counters above ``rows`` are then counted one by one."""
    keys = pings.select(*TRIP_KEYS, F.pmod(F.xxhash64(*TRIP_KEYS), F.lit(counters)).cast("int").alias("_h"))
    above = F.col("count") > rows
    full = materialize(keys.groupBy("_h").count().where(above).select("_h"))
    if full.isEmpty():
        return None
    large = materialize(keys.join(full, "_h", "left_semi").groupBy(*TRIP_KEYS).count().where(above).select(*TRIP_KEYS))
    return None if large.isEmpty() else large


def trip_fold_sql(masks: list[str]) -> str:
    """Fold from 0 over a trip's sorted masks (``_<mask>``: one list for each)
    and times ``_t``, keeping only transitions (j, pos, ts)."""
    left = [f"(_{name}[j] & shiftrightunsigned(9223372036854775807L, least(greatest(acc.m - {WORD * k}, 0), {WORD})))" for k, name in enumerate(masks)]
    pos = " ".join(f"WHEN {x} > 0 THEN {WORD * (k + 1)} - length(bin({x}))" for k, x in enumerate(left))
    empty = "CAST(array() AS ARRAY<STRUCT<j: INT, pos: INT, ts: TIMESTAMP>>)"
    return (f"aggregate(sequence(0, size(_t) - 1), named_struct('m', 0, 'tr', {empty}), (acc, j) -> "
            f"aggregate(array(CASE {pos} ELSE n - 1 END), acc, (a, p) -> named_struct('m', p, 'tr', "
            f"CASE WHEN j = 0 OR p <> a.m THEN concat(a.tr, array(named_struct('j', j, 'pos', p, 'ts', _t[j]))) ELSE a.tr END))).tr")


#: A trip's positions by its transitions and number of pings.
PLACES_SQL = "flatten(transform(_tr0, (t, k) -> array_repeat(t.pos, coalesce(try_element_at(_tr0, k + 2).j, _size) - t.j)))"
#: The first arrival (J5 / A10) at every stop among a trip's transitions.
FIRST_ARRIVAL_SQL = ("map_from_entries(transform(array_distinct(transform(_tr0, t -> ids[t.pos])), s -> struct(s AS stop_id, "
                     "array_min(transform(filter(_tr0, t -> ids[t.pos] = s), t -> t.ts)) AS ts)))")


def fold_trips(p: DataFrame, base_cols: list[str], routes: DataFrame, masks: list[str]) -> DataFrame:
    """The fold over pings carrying masks and ``n``, each trip as a whole; the
    columns of :func:`fold_positions`, with one chunk per trip.

    A trip's masks and times are listed by a window; its transitions and by them
    the first arrivals are made once, at its first ping, and given to the others
    by a second window. All windows have the trip's pings in one order."""
    own = [c for c in base_cols if c not in TRIP_KEYS]
    p = p.where("date IS NOT NULL AND ts IS NOT NULL")
    trip = Window.partitionBy(*TRIP_KEYS)
    # pings alike in ts and seq in the order of their steps
    order = trip.orderBy("ts", "seq", *map(F.desc, masks))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p = p.withColumns({"_first": F.row_number().over(order) == 1, "_size": F.count(F.lit(1)).over(whole).cast("int"), "_t": F.collect_list("ts").over(whole),
                       **{f"_{name}": F.collect_list(name).over(whole) for name in masks}})
    p = p.withColumn("_tr0", F.expr(f"CASE WHEN _first THEN {trip_fold_sql(masks)} END")).drop("_t", *[f"_{name}" for name in masks])
    r = routes.select(F.col("route_id").alias("_rid"), "ids")
    p = p.withColumn("_rk", F.expr("try_cast(route_id AS BIGINT)"))
    p = p.join(r, p["_rk"] == r["_rid"])
    p = p.withColumn("_fa0", F.expr(f"CASE WHEN _first THEN {FIRST_ARRIVAL_SQL} END"))
    # by position in the route, looked up once per trip instead of per ping and stop
    p = p.withColumn("_at0", F.expr("CASE WHEN _first THEN transform(ids, s -> try_element_at(_fa0, s)) END"))
    # the position of every ping, four bytes each
    p = p.withColumn("_at", F.expr(f"CASE WHEN _first THEN {PLACES_SQL} END"))
    p = p.withColumns({name: F.first(c, ignorenulls=True).over(whole) for name, c in (("_places", "_at"), ("first_arrival", "_fa0"), ("_arrivals", "_at0"))}
                      # those alike in ts and seq have one position, the last
                      | {"_upto": F.count(F.lit(1)).over(trip.orderBy("ts", "seq").rangeBetween(Window.unboundedPreceding, Window.currentRow))})
    p = p.withColumn("route_position", F.expr("_places[cast(_upto - 1 AS INT)]"))
    out = [*TRIP_KEYS, *own, "n", "route_position", "first_arrival", "_arrivals", F.lit(0).cast("bigint").alias("bucket")]
    if all(c in base_cols for c in ("latitude", "longitude", "bearing")):
        head = "ts: {ts}, latitude: {latitude}, longitude: {longitude}, bearing: {bearing}".format(**dict(p.dtypes))
        out += [F.lit(0).cast("bigint").alias("_rows_before"), F.expr(f"CAST(array() AS array<struct<{head}>>)").alias("_next_heads"),
                F.expr("CAST(array() AS array<double>)").alias("_prev_tails"), F.lit(0.0).alias("_next_speed0")]
    return p.select(*out)


def with_order(pings: DataFrame) -> DataFrame:
    """Adds ``seq`` where the pings carry none: a hash of the whole row, so
    pings of one time have one order everywhere, in every run. Pings alike in
    all columns are interchangeable."""
    if "seq" in pings.columns:
        return pings
    return pings.withColumn("seq", F.xxhash64(*[F.col(f"`{c}`") for c in pings.columns]))


def _join_back(c1: DataFrame, summary: DataFrame) -> DataFrame:
    """Attach per-chunk results of a trip-level window to the chunk rows.

    The chunk rows stay where they are (already hash-partitioned by the
    chunk key); only the narrow summary moves.
    """
    return c1.join(summary, CHUNK_KEYS)


def fold_positions(p: DataFrame, base_cols: list[str], chunk_seconds: int = CHUNK_SECONDS,
                   routes: DataFrame | None = None, rounds: int | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The chunked fold over pings carrying ``open`` or ``step``, and ``n`` (and, if
    ``rounds`` is given, ``bucket``; see :func:`with_chunks`).

    ``base_cols`` are the ping columns to keep (must include the trip keys,
    ``ts`` and ``seq``). Adds ``route_position``, ``bucket`` and the
    per-trip ``first_arrival`` map. The route's stop ids come from
    ``routes`` (joined per chunk) or from an ``ids`` column on the pings.

    Pings are hash-partitioned once, by (date, route, trip, bucket), so a
    trip with many pings spreads over many tasks. Only narrow events
    ``(ts, seq, step[, lat, lon, bearing])`` are gathered per chunk; the
    fold yields one small row per chunk (transitions, first arrivals,
    boundary carries) that is hash-joined back to the pings of the same
    partition. Trip-level facts come from windows over one summary row
    per chunk:

    * ``_rows_before``: pings of the trip before this chunk;
    * ``_next_heads``: the first two pings after this chunk;
    * ``_next_speed0``: speed of the first ping after this chunk;
    * ``_prev_tails``: |bearing change| of the last (up to) four pings
      before this chunk, oldest first.
    """
    if rounds is None:
        p, rounds = with_chunks(p, chunk_seconds, chunk_rows)
    if routes is not None:
        p = p.drop("ids")
    if "step" not in p.columns:
        p = p.withColumn("step", F.expr(STEP_SQL)).drop("open")
    # the shuffled pings are read twice (chunk events, and the final join of the
    # per-chunk results): keep them on the executors, spilling to disk
    p = keep(p.repartition(*CHUNK_KEYS))
    carry = all(c in base_cols for c in ("latitude", "longitude", "bearing"))
    ev = F.struct("ts", "seq", "step", *(["latitude", "longitude", "bearing"] if carry else []))
    aggs = [F.sort_array(F.collect_list(ev)).alias("ev"), F.first("n").alias("n")]
    if routes is None:
        aggs.append(F.first("ids").alias("ids"))
    c1 = p.groupBy(*CHUNK_KEYS).agg(*aggs)
    if routes is not None:
        r = routes.select(F.col("route_id").alias("_rid"), "ids")
        c1 = c1.withColumn("_rk", F.expr("try_cast(route_id AS BIGINT)"))
        c1 = c1.join(r, c1["_rk"] == r["_rid"]).drop("_rk", "_rid")
    # the chunk table feeds three summaries and the fold: keep it on the
    # executors (spilling to disk) instead of re-aggregating it per branch
    c1 = keep(c1)
    trip = Window.partitionBy(*TRIP_KEYS)
    ob = trip.orderBy("bucket")
    before = ob.rowsBetween(Window.unboundedPreceding, -1)

    # phase A: chunk order facts and boundary carries
    sa = c1.select(*CHUNK_KEYS, F.size("ev").alias("_cnt"), *([
        F.expr("transform(slice(ev, 1, 2), e -> named_struct('ts', e.ts, 'latitude', e.latitude, "
               "'longitude', e.longitude, 'bearing', e.bearing))").alias("_head2"),
        F.expr("transform(slice(ev, greatest(-4, -size(ev)), least(4, size(ev))), e -> e.bearing)")
        .alias("_tail4")] if carry else []))
    sa = sa.withColumns({
        "is_first": F.col("bucket") == F.min("bucket").over(trip),
        "_rows_before": F.coalesce(F.sum("_cnt").over(before), F.lit(0)),
    })
    facts = ["is_first", "_rows_before"]
    if carry:
        sa = sa.withColumn("_nh", F.collect_list("_head2").over(ob.rowsBetween(1, 2)))
        sa = sa.withColumn("_next_heads", F.expr("slice(flatten(_nh), 1, 2)"))
        # |bearing change| of this chunk's last rows; the last one looks at the
        # first bearing after the chunk (0 at the end of the trip)
        sa = sa.withColumn("_tail_abs", F.expr(
            "transform(_tail4, (b, i) -> abs(coalesce(b - CASE WHEN i + 1 < size(_tail4) THEN _tail4[i + 1] "
            "ELSE try_element_at(_next_heads, 1).bearing END, 0e0)))"))
        sa = sa.withColumn("_pt", F.flatten(F.collect_list("_tail_abs").over(ob.rowsBetween(-4, -1))))
        sa = sa.withColumn("_prev_tails", F.expr(
            "CASE WHEN size(_pt) = 0 THEN _pt ELSE slice(_pt, -least(4, size(_pt)), least(4, size(_pt))) END"))
        # speed of the first ping after the chunk: its segment to the ping after it
        sa = sa.withColumns({
            "_h0lat": F.expr("try_element_at(_next_heads, 1).latitude"),
            "_h0lon": F.expr("try_element_at(_next_heads, 1).longitude"),
            "_h1lat": F.expr("coalesce(try_element_at(_next_heads, 2).latitude, try_element_at(_next_heads, 1).latitude)"),
            "_h1lon": F.expr("coalesce(try_element_at(_next_heads, 2).longitude, try_element_at(_next_heads, 1).longitude)"),
            "_hdur": F.expr("(unix_micros(coalesce(try_element_at(_next_heads, 2).ts, try_element_at(_next_heads, 1).ts)) "
                            "- unix_micros(try_element_at(_next_heads, 1).ts)) / 1e6"),
        })
        sa = geo.with_distance(sa, "_h0lat", "_h0lon", "_h1lat", "_h1lon", "_hdist")
        sa = sa.withColumn("_next_speed0", F.expr("CASE WHEN _hdur > 0 THEN _hdist / _hdur ELSE 0e0 END"))
        facts += ["_next_heads", "_prev_tails", "_next_speed0"]
    c1 = _join_back(c1, sa.select(*CHUNK_KEYS, *facts))

    # phase B: chunk maps -> entry state of every chunk
    c1 = c1.withColumns({
        "comp": F.expr(f"CASE WHEN NOT is_first THEN {COMPOSE_SQL} END"),
        "tr0": F.expr(f"CASE WHEN is_first THEN {fold_sql('ev', '0')} END"),
    })
    # what the chunks up to each one, back to the trip's first, make of any state
    sb = c1.select(*CHUNK_KEYS, F.expr("CASE WHEN is_first THEN array_repeat(tr0.m, n) ELSE comp END").alias("_map"))
    for i in range(rounds):
        sb = sb.withColumn("_lag", F.lag("_map", 1 << i).over(ob))
        sb = sb.withColumn("_map", F.expr("CASE WHEN _lag IS NULL THEN _map ELSE transform(_lag, v -> _map[v]) END"))
    sb = sb.select(*CHUNK_KEYS, F.expr("coalesce(try_element_at(lag(_map) OVER (PARTITION BY date, route_id, trip_id ORDER BY bucket), 1), 0)").alias("m0"))
    c3 = _join_back(c1.drop("comp"), sb)
    c3 = c3.withColumn("tr", F.expr(f"CASE WHEN is_first THEN tr0.tr ELSE {fold_sql('ev', 'm0')}.tr END"))
    # transitions keyed by (ts, seq) of the event where they happen
    c3 = c3.withColumn("tr", F.expr(
        "transform(tr, t -> named_struct('k', named_struct('ts', ev[t.j].ts, 'seq', ev[t.j].seq), "
        "'pos', t.pos, 'ts', t.ts))"))

    # phase C: first arrival at each stop id over the whole trip.
    # Positions are monotone, so first arrivals are fold transitions.
    c3 = keep(c3.select(*CHUNK_KEYS, "tr", "ids", *facts[1:], F.expr("transform(tr, t -> named_struct('stop_id', ids[t.pos], 'ts', t.ts))").alias("_a")))
    first = (c3.select(*TRIP_KEYS, F.explode("_a").alias("a"))
             .groupBy(*TRIP_KEYS, "a.stop_id").agg(F.min("a.ts").alias("ts")))
    first = first.groupBy(*TRIP_KEYS).agg(F.map_from_entries(F.collect_list(F.struct("stop_id", "ts"))).alias("first_arrival"))
    c3 = c3.drop("_a").join(first, TRIP_KEYS)
    # by position in the route, looked up once per chunk instead of per ping and stop
    c3 = c3.withColumn("_arrivals", F.expr("transform(ids, s -> try_element_at(first_arrival, s))")).drop("ids")

    # back to the pings of the same partition: one small row per chunk
    out = p.join(c3, CHUNK_KEYS)
    # (ts, seq) compared part by part, nulls first: a struct would be made for every transition
    out = out.withColumn("route_position", F.expr(
        "element_at(tr, size(filter(tr, t -> t.ts < ts OR t.ts = ts AND (t.k.seq IS NULL OR t.k.seq <= seq)))).pos"))
    own = [c for c in base_cols if c not in CHUNK_KEYS]
    return out.select(*TRIP_KEYS, *own, "n", "route_position", "first_arrival", "_arrivals", "bucket", *facts[1:])


# ---- stateless locate for one query ping (inference, G6-G8) ---------------

LOCATE_SQL = (
    "coalesce(array_min(filter(transform(segs, (s, i) -> CASE WHEN s.l2 > 0 AND "
    "((px - s.ax) * s.dx + (py - s.ay) * s.dy) / s.l2 BETWEEN 0e0 AND 1e0 AND "
    "sqrt(power((px - s.ax) - ((px - s.ax) * s.dx + (py - s.ay) * s.dy) / s.l2 * s.dx, 2) + "
    "power((py - s.ay) - ((px - s.ax) * s.dx + (py - s.ay) * s.dy) / s.l2 * s.dy, 2)) "
    "<= greatest(1e2, sqrt(s.l2) * 5e-1) AND "
    "sqrt(power(px - s.ax, 2) + power(py - s.ay, 2)) <= sqrt(s.l2) * 1.5e0 THEN i END), "
    "i -> i IS NOT NULL)), n - 1)")


def locate(pings: DataFrame, routes: DataFrame) -> DataFrame:
    """First segment with 0 <= t <= 1 whose perpendicular offset is within
    max(100 m, half its length) and whose start is within 1.5 lengths; else
    the last stop. Adds ``route_position`` (and the route columns)."""
    p = attach_route(pings, routes)
    p = with_projection(p, routes)
    return p.withColumn("route_position", F.expr(LOCATE_SQL))
