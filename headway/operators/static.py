"""Static network tables: stop lookup (J1), stop-to-stop distances (W2), and
the per-route table every trip operator broadcasts.

Static tables are stored as Parquet, so the planner knows their bytes: it
broadcasts them below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
them beyond it. No join carries a broadcast hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import scratch_path


#: Whether the shuffle files of a write go with its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write a derived table as Parquet to the shared folder and read it back:
    plans that use it scan only the columns they need and know its bytes, and
    a lost executor costs nothing written. The shuffle files of the write are
    dropped when it is done, not when the driver happens to collect its garbage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "table")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def parse_stop_list(col: str) -> F.Column:
    """Python list literal text ``"['a', 'b']"`` -> ARRAY<STRING>."""
    cleaned = F.regexp_replace(F.col(col), r"[\[\]'\" ]", "")
    return F.when(cleaned == "", F.array().cast("array<string>")).otherwise(F.split(cleaned, ","))


def join_sequence_stops(sequences: DataFrame, stops: DataFrame) -> DataFrame:
    """Every stop of every route with its coordinates, order kept.

    Returns ``route_id, pos, stop_id, stop_lat, stop_lon, known``; an unknown
    stop (the reference raises) is kept with ``known = false`` so callers can
    quarantine the route instead of failing the whole job.
    """
    rs = sequences.select("route_id", F.posexplode("stop_id_list").alias("pos", "stop_id"))
    st = stops.select("stop_id", "stop_lat", "stop_lon").dropDuplicates(["stop_id"])
    j = rs.join(st, "stop_id", "left")
    return j.select("route_id", "pos", "stop_id", "stop_lat", "stop_lon",
                    F.col("stop_lat").isNotNull().alias("known"))


def first_rows(sequences: DataFrame) -> DataFrame:
    """The first row of every route id, in the order of the table's files."""
    rest = [c for c in sequences.columns if c != "route_id"]
    f = sequences.withColumn("_row", F.monotonically_increasing_id()).groupBy("route_id").agg(F.min_by(F.struct(*rest), "_row").alias("_f"))
    return f.select("route_id", "_f.*")


def next_stop_distances(sequences: DataFrame, stops: DataFrame) -> DataFrame:
    """``route_id, stop_id_list, next_stop_distances`` (last = 0).

    Distances are planar UTM metres in the zone of the route's first stop,
    rounded half-to-even to 0.1 m. Of a repeated route id the first row counts.
    Routes with an unknown stop are left out; :func:`quarantined` lists them.
    """
    j = join_sequence_stops(first_rows(sequences), stops)
    per_route = (j.groupBy("route_id")
                 .agg(F.sort_array(F.collect_list(F.struct("pos", "stop_id", "stop_lat", "stop_lon")))
                      .alias("st"), F.min(F.col("known").cast("int")).alias("ok"))
                 .where("ok = 1"))
    # zone of the route's first stop (the reference projects the whole route there)
    z0, s0 = geo.zone_sql("st[0].stop_lon"), geo.south_sql("st[0].stop_lat")
    per_route = per_route.withColumn("pts", F.expr(geo.utm_array_sql("st", "stop_lat", "stop_lon", z0, s0)))
    dist = F.expr("transform(pts, (p, i) -> rint(sqrt(power(pts[least(i + 1, size(pts) - 1)].x - p.x, 2) "
                  "+ power(pts[least(i + 1, size(pts) - 1)].y - p.y, 2)) * 1e1) / 1e1)")
    return per_route.select(
        "route_id",
        F.expr("transform(st, s -> s.stop_id)").alias("stop_id_list"),
        dist.alias("next_stop_distances"))


def quarantined(sequences: DataFrame, stops: DataFrame) -> DataFrame:
    """``route_id, unknown_stops``: the routes that W2 leaves out, and why."""
    j = join_sequence_stops(first_rows(sequences), stops).where("NOT known")
    return j.groupBy("route_id").agg(F.sort_array(F.collect_set("stop_id")).alias("unknown_stops"))


def route_table(sequences: DataFrame, stops: DataFrame) -> DataFrame:
    """Per route: ids, distances, ordered stop coordinates and stop count.

    ``sequences`` must carry ``next_stop_distances`` (output of W2). The
    first row wins when a route id is duplicated (J2's pre-dedupe).
    """
    seq = first_rows(sequences)
    j = join_sequence_stops(seq, stops)
    geo_rows = (j.groupBy("route_id")
                .agg(F.sort_array(F.collect_list(F.struct(
                    "pos", "stop_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))))
                     .alias("stops"), F.min(F.col("known").cast("int")).alias("ok"))
                .where("ok = 1").drop("ok"))
    return (seq.select("route_id", F.col("stop_id_list").alias("ids"),
                       F.col("next_stop_distances").alias("dists"))
            .join(geo_rows, "route_id")
            .withColumn("n", F.size("ids")))


def stop_zones(routes: DataFrame) -> DataFrame:
    """Segments of each route pre-projected in every UTM zone its stops touch.

    ``route_id, zone, south, segs ARRAY<STRUCT<ax, ay, dx, dy, l2>>,
    pts ARRAY<STRUCT<x, y>>`` -- static-sized (routes x zones x stops).
    """
    zones = (f"array_distinct(transform(stops, s -> named_struct('zone', {geo.zone_sql('s.lon')}, "
             f"'south', {geo.south_sql('s.lat')})))")
    r = routes.withColumn("_z", F.explode(F.expr(zones))).select("*", "_z.zone", "_z.south").where("zone IS NOT NULL").drop("_z")
    return with_projected(r, "stops", "zone", "south").select(
        "route_id", "zone", "south", "pts", "segs")


def with_projected(df: DataFrame, stops_col: str, zone: str, south: str) -> DataFrame:
    """Add ``pts`` (stops projected in (zone, south)) and ``segs`` (segment vectors)."""
    df = df.withColumn("pts", F.expr(geo.utm_array_sql(stops_col, "lat", "lon", zone, south)))
    return df.withColumn("segs", F.expr(SEGS_SQL))


SEGS_SQL = (
    "transform(filter(sequence(0, size(pts) - 2), i -> i >= 0 AND i < size(pts) - 1), i -> named_struct("
    "'ax', pts[i].x, 'ay', pts[i].y, 'dx', pts[i + 1].x - pts[i].x, "
    "'dy', pts[i + 1].y - pts[i].y, "
    "'l2', power(pts[i + 1].x - pts[i].x, 2) + power(pts[i + 1].y - pts[i].y, 2)))")
