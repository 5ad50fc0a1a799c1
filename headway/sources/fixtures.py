"""Deterministic transit tables derived from the driver's TPC-H-style tables.

``nation`` becomes 25 routes with 12 stops each, ``orders`` becomes trips
(40 pings, 20 s apart), so every derived table grows with the scale factor.
The formulas are kept as SQL text shared with the DuckDB oracle
(:mod:`headway.oracle.sql`), which builds the very same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import lit

# --- fixed values: fixture layout ------------------------------------------
STOPS_PER_ROUTE = 12
PINGS_PER_TRIP = 40
PING_INTERVAL_S = 20
N_ROUTES = 25
# ---------------------------------------------------------------------------

# SQL text over columns n (nation key) and k (stop slot / ping ordinal).
STOP_ID_SQL = "(20000 + n * 12 + k)"
STOP_LAT_SQL = f"({lit(12.90)} + 4e-3 * n + 1e-3 * ((k * k) % 3))"
STOP_LON_SQL = f"({lit(77.50)} + 3e-3 * n + 4e-3 * k)"
# stop at position k of route r (routes >= 20 run routes 0..4 backwards,
# route 19 is a loop that ends at its first stop)
ROUTE_STOP_SQL = ("(CASE WHEN r >= 20 THEN 20000 + (r - 20) * 12 + (11 - k) "
                  "WHEN r = 19 AND k = 11 THEN 20000 + 19 * 12 "
                  "ELSE 20000 + r * 12 + k END)")
# per ping (o = o_orderkey, c = o_custkey, k = ping ordinal)
PROG_SQL = "(37e-3 + k * (8 + o % 5) / 4e1)"
JIT_SQL = "((((o * 31 + k * 17) % 11) - 5) * 1e-5)"
BEARING_SQL = "CAST((o * 13 + k * 29) % 360 AS DOUBLE)"
OFFSET_S_SQL = "((o * 7919) % 86400 + k * 20)"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: ``stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE`` (25 x 12 rows)."""
    return (_t(spark, sf_dir, "nation")
            .select(F.col("n_nationkey").alias("n"),
                    F.explode(F.sequence(F.lit(0), F.lit(STOPS_PER_ROUTE - 1))).alias("k"))
            .select(F.expr(f"CAST({STOP_ID_SQL} AS STRING)").alias("stop_id"),
                    F.expr(STOP_LAT_SQL).alias("stop_lat"),
                    F.expr(STOP_LON_SQL).alias("stop_lon")))


def route_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: ``route_id BIGINT, stop_id_list ARRAY<STRING>`` (one row per nation)."""
    body = ROUTE_STOP_SQL.replace("k", "x")
    return (_t(spark, sf_dir, "nation")
            .select(F.col("n_nationkey").cast("bigint").alias("route_id"))
            .withColumn("r", F.col("route_id"))
            .select("route_id", F.expr(
                f"transform(sequence(0, {STOPS_PER_ROUTE - 1}), x -> CAST({body} AS STRING))"
            ).alias("stop_id_list")))


def route_sequences_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 as the reference's CSV cell text: ``"['20921', '21010']"``."""
    return route_sequences(spark, sf_dir).select(
        "route_id",
        F.concat(F.lit("['"), F.array_join("stop_id_list", "', '"), F.lit("']")).alias("stop_id_list"))


def _route_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per route: ordered ARRAY<STRUCT<stop_id, lat, lon>> (static, 25 rows)."""
    seq = route_sequences(spark, sf_dir)
    st = stops(spark, sf_dir)
    rs = seq.select("route_id", F.posexplode("stop_id_list").alias("pos", "stop_id"))
    j = rs.join(F.broadcast(st), "stop_id")
    return (j.groupBy("route_id")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "stop_id", F.col("stop_lat").alias("lat"),
                                                      F.col("stop_lon").alias("lon")))).alias("geo")))


def clean_pings(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """40 noise-free pings per order; ``ts`` TIMESTAMP (UTC). ``by_day``
    ranges the orders by day, so that a task has the pings of few dates."""
    # the order table is small next to its 40x ping expansion: spread it over
    # the cluster first so the expansion and everything downstream run wide
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = (_t(spark, sf_dir, "orders")
         .select(F.col("o_orderkey").alias("o"), F.col("o_custkey").alias("c"),
                 F.col("o_orderdate").cast("timestamp").alias("od")))
    # four times as many ranges: a task sorts its pings by date to write them
    o = o.repartitionByRange(4 * parts, "od", "o") if by_day else o.repartition(parts, "o")
    o = o.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(PINGS_PER_TRIP - 1))))
    o = (o.withColumn("prog", F.expr(PROG_SQL))
          .withColumn("i", F.expr("least(CAST(floor(prog) AS INT), 10)"))
          .withColumn("fr", F.expr("prog - i"))
          .withColumn("jit", F.expr(JIT_SQL))
          .withColumn("route_key", F.expr("c % 25")))
    geo = _route_geometry(spark, sf_dir)
    j = o.join(F.broadcast(geo), o.route_key == geo.route_id).drop(geo.route_id)
    j = j.withColumn("a", F.expr("geo[i]")).withColumn("b", F.expr("geo[i + 1]"))
    return j.select(
        F.expr("CAST(c % 25 AS STRING)").alias("route_id"),
        F.expr("CAST(o AS STRING)").alias("trip_id"),
        F.expr("CAST(c AS STRING)").alias("vehicle_id"),
        F.col("a.stop_id").alias("stop_id"),
        F.col("k").alias("seq"),
        F.expr(f"timestamp_seconds(unix_seconds(od) + {OFFSET_S_SQL})").alias("ts"),
        F.expr("a.lat + (b.lat - a.lat) * fr + jit").alias("latitude"),
        F.expr("a.lon + (b.lon - a.lon) * fr - jit").alias("longitude"),
        F.expr(BEARING_SQL).alias("bearing"),
        F.lit("SCHEDULED").alias("schedule_relationship"),
    )


# raw-ping noise (FIXTURES B4), as SQL over the B3 columns and k = seq
RAW_ROUTE_SQL = "CASE WHEN seq % 3 = 0 THEN concat('\"', route_id, '\"') ELSE route_id END"
RAW_TRIP_SQL = "CASE WHEN seq % 3 = 0 THEN concat('\"', trip_id, '\"') ELSE trip_id END"
RAW_SCHED_SQL = ("CASE WHEN seq % 17 = 4 THEN NULL WHEN seq % 13 = 7 THEN 'CANCELED' "
                 "WHEN seq % 5 = 0 THEN '\"SCHEDULED\"' WHEN seq % 5 = 1 THEN 'ADDED' "
                 "ELSE 'SCHEDULED' END")
RAW_LAT_SQL = "CASE WHEN seq % 29 = 11 THEN 91e0 ELSE latitude END"
RAW_LON_SQL = "CASE WHEN seq % 31 = 12 THEN NULL ELSE longitude END"
RAW_EPOCH_SQL = ("CASE WHEN seq % 37 = 20 THEN 'bad' WHEN seq % 2 = 0 THEN "
                 "concat('\"', CAST(epoch_s AS STRING), '\"') ELSE CAST(epoch_s AS STRING) END")


def raw_pings(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """B3 with quoted ids/times, junk times, bad coordinates and statuses."""
    b3 = clean_pings(spark, sf_dir, by_day).withColumn("epoch_s", F.expr("unix_seconds(ts)"))
    return b3.select(
        F.expr(RAW_ROUTE_SQL).alias("route_id"),
        F.expr(RAW_TRIP_SQL).alias("trip_id"),
        "vehicle_id", "stop_id", "seq",
        F.expr(RAW_EPOCH_SQL).alias("vehicle_timestamp"),
        F.expr(RAW_LAT_SQL).alias("latitude"),
        F.expr(RAW_LON_SQL).alias("longitude"),
        "bearing",
        F.expr(RAW_SCHED_SQL).alias("schedule_relationship"),
        F.to_date("ts").alias("date"),
    )


# --- fixed values: train / query split (FIXTURES B5, re-aimed to a time split)
QUERY_FROM_DATE = "2001-01-01"   # trips on or after this date are live queries
QUERY_CUT_SQL = "(10 + o % 30)"  # a query sees pings with ordinal k <= cut
# ---------------------------------------------------------------------------
