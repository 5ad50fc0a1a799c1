"""Route volume, selection and trip counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def route_volume(pings: DataFrame) -> DataFrame:
    """A1: cleaned rows per (date, route)."""
    return pings.groupBy("date", "route_id").agg(F.count(F.lit(1)).alias("n"))


def distinct_trips(pings: DataFrame) -> DataFrame:
    """Distinct trips per (date, route), their ids in order and their
    number, and rows. Ids that are NULL are no trip; their rows count."""
    trips = pings.groupBy("date", "route_id", "trip_id").agg(F.count(F.lit(1)).alias("_n"))
    return trips.groupBy("date", "route_id").agg(F.sort_array(F.collect_list("trip_id")).alias("trip_ids"),
                                                 F.count("trip_id").alias("n_trips"), F.sum("_n").alias("n_rows"))


def _id_table(spark: SparkSession, ids) -> DataFrame:
    return spark.createDataFrame([(str(r),) for r in ids], "route_id string")


def top_routes(volume: DataFrame, k: int = 5, exclude=()) -> DataFrame:
    """T2 + U2: the K busiest routes per date after exclusion (K <= 0: all);
    ties broken by route id. Catalyst plans this as a window group limit."""
    v = volume
    if exclude:
        v = v.join(F.broadcast(_id_table(volume.sparkSession, exclude)), "route_id", "left_anti")
    if k <= 0:
        return v.withColumn("rank", F.row_number().over(
            Window.partitionBy("date").orderBy(F.desc("n"), "route_id")))
    w = Window.partitionBy("date").orderBy(F.desc("n"), "route_id")
    return v.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def select_routes(pings: DataFrame, include=(), exclude=(), k: int = 5) -> DataFrame:
    """Pings of the selected routes per date.

    With an include list: include minus exclude (K ignored). Otherwise the
    top-K routes by cleaned volume of each date, minus exclude. A semi join
    against the (date, route) choice keeps the pings.
    """
    spark = pings.sparkSession
    if include:
        chosen = _id_table(spark, sorted(set(map(str, include)) - set(map(str, exclude))))
        return pings.join(F.broadcast(chosen), "route_id", "left_semi")
    chosen = top_routes(route_volume(pings), k, exclude).select("date", "route_id")
    return pings.join(chosen, ["date", "route_id"], "left_semi")
