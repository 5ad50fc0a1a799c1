"""Report tables behind the published charts and inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def speed_by_hour_day(features: DataFrame) -> DataFrame:
    """Mean speed per stop, date and hour (moving rows)."""
    f = features.where(F.col("segment_duration") > 0)
    return f.groupBy("current_stop_id", "date", "hour").agg(
        F.avg("speed").alias("mean_speed"), F.count(F.lit(1)).alias("n"))


def speed_histogram(features: DataFrame, width_mps: float = 1.0, max_mps: float = 30.0) -> DataFrame:
    """Counts of moving rows per (stop, hour, speed bucket); bucket b
    covers [b*width, (b+1)*width) and the last bucket is open-ended."""
    f = features.where(F.col("segment_duration") > 0)
    nb = int(max_mps / width_mps)
    b = F.least(F.floor(F.col("speed") / F.lit(width_mps)).cast("int"), F.lit(nb))
    return f.groupBy("current_stop_id", "hour", b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def pattern_inventory(features: DataFrame) -> DataFrame:
    """Per route, distinct stops and distinct (stop, hour, weekday) cells."""
    f = features.where(F.col("segment_duration") > 0)
    return f.groupBy("route_id").agg(
        F.countDistinct("current_stop_id").alias("n_stops"),
        F.countDistinct("current_stop_id", "hour", "day_of_week").alias("n_cells"))
