"""Historical speed patterns (A2, A3, A6) and the five-level fallback lookup.

Training is one hash aggregate; Spark runs it as a partial (map-side)
aggregate, a shuffle of at most one row per key per partition, and a
final aggregate, so a stop holding a third of the rows costs no more than
any other key.

The ladder pre-aggregates every level from the pattern table, which is
bounded by (stops x 24 x 7). Level tables are joined to the prediction rows; the first level that *exists* wins,
even when its mean is 0 (then the global mean is used).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATTERN_KEYS = ["current_stop_id", "hour", "day_of_week"]
# --- fixed values: fallback speed (20 km/h in m/s) and default duration ----
DEFAULT_SPEED_MPS = 20.0 / 3.6
DEFAULT_SEGMENT_SECONDS = 60.0
# ---------------------------------------------------------------------------


def stop_patterns(features: DataFrame, keys=PATTERN_KEYS) -> DataFrame:
    """A2: per (stop, hour, weekday): segment duration mean/std/count, speed
    mean/std, segment distance mean. Sample std (NULL for one row); rows with
    a NULL key are dropped, as pandas' group-by does."""
    f = features.dropna(subset=list(keys))
    return f.groupBy(*keys).agg(
        F.avg("segment_duration").alias("dur_mean"),
        F.stddev_samp("segment_duration").alias("dur_std"),
        F.count("segment_duration").alias("dur_count"),
        F.avg("speed").alias("speed_mean"),
        F.stddev_samp("speed").alias("speed_std"),
        F.avg("segment_distance").alias("dist_mean"),
    )


def train(features: DataFrame, model_key: str = "default", per_route: bool = False) -> DataFrame:
    """E3 core: P8 filter then A2 (``model_key='default'``) or A3 (one model
    per route, ``model_key`` = route id). Output has a ``model_key`` column."""
    moving = features.where(F.col("segment_duration") > 0)
    if per_route:
        p = stop_patterns(moving, ["route_id"] + PATTERN_KEYS)
        return p.withColumnRenamed("route_id", "model_key")
    return stop_patterns(moving).withColumn("model_key", F.lit(model_key))


def ladder_levels(patterns: DataFrame) -> dict[str, DataFrame]:
    """Unweighted mean of cell ``speed_mean`` at each fallback level.

    Level 3 (hour +-1, no wrap) is served from the (stop, hour) sums so a
    query hour h reads cells h-1 and h+1.
    """
    p = patterns
    return {
        "l1": p.select(F.col("current_stop_id").alias("s"), "hour", "day_of_week",
                       F.col("speed_mean").alias("l1")),
        "l2": p.groupBy(F.col("current_stop_id").alias("s"), "hour").agg(
            F.avg("speed_mean").alias("l2"), F.sum("speed_mean").alias("l2_sum"),
            F.count("speed_mean").alias("l2_n"), F.count(F.lit(1)).alias("l2_cells")),
        "l4": p.groupBy("hour", "day_of_week").agg(F.avg("speed_mean").alias("l4"),
                                                   F.count(F.lit(1)).alias("l4_cells")),
        "l5": p.groupBy(F.col("current_stop_id").alias("s")).agg(F.avg("speed_mean").alias("l5"),
                                                                 F.count(F.lit(1)).alias("l5_cells")),
        "g": p.agg(F.avg("speed_mean").alias("g")),
    }


def ladder_speed(rows: DataFrame, patterns: DataFrame, stop_col: str = "key_stop",
                 hour_col: str = "hour", dow_col: str = "day_of_week", model_key: str = "default") -> DataFrame:
    """Add ``speed`` and ``level`` (1-5, 6 = global, 7 = default) to rows.

    Levels: (stop, hour, dow) -> (stop, hour) -> (stop, hour +- 1) ->
    (hour, dow) any stop -> (stop). The first level with at least one cell
    is used; a missing, zero or NaN mean then falls to the global mean,
    then to 20 km/h. Of a table with several models only ``model_key`` is read.
    """
    if "model_key" in patterns.columns:
        patterns = patterns.where(F.col("model_key") == model_key)
    lv = ladder_levels(patterns)
    r = rows.withColumns({"_s": F.col(stop_col), "_h": F.col(hour_col), "_d": F.col(dow_col)})
    l1 = lv["l1"].withColumnsRenamed({"s": "_k1", "hour": "_kh1", "day_of_week": "_kd1"})
    r = r.join(l1, (r["_s"] == F.col("_k1")) & (r["_h"] == F.col("_kh1")) & (r["_d"] == F.col("_kd1")),
               "left").withColumn("_l1", F.col("_k1").isNotNull()).drop("_k1", "_kh1", "_kd1")
    l2 = lv["l2"].withColumnsRenamed({"s": "_k2", "hour": "_kh2"})
    r = r.join(l2.select("_k2", "_kh2", "l2", "l2_cells"),
               (r["_s"] == F.col("_k2")) & (r["_h"] == F.col("_kh2")), "left").drop("_k2", "_kh2")
    # level 3 reads the (stop, hour) sums of hours h - 1 and h + 1 (no wrap)
    for tag, off in (("lo", -1), ("hi", 1)):
        t = l2.select(F.col("_k2").alias(f"_k_{tag}"), F.col("_kh2").alias(f"_kh_{tag}"),
                      F.col("l2_sum").alias(f"_{tag}_sum"), F.col("l2_n").alias(f"_{tag}_n"),
                      F.col("l2_cells").alias(f"_{tag}_cells"))
        r = r.join(t, (r["_s"] == F.col(f"_k_{tag}")) & (r["_h"] + off == F.col(f"_kh_{tag}")),
                   "left").drop(f"_k_{tag}", f"_kh_{tag}")
    l4 = lv["l4"].withColumnsRenamed({"hour": "_kh4", "day_of_week": "_kd4"})
    r = r.join(l4, (r["_h"] == F.col("_kh4")) & (r["_d"] == F.col("_kd4")), "left").drop("_kh4", "_kd4")
    l5 = lv["l5"].withColumnRenamed("s", "_k5")
    r = r.join(l5, r["_s"] == F.col("_k5"), "left").drop("_k5")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    l3_cells = z("_lo_cells") + z("_hi_cells")
    l3 = F.try_divide(F.coalesce(F.col("_lo_sum"), F.lit(0.0)) + F.coalesce(F.col("_hi_sum"), F.lit(0.0)),
                      (z("_lo_n") + z("_hi_n")).cast("double"))
    level = (F.when(F.col("_l1"), 1).when(F.col("l2_cells") > 0, 2).when(l3_cells > 0, 3)
             .when(F.col("l4_cells") > 0, 4).when(F.col("l5_cells") > 0, 5))
    r = r.withColumn("level", level)
    chosen = (F.when(F.col("level") == 1, F.col("l1")).when(F.col("level") == 2, F.col("l2"))
              .when(F.col("level") == 3, l3).when(F.col("level") == 4, F.col("l4"))
              .when(F.col("level") == 5, F.col("l5")))
    r = r.withColumn("_g", lv["g"].select("g").scalar())

    def bad(c):
        return c.isNull() | F.isnan(c) | (c == 0)
    speed = (F.when(~bad(chosen), chosen).when(~bad(F.col("_g")), F.col("_g"))
             .otherwise(F.lit(DEFAULT_SPEED_MPS)))
    lvl = F.when(~bad(chosen), F.col("level")).when(~bad(F.col("_g")), F.lit(6)).otherwise(F.lit(7))
    r = r.withColumns({"speed": speed, "level": lvl})
    return r.drop("_s", "_h", "_d", "_l1", "l1", "l2", "l2_cells", "_lo_sum", "_lo_n", "_lo_cells",
                  "_hi_sum", "_hi_n", "_hi_cells", "l4", "l4_cells", "l5", "l5_cells", "_g")
