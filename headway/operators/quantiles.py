"""Exact per-group medians without gathering a group into one task.

``percentile``/``median`` keep every distinct value of a group in one
aggregation buffer. Here a sketch brackets the two middle ranks first:

1. one aggregate gives every group's count and approximate quantiles either
   side of the middle, further away than the sketch's rank error;
2. a second pass counts the values below the bracket, keeps the smallest one
   above it, and counts the distinct values inside (a few in ten thousand of
   the group's rows);
3. running counts over these few rows hold the exact middle ranks.

The result equals linear interpolation at 0.5 (pandas' ``median``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: the sketch's rank error is 1 / ACCURACY of a group's rows,
# the bracket reaches three times that to either side -------------------------
ACCURACY = 10_000
REACH = 3
LEAST_ACCURACY = 16
# ---------------------------------------------------------------------------


def exact_medians(df: DataFrame, keys: list[str], values: dict[str, Column], accuracy: int = ACCURACY) -> DataFrame:
    """``keys..., <name>...``: exact median of every named expression per group
    (NULL/NaN ignored; NULL where a group has no value of that name)."""
    names = list(values)
    x = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_k"), v.cast("double").alias("_x")) for i, v in enumerate(values.values())])).alias("_v"))
    x = x.select(*keys, "_v._k", "_v._x").where("_x IS NOT NULL AND NOT isnan(_x)")
    g = [*keys, "_k"]
    accuracy = max(accuracy, LEAST_ACCURACY)
    q = F.percentile_approx("_x", [0.5 - REACH / accuracy, 0.5 + REACH / accuracy], accuracy)
    st = x.groupBy(*g).agg(F.count(F.lit(1)).alias("_c"), q.alias("_q")).select(
        *g, "_c", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"))
    # -1 below, 0 inside, 1 above; inside by distinct value
    side = F.when(F.col("_x") < F.col("_lo"), -1).when(F.col("_x") > F.col("_hi"), 1).otherwise(0)
    j = x.join(st, g).withColumn("_side", side)
    c = j.groupBy(*g, "_side", F.when(F.col("_side") == 0, F.col("_x")).alias("_in")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_first"), F.first("_c").alias("_c"))
    before = Window.partitionBy(*g).orderBy("_side", "_in").rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # 0-based middle ranks; equal for odd counts. Above the bracket only its
    # smallest value can be one, so its first value is the right one there too
    has = lambda r: (F.col("_before") <= F.expr(r)) & (F.expr(r) < F.col("_before") + F.col("_n"))
    low, high = "(_c - 1) div 2", "_c div 2"
    m = c.groupBy(*g).agg(F.max(F.when(has(low), F.col("_first"))).alias("_a"), F.max(F.when(has(high), F.col("_first"))).alias("_b"))
    m = m.withColumn("_m", F.col("_a") + (F.col("_b") - F.col("_a")) * F.lit(0.5))
    return m.groupBy(*keys).agg(*[F.max(F.when(F.col("_k") == i, F.col("_m"))).alias(n) for i, n in enumerate(names)])


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "median", buckets: int = ACCURACY) -> DataFrame:
    """``keys..., out``: exact median of ``value`` per group (NULL/NaN ignored;
    groups without values are absent). ``buckets`` is the sketch's accuracy:
    fewer of them leave more values in the bracket."""
    return exact_medians(df, keys, {out: F.col(value)}, buckets)
