"""Scoring predictions against observed arrivals.

Ground truth drives the join: every (key, stop) in ``actual`` is scored;
extra predictions are ignored. Penalties (fixed values of the scoring
rules): missing key 100 min, missing stop 10 min, unparsable time 10 min.
A key whose actual set is empty scores 0.0, unless it is also missing
from the predictions (then 100: the missing-key test comes first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import parse_timestamp

# --- fixed values: scoring penalties (minutes) -----------------------------
MISSING_ROUTE_MIN = 100.0
MISSING_STOP_MIN = 10.0
BAD_TIME_MIN = 10.0
# ---------------------------------------------------------------------------


def stop_errors(actual: DataFrame, predicted: DataFrame, key: str = "route_id") -> DataFrame:
    """Per actual (key, stop): ``abs_min`` (absolute minutes or penalty)
    and ``diff_s`` (predicted - actual seconds, NULL when penalised).

    ``actual``: ``key, stop_id, arrival`` (text; ``stop_id`` NULL marks a key
    with no actual stops). ``predicted``: ``key, stop_id, arrival`` text.
    """
    keys_p = predicted.select(key).distinct().withColumn("_has_key", F.lit(True))
    a = actual.select(key, "stop_id", F.col("arrival").alias("_a"))
    p = predicted.select(key, "stop_id", F.col("arrival").alias("_p"))
    j = a.join(keys_p, key, "left").join(p, [key, "stop_id"], "left")
    at, pt = parse_timestamp("_a"), parse_timestamp("_p")
    diff_s = (F.unix_micros(pt) - F.unix_micros(at)) / F.lit(1e6)
    abs_min = (F.when(F.col("_has_key").isNull(), F.lit(MISSING_ROUTE_MIN))
               .when(F.col("stop_id").isNull(), F.lit(None))
               .when(F.col("_p").isNull(), F.lit(MISSING_STOP_MIN))
               .when(at.isNull() | pt.isNull(), F.lit(BAD_TIME_MIN))
               .otherwise(F.abs(diff_s / F.lit(60.0))))
    return j.select(key, "stop_id", F.col("_has_key").isNotNull().alias("key_predicted"),
                    abs_min.alias("abs_min"),
                    F.when(F.col("_p").isNotNull(), diff_s).alias("diff_s"))


def route_scores(errors: DataFrame, key: str = "route_id") -> DataFrame:
    """Mean absolute minutes per key (missing key = 100, empty = 0.0)."""
    return errors.groupBy(key).agg(
        F.when(~F.first("key_predicted"), F.lit(MISSING_ROUTE_MIN))
         .otherwise(F.coalesce(F.avg("abs_min"), F.lit(0.0))).alias("eta_score_minutes"))


def overall_score(scores: DataFrame) -> DataFrame:
    """Unweighted mean of key scores and the number of keys."""
    return scores.agg(F.count(F.lit(1)).alias("total_routes"),
                      F.avg("eta_score_minutes").alias("overall_eta_score_minutes"))


def error_summary(errors: DataFrame, key: str = "route_id") -> DataFrame:
    """MAE and RMSE (s), max error, exact hits and counts within 1/2/5
    minutes per key, over stops that have a predicted time."""
    e = errors.where(F.col("diff_s").isNotNull())
    ad = F.abs("diff_s")
    return e.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_stops"),
        F.avg(ad).alias("mae_s"),
        F.sqrt(F.avg(F.col("diff_s") * F.col("diff_s"))).alias("rmse_s"),
        F.max(ad).alias("max_abs_s"),
        F.count_if(ad == 0).alias("exact"),
        F.count_if(ad <= 60).alias("within_1min"),
        F.count_if(ad <= 120).alias("within_2min"),
        F.count_if(ad <= 300).alias("within_5min"),
    )
