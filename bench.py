"""Benchmark the headline plans on the driver tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each stage runs to completion through a no-op sink (full execution, no
collect); inputs of later stages are materialised first so each number
measures one stage. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from headway.operators import clean, context  # noqa: E402
from headway.operators.static import materialize  # noqa: E402
from headway.plans import pipelines  # noqa: E402
from headway.plans.workload import Workload  # noqa: E402
from headway.session import build_session, release, scratch_path  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    w = Workload(spark, sf_dir)
    times = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    timed("static_routes", lambda: w.routes().count())
    # the pings as they would lie in a store; deriving them from the orders is no stage
    root = scratch_path(spark, "bench_pings")
    began = time.time()
    w.raw_pings().repartition("date").write.parquet(root)
    stored_s = round(time.time() - began, 3)
    w.raw_pings = lambda: spark.read.parquet(root)
    timed("clean_pings", lambda: run(w.clean_pings()))
    timed("map_match", lambda: run(context.process_trips(clean.clean_pings(w.history_raw()), w.routes())))
    release(spark)
    feats = timed("features", lambda: materialize(w.features(w.history_raw())))
    release(spark)
    pats = timed("train_patterns", lambda: materialize(pipelines.fit_patterns(feats)))
    st, seq = w.static()
    pred = timed("predict", lambda: materialize(
        pipelines.predict(w.query_raw(), st, seq, pats, routes_tbl=w.routes())))
    act = timed("actuals", lambda: materialize(w.actuals()))
    release(spark)

    def evaluate():
        p = pred.select("query_id", "stop_id", F.date_format("arrival_ts", "yyyy-MM-dd HH:mm:ss").alias("arrival"))
        scores, overall = pipelines.evaluate(p, act, "query_id")
        run(scores)
        return overall.first()
    overall = timed("evaluate", evaluate)
    n_pings = feats.count()
    print(json.dumps({
        "metric": "total_pipeline_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus, "fixture_seconds": stored_s, "history_pings": n_pings,
        "eta_score_minutes": round(overall["overall_eta_score_minutes"], 4),
        "scored_queries": overall["total_routes"],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
