"""Steps tested by batch, and the distances summed once per route, against the
expressions that do so ping by ping."""
from pyspark.sql import functions as F

from headway.operators import context, mapmatch, static


def _routes(spark):
    lists = {1: [(12.9, 77.5), (12.91, 77.51), (12.91, 77.51), (12.93, 77.52)], 2: [(-33.9, 18.4), (-33.91, 18.42)],
             3: [(0.01, 5.99), (-0.01, 6.01), (0.02, 6.02)], 4: [(10.0, 10.0)]}
    stops = spark.createDataFrame([(f"{r}-{i}", lat, lon) for r, at in lists.items() for i, (lat, lon) in enumerate(at)], "stop_id string, stop_lat double, stop_lon double")
    seqs = spark.createDataFrame([(r, [f"{r}-{i}" for i in range(len(at))]) for r, at in lists.items()], "route_id long, stop_id_list array<string>")
    return static.materialize(static.route_table(static.next_stop_distances(seqs, stops), stops))


def _pings(spark):
    at = [(12.9, 77.5), (12.905, 77.505), (12.911, 77.511), (12.95, 77.6), (-33.905, 18.41), (0.0, 6.0), (-0.005, 6.005), (0.015, 5.995), (10.0, 10.0), (50.0, -170.0), (0.0, 180.0),
          (float("nan"), 77.5), (None, 77.5), (12.9, None)]
    return spark.createDataFrame([(str(r), i, lat, lon) for r in (1, 2, 3, 4) for i, (lat, lon) in enumerate(at)], "route_id string, seq int, latitude double, longitude double")


def test_steps_by_batch_equal_the_expressions(spark, monkeypatch):
    routes = _routes(spark)
    p = mapmatch.attach_route(_pings(spark), routes)
    rows = lambda df: {(r["route_id"], r["seq"]): r["step"] for r in df.select("route_id", "seq", "step").collect()}
    want = rows(mapmatch.with_projection(p, routes).withColumn("open", F.expr(mapmatch.OPEN_SQL)).withColumn("step", F.expr(mapmatch.STEP_SQL)))
    by_batch = mapmatch.with_steps(p, routes)
    assert "ArrowEvalPython" in by_batch._jdf.queryExecution().executedPlan().toString()
    assert rows(by_batch) == want and len(want) == 56
    assert len({tuple(x) for x in want.values()}) > 8
    monkeypatch.setattr(mapmatch, "SEGMENT_CELLS", 0)     # too many segments to broadcast
    assert rows(mapmatch.with_steps(p, routes)) == want


def test_values_by_segment_equal_the_expressions(spark, monkeypatch):
    routes = _routes(spark)
    p = mapmatch.attach_route(_pings(spark), routes)
    names = list(mapmatch.SEGMENT_SQL)
    rows = lambda df: {(r["route_id"], r["seq"]): repr([r[c] for c in names]) for r in df.select("route_id", "seq", *names).collect()}
    want = rows(mapmatch.with_projection(p, routes).withColumns({c: F.expr(x) for c, x in mapmatch.SEGMENT_SQL.items()}))
    by_batch = mapmatch.with_segments(p, routes, *names)
    plan = by_batch._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "stops#" not in plan.split("ArrowEvalPython")[1].splitlines()[1].split("CASE")[0]
    assert rows(by_batch) == want and len(want) == 56
    monkeypatch.setattr(mapmatch, "SEGMENT_CELLS", 0)     # too many segments to broadcast
    assert rows(mapmatch.with_segments(p, routes, *names)) == want


def test_distances_after_the_next_stop_are_summed_once_per_route(spark):
    routes = _routes(spark)
    p = _pings(spark).where("latitude = 12.9 and longitude is not null")
    p = mapmatch.attach_route(p, context.with_rests(routes), ["rests"]).withColumn("route_position", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    got = context.route_context(p)
    assert "aggregate(" not in got._jdf.queryExecution().analyzed().toString().split("Join")[0]
    key = lambda df: sorted((r[0], r[1], r[2]) for r in df.select("route_id", "route_position", "distance_remaining_after_next_stop").collect())
    assert key(got) == key(context.route_context(p.drop("rests")))
