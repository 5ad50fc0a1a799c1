"""Trips folded as a whole against the chunked fold, and what their plans move and store."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from headway import registry
from headway.operators import features, mapmatch, routes as rts, static


@pytest.fixture(scope="module")
def network(spark):
    """A route of 130 stops (three masks), one of one stop, a loop, and one at a zone's edge."""
    lists = {1: [(12.0 + 0.002 * i, 77.5 + 0.001 * (i % 3)) for i in range(130)], 2: [(10.0, 10.0)],
             3: [(0.01, 5.99), (-0.01, 6.01), (0.02, 6.02), (0.01, 5.99)], 4: [(12.9, 77.5), (12.91, 77.51), (12.91, 77.51), (12.93, 77.52)]}
    name = lambda r, i, at: f"{r}-{at.index(at[i])}" if r == 3 else f"{r}-{i}"
    stops = spark.createDataFrame(sorted({(name(r, i, at), *at[i]) for r, at in lists.items() for i in range(len(at))}), "stop_id string, stop_lat double, stop_lon double")
    seqs = spark.createDataFrame([(r, [name(r, i, at) for i in range(len(at))]) for r, at in lists.items()], "route_id long, stop_id_list array<string>")
    return static.materialize(static.route_table(static.next_stop_distances(seqs, stops), stops))


@pytest.fixture(scope="module")
def pings(spark):
    """Trips of 40 to 300 pings that advance, turn back, repeat times and seqs,
    and leave their route's zones; rows without a trip, a time or a route."""
    rows = []
    for r, lat, lon, n in ((1, 12.0, 77.5, 300), (1, 12.1, 77.501, 90), (2, 10.0, 10.0, 40), (3, 0.01, 5.99, 60), (4, 12.9, 77.5, 60), (4, 12.93, 77.52, 41)):
        for k in range(n):
            far = k % 29 == 17
            rows.append((str(r), f"t{len(rows) - k}", 1_704_067_200 + 7 * (k // 3), (k * 5) % 3 % 2, lat + 0.0009 * (k - (k * 7) % 11) - 9 * far,
                         lon + 0.0004 * ((k * 13) % 5) + 12 * far, float(k * 29 % 360)))
    rows += [("1", None, 1_704_067_200, 0, 12.0, 77.5, 1.0), ("1", "t", None, 0, 12.0, 77.5, 1.0), (None, "t", 1_704_067_200, 0, 12.0, 77.5, 1.0), ("9", "t", 1_704_067_200, 0, 12.0, 77.5, 1.0)]
    p = spark.createDataFrame(rows, "route_id string, trip_id string, s long, seq int, latitude double, longitude double, bearing double")
    p = p.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    return p.withColumn("date", F.lit("2024-01-01").cast("date")).repartition(5).cache()


def _rows(df):
    cols = ["date", "route_id", "trip_id", "ts", "seq", "latitude", "n", "route_position", "_arrivals"]
    return Counter((*(r[c] for c in cols[:-1]), tuple(r["_arrivals"]), tuple(sorted(r["first_arrival"].items()))) for r in df.select(*cols, "first_arrival").collect())


def test_whole_trips_equal_chunked_ones(spark, network, pings, monkeypatch):
    want = _rows(mapmatch.map_match(pings, network, chunk_seconds=60, whole_rows=0))
    assert sum(want.values()) == 591 and len({k[7] for k in want}) > 60
    whole = mapmatch.map_match(pings, network)
    assert whole.columns == mapmatch.map_match(pings, network, whole_rows=0).columns
    assert _rows(whole) == want
    assert _rows(mapmatch.map_match(pings, network, whole_rows=60)) == want      # some whole, some cut
    monkeypatch.setattr(mapmatch, "SEGMENT_CELLS", 0)     # too many segments to broadcast
    assert _rows(mapmatch.map_match(pings, network)) == want


def test_large_trips_are_found(spark, pings):
    sizes = {(r["trip_id"], r["count"]) for r in pings.where("ts IS NOT NULL AND route_id < '9'").groupBy("trip_id").count().collect() if r["trip_id"]}
    for most in (0, 59, 60, 299, 300):
        for counters in (1, 1 << 10):
            got = mapmatch.large_trips(pings.where("trip_id <> 't'"), most, counters)
            assert ({r["trip_id"] for r in got.collect()} if got is not None else set()) == {t for t, n in sizes if n > most}


def _plan(spark, df):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def _moved(plan):
    """The columns below each shuffle by trip."""
    lines = plan.splitlines()
    return [re.findall(r"(\w+)#", lines[i + 1].split(" AS ")[0] if "Project" not in lines[i + 1] else re.sub(r".*?Project \[", "", lines[i + 1]))
            for i, x in enumerate(lines) if "Exchange hashpartitioning(date" in x and "trip_id" in x]


@pytest.mark.parametrize("key,unread", [("win_map_match", "latitude bearing vehicle_id stop_id first_arrival"), ("win_next_ping", "bearing vehicle_id stop_id"),
                                        ("join_first_arrival", "latitude bearing vehicle_id"), ("feat_segment_metrics", "vehicle_id stop_id"), ("ctx_process_trips", "vehicle_id stop_id")])
def test_pings_are_shuffled_once_and_nothing_is_kept(spark, key, unread):
    """Only the columns that the query reads are shuffled; no table of the pings is kept or stored."""
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keys())
    df = registry.REG[key][0](spark, SF_SMALL)
    plan = _plan(spark, df)
    assert "InMemoryTableScan" not in plan and "orders.parquet" in plan
    moved = _moved(plan)
    assert len(moved) == 1 and {"trip_id", "seq"} <= set(moved[0]) and not set(unread.split()) & set(moved[0]), moved
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keys()) <= before


def test_generated_methods_are_small_enough_for_the_compiler(spark):
    """Above 8,000 bytes the JVM compiles no method: a stage then took four times as long."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for key in ("agg_stop_patterns", "ctx_process_trips", "win_map_match"):
            df = registry.pat.train(registry.all_features(spark, SF_SMALL).where("date < '2001-01-01'")) if key == "agg_stop_patterns" else registry.REG[key][0](spark, SF_SMALL)
            debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
            stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
            assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000, key
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_route_statistics_are_the_same_stored_or_planned(spark):
    cols = ["date", "route_id", "trip_id", "seq", "route_length", "route_complexity", "route_stop_density", "route_avg_speed"]
    w = registry._wl(spark, SF_SMALL)
    rows = lambda df: sorted((*r[:4], *(round(x, 9) if x is not None else None for x in r[4:])) for r in df.select(*cols).collect())
    planned = w.features(stored=False)
    got, want = rows(planned), rows(w.features())
    assert got == want and len(got) > 0
    # a query without their columns doesn't work them out
    assert "percentile_approx" in _plan(spark, planned) and "percentile_approx" not in _plan(spark, planned.select("date", "seq", "speed"))
    f = w.features()
    assert f.columns == planned.columns
    s = features.route_characteristics(f)
    assert {tuple(r) for r in s.select("date", "route_id").collect()} == {(r[0], r[1]) for r in got}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    t = static.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "k"))
    assert tracker.shuffleStatuses().size() <= before
    assert sorted(map(tuple, t.collect())) == [(k, len(range(k, 1000, 7))) for k in range(7)]
    assert spark.conf.get(static.SHUFFLE_CLEANUP, "false") == "false"


def test_distinct_trips_are_listed(spark):
    rows = [("d", "1", "b"), ("d", "1", "a"), ("d", "1", "b"), ("d", "1", None), ("d", "2", None), ("e", "1", "c"), (None, None, "x")]
    got = {(r["date"], r["route_id"]): (r["trip_ids"], r["n_trips"], r["n_rows"]) for r in rts.distinct_trips(spark.createDataFrame(rows, "date string, route_id string, trip_id string")).collect()}
    assert got == {("d", "1"): (["a", "b"], 2, 4), ("d", "2"): ([], 0, 1), ("e", "1"): (["c"], 1, 1), (None, None): (["x"], 1, 1)}
