"""Streams over several micro-batches against the batch operators, and the composed pipelines."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from headway import registry
from headway.operators import clean, eta
from headway.plans import pipelines
from headway.plans.workload import Workload
from headway.session import scratch_path
from headway.sources import files
from headway.streaming import stream


@pytest.fixture(scope="module")
def work(spark):
    w = Workload(spark, SF_SMALL)
    src = stream.write_stream_source(w.query_raw(), scratch_path(spark, "stream_src"), 3)
    return w, src


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_cleaning_in_batches(spark, work):
    w, src = work
    cols = ["query_id", "seq", "ts", "latitude"]
    assert rows(stream.clean_stream(spark, src, files_per_batch=1), *cols) == rows(clean.clean_pings(w.query_raw()), *cols)


@pytest.mark.parametrize("lateness", [None, "3650 days"])
def test_latest_pings_in_batches(spark, work, lateness):
    w, src = work
    cols = ["query_id", "seq", "ts", "latitude"]
    want = rows(eta.latest_ping(clean.clean_pings(w.query_raw())), *cols)
    assert rows(stream.latest_ping_stream(spark, src, files_per_batch=1, lateness=lateness), *cols) == want


def test_watermark_ignores_late_pings(spark):
    root = scratch_path(spark, "late")
    cols = "query_id string, route_id string, trip_id string, vehicle_id string, stop_id string, seq int, vehicle_timestamp string, latitude double, longitude double, bearing double, schedule_relationship string"
    day = 86400
    for k, (q, t) in enumerate([("a", 1_700_000_000), ("b", 1_700_000_000 + 10 * day), ("a", 1_700_000_000 + day), ("a", 1_700_000_000 + 11 * day)]):
        spark.createDataFrame([(q, "1", "t", "v", "s", k, str(t), 1.0, 1.0, 0.0, "SCHEDULED")], cols).coalesce(1).write.mode("append").parquet(root)
    got = stream.latest_ping_stream(spark, root, files_per_batch=1, lateness="1 hour")
    assert rows(got, "query_id", "seq") == [("a", 3), ("b", 1)]


def test_predictions_in_batches(spark, work):
    w, src = work
    pats, rt = registry.patterns_tbl(spark, SF_SMALL), w.routes()
    cols = ["query_id", "route_id", "i", "stop_id", "level", "arrival_ts"]
    st, seq = w.static()
    want = rows(pipelines.predict(w.query_raw(), st, seq, pats, routes_tbl=rt), *cols)
    assert want and rows(stream.predict_stream(spark, src, rt, pats, files_per_batch=1), *cols) == want


def test_manifest_to_route_documents(spark, work):
    w, _ = work
    st, seq = w.static()
    pats = registry.patterns_tbl(spark, SF_SMALL)
    ids = [r["query_id"] for r in w.query_raw().select("query_id").distinct().orderBy("query_id").limit(6).collect()]
    root = scratch_path(spark, "files")
    w.query_raw().where(F.col("query_id").isin(ids)).drop("query_id").withColumn("f", F.translate("trip_id", '"', "")).repartition("f").write.partitionBy("f").parquet(root)
    manifest = scratch_path(spark, "manifest")
    spark.createDataFrame([(json.dumps({str(k): f"{root}/f={i}" for k, i in enumerate(ids)}),)], "value string").write.text(manifest)
    got = rows(pipelines.run_predict(spark, manifest, st, seq, pats, scratch_path(spark, "eta"), w.routes()), "route_id", "stop_id", "arrival")
    each = pipelines.predict(w.query_raw().where(F.col("query_id").isin(ids)), st, seq, pats, routes_tbl=w.routes()).collect()
    last = {}
    for r in each:
        last[r["route_id"]] = max(last.get(r["route_id"], -1), ids.index(r["query_id"]))
    want = sorted((r["route_id"], r["stop_id"], r["arrival_ts"].strftime("%Y-%m-%d %H:%M:%S")) for r in each if ids.index(r["query_id"]) == last[r["route_id"]])
    assert want and got == want


def test_feature_run_of_given_dates(spark, work):
    w, _ = work
    st, seq = w.static()
    pings = files.read_pings(spark, _pings(spark, w))
    days = [str(r["date"]) for r in w.raw_pings().select("date").distinct().orderBy("date").limit(2).collect()]
    got = pipelines.run_features(pings, st, seq, scratch_path(spark, "feats"), dates=days, max_routes=1, routes_tbl=w.routes())
    per = got.groupBy("date").agg(F.countDistinct("route_id").alias("n")).collect()
    assert sorted(str(r["date"]) for r in per) == days and all(r["n"] == 1 for r in per)


def _pings(spark, w):
    root = scratch_path(spark, "pings")
    w.raw_pings().hint("rebalance", "date").write.partitionBy("date").parquet(root)
    return root


COLS = "query_id string, route_id string, trip_id string, vehicle_id string, stop_id string, seq int, vehicle_timestamp string, latitude double, longitude double, bearing double, schedule_relationship string"


def _files(spark, name, batches):
    """A source with one file per batch of (query, seq, time)."""
    root = scratch_path(spark, name)
    for rows in batches:
        made = [(q, "1", q, "v", "s", k, str(t), 1.0, 1.0, 0.0, "SCHEDULED") for q, k, t in rows]
        spark.createDataFrame(made, COLS).coalesce(1).write.mode("append").parquet(root)
    return root


def test_replayed_pings_are_dropped_and_late_ones_counted(spark):
    t0, hour = 1_700_000_000, 3600
    batches = [[("a", 1, t0), ("b", 1, t0 + 10)], [("a", 1, t0), ("a", 2, t0 + hour), ("a", 2, t0 + hour)], [("c", 1, t0 + 9 * hour), ("b", 1, t0 + 10)],
               [("d", 1, t0 + 9 * hour + 5), ("h", 1, t0 + 2 * hour)], [("e", 1, t0 + hour), ("c", 1, t0 + 9 * hour), ("f", 1, t0 + 8 * hour)], [("e", 2, t0), ("g", 1, t0 + 10 * hour)]]
    src, late = _files(spark, "dups", batches), scratch_path(spark, "late")
    got = stream.clean_stream(spark, src, files_per_batch=1, lateness="2 hours", late=late)
    behind = stream.late_pings(spark, late)
    kept = rows(got, "trip_id", "seq")
    assert kept == [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("d", 1), ("f", 1), ("g", 1), ("h", 1)]     # the watermark of h's batch is of the batch before the last
    assert rows(behind, "trip_id", "seq") == [("e", 1), ("e", 2)]
    # without lateness nothing is dropped
    assert stream.clean_stream(spark, src, files_per_batch=1).count() == sum(map(len, batches))


def test_sink_of_many_batches_is_compacted(spark):
    root = scratch_path(spark, "sink")
    sink = stream.LatestSink(spark, root, "q", every=4)
    want = {}
    for epoch in range(11):
        made = [(f"q{k}", epoch * 10 + k) for k in range(epoch % 3, 6, 2)]
        want |= dict(made)
        sink.write(spark.createDataFrame(made, "q string, ts int").coalesce(1), epoch)
        sink.compact(epoch)
    assert sink.generation() == (2, 7)
    files_read = {"/".join(r["f"].split("/")[-4:-1]) for r in sink._rows(2).select(F.input_file_name().alias("f")).distinct().collect()}
    assert all("gen=2" in f for f in files_read)
    assert dict(rows(sink.read(), "q", "ts")) == want
    # a batch run again, before and after the base that holds it
    sink.write(spark.createDataFrame([("q9", 1)], "q string, ts int"), 3)
    assert dict(rows(sink.read(), "q", "ts")) == want
    # a compaction that dies: its base is there, the commit is not
    sink.write_base(3)
    assert sink.generation() == (2, 7) and dict(rows(sink.read(), "q", "ts")) == want
    sink.write(spark.createDataFrame([("q0", 999)], "q string, ts int"), 11)
    sink.compact(11)
    assert sink.generation() == (3, 11) and dict(rows(sink.read(), "q", "ts")) == want | {"q0": 999}


def test_streams_with_compaction(spark, work):
    w, _ = work
    src = stream.write_stream_source(w.query_raw(), scratch_path(spark, "stream_src"), 6)
    cols = ["query_id", "seq", "ts", "latitude"]
    want = rows(eta.latest_ping(clean.clean_pings(w.query_raw())), *cols)
    assert rows(stream.latest_ping_stream(spark, src, files_per_batch=1, compact_every=2), *cols) == want
    pats, rt = registry.patterns_tbl(spark, SF_SMALL), w.routes()
    cols = ["query_id", "route_id", "i", "stop_id", "level", "arrival_ts"]
    st, seq = w.static()
    want = rows(pipelines.predict(w.query_raw(), st, seq, pats, routes_tbl=rt), *cols)
    assert rows(stream.predict_stream(spark, src, rt, pats, files_per_batch=2, compact_every=2), *cols) == want
