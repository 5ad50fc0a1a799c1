"""Chunk boundaries are invisible: tiny chunks (about three pings each, so the
window carries span several chunks) give exactly the single-chunk result."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from headway.operators import clean, context, features
from headway.plans.workload import Workload

COLS = ["route_position", "next_lat", "next_lon", "next_timestamp", "current_stop_id", "distance_remaining",
        "duration_to_future_stops", "segment_distance", "segment_duration", "bearing_change", "speed",
        "acceleration", "direction_consistency"]


def _features(w, chunk):
    t = context.process_trips(clean.clean_pings(w.history_raw()), w.routes(), chunk_seconds=chunk)
    f = features.spatial_features(features.temporal_features(t))
    return {(r["date"], r["route_id"], r["trip_id"], r["seq"]): tuple(r[c] for c in COLS)
            for r in f.select("date", "route_id", "trip_id", "seq", *COLS).collect()}


def test_tiny_chunks_equal_one_chunk(spark):
    w = Workload(spark, SF_SMALL)
    small, whole = _features(w, 60), _features(w, 10 ** 8)
    assert len(small) == len(whole) > 0
    bad = [k for k in whole if small[k] != whole[k]]
    assert not bad, (bad[:3], [small[k] for k in bad[:1]], [whole[k] for k in bad[:1]])


def test_lists_after_the_windows(spark):
    """Trips whose lists come last have the rows of those that carry them, and
    no generated stage projects both the next stop and the next ping."""
    w = Workload(spark, SF_SMALL)
    p = clean.clean_pings(w.history_raw())
    narrow = context.process_trips(p, w.routes(), lists=False)
    assert not [c for c in narrow.columns if c.startswith("future_") or c == "_next_heads"]
    lists = ["future_stop_ids", "future_segment_distances", "duration_to_future_stops"]
    rows = lambda df: {(r["trip_id"], r["seq"]): tuple(r[c] for c in lists) for r in df.select("trip_id", "seq", *lists).collect()}
    got, want = rows(context.with_lists(narrow, w.routes())), rows(context.process_trips(p, w.routes()))
    assert got == want and len(got) > 0
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = features.spatial_features(narrow)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    parts = plan.split("- Window [")
    found = [[f"_{c}_x1_xi" in x for c in ("segment_distance", "distance_to_next_route_stop")] for x in parts]
    assert any(a for a, _ in found) and any(b for _, b in found)
    assert not any(a and b for a, b in found)
