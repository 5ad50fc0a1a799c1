"""Registered queries: one per operator key of the inventory.

Each entry has a Spark callable ``(spark, sf_dir) -> DataFrame``, the
equivalent DuckDB SQL (or None for a rows-only check) and an output spec.
The spec canonicalises both sides the same way: ids as text, integers as
BIGINT, doubles rounded half-to-even at a stated number of decimals,
timestamps as text with microseconds.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo, timeparts
from .oracle import sql as O
from .operators import clean, context, eta, evaluate as ev, features as feat, mapmatch, patterns as pat
from .operators import reports, routes as rts, static
from .plans import pipelines
from .plans.workload import Workload
from .session import scratch_path
from .sources import files, fixtures as fx

# ---- canonical output ------------------------------------------------------------


def _spec(s: str) -> list[tuple[str, str]]:
    return [tuple(x.split(":")) for x in s.split()]


def canon(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for name, kind in _spec(spec):
        c = F.col(name)
        if kind == "s":
            e = c.cast("string")
        elif kind == "i":
            e = c.cast("bigint")
        elif kind == "b":
            e = c.cast("boolean")
        elif kind.startswith("ad"):
            k = int(kind[2:])
            e = F.expr(f"transform(`{name}`, x -> rint(CAST(x AS DOUBLE) * 1e{k}) / 1e{k})")
        elif kind[0] == "d" and kind[1:].isdigit():
            k = int(kind[1:])
            e = F.expr(f"rint(CAST(`{name}` AS DOUBLE) * 1e{k}) / 1e{k}")
        elif kind == "t":
            e = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            e = c.cast("date").cast("string")
        elif kind == "as":
            e = c.cast("array<string>")
        elif kind == "ai":
            e = c.cast("array<bigint>")
        elif kind == "at":
            e = F.expr(f"transform(`{name}`, x -> date_format(x, 'yyyy-MM-dd HH:mm:ss.SSSSSS'))")
        else:
            raise ValueError(kind)
        out.append(e.alias(name))
    return df.select(*out)


def canon_sql(inner: str, spec: str) -> str:
    cols = []
    for name, kind in _spec(spec):
        c = f'"{name}"'
        if kind == "s":
            e = f"CAST({c} AS VARCHAR)"
        elif kind == "i":
            e = f"CAST({c} AS BIGINT)"
        elif kind == "b":
            e = f"CAST({c} AS BOOLEAN)"
        elif kind.startswith("ad"):
            k = int(kind[2:])
            e = f"list_transform({c}, lambda x: round_even(CAST(x AS DOUBLE) * 1e{k}, 0) / 1e{k})"
        elif kind[0] == "d" and kind[1:].isdigit():
            k = int(kind[1:])
            e = f"round_even(CAST({c} AS DOUBLE) * 1e{k}, 0) / 1e{k}"
        elif kind == "t":
            e = f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
        elif kind == "date":
            e = f"strftime({c}, '%Y-%m-%d')"
        elif kind == "as":
            e = f"CAST({c} AS VARCHAR[])"
        elif kind == "ai":
            e = f"CAST({c} AS BIGINT[])"
        elif kind == "at":
            e = f"list_transform({c}, lambda x: strftime(x, '%Y-%m-%d %H:%M:%S.%f'))"
        else:
            raise ValueError(kind)
        cols.append(f"{e} AS {c}")
    return f"SELECT {', '.join(cols)} FROM ({inner}) AS _q"


# ---- shared derived tables (small ones are stored once per session and scale) --------

_CACHE: dict = {}


def _cached(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _CACHE:
        _CACHE[key] = static.materialize(build())
    return _CACHE[key]


def _wl(spark, sf) -> Workload:
    key = (spark.sparkContext.applicationId, sf, "workload")
    if key not in _CACHE:
        _CACHE[key] = Workload(spark, sf)
    return _CACHE[key]


def routes_tbl(spark, sf):
    return _wl(spark, sf).routes()


def all_features(spark, sf, stored: bool = False):
    """Planned anew by each query, which reads the columns it needs: a stored
    table of all takes many times the input's disk. The route statistics are
    ``stored`` for the queries that read them."""
    return _wl(spark, sf).features(stored=stored)


def all_trips(spark, sf):
    """As :func:`all_features`; the lists are read out of the route's row by the queries that have them."""
    w = _wl(spark, sf)
    return context.with_lists(context.process_trips(w.clean_pings(), w.routes(), lists=False), w.routes())


def patterns_tbl(spark, sf):
    return _cached(spark, sf, "patterns", lambda: pipelines.fit_patterns(
        all_features(spark, sf).where(F.col("date") < F.lit(fx.QUERY_FROM_DATE).cast("date"))))


def predictions_tbl(spark, sf):
    w = _wl(spark, sf)
    st, seq = w.static()
    return _cached(spark, sf, "predictions", lambda: pipelines.predict(
        w.query_raw(), st, seq, patterns_tbl(spark, sf), routes_tbl=w.routes()))


def actuals_tbl(spark, sf):
    return _cached(spark, sf, "actuals", lambda: _wl(spark, sf).actuals())


def pred_text(spark, sf):
    return predictions_tbl(spark, sf).select(
        "query_id", "stop_id", timeparts.format_arrival("arrival_ts").alias("arrival"))


def stop_errs(spark, sf):
    return ev.stop_errors(actuals_tbl(spark, sf), pred_text(spark, sf), "query_id")


def scores_tbl(spark, sf):
    return ev.route_scores(stop_errs(spark, sf), "query_id")


# ---- registry ----------------------------------------------------------------------

REG: dict[str, tuple[Callable, str | None, str]] = {}


def reg(key: str, spec: str, sql_body: str | None, *roots: str):
    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return canon(fn(spark, sf), spec)
        run.__name__ = key
        sql = None if sql_body is None else canon_sql(O.with_ctes(sql_body, *roots), spec)
        REG[key] = (run, sql, spec)
        return fn
    return deco


PK = "date:date route_id:s trip_id:s seq:i"
RAWK = "route_id:s trip_id:s seq:i"

# -- 2.1 scans and sinks --


@reg("src_stops", "stop_id:s stop_lat:d9 stop_lon:d9", "SELECT * FROM fx_stops", "fx_stops")
def _src_stops(spark, sf):
    path = scratch_path(spark, "stops_csv")
    fx.stops(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    return files.read_stops_csv(spark, path)


@reg("src_route_sequences", "route_id:i stop_id_list:as", "SELECT * FROM fx_seqs", "fx_seqs")
def _src_seqs(spark, sf):
    path = scratch_path(spark, "seq_csv")
    (fx.route_sequences_csv_text(spark, sf).write.mode("overwrite").option("header", True)
     .option("quoteAll", True).option("escape", '"').csv(path))
    return files.read_route_sequences_csv(spark, path)


@reg("src_static_processed", "route_id:i stop_id_list:as next_stop_distances:ad1",
     "SELECT * FROM seq_dists", "seq_dists")
def _src_static(spark, sf):
    path = scratch_path(spark, "static_csv")
    st, seq = _wl(spark, sf).static()
    (seq.select("route_id", timeparts.list_join("stop_id_list").alias("stop_id_list"),
                timeparts.list_join("next_stop_distances").alias("next_stop_distances"))
     .write.mode("overwrite").option("header", True).csv(path))
    return files.read_processed_sequences_csv(spark, path)


RAW_SPEC = (RAWK + " vehicle_id:s stop_id:s vehicle_timestamp:s latitude:d9 longitude:d9 bearing:d6 "
            "schedule_relationship:s date:date")


@reg("src_pings", RAW_SPEC, "SELECT * FROM fx_raw", "fx_raw")
def _src_pings(spark, sf):
    path = scratch_path(spark, "pings")
    fx.raw_pings(spark, sf, by_day=True).write.mode("overwrite").partitionBy("date").parquet(path)   # the orders are shuffled, not their pings
    return files.read_pings(spark, path)


@reg("src_pings_audit", "date:s files_read:b empty:i unreadable:i damaged:i rows:i status:s",
     """SELECT strftime(date, '%Y-%m-%d') AS date, true AS files_read, 0 AS empty, 0 AS unreadable, 0 AS damaged, count(*) AS rows, 'ok' AS status
        FROM fx_raw GROUP BY date
        UNION ALL SELECT '1900-01-01', false, 0, 0, 0, 0, 'missing'""", "fx_raw")
def _src_audit(spark, sf):
    """Every date of the pings, and one that has no folder."""
    path = scratch_path(spark, "pings")
    fx.raw_pings(spark, sf, by_day=True).write.partitionBy("date").parquet(path)
    days = [r["date"] for r in fx.raw_pings(spark, sf).select("date").distinct().collect()]     # the dates asked for: a list, as for read_pings
    return files.audit_pings(spark, path, [*days, "1900-01-01"]).withColumn("files_read", F.col("files") > 0)


def _manifest(spark, sf) -> str:
    """Every query in a folder of its own, and the manifest that lists them."""
    root = scratch_path(spark, "queries")
    q = _wl(spark, sf).query_raw()
    q.repartition("query_id").write.mode("overwrite").partitionBy("query_id").parquet(root)
    ids = sorted(r["query_id"] for r in q.select("query_id").distinct().collect())  # manifest = config
    ids.sort(key=int)
    manifest = {i: f"{root}/query_id={i}" for i in ids}
    mpath = scratch_path(spark, "manifest")
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(mpath)
    return mpath


@reg("src_query_manifest", RAWK + " query_id:s manifest_pos:i latitude:d9",
     """SELECT route_id, trip_id, seq, query_id, latitude,
        dense_rank() OVER (ORDER BY CAST(query_id AS BIGINT)) - 1 AS manifest_pos FROM q_raw""", "q_raw")
def _src_manifest(spark, sf):
    return files.read_query_manifest(spark, _manifest(spark, sf))


@reg("src_query_status", "query_id:s manifest_pos:i rows:i status:s",
     """SELECT query_id, dense_rank() OVER (ORDER BY CAST(query_id AS BIGINT)) - 1 AS manifest_pos, count(*) AS rows, 'ok' AS status
        FROM q_raw GROUP BY query_id""", "q_raw")
def _src_status(spark, sf):
    return files.query_status(spark, _manifest(spark, sf))


FEAT_OUT = PK + " current_stop_id:s route_position:i speed:d6 segment_distance:d3 hour:i"


@reg("src_route_features", FEAT_OUT, "SELECT * FROM h_full", "h_full")
def _src_feats(spark, sf):
    root = scratch_path(spark, "features")
    files.write_route_features(all_features(spark, sf, stored=True), root)
    return files.read_route_features(spark, root)


@reg("src_route_features_mixed", PK + " route_position:i speed:d6", "SELECT * FROM h_full", "h_full")
def _src_feats_mixed(spark, sf):
    """Files that disagree on the type of one column: by date an int, a double or a text."""
    root = scratch_path(spark, "features_mixed")
    f = static.materialize(all_features(spark, sf).select("date", "route_id", "trip_id", "seq", "route_position", "speed"))   # read three times
    for k, kind in enumerate(("int", "double", "string")):
        part = f.where(F.dayofyear("date") % 3 == k).withColumn("route_position", F.col("route_position").cast(kind))
        part.repartitionByRange(8, "date").write.mode("append").partitionBy("date").parquet(root)
    return files.read_route_features(spark, root).withColumn("route_position", F.expr("try_cast(route_position as double)"))


PAT_SPEC = ("current_stop_id:s hour:i day_of_week:i dur_mean:d6 dur_std:d6 dur_count:i speed_mean:d6 "
            "speed_std:d6 dist_mean:d3")


@reg("src_patterns", PAT_SPEC, "SELECT * FROM patterns", "patterns")
def _src_patterns(spark, sf):
    path = scratch_path(spark, "patterns")
    files.write_patterns(patterns_tbl(spark, sf), path)
    return files.read_patterns(spark, path)


@reg("src_eta_json", "query_id:s stop_id:s arrival:s", "SELECT * FROM pred_text", "pred_text")
def _src_eta(spark, sf):
    path = scratch_path(spark, "eta_json")
    files.write_predictions_json(predictions_tbl(spark, sf), path, "query_id")
    return files.read_eta_json(spark, path, "query_id")


@reg("sink_static", "part:s id:s pos:i stop_id:s x:d9 y:d9",
     """SELECT 'stop' AS part, stop_id AS id, NULL AS pos, stop_id, stop_lon AS x, stop_lat AS y FROM fx_stops
        UNION ALL
        SELECT 'sequence', CAST(route_id AS VARCHAR), u.i - 1, u.stop_id, next_stop_distances[u.i], NULL
        FROM seq_dists CROSS JOIN LATERAL unnest(stop_id_list) WITH ORDINALITY AS u(stop_id, i)""", "fx_stops", "seq_dists")
def _sink_static(spark, sf):
    root = scratch_path(spark, "static")
    files.write_static(*_wl(spark, sf).static(), root)
    st, seq = files.read_static(spark, root)
    st = st.select(F.lit("stop").alias("part"), F.col("stop_id").alias("id"), F.lit(None).cast("int").alias("pos"), "stop_id",
                   F.col("stop_lon").alias("x"), F.col("stop_lat").alias("y"))
    seq = seq.select("route_id", "next_stop_distances", F.posexplode("stop_id_list").alias("pos", "stop_id"))
    return st.unionByName(seq.select(F.lit("sequence").alias("part"), F.col("route_id").cast("string").alias("id"), "pos", "stop_id",
                                     F.expr("next_stop_distances[pos]").alias("x"), F.lit(None).cast("double").alias("y")))


@reg("sink_route_features", "route_id:s date:date n:i",
     "SELECT route_id, date, count(*) AS n FROM h_full GROUP BY ALL", "h_full")
def _sink_feats(spark, sf):
    root = scratch_path(spark, "features_sink")
    files.write_route_features(all_features(spark, sf, stored=True), root)
    r = files.read_route_features(spark, root)
    return r.groupBy("route_id", "date").agg(F.count(F.lit(1)).alias("n"))


@reg("sink_patterns", PAT_SPEC, "SELECT * FROM patterns", "patterns")
def _sink_patterns(spark, sf):
    return _src_patterns(spark, sf)


@reg("sink_predictions_json", "query_id:s stop_id:s arrival:s", "SELECT * FROM pred_text", "pred_text")
def _sink_pred(spark, sf):
    path = scratch_path(spark, "pred_json")
    files.write_predictions_json(predictions_tbl(spark, sf), path, "query_id")
    t = spark.read.text(path).select(F.explode(F.from_json("value", files.ETA_MAP)).alias("query_id", "stops"))
    return t.select("query_id", F.explode("stops").alias("stop_id", "arrival"))


@reg("sink_evaluation_json", "total_routes:i overall_eta_score_minutes:d6 route_id:s eta_score_minutes:d6",
     """SELECT total_routes, overall_eta_score_minutes, query_id AS route_id, eta_score_minutes FROM scores
        CROSS JOIN (SELECT count(*) AS total_routes, avg(eta_score_minutes) AS overall_eta_score_minutes FROM scores)""", "scores")
def _sink_eval(spark, sf):
    path = scratch_path(spark, "eval_json")
    files.write_evaluation_json(scores_tbl(spark, sf), path, "query_id")
    doc = spark.read.text(path).select(F.from_json(
        "value", "total_routes bigint, overall_eta_score_minutes double, route_details array<struct<route_id: string, eta_score_minutes: double>>").alias("d"))
    return doc.select("d.total_routes", "d.overall_eta_score_minutes", F.explode("d.route_details").alias("r")).select("total_routes", "overall_eta_score_minutes", "r.*")


# -- 2.2 projections and filters --

@reg("clean_strip_quotes", RAWK + " vehicle_id:s stop_id:s",
     "SELECT replace(route_id, '\"', '') AS route_id, replace(trip_id, '\"', '') AS trip_id, seq, "
     "replace(vehicle_id, '\"', '') AS vehicle_id, replace(stop_id, '\"', '') AS stop_id FROM fx_raw", "fx_raw")
def _p1(spark, sf):
    return clean.strip_quotes(fx.raw_pings(spark, sf))


@reg("clean_epoch_ts", "trip_id:s seq:i vehicle_timestamp:d3 ts:t",
     "SELECT trip_id, seq, secs AS vehicle_timestamp, make_timestamp(CAST(round(secs * 1e6) AS BIGINT)) AS ts "
     "FROM (SELECT *, TRY_CAST(replace(vehicle_timestamp, '\"', '') AS DOUBLE) AS secs FROM fx_raw)", "fx_raw")
def _p2(spark, sf):
    return clean.epoch_to_ts(fx.raw_pings(spark, sf))


@reg("clean_valid_gps", RAWK + " latitude:d9 longitude:d9",
     "SELECT * FROM fx_raw WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180", "fx_raw")
def _p3(spark, sf):
    return clean.valid_gps(fx.raw_pings(spark, sf))


@reg("clean_schedule_status", RAWK + " schedule_relationship:s",
     "SELECT * FROM fx_raw WHERE schedule_relationship IN ('\"ADDED\"', '\"SCHEDULED\"', 'ADDED', 'SCHEDULED')",
     "fx_raw")
def _p4(spark, sf):
    return clean.schedule_status(fx.raw_pings(spark, sf))


@reg("clean_drop_incomplete", RAWK + " ts:t",
     "SELECT * FROM (SELECT *, make_timestamp(CAST(round(TRY_CAST(replace(vehicle_timestamp, '\"', '') AS DOUBLE) "
     "* 1e6) AS BIGINT)) AS ts FROM fx_raw) WHERE ts IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL",
     "fx_raw")
def _p5(spark, sf):
    return clean.drop_incomplete(clean.epoch_to_ts(fx.raw_pings(spark, sf)))


CLEAN_SPEC = (RAWK + " vehicle_id:s stop_id:s vehicle_timestamp:d3 ts:t latitude:d9 longitude:d9 bearing:d6 "
              "schedule_relationship:s date:date")


@reg("clean_pings", CLEAN_SPEC, "SELECT * FROM clean", "clean")
def _p6(spark, sf):
    return clean.clean_pings(fx.raw_pings(spark, sf))


@reg("filter_route", CLEAN_SPEC, "SELECT * FROM clean WHERE route_id = '7'", "clean")
def _p7(spark, sf):
    return clean.filter_route(clean.clean_pings(fx.raw_pings(spark, sf)), "7")


@reg("filter_moving_segments", PK + " segment_duration:d3 speed:d6",
     "SELECT * FROM h_full WHERE segment_duration > 0", "h_full")
def _p8(spark, sf):
    return clean.moving_segments(all_features(spark, sf))


@reg("select_routes", "date:date route_id:s n:i",
     """SELECT date, route_id, count(*) AS n FROM clean
        WHERE (date, route_id) IN (SELECT (date, route_id) FROM (
          SELECT date, route_id, row_number() OVER (PARTITION BY date ORDER BY n DESC, route_id) AS rk
          FROM (SELECT date, route_id, count(*) AS n FROM clean GROUP BY ALL)) WHERE rk <= 5)
        GROUP BY ALL""", "clean")
def _p9(spark, sf):
    sel = rts.select_routes(clean.clean_pings(fx.raw_pings(spark, sf)), k=5)
    return sel.groupBy("date", "route_id").agg(F.count(F.lit(1)).alias("n"))


FM_COLS = ["hour", "speed", "acceleration", "route_complexity", "stops_remaining", "progress_ratio"]
FM_SPEC = PK + " " + " ".join(f"{c}:d6" for c in FM_COLS)


@reg("feature_matrix", FM_SPEC,
     "SELECT date, route_id, trip_id, seq, " + ", ".join(
         f"coalesce(CASE WHEN isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) THEN NULL "
         f"ELSE CAST({c} AS DOUBLE) END, 0e0) AS {c}" for c in FM_COLS) + " FROM h_full", "h_full")
def _p10(spark, sf):
    m = clean.feature_matrix(all_features(spark, sf, stored=True), keep=("date", "route_id", "trip_id"))
    return m.select("date", "route_id", "trip_id", "seq", *FM_COLS)


# -- 2.3 joins --

@reg("join_sequence_stops", "route_id:i pos:i stop_id:s stop_lat:d9 stop_lon:d9 known:b",
     "SELECT rs.route_id, rs.pos, rs.stop_id, s.stop_lat, s.stop_lon, s.stop_lat IS NOT NULL AS known "
     "FROM fx_route_stops rs LEFT JOIN fx_stops s USING (stop_id)", "fx_route_stops", "fx_stops")
def _j1(spark, sf):
    return static.join_sequence_stops(fx.route_sequences(spark, sf), fx.stops(spark, sf))


@reg("join_route_sequence", PK + " n:i",
     "SELECT p.date, p.route_id, p.trip_id, p.seq, r.n FROM clean p "
     "JOIN routes_info r ON r.route_id = TRY_CAST(p.route_id AS BIGINT)", "clean", "routes_info")
def _j2(spark, sf):
    p = clean.clean_pings(fx.raw_pings(spark, sf))
    return mapmatch.attach_route(p, routes_tbl(spark, sf))


@reg("join_next_stop_geometry", PK + " next_stop_id:s stop_lat:d9 stop_lon:d9",
     "SELECT c.date, c.route_id, c.trip_id, c.seq, c.next_stop_id, s.stop_lat, s.stop_lon "
     "FROM h_ctx2 c LEFT JOIN fx_stops s ON s.stop_id = c.next_stop_id", "h_ctx2", "fx_stops")
def _j3(spark, sf):
    st = fx.stops(spark, sf).withColumnRenamed("stop_id", "next_stop_id")
    return all_trips(spark, sf).join(st, "next_stop_id", "left")


@reg("join_ping_segments", PK + " open:ai",
     "SELECT date, route_id, trip_id, seq, coalesce(open, []::INTEGER[]) AS open FROM h_ord", "h_ord")
def _j4(spark, sf):
    w = _wl(spark, sf)
    return mapmatch.with_segments(mapmatch.attach_route(w.clean_pings(), w.routes()), w.routes(), "open")


@reg("join_first_arrival", "date:date route_id:s trip_id:s stop_id:s first_ts:t",
     "SELECT * FROM h_fa", "h_fa")
def _j5(spark, sf):
    w = _wl(spark, sf)
    m = mapmatch.map_match(w.clean_pings(), w.routes())
    per_trip = m.groupBy(*mapmatch.TRIP_KEYS).agg(F.first("first_arrival").alias("fa"))
    return per_trip.select(*mapmatch.TRIP_KEYS, F.explode("fa").alias("stop_id", "first_ts"))


PRED_SPEC = ("query_id:s route_id:s i:i stop_id:s key_stop:s level:i speed_mps:d6 distance_m:d3 "
             "duration_s:d3 arrival_ts:t")


@reg("join_pattern_ladder", PRED_SPEC, "SELECT * FROM predictions", "predictions")
def _j6(spark, sf):
    return predictions_tbl(spark, sf)


LADDER_CELLS = "SELECT * FROM patterns WHERE hour BETWEEN 5 AND 8 AND day_of_week < 5"


@reg("join_pattern_ladder_levels", "model_key:s key_stop:s hour:i day_of_week:i speed:d6 level:i",
     f"""SELECT * FROM (WITH cells AS ({LADDER_CELLS}),
        asked AS (SELECT s AS key_stop, CAST(h AS INTEGER) AS hour, CAST(d AS INTEGER) AS day_of_week
          FROM (SELECT DISTINCT current_stop_id AS s FROM patterns UNION ALL SELECT 'nowhere') CROSS JOIN range(24) a(h) CROSS JOIN range(7) b(d)),
        found AS (SELECT a.*,
          (SELECT avg(speed_mean) FROM cells c WHERE c.current_stop_id = a.key_stop AND c.hour = a.hour AND c.day_of_week = a.day_of_week) AS l1,
          (SELECT avg(speed_mean) FROM cells c WHERE c.current_stop_id = a.key_stop AND c.hour = a.hour) AS l2,
          (SELECT avg(speed_mean) FROM cells c WHERE c.current_stop_id = a.key_stop AND abs(c.hour - a.hour) = 1) AS l3,
          (SELECT avg(speed_mean) FROM cells c WHERE c.hour = a.hour AND c.day_of_week = a.day_of_week) AS l4,
          (SELECT avg(speed_mean) FROM cells c WHERE c.current_stop_id = a.key_stop) AS l5,
          (SELECT avg(speed_mean) FROM cells) AS g FROM asked a),
        used AS (SELECT *, coalesce(l1, l2, l3, l4, l5) AS v,
          CASE WHEN l1 IS NOT NULL THEN 1 WHEN l2 IS NOT NULL THEN 2 WHEN l3 IS NOT NULL THEN 3 WHEN l4 IS NOT NULL THEN 4 ELSE 5 END AS lvl FROM found)
        SELECT 'cells' AS model_key, key_stop, hour, day_of_week, CASE WHEN coalesce(v, 0) <> 0 THEN v ELSE g END AS speed,
          CASE WHEN coalesce(v, 0) <> 0 THEN lvl ELSE 6 END AS level FROM used
        UNION ALL SELECT 'standing', key_stop, hour, day_of_week, 2e1 / 3.6e0, 7 FROM asked)""", "patterns")
def _j6_levels(spark, sf):
    """Every stop of the network and an unknown one, at every hour and weekday,
    against the cells of weekday mornings, and against a model where nothing moves."""
    p = patterns_tbl(spark, sf)
    cells = p.where("hour BETWEEN 5 AND 8 AND day_of_week < 5")
    stops = p.select(F.col("current_stop_id").alias("key_stop")).distinct().unionByName(spark.createDataFrame([("nowhere",)], "key_stop string"))
    asked = (stops.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn("day_of_week", F.explode(F.sequence(F.lit(0), F.lit(6)))))
    models = static.materialize(cells.withColumn("model_key", F.lit("cells")).unionByName(cells.withColumn("model_key", F.lit("standing")).withColumn("speed_mean", F.lit(0.0))))
    got = [pat.ladder_speed(asked, models, model_key=k).withColumn("model_key", F.lit(k)) for k in ("cells", "standing")]
    return got[0].unionByName(got[1])


@reg("join_route_characteristics", PK + " route_length:d3 route_complexity:d6 route_stop_density:d9 "
     "route_avg_speed:d6", "SELECT * FROM h_full", "h_full")
def _j7(spark, sf):
    return all_features(spark, sf, stored=True)


ERR_SPEC = "query_id:s stop_id:s key_predicted:b abs_min:d6 diff_s:d3"


@reg("join_actual_predicted", ERR_SPEC, "SELECT * FROM stop_err", "stop_err")
def _j8(spark, sf):
    return stop_errs(spark, sf)


# -- 2.4 aggregations --

@reg("agg_route_volume", "date:date route_id:s n:i",
     "SELECT date, route_id, count(*) AS n FROM clean GROUP BY ALL", "clean")
def _a1(spark, sf):
    return rts.route_volume(clean.clean_pings(fx.raw_pings(spark, sf)))


@reg("agg_stop_patterns", PAT_SPEC, "SELECT * FROM patterns", "patterns")
def _a2(spark, sf):
    return patterns_tbl(spark, sf)


@reg("agg_route_patterns", "model_key:s " + PAT_SPEC,
     """SELECT route_id AS model_key, current_stop_id, hour, day_of_week, avg(segment_duration) AS dur_mean,
        stddev_samp(segment_duration) AS dur_std, count(segment_duration) AS dur_count, avg(speed) AS speed_mean,
        stddev_samp(speed) AS speed_std, avg(segment_distance) AS dist_mean
        FROM h_feat WHERE segment_duration > 0 GROUP BY ALL""", "h_feat")
def _a3(spark, sf):
    return pat.train(all_features(spark, sf), per_route=True)


RSTAT_SPEC = "date:date route_id:s avg_trip_length:d3 stop_density:d9 avg_speed:d6 complexity_score:d6"


@reg("agg_route_characteristics", RSTAT_SPEC, "SELECT * FROM h_rstats", "h_rstats")
def _a4(spark, sf):
    return feat.route_characteristics(all_features(spark, sf))


@reg("agg_route_complexity", "date:date route_id:s complexity_score:d6", "SELECT * FROM h_rstats", "h_rstats")
def _a5(spark, sf):
    return feat.route_characteristics(all_features(spark, sf))


@reg("agg_ladder_levels", "level:i s:s hour:i day_of_week:i mean:d6 cells:i",
     """SELECT 2 AS level, current_stop_id AS s, hour, NULL AS day_of_week, avg(speed_mean) AS mean, count(*) AS cells
          FROM patterns GROUP BY ALL
        UNION ALL SELECT 4, NULL, hour, day_of_week, avg(speed_mean), count(*) FROM patterns GROUP BY hour, day_of_week
        UNION ALL SELECT 5, current_stop_id, NULL, NULL, avg(speed_mean), count(*) FROM patterns GROUP BY current_stop_id
        UNION ALL SELECT 6, NULL, NULL, NULL, avg(speed_mean), count(*) FROM patterns""", "patterns")
def _a6(spark, sf):
    lv = pat.ladder_levels(patterns_tbl(spark, sf))
    n = F.lit(None)
    return (lv["l2"].select(F.lit(2).alias("level"), "s", "hour", n.cast("int").alias("day_of_week"),
                            F.col("l2").alias("mean"), F.col("l2_cells").alias("cells"))
            .unionByName(lv["l4"].select(F.lit(4).alias("level"), n.cast("string").alias("s"), "hour",
                                         "day_of_week", F.col("l4").alias("mean"), F.col("l4_cells").alias("cells")))
            .unionByName(lv["l5"].select(F.lit(5).alias("level"), "s", n.cast("int").alias("hour"),
                                         n.cast("int").alias("day_of_week"), F.col("l5").alias("mean"),
                                         F.col("l5_cells").alias("cells")))
            .unionByName(patterns_tbl(spark, sf).agg(
                F.lit(6).alias("level"), n.cast("string").alias("s"), n.cast("int").alias("hour"),
                n.cast("int").alias("day_of_week"), F.avg("speed_mean").alias("mean"),
                F.count(F.lit(1)).alias("cells"))))


@reg("agg_eta_score_route", "query_id:s eta_score_minutes:d6", "SELECT * FROM scores", "scores")
def _a7(spark, sf):
    return scores_tbl(spark, sf)


@reg("agg_eta_score_overall", "total_routes:i overall_eta_score_minutes:d6",
     "SELECT count(*) AS total_routes, avg(eta_score_minutes) AS overall_eta_score_minutes FROM scores", "scores")
def _a8(spark, sf):
    return ev.overall_score(scores_tbl(spark, sf))


@reg("agg_distance_remaining", PK + " distance_to_next_route_stop:d3 distance_remaining_after_next_stop:d3 "
     "distance_remaining:d3", "SELECT * FROM h_ctx2", "h_ctx2")
def _a9(spark, sf):
    return all_trips(spark, sf)


@reg("agg_first_arrival", "date:date route_id:s trip_id:s stop_id:s first_ts:t",
     "SELECT date, route_id, trip_id, current_stop_id AS stop_id, min(ts) AS first_ts FROM h_ctx2 GROUP BY ALL",
     "h_ctx2")
def _a10(spark, sf):
    return (all_trips(spark, sf).groupBy(*mapmatch.TRIP_KEYS, F.col("current_stop_id").alias("stop_id"))
            .agg(F.min("ts").alias("first_ts")))


@reg("agg_distinct_trips", "date:date route_id:s n_trips:i n_rows:i trip_ids:as",
     "SELECT date, route_id, count(DISTINCT trip_id) AS n_trips, count(*) AS n_rows, "
     "coalesce(list(DISTINCT trip_id ORDER BY trip_id) FILTER (WHERE trip_id IS NOT NULL), []::VARCHAR[]) AS trip_ids FROM clean GROUP BY ALL",
     "clean")
def _a11(spark, sf):
    return rts.distinct_trips(clean.clean_pings(fx.raw_pings(spark, sf)))


@reg("report_error_summary", "query_id:s n_stops:i mae_s:d3 rmse_s:d3 max_abs_s:d3 exact:i within_1min:i "
     "within_2min:i within_5min:i",
     """SELECT query_id, count(*) AS n_stops, avg(abs(diff_s)) AS mae_s, sqrt(avg(diff_s * diff_s)) AS rmse_s,
        max(abs(diff_s)) AS max_abs_s, count(*) FILTER (WHERE abs(diff_s) = 0) AS exact,
        count(*) FILTER (WHERE abs(diff_s) <= 60) AS within_1min,
        count(*) FILTER (WHERE abs(diff_s) <= 120) AS within_2min,
        count(*) FILTER (WHERE abs(diff_s) <= 300) AS within_5min
        FROM stop_err WHERE diff_s IS NOT NULL GROUP BY query_id""", "stop_err")
def _a12(spark, sf):
    return ev.error_summary(stop_errs(spark, sf), "query_id")


@reg("report_speed_by_hour_day", "current_stop_id:s date:date hour:i mean_speed:d6 n:i",
     "SELECT current_stop_id, date, hour, avg(speed) AS mean_speed, count(*) AS n FROM h_full "
     "WHERE segment_duration > 0 GROUP BY ALL", "h_full")
def _a13(spark, sf):
    return reports.speed_by_hour_day(all_features(spark, sf))


@reg("report_speed_histogram", "current_stop_id:s hour:i bucket:i n:i",
     "SELECT current_stop_id, hour, least(CAST(floor(speed / 1e0) AS INTEGER), 30) AS bucket, count(*) AS n "
     "FROM h_full WHERE segment_duration > 0 GROUP BY ALL", "h_full")
def _a14(spark, sf):
    return reports.speed_histogram(all_features(spark, sf))


@reg("report_pattern_inventory", "route_id:s n_stops:i n_cells:i",
     "SELECT route_id, count(DISTINCT current_stop_id) AS n_stops, "
     "count(DISTINCT (current_stop_id, hour, day_of_week)) AS n_cells FROM h_full WHERE segment_duration > 0 "
     "GROUP BY route_id", "h_full")
def _a15(spark, sf):
    return reports.pattern_inventory(all_features(spark, sf))


# -- 2.5 windows --

@reg("win_next_ping", PK + " next_lat:d9 next_lon:d9 next_timestamp:t", "SELECT * FROM h_ctx2", "h_ctx2")
def _w1(spark, sf):
    return all_trips(spark, sf)


@reg("win_next_stop_distance", "route_id:i stop_id_list:as next_stop_distances:ad1",
     "SELECT * FROM seq_dists", "seq_dists")
def _w2(spark, sf):
    return _wl(spark, sf).static()[1]


@reg("win_bearing_change", PK + " bearing_change:d6", "SELECT * FROM h_feat", "h_feat")
def _w3(spark, sf):
    return all_features(spark, sf)


@reg("win_acceleration", PK + " speed:d6 acceleration:d6", "SELECT * FROM h_feat", "h_feat")
def _w4(spark, sf):
    return all_features(spark, sf)


@reg("win_direction_consistency", PK + " direction_consistency:d6", "SELECT * FROM h_feat", "h_feat")
def _w5(spark, sf):
    return all_features(spark, sf)


@reg("win_direction_consistency_route", PK + " direction_consistency:d6",
     """SELECT date, route_id, trip_id, seq,
        CASE WHEN count(*) OVER w = 5 THEN avg(abs(bearing_change)) OVER w END AS direction_consistency
        FROM (SELECT *, min(ts) OVER (PARTITION BY date, route_id, trip_id) AS tfirst FROM h_feat)
        WINDOW w AS (PARTITION BY date, route_id ORDER BY tfirst, trip_id, ts, seq
                     ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""", "h_feat")
def _w5r(spark, sf):
    f = static.materialize(all_features(spark, sf).select("date", "route_id", "trip_id", "seq", "ts", "bearing_change"))     # read four times
    return feat.direction_consistency(f, scope="route")


@reg("win_direction_consistency_route_features", PK + " direction_consistency:d6",
     """SELECT date, route_id, trip_id, seq,
        CASE WHEN count(*) OVER w = 5 THEN avg(abs(bearing_change)) OVER w END AS direction_consistency
        FROM (SELECT *, min(ts) OVER (PARTITION BY date, route_id, trip_id) AS tfirst FROM h_feat)
        WINDOW w AS (PARTITION BY date, route_id ORDER BY tfirst, trip_id, ts, seq
                     ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""", "h_feat")
def _w5rf(spark, sf):
    """The same within the feature run, from the carries of the chunks."""
    return _wl(spark, sf).features(rolling_scope="route", stored=False)


@reg("win_map_match", PK + " route_position:i", "SELECT * FROM h_mm", "h_mm")
def _w6(spark, sf):
    w = _wl(spark, sf)
    return mapmatch.map_match(w.clean_pings(), w.routes())


@reg("win_cumulative_eta", "query_id:s i:i duration_s:d3 arrival_ts:t", "SELECT * FROM predictions",
     "predictions")
def _w7(spark, sf):
    return predictions_tbl(spark, sf)


@reg("win_latest_ping", "query_id:s ts:t seq:i latitude:d9 longitude:d9", "SELECT * FROM q_latest", "q_latest")
def _w8(spark, sf):
    return eta.latest_ping(clean.clean_pings(_wl(spark, sf).query_raw()))


# -- 2.6 sorts and top-k --

@reg("sort_trip_pings", PK + " r:i",
     "SELECT *, row_number() OVER (PARTITION BY date, route_id, trip_id ORDER BY ts, seq) AS r FROM clean", "clean")
def _t1(spark, sf):
    from pyspark.sql import Window
    p = clean.clean_pings(fx.raw_pings(spark, sf))
    return p.withColumn("r", F.row_number().over(Window.partitionBy(*mapmatch.TRIP_KEYS).orderBy("ts", "seq")))


TOPK_SQL = """SELECT * FROM (SELECT date, route_id, n, row_number() OVER (PARTITION BY date ORDER BY n DESC, route_id) AS rank
  FROM (SELECT date, route_id, count(*) AS n FROM clean {where} GROUP BY ALL)) WHERE rank <= 5"""


@reg("topk_routes_per_date", "date:date route_id:s n:i rank:i", TOPK_SQL.format(where=""), "clean")
def _t2(spark, sf):
    return rts.top_routes(rts.route_volume(clean.clean_pings(fx.raw_pings(spark, sf))), 5)


@reg("sort_route_scores", "query_id:s eta_score_minutes:d6", "SELECT * FROM scores ORDER BY query_id", "scores")
def _t3(spark, sf):
    return scores_tbl(spark, sf).orderBy("query_id")


# -- 2.7 set operations --

@reg("union_pings", PK + " ts:t latitude:d9 longitude:d9 bearing:d6 vehicle_id:s depot:s",
     """SELECT date, route_id, trip_id, seq, ts, latitude, longitude, bearing, vehicle_id, NULL AS depot FROM hist
        UNION ALL SELECT date, route_id, trip_id, seq, ts, latitude, longitude, NULL, vehicle_id, concat('d', CAST(seq % 3 AS VARCHAR)) FROM live""",
     "hist", "live")
def _u1(spark, sf):
    """History in one layout, live pings in a later one: columns renamed and
    retyped, one dropped, one added."""
    w = _wl(spark, sf)
    live = w.live_raw()
    live = live.select(F.col("route_id").alias("routeId"), F.col("trip_id").alias("tripId"), F.translate("vehicle_id", '"', "").cast("bigint").alias("vehicle_id"),
                       "stop_id", F.col("seq").cast("bigint").alias("seq"), F.expr("try_cast(translate(vehicle_timestamp, '\"', '') as double)").alias("Timestamp"),
                       F.col("latitude").cast("string").alias("lat"), F.col("longitude").cast("decimal(18, 12)").alias("lon"), "schedule_relationship", "date",
                       F.concat(F.lit("d"), (F.col("seq") % 3).cast("string")).alias("depot"))
    return clean.clean_pings(clean.union_pings(w.history_raw(), live))


@reg("except_routes", "date:date route_id:s n:i rank:i",
     TOPK_SQL.format(where="WHERE route_id NOT IN ('3', '7')"), "clean")
def _u2(spark, sf):
    return rts.top_routes(rts.route_volume(clean.clean_pings(fx.raw_pings(spark, sf))), 5, exclude=("3", "7"))


@reg("upsert_latest_prediction", "route_id:s query_id:s stop_id:s arrival_ts:t",
     """SELECT p.route_id, p.query_id, p.stop_id, p.arrival_ts FROM predictions p
        JOIN (SELECT route_id, max(CAST(query_id AS BIGINT)) AS q FROM predictions GROUP BY route_id) m
          ON m.route_id = p.route_id AND CAST(p.query_id AS BIGINT) = m.q""", "predictions")
def _u3(spark, sf):
    p = predictions_tbl(spark, sf).withColumn("manifest_pos", F.col("query_id").cast("bigint"))
    return eta.latest_per_route(p, "manifest_pos")


# -- 2.8 scalar functions --

EV_TS = "CAST(ts AS TIMESTAMP)"


def _events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@reg("feat_time_parts", "event_id:i hour:i day_of_week:i day_of_month:i month:i week_of_year:i",
     "SELECT event_id, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, day(ts) AS day_of_month, "
     "month(ts) AS month, week(ts) AS week_of_year FROM events")
def _f1(spark, sf):
    return timeparts.time_parts(_events(spark, sf))


FLAGS = "is_weekend is_rush_hour is_morning_peak is_evening_peak is_lunch_hour is_night".split()


@reg("feat_time_flags", "event_id:i " + " ".join(f"{c}:b" for c in FLAGS),
     "SELECT event_id, isodow(ts) - 1 IN (5, 6) AS is_weekend, hour(ts) IN (7, 8, 9, 17, 18, 19) AS is_rush_hour, "
     "hour(ts) IN (7, 8, 9) AS is_morning_peak, hour(ts) IN (17, 18, 19) AS is_evening_peak, "
     "hour(ts) IN (12, 13, 14) AS is_lunch_hour, hour(ts) IN (22, 23, 0, 1, 2, 3, 4, 5) AS is_night FROM events")
def _f2(spark, sf):
    return timeparts.time_flags(timeparts.time_parts(_events(spark, sf)))


CYC = "hour_sin hour_cos day_sin day_cos month_sin month_cos".split()
_TWO_PI = geo.lit(6.283185307179586)


@reg("feat_time_cyclic", "event_id:i " + " ".join(f"{c}:d9" for c in CYC),
     f"SELECT event_id, sin({_TWO_PI} * h / 24e0) AS hour_sin, cos({_TWO_PI} * h / 24e0) AS hour_cos, "
     f"sin({_TWO_PI} * d / 7e0) AS day_sin, cos({_TWO_PI} * d / 7e0) AS day_cos, "
     f"sin({_TWO_PI} * m / 12e0) AS month_sin, cos({_TWO_PI} * m / 12e0) AS month_cos "
     "FROM (SELECT event_id, hour(ts) AS h, isodow(ts) - 1 AS d, month(ts) AS m FROM events)")
def _f3(spark, sf):
    return timeparts.with_time_features(_events(spark, sf))


def _clean(spark, sf):
    return clean.clean_pings(fx.raw_pings(spark, sf))


@reg("geo_utm_zone", PK + " utm_zone:i", f"SELECT *, {geo.zone_sql('longitude')} AS utm_zone FROM clean", "clean")
def _g1(spark, sf):
    return _clean(spark, sf).withColumn("utm_zone", geo.utm_zone("longitude"))


@reg("geo_hemisphere", PK + " is_south:b", f"SELECT *, {geo.south_sql('latitude')} AS is_south FROM clean",
     "clean")
def _g2(spark, sf):
    return _clean(spark, sf).withColumn("is_south", geo.is_south("latitude"))


@reg("geo_utm_epsg", PK + " epsg:s", f"SELECT *, {geo.epsg_sql('latitude', 'longitude')} AS epsg FROM clean",
     "clean")
def _g3(spark, sf):
    return _clean(spark, sf).withColumn("epsg", geo.utm_epsg("latitude", "longitude"))


_E, _N = geo.utm_sql("latitude", "longitude", geo.zone_sql("longitude"), geo.south_sql("latitude"))


@reg("geo_to_utm", PK + " easting:d3 northing:d3", f"SELECT *, {_E} AS easting, {_N} AS northing FROM clean",
     "clean")
def _g4(spark, sf):
    return geo.with_utm(_clean(spark, sf), "latitude", "longitude", "easting", "northing")


@reg("geo_distance", PK + " d:d3",
     f"SELECT *, {geo.distance_sql('latitude', 'longitude', 'next_lat', 'next_lon')} AS d FROM h_ctx2", "h_ctx2")
def _g5(spark, sf):
    return geo.with_distance(all_trips(spark, sf), "latitude", "longitude", "next_lat", "next_lon", "d")


def _segment_pings(spark, sf, *names):
    w = _wl(spark, sf)
    return mapmatch.with_segments(mapmatch.attach_route(w.clean_pings(), w.routes()), w.routes(), *names)


@reg("geo_segment_projection", PK + " t:ad3",
     """SELECT p.date, p.route_id, p.trip_id, p.seq,
        list(CASE WHEN s.l2 > 0 THEN ((p.px - s.ax) * s.dx + (p.py - s.ay) * s.dy) / s.l2 END ORDER BY s.i) AS t
        FROM h_pxy p JOIN h_zsegs s ON s.route_id = TRY_CAST(p.route_id AS BIGINT) AND s.pzone = p.pzone
          AND s.psouth = p.psouth GROUP BY ALL""", "h_pxy", "h_zsegs")
def _g6(spark, sf):
    return _segment_pings(spark, sf, "t")


_PERP = ("sqrt(power((px - s.ax) - ((px - s.ax) * s.dx + (py - s.ay) * s.dy) / s.l2 * s.dx, 2) + "
         "power((py - s.ay) - ((px - s.ax) * s.dx + (py - s.ay) * s.dy) / s.l2 * s.dy, 2))")


@reg("geo_segment_offset", PK + " perp:ad1 gps_len:ad1",
     f"""SELECT p.date, p.route_id, p.trip_id, p.seq,
        list(CASE WHEN s.l2 > 0 THEN {_PERP.replace('px', 'p.px').replace('py', 'p.py')} END ORDER BY s.i) AS perp,
        list(sqrt(power(p.px - s.ax, 2) + power(p.py - s.ay, 2)) ORDER BY s.i) AS gps_len
        FROM h_pxy p JOIN h_zsegs s ON s.route_id = TRY_CAST(p.route_id AS BIGINT) AND s.pzone = p.pzone
          AND s.psouth = p.psouth GROUP BY ALL""", "h_pxy", "h_zsegs")
def _g7(spark, sf):
    return _segment_pings(spark, sf, "perp", "gps_len")


@reg("geo_locate_on_route", "query_id:s route_position:i", "SELECT * FROM q_loc", "q_loc")
def _g8(spark, sf):
    latest = eta.latest_ping(clean.clean_pings(_wl(spark, sf).query_raw()))
    return mapmatch.locate(latest, routes_tbl(spark, sf))


@reg("geo_wkt_point", PK + " geometry:s",
     f"SELECT *, {geo.wkt_point_sql('latitude', 'longitude')} AS geometry FROM clean", "clean")
def _g9(spark, sf):
    return geo.with_wkt(_clean(spark, sf), "latitude", "longitude", "geometry")


@reg("feat_segment_metrics", PK + " segment_distance:d3 segment_duration:d3", "SELECT * FROM h_feat", "h_feat")
def _v1(spark, sf):
    return all_features(spark, sf)


@reg("feat_speed", PK + " speed:d6", "SELECT * FROM h_feat", "h_feat")
def _v2(spark, sf):
    return all_features(spark, sf)


@reg("feat_turn_rates", PK + " bearing_change_per_meter:d6 bearing_change_per_second:d6",
     "SELECT * FROM h_feat", "h_feat")
def _v3(spark, sf):
    return all_features(spark, sf)


@reg("feat_progress", PK + " stops_remaining:i progress_ratio:d6", "SELECT * FROM h_full", "h_full")
def _v4(spark, sf):
    return all_features(spark, sf)


ALL_SPEC = (PK + " hour:i day_of_week:i week_of_year:i is_weekend:b is_night:b hour_sin:d9 month_cos:d9 "
            "segment_distance:d3 segment_duration:d3 speed:d6 bearing_change:d6 acceleration:d6 "
            "direction_consistency:d6 route_length:d3 route_complexity:d6 route_stop_density:d9 "
            "route_avg_speed:d6 stops_remaining:i progress_ratio:d6")


@reg("feat_all", ALL_SPEC, "SELECT * FROM h_full", "h_full")
def _v5(spark, sf):
    return all_features(spark, sf, stored=True)


@reg("ctx_current_next_stop", PK + " route_position:i total_route_stops:i current_stop_id:s next_stop_id:s",
     "SELECT * FROM h_ctx2", "h_ctx2")
def _r1(spark, sf):
    return all_trips(spark, sf)


@reg("ctx_future_stops", PK + " future_stop_ids:as", "SELECT * FROM h_ctx2", "h_ctx2")
def _r2(spark, sf):
    return all_trips(spark, sf)


@reg("ctx_future_distances", PK + " future_segment_distances:ad1", "SELECT * FROM h_ctx2", "h_ctx2")
def _r3(spark, sf):
    return all_trips(spark, sf)


@reg("ctx_distance_to_next_stop", PK + " distance_to_next_route_stop:d3", "SELECT * FROM h_ctx2", "h_ctx2")
def _r4(spark, sf):
    return all_trips(spark, sf)


@reg("ctx_duration_to_future_stops", PK + " duration_to_future_stops:ad3",
     """SELECT c.date, c.route_id, c.trip_id, c.seq,
        coalesce(list((epoch_us(fa.first_ts) - epoch_us(c.ts)) / 1e6 ORDER BY u.i) FILTER (WHERE fa.first_ts IS NOT NULL), []::DOUBLE[])
          AS duration_to_future_stops
        FROM h_ctx2 c CROSS JOIN LATERAL unnest(c.future_stop_ids) WITH ORDINALITY AS u(s, i)
        LEFT JOIN h_fa fa ON fa.date = c.date AND fa.route_id = c.route_id AND fa.trip_id = c.trip_id
          AND fa.stop_id = u.s GROUP BY ALL""", "h_ctx2", "h_fa")
def _r5(spark, sf):
    return all_trips(spark, sf)


@reg("ctx_arrival_time_to_future_stops", PK + " arrival_time_to_future_stops:at",
     """SELECT c.date, c.route_id, c.trip_id, c.seq,
        coalesce(list(fa.first_ts ORDER BY u.i) FILTER (WHERE fa.first_ts IS NOT NULL), []::TIMESTAMP[])
          AS arrival_time_to_future_stops
        FROM h_ctx2 c CROSS JOIN LATERAL unnest(c.future_stop_ids) WITH ORDINALITY AS u(s, i)
        LEFT JOIN h_fa fa ON fa.date = c.date AND fa.route_id = c.route_id AND fa.trip_id = c.trip_id
          AND fa.stop_id = u.s GROUP BY ALL""", "h_ctx2", "h_fa")
def _r6(spark, sf):
    w = _wl(spark, sf)
    m = mapmatch.map_match(w.clean_pings(), w.routes())
    m = mapmatch.attach_route(m.drop("n"), w.routes())
    return context.arrival_times_to_future_stops(context.route_context(m))


@reg("ctx_route_context", PK + " current_stop_id:s next_stop_id:s future_stop_ids:as distance_remaining:d3",
     "SELECT * FROM h_ctx2", "h_ctx2")
def _r7(spark, sf):
    return all_trips(spark, sf)


@reg("ctx_process_trips", PK + " ts:t next_timestamp:t route_position:i distance_remaining:d3",
     "SELECT * FROM h_ctx2", "h_ctx2")
def _r8(spark, sf):
    w = _wl(spark, sf)
    return context.process_trips(w.clean_pings(), w.routes())


@reg("ctx_query_state", "query_id:s route_id:s ts:t route_position:i total_route_stops:i current_stop_id:s "
     "next_stop_id:s future_stop_ids:as future_segment_distances:ad1 distance_to_next_route_stop:d3",
     "SELECT * FROM q_state", "q_state")
def _r9(spark, sf):
    latest = eta.latest_ping(clean.clean_pings(_wl(spark, sf).query_raw()))
    return eta.query_state(latest, routes_tbl(spark, sf))


@reg("fn_list_join", PK + " future_text:s",
     "SELECT *, array_to_string(future_stop_ids, ', ') AS future_text FROM h_ctx2", "h_ctx2")
def _h1(spark, sf):
    return all_trips(spark, sf).withColumn("future_text", timeparts.list_join("future_stop_ids"))


@reg("fn_list_split", PK + " back:ad1", "SELECT *, future_segment_distances AS back FROM h_ctx2", "h_ctx2")
def _h2(spark, sf):
    t = all_trips(spark, sf).withColumn("_txt", timeparts.list_join("future_segment_distances"))
    return t.withColumn("back", timeparts.list_split("_txt", as_double=True))


@reg("fn_parse_timestamp", "query_id:s stop_id:s parsed:t",
     "SELECT query_id, stop_id, try_strptime(arrival, '%Y-%m-%d %H:%M:%S') AS parsed FROM pred_text", "pred_text")
def _h3(spark, sf):
    return pred_text(spark, sf).withColumn("parsed", timeparts.parse_timestamp("arrival"))


@reg("fn_format_arrival", "query_id:s stop_id:s arrival:s", "SELECT * FROM pred_text", "pred_text")
def _h4(spark, sf):
    return pred_text(spark, sf)


@reg("fn_minutes_between", "query_id:s stop_id:s minutes:d6",
     "SELECT query_id, stop_id, diff_s / 6e1 AS minutes FROM stop_err WHERE diff_s IS NOT NULL", "stop_err")
def _h5(spark, sf):
    e = actuals_tbl(spark, sf).join(pred_text(spark, sf).withColumnRenamed("arrival", "p"), ["query_id", "stop_id"])
    e = e.withColumns({"_pt": timeparts.parse_timestamp("p"), "_at": timeparts.parse_timestamp("arrival")})
    return e.select("query_id", "stop_id", timeparts.minutes_between("_pt", "_at").alias("minutes"))


# -- 2.9 pipelines --

@reg("pipe_static", "route_id:i stop_id_list:as next_stop_distances:ad1", "SELECT * FROM seq_dists", "seq_dists")
def _e1(spark, sf):
    return pipelines.build_static(fx.stops(spark, sf), fx.route_sequences(spark, sf))[1]


@reg("pipe_features", ALL_SPEC, "SELECT * FROM h_full", "h_full")
def _e2(spark, sf):
    w = _wl(spark, sf)
    st, seq = w.static()
    return pipelines.build_features(w.raw_pings(), st, seq, select=False, routes_tbl=w.routes())


@reg("pipe_features_top_routes", ALL_SPEC, "SELECT * FROM top_full", "top_full")
def _e2t(spark, sf):
    w = _wl(spark, sf)
    st, seq = w.static()
    return pipelines.run_features(w.raw_pings(), st, seq, scratch_path(spark, "top_features"), routes_tbl=w.routes())


@reg("pipe_train", "model_key:s " + PAT_SPEC, "SELECT 'default' AS model_key, * FROM patterns", "patterns")
def _e3(spark, sf):
    return pipelines.fit_patterns(all_features(spark, sf).where(F.col("date") < F.lit(fx.QUERY_FROM_DATE).cast("date")))


@reg("pipe_predict", "query_id:s route_id:s i:i stop_id:s arrival:s",
     "SELECT query_id, route_id, i, stop_id, strftime(arrival_ts, '%Y-%m-%d %H:%M:%S') AS arrival FROM predictions",
     "predictions")
def _e4(spark, sf):
    w = _wl(spark, sf)
    st, seq = w.static()
    p = pipelines.predict(w.query_raw(), st, seq, patterns_tbl(spark, sf), routes_tbl=w.routes())
    return p.withColumn("arrival", timeparts.format_arrival("arrival_ts"))


@reg("pipe_predict_routes", "route_id:s stop_id:s arrival:s",
     """SELECT p.route_id, p.stop_id, strftime(p.arrival_ts, '%Y-%m-%d %H:%M:%S') AS arrival FROM predictions p
        JOIN (SELECT route_id, max(CAST(query_id AS BIGINT)) AS q FROM predictions GROUP BY route_id) m
          ON m.route_id = p.route_id AND CAST(p.query_id AS BIGINT) = m.q""", "predictions")
def _e4r(spark, sf):
    w = _wl(spark, sf)
    st, seq = w.static()
    return pipelines.run_predict(spark, _manifest(spark, sf), st, seq, patterns_tbl(spark, sf),
                                 scratch_path(spark, "eta"), routes_tbl=w.routes())


@reg("pipe_evaluate", "query_id:s eta_score_minutes:d6", "SELECT * FROM scores", "scores")
def _e5(spark, sf):
    return pipelines.evaluate(pred_text(spark, sf), actuals_tbl(spark, sf), "query_id")[0]


# -- 2.10 streaming (re-aimed live path) --

def _stream_src(spark, sf, name, df):
    from .streaming.stream import write_stream_source
    return write_stream_source(df, scratch_path(spark, name))


@reg("stream_clean_pings", CLEAN_SPEC, "SELECT * FROM clean", "clean")
def _x1(spark, sf):
    from .streaming.stream import clean_stream
    src = _stream_src(spark, sf, "x1_src", _wl(spark, sf).raw_pings())
    return clean_stream(spark, src)


@reg("stream_clean_pings_once", CLEAN_SPEC, "SELECT * FROM clean", "clean")
def _x1_once(spark, sf):
    """Every ping arrives twice, the second time in files of its own."""
    from .streaming.stream import clean_stream
    src = _stream_src(spark, sf, "x1_src", _wl(spark, sf).raw_pings())
    _wl(spark, sf).raw_pings().write.mode("append").parquet(src)
    return clean_stream(spark, src, lateness="36500 days")


@reg("stream_latest_ping", "query_id:s ts:t seq:i latitude:d9 longitude:d9", "SELECT * FROM q_latest",
     "q_latest")
def _x2(spark, sf):
    from .streaming.stream import latest_ping_stream
    src = _stream_src(spark, sf, "x2_src", _wl(spark, sf).query_raw())
    return latest_ping_stream(spark, src)


@reg("stream_predict", PRED_SPEC, "SELECT * FROM predictions", "predictions")
def _x3(spark, sf):
    from .streaming.stream import predict_stream
    src = _stream_src(spark, sf, "x3_src", _wl(spark, sf).query_raw())
    return predict_stream(spark, src, routes_tbl(spark, sf), patterns_tbl(spark, sf))


# -- the same operators over the events table (FIXTURES.md B6) --

def _events_as_pings(spark, sf):
    e = _events(spark, sf)
    return e.select("event_id", F.col("user_id").cast("string").alias("trip_id"), "ts",
                    F.col("event_id").alias("seq"), F.col("value").alias("bearing"),
                    F.to_date("ts").alias("date"), "event_type")


@reg("events_bearing_rolling", "event_id:i bearing_change:d6 direction_consistency:d6",
     """SELECT event_id, bearing_change,
        CASE WHEN row_number() OVER w >= 5 THEN avg(abs(bearing_change)) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
        END AS direction_consistency
        FROM (SELECT *, coalesce(value - lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0e0)
              AS bearing_change FROM events)
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _ev1(spark, sf):
    d = feat.bearing_change(_events_as_pings(spark, sf), ["trip_id"])
    return feat.direction_consistency(d, ["trip_id"])


@reg("events_topk_per_day", "date:date route_id:s n:i rank:i",
     """SELECT * FROM (SELECT date, route_id, n, row_number() OVER (PARTITION BY date ORDER BY n DESC, route_id) AS rank
        FROM (SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS route_id, count(*) AS n FROM events
              GROUP BY ALL)) WHERE rank <= 5""")
def _ev2(spark, sf):
    e = _events_as_pings(spark, sf).withColumnRenamed("trip_id", "route_id")
    return rts.top_routes(rts.route_volume(e), 5)


@reg("events_type_patterns", "current_stop_id:s hour:i day_of_week:i dur_mean:d6 dur_std:d6 dur_count:i "
     "speed_mean:d6 speed_std:d6 dist_mean:d6",
     """SELECT event_type AS current_stop_id, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week,
        avg(value) AS dur_mean, stddev_samp(value) AS dur_std, count(value) AS dur_count, avg(value) AS speed_mean,
        stddev_samp(value) AS speed_std, avg(value) AS dist_mean FROM events GROUP BY ALL""")
def _ev3(spark, sf):
    e = timeparts.time_parts(_events(spark, sf))
    e = e.select(F.col("event_type").alias("current_stop_id"), "hour", "day_of_week",
                 F.col("value").alias("segment_duration"), F.col("value").alias("speed"),
                 F.col("value").alias("segment_distance"))
    return pat.stop_patterns(e)
