"""End-to-end plans (E1-E5) composed from the operators.

Nothing of a table is collected. Static tables, route statistics and the
pattern model are written once to the shared folder while a plan is built,
because it reads them several times; so do the ``run_*`` functions with their
outputs. Everything else is lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, context, eta, evaluate as ev, features, patterns, routes, static
from ..session import release
from ..sources import files


def build_static(stops: DataFrame, sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stops as given (id as text) and sequences with next-stop distances."""
    st = stops.withColumn("stop_id", F.col("stop_id").cast("string"))
    return st, static.next_stop_distances(sequences, st)


def route_table(stops: DataFrame, sequences: DataFrame) -> DataFrame:
    """The broadcast route table (ids, distances, coordinates), materialised."""
    return static.materialize(static.route_table(sequences, stops))


def build_features(raw_pings: DataFrame, stops: DataFrame, sequences: DataFrame, dates=None,
                   include=(), exclude=(), max_routes: int = 5, rolling_scope: str = "trip",
                   stats_scope: str = "first_date", position_col: str | None = None,
                   select: bool = True, routes_tbl: DataFrame | None = None, stored: bool = True) -> DataFrame:
    """Clean -> route choice per date -> map-match + context -> features.

    ``sequences`` must carry ``next_stop_distances`` (E1 output).
    ``select=False`` processes every route (no top-K choice). ``stored=False``
    leaves the route statistics to the plan (see :func:`features.extract_all`).
    """
    p = raw_pings
    if dates:
        p = p.where(F.col("date").isin([str(d).replace("date=", "") for d in dates]))
    p = clean.clean_pings(p)
    if "date" not in p.columns:
        p = p.withColumn("date", F.to_date("ts"))
    if select:
        p = routes.select_routes(p, include, exclude, max_routes)
    rt = routes_tbl if routes_tbl is not None else route_table(stops, sequences)
    trips = context.process_trips(p, rt, lists=False)
    return features.extract_all(trips, rolling_scope, stats_scope, position_col, dates, rt, stored)


def run_features(raw_pings: DataFrame, stops: DataFrame, sequences: DataFrame, root: str, dates=None,
                 include=(), exclude=(), max_routes: int = 5, **kw) -> DataFrame:
    """E2 as one call: the features of the chosen routes of every date (by
    default the five busiest) are written below ``root`` (K2) and read back (S6)."""
    feats = build_features(raw_pings, stops, sequences, dates, include, exclude, max_routes, **kw)
    files.write_route_features(feats, root)
    release(raw_pings.sparkSession)
    return files.read_route_features(raw_pings.sparkSession, root)


def fit_patterns(feats: DataFrame, model_key: str = "default") -> DataFrame:
    """Moving rows -> pattern table (``model_key`` column)."""
    return patterns.train(feats, model_key)


def predict(query_pings: DataFrame, stops: DataFrame, sequences: DataFrame, pattern_tbl: DataFrame,
            query_col: str = "query_id", routes_tbl: DataFrame | None = None) -> DataFrame:
    """Raw query pings (one query per ``query_col``) -> one row per
    predicted stop: ``query_id, route_id, i, stop_id, ..., arrival_ts``.

    Queries that clean to nothing, have no route sequence, or sit at the
    last stop produce no rows (the reference skips them)."""
    q = clean.clean_pings(query_pings)
    rt = routes_tbl if routes_tbl is not None else route_table(stops, sequences)
    pattern_tbl = static.materialize(pattern_tbl)  # the model: small, read by five lookups
    latest = eta.latest_ping(q, query_col)
    state = eta.query_state(latest, rt)
    rows = eta.predict_rows(state, pattern_tbl, query_col)
    return eta.dedupe_repeated_stops(rows, query_col)


def predict_routes(query_pings: DataFrame, stops: DataFrame, sequences: DataFrame, pattern_tbl: DataFrame,
                   routes_tbl: DataFrame | None = None) -> DataFrame:
    """E4 by route: of several queries on one route the later one in the
    manifest (``manifest_pos``) that predicts anything replaces the route (U3)."""
    order = query_pings.groupBy("query_id").agg(F.min("manifest_pos").alias("manifest_pos"))
    rows = predict(query_pings, stops, sequences, pattern_tbl, routes_tbl=routes_tbl)
    # written once: the choice of the last query and its rows both read it
    return eta.latest_per_route(static.materialize(rows.join(order, "query_id")))


def run_predict(spark: SparkSession, manifest_path: str, stops: DataFrame, sequences: DataFrame,
                pattern_tbl: DataFrame, out: str, routes_tbl: DataFrame | None = None) -> DataFrame:
    """E4 as one call: query files of a manifest (S5) -> predictions by route
    -> ``{route: {stop: time}}`` documents below ``out`` (K4), read back (S8)."""
    queries = files.read_query_manifest(spark, manifest_path)
    files.write_predictions_json(predict_routes(queries, stops, sequences, pattern_tbl, routes_tbl), out)
    return files.read_eta_json(spark, out)


def evaluate(predicted: DataFrame, actual: DataFrame, key: str = "route_id") -> tuple[DataFrame, DataFrame]:
    """E5: per-key scores (in key order) and the overall score.

    ``predicted`` / ``actual``: ``key, stop_id, arrival`` (text)."""
    errs = ev.stop_errors(actual, predicted, key)
    scores = ev.route_scores(errs, key)
    return scores.orderBy(key), ev.overall_score(scores)
