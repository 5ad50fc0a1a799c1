"""Rules that the fixture's rows don't reach: ties, repeated and odd input, medians, projection."""

import json
import random

import pytest
from pyspark.sql import functions as F

from headway import session
from headway.functions import geo
from headway.operators import clean, features, mapmatch, patterns, routes, static
from headway.operators.quantiles import exact_median
from headway.sources import files


def test_tied_times_without_seq(spark):
    rows = [("2024-01-01", 1, "t", "2024-01-01 00:00:00", k) for k in range(6)]
    p = spark.createDataFrame(rows, "date string, route_id long, trip_id string, ts string, k int").withColumn("ts", F.to_timestamp("ts"))
    p = mapmatch.with_order(p)
    opened = F.when(F.col("k") % 2 == 0, F.array(F.lit(2))).otherwise(F.array(F.lit(3)))
    p = p.withColumn("open", opened).withColumn("n", F.lit(6)).withColumn("ids", F.expr("transform(sequence(0, 5), i -> string(i))"))
    base = ["date", "route_id", "trip_id", "ts", "seq", "k"]
    got = mapmatch.fold_positions(p, base).orderBy("seq").collect()
    m, want = 0, []
    for r in sorted(p.collect(), key=lambda r: r["seq"]):
        m = min((i for i in r["open"] if i >= m), default=r["n"] - 1)
        want.append(m)
    assert [r["route_position"] for r in got] == want


def test_median_equals_builtin(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") < 40_000, 0).otherwise(F.col("id") % 700).alias("g"),      # one hot group
        F.when(F.col("id") % 13 == 0, F.lit(None)).when(F.col("id") % 5 == 0, 1.0)
        .otherwise(F.exp(F.rand(3) * 40)).cast("double").alias("x")).checkpoint()
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "x").collect()}
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("x").alias("m")).collect() if r["m"] is not None}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_pretty_printed_and_one_line_json(spark, tmp_path):
    doc = {"1": {"a": "2024-01-01 00:00:00", "b": "2024-01-01 00:01:00"}, "2": {}}
    for name, text in (("line", json.dumps(doc)), ("pretty", json.dumps(doc, indent=2))):
        (tmp_path / name).write_text(text)
        got = {(r["route_id"], r["stop_id"]) for r in files.read_eta_json(spark, str(tmp_path / name)).collect()}
        assert got == {("1", "a"), ("1", "b"), ("2", None)}
    (tmp_path / "bad").write_text("{ nothing")
    with pytest.raises(Exception):
        files.read_eta_json(spark, str(tmp_path / "bad")).collect()


def test_first_of_repeated_routes(spark):
    stops = spark.createDataFrame([("a", 0.0, 1.0), ("b", 0.0, 2.0), ("c", 0.0, 2.5)], "stop_id string, stop_lat double, stop_lon double")
    seq = spark.createDataFrame([(1, ["a", "b"]), (1, ["b", "c"]), (2, ["a", "z"])], "route_id long, stop_id_list array<string>").coalesce(1)
    assert [(r["route_id"], r["stop_id_list"]) for r in static.next_stop_distances(seq, stops).collect()] == [(1, ["a", "b"])]
    assert [(r["route_id"], r["unknown_stops"]) for r in static.quarantined(seq, stops).collect()] == [(2, ["z"])]


def test_one_model_of_several(spark):
    p = spark.createDataFrame([("s", 1, 1, 5.0, "default"), ("s", 1, 1, 9.0, "7")], "current_stop_id string, hour int, day_of_week int, speed_mean double, model_key string")
    rows = spark.createDataFrame([("s", 1, 1)], "key_stop string, hour int, day_of_week int")
    assert [(r["speed"], r["level"]) for r in patterns.ladder_speed(rows, p).collect()] == [(5.0, 1)]
    assert [r["speed"] for r in patterns.ladder_speed(rows, p, model_key="7").collect()] == [9.0]


def test_include_and_exclude_of_mixed_types(spark):
    p = spark.createDataFrame([("7", 1), ("8", 2)], "route_id string, x int")
    assert [r["route_id"] for r in routes.select_routes(p, include=[7, 8], exclude=["7"]).collect()] == ["8"]


def test_predictions_of_a_stop_given_twice(spark):
    p = spark.createDataFrame([("1", "a", "2024-01-01 00:00:00"), ("1", "a", "2024-01-01 00:05:00")], "route_id string, stop_id string, t string")
    got = files.predictions_json_lines(p.withColumn("arrival_ts", F.to_timestamp("t"))).first()["value"]
    assert json.loads(got) == {"1": {"a": "2024-01-01 00:05:00"}}


def test_millisecond_epochs_are_no_times(spark):
    df = spark.createDataFrame([("1700000000",), ("1700000000000",), ("x",), ("nan",)], "vehicle_timestamp string")
    assert [r["ts"] is not None for r in clean.epoch_to_ts(df).collect()] == [True, False, False, False]


def test_unreadable_files_fail_or_are_audited(spark, tmp_path):
    root = tmp_path / "pings"
    spark.range(3).withColumn("date", F.lit("2024-01-01")).coalesce(1).write.partitionBy("date").parquet(str(root))
    (root / "date=2024-01-01" / "bad.parquet").write_bytes(b"PAR1 nothing")
    with pytest.raises(Exception):
        files.read_pings(spark, str(root)).collect()
    assert files.read_pings(spark, str(root), skip_unreadable=True).count() == 3
    assert sorted(r["rows"] for r in files.file_status(spark, str(root)).collect()) == [0, 3]


def test_published_utm_point(spark):
    # CN Tower, Toronto: zone 17 N, 630084 m E, 4833438 m N
    df = spark.createDataFrame([(43.642566, -79.387139)], "lat double, lon double")
    r = geo.with_utm(df.withColumns({"z": F.expr(geo.zone_sql("lon")), "s": F.expr(geo.south_sql("lat"))}), "lat", "lon", "x", "y", zone="z", south="s").first()
    assert r["z"] == 17 and abs(r["x"] - 630084.3) < 0.5 and abs(r["y"] - 4833438.5) < 0.5


def test_complexity_without_turn_rates(spark):
    df = spark.createDataFrame([("2024-01-01", "1", "t", "s", 10.0, 2.0), ("2024-01-01", "1", "u", "s", 30.0, 4.0)], "date string, route_id string, trip_id string, stop_id string, segment_distance double, speed double")
    r = features.route_characteristics(df).first()
    assert (r["complexity_score"], r["avg_trip_length"], r["avg_speed"], r["stop_density"]) == (1.0, 20.0, 3.0, 1 / 40)


def test_first_processed_date_follows_the_list(spark):
    stats = spark.createDataFrame([(d, r, v, v, v, v) for d, r, v in (("2024-01-01", "a", 1.0), ("2024-01-02", "a", 2.0), ("2024-01-03", "a", 3.0), ("2024-01-01", "b", 4.0), ("2024-01-04", "c", 5.0), ("2024-01-05", "c", 6.0))],
                                  "date string, route_id string, avg_trip_length double, complexity_score double, stop_density double, avg_speed double").withColumn("date", F.to_date("date"))
    rows = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "route_id string, total_route_stops int")

    def used(dates):
        got = features.attach_route_characteristics(rows, stats, dates=dates)
        return {r["route_id"]: r["route_length"] for r in got.collect()}
    assert used(None) == {"a": 1.0, "b": 4.0, "c": 5.0}
    assert used(["2024-01-03", "date=2024-01-01"]) == {"a": 3.0, "b": 4.0, "c": 5.0}
    assert used(["2024-01-05", "2024-01-02"]) == {"a": 2.0, "b": 4.0, "c": 6.0}


def test_layouts_of_pings_in_one_union(spark):
    old = spark.createDataFrame([("1", "t", "v", "s", "1700000000", 1.5, 2.5, 90.0, "SCHEDULED", "x")],
                                "route_id string, trip_id string, vehicle_id string, stop_id string, vehicle_timestamp string, latitude double, longitude double, bearing double, schedule_relationship string, note string")
    new = spark.createDataFrame([(1, "u", 7, 1.7e9, "3.5", "off", 1, 9)], "RouteId int, trip_id string, vehicle_id long, Timestamp double, LAT string, lng string, note int, door int")
    got = {r["trip_id"]: r.asDict() for r in clean.union_pings(old, new).collect()}
    assert got["u"] == {"route_id": "1", "trip_id": "u", "vehicle_id": "7", "stop_id": None, "vehicle_timestamp": "1.7E9", "latitude": 3.5, "longitude": None, "bearing": None,
                        "schedule_relationship": None, "note": "1", "door": 9}
    assert got["t"]["bearing"] == 90.0 and got["t"]["door"] is None and got["t"]["note"] == "x"
    # a column under both names keeps both; an own mapping replaces the usual one
    both = spark.createDataFrame([(1.0, 2.0)], "latitude double, lat double")
    assert clean.conform(both).first()["latitude"] == 1.0 and clean.conform(both).first()["lat"] == 2.0
    assert clean.conform(spark.createDataFrame([("9",)], "linie string"), {"linie": "route_id"}).first()["route_id"] == "9"
    assert clean.union_pings(old).count() == 1 and clean.clean_pings(clean.union_pings(old, old.limit(0))).count() == 1


def test_a_hot_quarter_of_an_hour_is_cut(spark):
    rng = random.Random(4)
    n = 7
    rows = [("2024-01-01", 1, "hot", 1_704_067_200_000_000 + rng.choice((0, 1, 2_000_000, 5_000_000)), k, sorted(rng.sample(range(n - 1), rng.randint(0, n - 1)))) for k in range(4000)]
    rows += [("2024-01-01", 1, f"t{k}", 1_704_067_200_000_000 + 60_000_000 * j, j, sorted(rng.sample(range(n - 1), 2))) for k in range(20) for j in range(40)]
    p = spark.createDataFrame(rows, "date string, route_id long, trip_id string, us long, seq long, open array<int>").withColumn("ts", F.timestamp_micros("us"))
    p = p.withColumn("n", F.lit(n)).withColumn("ids", F.expr(f"transform(sequence(0, {n - 1}), i -> string(i))"))
    cut, rounds = mapmatch.with_chunks(p, 900, 100)
    sizes = sorted(r["count"] for r in cut.where("trip_id = 'hot'").groupBy("bucket").count().collect())
    assert len(sizes) >= 38 and sizes[-1] <= 2 * sizes[len(sizes) // 2] and 1 << rounds >= len(sizes)
    edges = cut.where("trip_id = 'hot'").groupBy("bucket").agg(F.min(F.struct("ts", "seq")).alias("a"), F.max(F.struct("ts", "seq")).alias("b")).orderBy("bucket").collect()
    assert all(tuple(x["b"]) < tuple(y["a"]) for x, y in zip(edges, edges[1:]))
    got = mapmatch.fold_positions(p, ["date", "route_id", "trip_id", "ts", "seq"], chunk_rows=100)
    found = {(r["trip_id"], r["seq"]): (r["route_position"], {k: v for k, v in r["first_arrival"].items()}) for r in got.collect()}
    for trip in {r[2] for r in rows}:
        m, first = 0, {}
        own = sorted((r for r in rows if r[2] == trip), key=lambda r: (r[3], r[4]))
        places = []
        for r in own:
            m = min((i for i in r[5] if i >= m), default=n - 1)
            first.setdefault(str(m), r[3])
            places.append((r[4], m))
        for seq, m in places:
            assert found[trip, seq][0] == m
        assert {k: int(v.timestamp() * 1_000_000) for k, v in found[trip, own[0][4]][1].items()} == first


def test_kept_tables_are_released(spark):
    session.release(spark)
    df = session.keep(spark.range(5))
    assert df.count() == 5 and df.storageLevel.useMemory
    assert session.release(spark) == 1 and not df.storageLevel.useMemory and session.release(spark) == 0


def test_epoch_text_is_parsed_once_per_row(spark):
    """Filters on the time move towards the scan; the parsing must not go with them."""
    raw = spark.createDataFrame([("1", '"12.5"')], "trip_id string, vehicle_timestamp string").repartition(2)
    d = clean.epoch_to_ts(raw).where("ts IS NOT NULL AND ts > timestamp'1970-01-01'")
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") == 1
    assert d.count() == 1


def test_epoch_rounding_is_that_of_round(spark):
    x = [0.0000005, -0.0000005, 0.00000049999999999999994, 1.0000015, -1.0000015, 4503599627.370497, 9223372036.0, -9223372036.0, 978307200.123456, 0.0000025, -0.0, 12.3456785]
    raw = spark.createDataFrame([(repr(v),) for v in x] + [('"7.25"',), ("NaN",), ("bad",), (None,), ("9223372037",)], "vehicle_timestamp string").withColumn("text", F.col("vehicle_timestamp"))
    d = clean.epoch_to_ts(raw).withColumn("want", F.expr("timestamp_micros(try_cast(round(vehicle_timestamp * 1e6) AS BIGINT))"))
    assert d.columns == ["vehicle_timestamp", "text", "ts", "want"]
    for r in d.select("text", F.unix_micros("ts").alias("a"), F.unix_micros("want").alias("b")).collect():
        assert r["a"] == r["b"], r
    assert d.where("ts IS NULL").count() == 4
