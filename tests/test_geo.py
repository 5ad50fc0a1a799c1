"""The projection against a second series, written here from the published
formulas (Snyder, Map Projections: A Working Manual, 1987, p. 61), and WKT."""

import math

import pytest
from pyspark.sql import functions as F

from headway.functions import geo

POINTS = [(43.642566, -79.387139), (12.9716, 77.5946), (-33.8568, 151.2153), (-0.0001, 36.8), (0.0001, 36.8), (59.9, 5.9),
          (48.2, 11.99), (48.2, 12.01), (-54.8, -68.3), (80.0, 2.9), (-79.9, 179.9), (10.0, -179.99)]


def snyder(lat, lon, zone, south):
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    p, l0 = math.radians(lat), math.radians(zone * 6 - 183)
    n = a / math.sqrt(1 - e2 * math.sin(p) ** 2)
    t, c, x = math.tan(p) ** 2, ep2 * math.cos(p) ** 2, (math.radians(lon) - l0) * math.cos(p)
    m = a * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * p - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * math.sin(2 * p)
             + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * math.sin(4 * p) - 35 * e2 ** 3 / 3072 * math.sin(6 * p))
    east = k0 * n * (x + (1 - t + c) * x ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * x ** 5 / 120)
    north = k0 * (m + n * math.tan(p) * (x * x / 2 + (5 - t + 9 * c + 4 * c * c) * x ** 4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * x ** 6 / 720))
    return east + 500_000, north + (10_000_000 if south else 0)


def test_projection_against_a_second_series(spark):
    df = spark.createDataFrame(POINTS, "lat double, lon double")
    df = df.withColumns({"z": F.expr(geo.zone_sql("lon")), "s": F.expr(geo.south_sql("lat")), "e": F.expr(geo.epsg_sql("lat", "lon"))})
    got = geo.with_utm(df, "lat", "lon", "x", "y", zone="z", south="s").collect()
    for r in got:
        zone = int((r["lon"] + 180) // 6) + 1
        south = r["lat"] < 0
        assert (r["z"], bool(r["s"])) == (zone, south)
        assert str(r["e"]).endswith(f"{327 if south else 326}{zone:02d}")
        x, y = snyder(r["lat"], r["lon"], zone, south)
        assert (r["x"], r["y"]) == (pytest.approx(x, abs=0.02), pytest.approx(y, abs=0.02))


def test_distance_is_planar_in_the_first_points_zone(spark):
    df = spark.createDataFrame([(48.2, 11.99, 48.2, 12.01), (10.0, 20.0, 10.0, 20.0)], "a double, b double, c double, d double")
    got = [r["m"] for r in geo.with_distance(df, "a", "b", "c", "d", "m").collect()]
    (x0, y0), (x1, y1) = snyder(48.2, 11.99, 32, False), snyder(48.2, 12.01, 32, False)
    assert got == [pytest.approx(math.hypot(x1 - x0, y1 - y0), abs=0.02), 0.0]


def test_wkt_by_hand(spark):
    df = spark.createDataFrame([(12.5, 77.25), (13.0, -77.0), (None, 1.0)], "lat double, lon double")
    assert [r["g"] for r in df.select(F.expr(geo.wkt_point_sql("lat", "lon")).alias("g")).collect()][:2] == ["POINT (77.25 12.5)", "POINT (-77 13)"]


def test_wkt_in_stages_equals_the_expression(spark):
    at = [(12.0, -77.5), (-0.0, 100.0), (1e-7, 1.25e10), (float("nan"), 0.1), (float("inf"), 10.05), (None, 1.0), (0.1, None)]
    df = geo.with_wkt(spark.createDataFrame(at, "lat double, lon double"), "lat", "lon", "g")
    assert df.columns == ["lat", "lon", "g"]
    assert all(r["g"] == r["w"] for r in df.selectExpr("g", f"{geo.wkt_point_sql('lat', 'lon')} AS w").collect())
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 0
