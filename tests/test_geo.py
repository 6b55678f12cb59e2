import math

import pytest
from pyspark.sql import functions as F

from skyloom.functions.geo import haversine_km
from skyloom.operators import spatial
from skyloom.operators.spatial import nearest_place, within_radius
from skyloom.sources import lake

POINT = "p int, latitude double, longitude double"
PLACE = "airport_code string, airport_lat double, airport_lon double"


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 6371.0 * 2 * math.asin(math.sqrt(min(1.0, h)))


def test_known_distance_and_nulls(spark):
    df = spark.createDataFrame([(51.477, -0.461, 49.009, 2.548), (None, 0.0, 1.0, 1.0), (5.0, 5.0, 5.0, 5.0), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    found = [r[0] for r in df.select(haversine_km(*map(F.col, "abcd"))).collect()]
    assert found[0] == pytest.approx(347.928315, abs=1e-6)
    assert found[1] is None and found[2] == 0.0
    assert found[3] == pytest.approx(math.pi * 6371.0)


def ring(lat, lon, distance_km, n=24):
    """Points at a distance, by bearing."""
    d, phi = distance_km / 6371.0, math.radians(lat)
    for i in range(n):
        bearing = 2 * math.pi * i / n
        s = math.sin(phi) * math.cos(d) + math.cos(phi) * math.sin(d) * math.cos(bearing)
        y = math.sin(bearing) * math.sin(d) * math.cos(phi)
        x = math.cos(d) - math.sin(phi) * s
        yield math.degrees(math.asin(s)), (lon + math.degrees(math.atan2(y, x)) + 180) % 360 - 180


CENTRES = [(0.0, 0.0), (51.477, -0.461), (-17.755, 179.95), (10.0, -179.99), (89.9, 20.0), (-89.7, 120.0), (89.4, 0.0), (70.0, 180.0), (-60.5, -180.0)]


@pytest.mark.parametrize("max_cells", [1_000_000, 0])
def test_radius_join_equals_all_pairs(spark, max_cells):
    """Rims just inside and outside, at the date line and both poles, in both join forms."""
    places = spark.createDataFrame([(str(i), *c) for i, c in enumerate(CENTRES)], PLACE)
    points = [p for c in CENTRES for r in (0.0, 20.0, 49.999, 50.001) for p in ring(*c, r)]
    points += [(90.0, 0.0), (-90.0, 33.0), (0.0, 180.0), (0.0, -180.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], POINT)
    joined = within_radius(df, places, max_broadcast_cells=max_cells, busy_rows=7)
    got = {(r.p, r.airport_code) for r in joined.collect()}
    want = {
        (i, str(j)) for i, p in enumerate(points) for j, c in enumerate(CENTRES) if km(*p, *c) <= 50.0
    }
    assert got == want and len(want) > 400




def test_busy_cells_split(spark):
    """Nine tenths of the points in one degree, many of them on one spot, with places all over it:
    the same pairs as all pairs, and no part much fuller than asked for."""
    import random

    rng = random.Random(3)
    points = [(40.0 + rng.random(), 8.0 + rng.random()) for _ in range(1500)] + [(40.5, 8.5)] * 300
    points += [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(200)]
    centres = [(40.0 + rng.random(), 8.0 + rng.random()) for _ in range(40)] + [(39.99, 7.99), (41.01, 8.5), (0.0, 0.0)]
    df = lake.staged(spark.createDataFrame([(i, *p) for i, p in enumerate(points)], POINT), "points")
    places = spark.createDataFrame([(str(i), *c) for i, c in enumerate(centres)], PLACE)
    joined = within_radius(df, places, radius_km=5.0, max_broadcast_cells=0, busy_rows=50)
    got = [(r.p, r.airport_code) for r in joined.collect()]
    want = {(i, str(j)) for i, p in enumerate(points) for j, c in enumerate(centres) if km(*p, *c) <= 5.0}
    assert set(got) == want and len(got) == len(want) > 500
    busy = spatial.busy_cells(df, 50).collect()
    assert len(busy) == 1 and len(busy[0].splits) >= 4 and list(busy[0].salts.values()) == [6]
    near = {r.p: r.airport_code for r in nearest_place(df, places, radius_km=5.0, max_broadcast_cells=0, busy_rows=50).collect()}
    plain = {r.p: r.airport_code for r in nearest_place(df, places, radius_km=5.0).collect()}
    assert near == plain and len(near) == 2000


def test_null_positions_match_nothing(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 1.0, None)], POINT)
    assert within_radius(df, lake.airports(spark)).count() == 0


@pytest.mark.parametrize("max_cells", [1000, 0])
def test_a_point_may_have_several_places_and_one_nearest(spark, max_cells):
    places = spark.createDataFrame([("A", 10.0, 10.0), ("B", 10.2, 10.0), ("C", 10.0, 10.0)], PLACE)
    points = spark.createDataFrame([(1, 10.15, 10.0), (2, 10.0, 10.0), (3, 40.0, 40.0), (4, None, 1.0)], POINT)
    assert within_radius(points, places).count() == 6
    nearest = {r.p: r.airport_code for r in nearest_place(points, places, max_broadcast_cells=max_cells).collect()}
    assert nearest == {1: "B", 2: "A", 3: None, 4: None}


def test_points_are_not_shuffled_for_small_place_tables(spark):
    points = spark.range(100).selectExpr("cast(id as int) p", "cast(id as double) / 2 latitude", "cast(id as double) longitude")
    plan = within_radius(points, lake.airports(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert "NestedLoop" not in plan and "Python" not in plan


def test_points_look_busy_cells_up_by_id(spark):
    """No search of lists in any row: its time would grow with the busy cells of the degree."""
    points = lake.staged(spark.range(400).selectExpr("cast(id as int) p", "50 + id % 20 / 25D latitude", "8 + id % 20 / 25D longitude"), "points")
    places = spark.createDataFrame([("A", 50.1, 8.1), ("B", 50.5, 8.5)], PLACE)
    joined = within_radius(points, places, radius_km=5.0, max_broadcast_cells=0, busy_rows=10)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "array_contains" not in plan and "salts#" not in plan.split("Generate explode(salts")[0]
    assert sorted(r.p for r in joined.collect()) == sorted(r.p for r in within_radius(points, places, radius_km=5.0).collect())
