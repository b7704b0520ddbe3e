import math

import pytest
from pyspark.sql import functions as F

from roadfeat.functions.crs import forward_scalar, inverse_scalar, project_points
from roadfeat.functions.geometry import inside_buffer, representative_point, segment_meets_buffer
from roadfeat.layer import LINE, POLYGON, Layer
from roadfeat.operators.roads import create_point_buffers, make_points

APOTHEM = 50 * math.cos(math.pi / 64)


def test_known_projection_values():
    x, y = forward_scalar(126.9779, 37.5663, 5179)
    assert (x, y) == pytest.approx((953892.2108, 1952009.9410), abs=1e-3)
    x, y = forward_scalar(126.9779, 37.5663, 5186)
    assert (x, y) == pytest.approx((198047.5268, 551862.8350), abs=1e-3)


def test_columns_project_like_scalars_and_back(spark):
    places = [(126.8 + 0.05 * i, 37.4 + 0.05 * i) for i in range(6)]
    df = spark.createDataFrame(places, "x double, y double")
    for code in (5179, 5186):
        plane = project_points(df, "x", "y", 4326, code)
        got = sorted((r["x"], r["y"]) for r in plane.collect())
        want = sorted(forward_scalar(lon, lat, code) for lon, lat in places)
        assert [v for p in got for v in p] == pytest.approx([v for p in want for v in p], abs=1e-6)
        back = sorted((r["x"], r["y"]) for r in project_points(plane, "x", "y", code, 4326).collect())
        assert [v for p in back for v in p] == pytest.approx([v for p in places for v in p], abs=1e-10)
        assert inverse_scalar(*want[0], code) == pytest.approx(places[0], abs=1e-10)


def test_parts_project_like_points(spark):
    df = spark.createDataFrame([([[(127.0, 37.5), (127.1, 37.6)]],)], "parts array<array<struct<x:double,y:double>>>")
    v = Layer(df, LINE, 4326).to_crs(5179).df.first()["parts"][0]
    assert (v[1]["x"], v[1]["y"]) == pytest.approx(forward_scalar(127.1, 37.6, 5179), abs=1e-6)


def test_buffer_is_a_64_gon_without_its_edge(spark):
    """A vertex is on the x axis; the middle of a side is nearer by 6 cm."""
    side = math.pi / 64
    cases = [
        (49.999, 0.0, True),
        (50.0, 0.0, False),
        ((APOTHEM - 1e-6) * math.cos(side), (APOTHEM - 1e-6) * math.sin(side), True),
        ((APOTHEM + 1e-6) * math.cos(side), (APOTHEM + 1e-6) * math.sin(side), False),
        (0.0, 0.0, True),
        (float("nan"), 0.0, False),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "dx double, dy double")
    got = [r[0] for r in df.select(F.expr(inside_buffer("dx", "dy", 50, 16))).collect()]
    assert got == [c[2] for c in cases]
    disc = [r[0] for r in df.select(F.expr(inside_buffer("dx", "dy", 50, None))).collect()]
    assert disc[3] is True


def test_segments_in_the_ring_are_clipped(spark):
    """Between the two circles only the polygon's own corners reach out."""
    side = math.pi / 64
    near_side = [(APOTHEM + 0.01) * f(side) for f in (math.cos, math.sin)]
    rows = [
        (49.99, -100.0, 49.99, 100.0, True),  # cuts the corner at angle 0
        (50.0, -100.0, 50.0, 100.0, True),  # meets it in one point
        (near_side[0], near_side[1], 2 * near_side[0], 2 * near_side[1], False),
        (0.0, 0.0, 0.0, 0.0, True),
        (-200.0, 0.0, 200.0, 0.0, True),
        (60.0, 0.0, 70.0, 5.0, False),
    ]
    df = spark.createDataFrame([r[:4] for r in rows], "x1 double, y1 double, x2 double, y2 double")
    test = F.expr(segment_meets_buffer("0D", "0D", "x1", "y1", "x2", "y2", 50, 16))
    assert [r[0] for r in df.select(test).collect()] == [r[4] for r in rows]


def test_representative_point(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    u_shape = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (7.0, 9.0), (7.0, 1.0), (3.0, 1.0), (3.0, 9.0), (0.0, 9.0), (0.0, 0.0)]
    box = lambda x0, y0, x1, y1: [(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]
    far = [box(200.0, 200.0, 210.0, 210.0), box(0.0, 0.0, 100.0, 100.0)]
    holed = [box(0.0, 0.0, 100.0, 100.0), box(10.0, 40.0, 60.0, 60.0), box(20.0, 45.0, 30.0, 55.0)]
    beside = [box(0.0, 0.0, 10.0, 10.0), box(20.0, 4.0, 24.0, 30.0)]
    shapes = [[square], [u_shape], far, holed, beside, [[(3.0, 4.0)]]]
    df = spark.createDataFrame([(s,) for s in shapes], "parts array<array<struct<x:double,y:double>>>")
    got = [tuple(r[0]) for r in df.select(representative_point("parts")).collect()]
    assert got == [(2.0, 1.0), (1.5, 5.0), (50.0, 50.0), (80.0, 50.0), (5.0, 5.0), (3.0, 4.0)]


def roads(spark, lines, kind=LINE):
    rows = [(i * 10, "길", "1", 1.0, 2.0, "3", parts) for i, parts in enumerate(lines)]
    schema = (
        "ord long, RN string, RN_CD string, ROAD_LT double, ROAD_BT double, ROA_CLS_SE string, "
        "parts array<array<struct<x:double,y:double>>>"
    )
    return Layer(spark.createDataFrame(rows, schema), kind)


def straight(length):
    return [[(0.0, 0.0), (length, 0.0)]]


@pytest.mark.parametrize(
    "length, places",
    [(0.0, [0]), (24.9, [0, 24.9]), (25.0, [0, 25]), (50.0, [0, 25, 50]), (50.3, [0, 25, 50, 50.3])],
)
def test_walk(spark, length, places):
    rows = make_points(roads(spark, [straight(length)]), "ord").df.orderBy("POINT_ID").collect()
    assert [r["x"] for r in rows] == places
    assert [r["POINT_SEQ"] for r in rows] == list(range(len(places)))


def test_parts_restart_and_empty_roads_keep_their_number(spark):
    two_parts = [[(0.0, 0.0), (30.0, 0.0)], [(30.0, 0.0), (30.0, 20.0), (30.0, 60.0)]]
    rows = make_points(roads(spark, [straight(10.0), None, [], two_parts]), "ord").df.orderBy("POINT_ID").collect()
    assert [(r["POINT_ID"], r["ROAD_IDX"], r["POINT_SEQ"], r["x"], r["y"]) for r in rows] == [
        (0, 0, 0, 0.0, 0.0),
        (1, 0, 1, 10.0, 0.0),
        (2, 3, 0, 0.0, 0.0),
        (3, 3, 1, 25.0, 0.0),
        (4, 3, 2, 30.0, 0.0),
        (5, 3, 3, 30.0, 0.0),
        (6, 3, 4, 30.0, 25.0),
        (7, 3, 5, 30.0, 50.0),
        (8, 3, 6, 30.0, 60.0),
    ]
    assert make_points(roads(spark, [two_parts], POLYGON), "ord").df.count() == 0


def test_ids_do_not_depend_on_buckets(spark, monkeypatch):
    from roadfeat.operators import ranking
    from roadfeat.operators import roads as module

    lines = [straight(7.0 * (i % 9)) for i in range(60)]
    layer = roads(spark, lines)
    want = sorted(map(tuple, make_points(layer, "ord").df.select("POINT_ID", "ROAD_IDX", "x").collect()))
    assert [w[0] for w in want] == list(range(len(want)))
    monkeypatch.setattr(ranking, "SMALLEST_PART", 20)
    monkeypatch.setattr(module, "POINTS_PER_RUN", 2)
    shuffled = Layer(layer.df.repartition(5, "ROAD_LT", "ord"), LINE)
    assert sorted(map(tuple, make_points(shuffled, "ord").df.select("POINT_ID", "ROAD_IDX", "x").collect())) == want


def test_buffer_polygon_export(spark):
    points = make_points(roads(spark, [straight(0.0)]), "ord")
    ring = create_point_buffers(points).df.first()["parts"][0]
    assert len(ring) == 65 and ring[0] == ring[-1]
    assert max(math.hypot(v["x"], v["y"]) for v in ring) == pytest.approx(50)
