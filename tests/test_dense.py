"""Sums over cells equal those over all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roadfeat import config as c
from roadfeat.functions.geometry import line_of, rectangle
from roadfeat.layer import POINT, POLYGON, Layer
from roadfeat.operators import dense
from roadfeat.operators.proximity import join_by_cell
from roadfeat.plans import features as ft
from roadfeat.sources.places import load_bus_passenger_stops


@pytest.fixture
def both(monkeypatch):
    """The table of features by pairs and by cells; fails if the cells are not used."""

    def run(points, wanted):
        base = points.df.select("POINT_ID")
        monkeypatch.setattr(dense, "DENSE_PAIRS", 1 << 60)
        by_pairs = ft.add_proximity_features(base, points, wanted).orderBy("POINT_ID").collect()
        monkeypatch.setattr(dense, "DENSE_PAIRS", 1)
        monkeypatch.setattr(dense, "EXACT_PAIRS", 20)
        used, sums = [], dense.object_sums
        monkeypatch.setattr(dense, "object_sums", lambda *a: used.append(sums(*a)) or used[-1])
        by_cells = ft.add_proximity_features(base, points, wanted).orderBy("POINT_ID").collect()
        monkeypatch.setattr(dense, "object_sums", sums)
        assert used
        return by_pairs, by_cells, used

    return run


def some_points(spark, rng, n=150, wide=600.0):
    rows = [(i, rng.uniform(-wide, wide), rng.uniform(-wide, wide)) for i in range(n)]
    rows += [(n, math.nan, 0.0), (n + 1, None, 0.0), (n + 2, 1e12, 1e12)]
    return Layer(spark.createDataFrame(rows, "POINT_ID long, x double, y double"))


def some_marks(spark, rng, n=3000, wide=800.0):
    """Ids at one place, at several near and far ones, at very many, and missing ones."""
    rows = []
    for i in range(n):
        x, y = rng.uniform(-wide, wide), rng.uniform(-wide, wide)
        kind = rng.randrange(6)
        ident = None if kind == 0 else "common" if kind == 1 else f"twice{i // 2}" if kind == 2 else f"{i}"
        rows.append((ident, x, y, rng.randrange(5)))
        if kind == 3:
            rows.append((ident, x + rng.uniform(-30, 30), y, 1))
        if kind == 4:
            rows.append((ident, x, y + rng.uniform(100, 900), 1))
    rows += [("nan", math.nan, 1.0, 1), ("far", -1e13, 5.0, 1), ("edge", math.inf, 1.0, 1)]
    return spark.createDataFrame(rows, "MGRNU string, x double, y double, val long")


def test_points_by_cells(spark, both):
    rng = random.Random(3)
    p, marks = some_points(spark, rng), some_marks(spark, rng)
    layer = Layer(marks, POINT)
    feature = ft.FEATURES
    wanted = [
        (feature["intersections"], layer),
        (ft.replace(feature["bus_stops"], ident="MGRNU"), layer),
        (ft.replace(feature["population"], value="val"), layer),
        (feature["cctv"], layer),
        (feature["crosswalk_warnings"], Layer(marks.where("x > 300"), POINT)),
    ]
    by_pairs, by_cells, used = both(p, wanted)
    assert by_cells == by_pairs
    assert sum(r[c.INTERSECTION_COLUMN] for r in by_pairs) > 1000 and {r[c.CROSSWALK_WARNING_COLUMN] for r in by_pairs} == {0, 1}
    # The wide id goes by pairs, all others by cells.
    (_, rest), *_ = used
    assert rest.where("_id is not null").select("_id").distinct().count() <= 4


def test_a_disc_for_a_buffer(spark, both, monkeypatch):
    rng = random.Random(5)
    p, marks = some_points(spark, rng, 60), some_marks(spark, rng, 1000)
    monkeypatch.setattr(ft.add_proximity_features, "__defaults__", (None, None, None))
    by_pairs, by_cells, _ = both(p, [(ft.FEATURES["intersections"], Layer(marks, POINT))])
    assert by_cells == by_pairs


def test_shapes_by_cells(spark, both):
    rng = random.Random(4)
    p = some_points(spark, rng)
    rows = []
    for i in range(1500):
        x, y, kind = rng.uniform(-700, 700), rng.uniform(-700, 700), rng.randrange(6)
        wide = 3000.0 if i < 3 else 400.0 if kind == 0 else rng.uniform(2, 60)
        ident = None if kind == 1 else f"pair{i // 2}" if kind == 2 else "common" if kind == 3 else f"{i}"
        rows.append((ident, x, y, x + wide, y + rng.uniform(2, 60)))
        if kind == 4:
            rows.append((ident, x + 20, y, x + 45, y + 9))
    boxes = spark.createDataFrame(rows, "MGRNU string, xmin double, ymin double, xmax double, ymax double")
    plain = boxes.select("MGRNU", rectangle("xmin", "ymin", "xmax", "ymax").alias("parts"))
    outer = line_of(("xmin", "ymin"), ("xmin", "ymin + 180"), ("xmin + 180", "ymin + 180"), ("xmin + 180", "ymin"), ("xmin", "ymin"))
    hole = line_of(("xmin + 60", "ymin + 60"), ("xmin + 120", "ymin + 60"), ("xmin + 120", "ymin + 120"), ("xmin + 60", "ymin + 60"))
    holed = boxes.where("xmax - xmin < 30").select("MGRNU", F.concat(outer, hole).alias("parts"))
    layer = Layer(plain.unionByName(holed), POLYGON)
    wanted = [
        (ft.FEATURES["crosswalks"], layer),
        (ft.replace(ft.FEATURES["speed_bumps"], how=ft.ROWS), Layer(layer.df.unionByName(plain.limit(200)), POLYGON)),
        (ft.FEATURES["market"], Layer(plain.limit(40), POLYGON)),
    ]
    by_pairs, by_cells, _ = both(p, wanted)
    assert by_cells == by_pairs
    assert sum(r[c.CROSSWALK_COLUMN] for r in by_pairs) > 1000 and {r[c.TRADITIONAL_MARKET_COLUMN] for r in by_pairs} == {0, 1}


def test_repeated_ids_of_points_go_by_pairs(spark, both):
    rng = random.Random(6)
    p = some_points(spark, rng, 20)
    p = Layer(p.df.unionByName(p.df.withColumn("x", F.col("x") + 5)))
    by_pairs, by_cells, used = both(p, [(ft.FEATURES["intersections"], Layer(some_marks(spark, rng, 500), POINT))])
    assert sorted(by_cells) == sorted(by_pairs) and used == [None]


def test_wide_outlines_go_by_cells_in_groups(spark, both, monkeypatch):
    """Outlines wider than the tiles, holes that a buffer fits into, edges in all directions, and tiles with more rows than a group."""
    monkeypatch.setattr(dense, "GROUP_ROWS", 40)
    rng = random.Random(7)
    p = some_points(spark, rng, 300, 500.0)
    rows = []
    for i in range(150):
        x, y, a = rng.uniform(-600, 600), rng.uniform(-600, 600), rng.uniform(0, 6)
        size = rng.choice([8.0, 130.0, 390.0])

        def ring(share, dx=0.0):
            corners = [(a + math.pi * k * 2 / 5, size * share * rng.uniform(0.6, 1)) for k in range(5)]
            made = [(x + dx + s * math.cos(t), y + s * math.sin(t)) for t, s in corners]
            return [*made, made[0]]

        parts = [ring(1.0), ring(0.5)] if i % 3 == 0 else [ring(1.0), ring(0.1, 450.0)] if i % 3 == 1 else [ring(1.0)]
        rows.append((f"{i // 2}", parts))
    shapes = spark.createDataFrame(rows, "MGRNU string, parts array<array<struct<x:double,y:double>>>")
    wanted = [(ft.FEATURES["crosswalks"], Layer(shapes, POLYGON)), (ft.FEATURES["market"], Layer(shapes.limit(30), POLYGON))]
    by_pairs, by_cells, used = both(p, wanted)
    assert by_cells == by_pairs and not used[0][1].take(1)
    assert sum(r[c.CROSSWALK_COLUMN] for r in by_pairs) > 1000 and {r[c.TRADITIONAL_MARKET_COLUMN] for r in by_pairs} == {0, 1}


def test_sums_of_odd_values_in_groups(spark, both, monkeypatch):
    """Fractions, and a value that would drown the others in a running sum."""
    monkeypatch.setattr(dense, "GROUP_ROWS", 200)
    rng = random.Random(8)
    p = some_points(spark, rng, 100)
    marks = some_marks(spark, rng, 800).withColumn("val", F.expr("if(x between 0 and 9, 4e17D, val + 0.25D)"))
    by_pairs, by_cells, _ = both(p, [(ft.replace(ft.FEATURES["population"], value="val"), Layer(marks, POINT))])
    pairs, cells = ([r[c.ELDERLY_POPULATION_COLUMN] for r in rows] for rows in (by_pairs, by_cells))
    # Sums with the great value are rounded in the order of addition.
    assert cells == [want if want < 1 << 50 else pytest.approx(want, rel=1e-14) for want in pairs]
    assert max(pairs) > 1 << 58 and min(pairs) < 1 << 20


def test_sides_that_grow_are_not_broadcast(spark):
    """Files of few bytes may hold many rows: neither cells with their copies nor stops go through the driver."""
    ids = spark.range(5)
    homes = ids.selectExpr(f"id as `{c.POINT_ID}`", "id % 3 as _cell", "0L as a")
    copies = ids.selectExpr("id as _cell", "1D as _v")
    stops = ids.selectExpr("string(id) as NODE_ID", "'일반' as `정류소타입`", "127D as `X좌표`", "37.5D as `Y좌표`")
    rides = ids.selectExpr("'d' as `사용일자`", "string(id) as `표준버스정류장ID`", "'1' as `승차총승객수`", "'2' as `하차총승객수`")
    for df in (join_by_cell(homes, copies, ["_cell"], "true").df, load_bus_passenger_stops(stops, rides).df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
        assert df.count() == 5
