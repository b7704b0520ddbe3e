import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from roadfeat import config as c
from roadfeat.diagnostics import Diagnostics
from roadfeat.functions.geometry import rectangle, two_point_line
from roadfeat.layer import LINE, POINT, POLYGON, Layer
from roadfeat.operators import proximity
from roadfeat.plans import features as ft
from roadfeat.plans import pipeline as pl
from roadfeat.sources import places


def points(spark, places):
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(places)]
    return Layer(spark.createDataFrame(rows, "POINT_ID long, x double, y double"))


def ids(layer):
    return layer.df.select("POINT_ID")


def marks(spark, rows):
    rows = [(i, float(x), float(y)) for i, x, y in rows]
    return Layer(spark.createDataFrame(rows, "MGRNU string, x double, y double"), POINT)


def column(df, name):
    return [r[name] for r in df.orderBy("POINT_ID").collect()]


def test_distinct_ids_nulls_and_edges(spark):
    p = points(spark, [(0, 0), (40, 0), (500, 500)])
    m = marks(spark, [("a", 10, 0), ("a", 12, 0), ("b", 20, 0), (None, 5, 0), ("edge", -50, 0)])
    assert column(ft.add_intersection_counts(ids(p), p, m), c.INTERSECTION_COLUMN) == [2, 2, 0]
    without_ids = Layer(m.df.drop("MGRNU"))
    assert column(ft.add_intersection_counts(ids(p), p, without_ids), c.INTERSECTION_COLUMN) == [4, 4, 0]


def test_adding_twice_replaces(spark):
    p = points(spark, [(0, 0)])
    m = marks(spark, [("a", 1, 1)])
    once = ft.add_crosswalk_warning_presence(ids(p), p, m)
    twice = ft.add_crosswalk_warning_presence(once, p, m)
    assert twice.columns == once.columns and twice.collect() == once.collect()


def test_risk_counts_rows_and_skips_missing_numbers(spark):
    rows = [("1", "1", "1", "0", "2"), ("1", "1", "0", "1", None), ("x", "1", "9", "9", "9")]
    df = spark.createDataFrame(rows, "x_crdnt string, y_crdnt string, dprs_cnt string, sep_cnt string, slp_cnt string")
    p = points(spark, [(0, 0), (900, 0)])
    got = column(ft.add_accident_risk(ids(p), p, df), c.RISK_COLUMN)
    assert got == pytest.approx([10 * 2 * (1 + 0.1168 + 0.0068 * 2), 0.0])


def test_risk_takes_the_points_coordinate_system(spark):
    df = spark.createDataFrame([("200000", "600000", "1", "0", "0")], "x_crdnt string, y_crdnt string, dprs_cnt string, sep_cnt string, slp_cnt string")
    p = Layer(points(spark, [(200_000, 600_000)]).df, crs=5186)
    assert column(ft.add_accident_risk(ids(p), p, df), c.RISK_COLUMN) == [10.0]


def test_features_run_with_broadcasts_switched_off(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = points(spark, [(0, 0), (40, 0)])
        assert column(ft.add_intersection_counts(ids(p), p, marks(spark, [("a", 10, 0)])), c.INTERSECTION_COLUMN) == [1, 1]
        bump = spark.createDataFrame([("m",)], "MGRNU string").withColumn("parts", rectangle("-5D", "-5D", "5D", "5D"))
        assert column(ft.add_speed_bump_counts(ids(p), p, Layer(bump, POLYGON)), c.SPEED_BUMP_COLUMN) == [1, 1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")


def test_shapes_are_measured_before_they_are_broadcast(spark):
    p = points(spark, [(i, i) for i in range(20)])
    shapes = spark.range(40_000).selectExpr("id % 200 as gx", "id div 200 as gy", "id").withColumn(
        "parts", rectangle("gx * 300D", "gy * 300D", "gx * 300D + 90", "gy * 300D + 90")
    )
    targets = proximity.shape_targets(shapes, POLYGON, 0, F.col("id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16MB")
    try:
        plan = proximity.near_shapes(p.df, targets, 50.0).df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")
    assert "strategy=broadcast" not in plan
    few = proximity.near_shapes(p.df, proximity.shape_targets(shapes.limit(10), POLYGON, 0, F.col("id")), 50.0).df
    assert "strategy=broadcast" in few._jdf.queryExecution().optimizedPlan().toString()


def test_population_copies_count_twice_and_round_half_even(spark):
    cell = spark.createDataFrame([("1.25",), ("1.25",), ("*",), (None,)], "val string").withColumn(
        "parts", rectangle("-10D", "-10D", "10D", "10D")
    )
    p = points(spark, [(0, 0), (299, 0), (301, 0)])
    assert column(ft.add_elderly_population_300m(ids(p), p, Layer(cell, POLYGON)), c.ELDERLY_POPULATION_COLUMN) == [2, 2, 0]


def test_categories(spark):
    rows = [("서울특별시", " 음식", "한식 "), ("서울특별시", "음식", "없음"), ("서울특별시", None, "한식"), ("경기도", "음식", "한식")]
    df = spark.createDataFrame(
        [(*r, 127.0, 37.5) for r in rows],
        "`시도명` string, `상권업종대분류명` string, `상권업종중분류명` string, `경도` double, `위도` double",
    )
    from roadfeat.functions.crs import forward_scalar

    p = points(spark, [forward_scalar(127.0, 37.5, 5179)])
    row = ft.add_business_category_counts(ids(p), p, df).first()
    assert (row["음식"], row["음식_한식"], row["교육"]) == (2, 1, 0)
    assert len(row) == 86


def test_polygons_and_lines(spark):
    boxes = [("in", -1, -1, 1, 1), ("far", 60, 0, 70, 1), ("near", 49, 0, 70, 1), ("huge", -9000, -9000, 9000, 9000)]
    df = spark.createDataFrame(boxes, "MGRNU string, a long, b long, c long, d long")
    layer = Layer(df.select("MGRNU", rectangle("a", "b", "c", "d").alias("parts")), POLYGON)
    p = points(spark, [(0, 0), (20000, 0), (5000, 5000)])
    for small in (True, False):
        feature = ft.FEATURES["speed_bumps"]
        got = ft.add_proximity_features(ids(p), p, [(feature, layer)], small=small)
        assert column(got, c.SPEED_BUMP_COLUMN) == [3, 0, 1]
    nameless = Layer(layer.df.drop("MGRNU").unionByName(layer.df.drop("MGRNU")), POLYGON)
    assert column(ft.add_speed_bump_counts(ids(p), p, nameless), c.SPEED_BUMP_COLUMN) == [6, 0, 2]
    line = Layer(spark.range(1).select(two_point_line("-100D", "30D", "100D", "30D").alias("parts")), LINE)
    assert column(ft.add_pedestrian_priority_road_presence(ids(p), p, line), c.PEDESTRIAN_PRIORITY_ROAD_COLUMN) == [1, 0, 0]


def brute(places, targets, radius):
    a, w = radius * math.cos(math.pi / 64), math.pi / 32
    out = []
    for px, py in places:
        seen = set()
        for ident, x, y in targets:
            d, t = math.hypot(x - px, y - py), math.atan2(y - py, x - px)
            if d * math.cos(t % w - w / 2) < a:
                seen.add(ident)
        out.append(len(seen - {None}))
    return out


def crowd(seed=5):
    """A third of the targets in one spot's cell, a third one id, and a crowd of points."""
    rnd = random.Random(seed)
    spread = [(f"s{i}", rnd.uniform(-2000, 2000), rnd.uniform(-2000, 2000)) for i in range(300)]
    cell = [(f"c{i}", rnd.uniform(0, 40), rnd.uniform(0, 40)) for i in range(300)]
    one = [("one", rnd.uniform(-2000, 2000), rnd.uniform(-2000, 2000)) for i in range(300)]
    places = [(rnd.uniform(-2000, 2000), rnd.uniform(-2000, 2000)) for _ in range(150)]
    places += [(rnd.uniform(0, 45), rnd.uniform(0, 45)) for _ in range(80)]
    return places, spread + cell + one


@pytest.mark.parametrize("small, hot", [(True, 50_000), (False, 50_000), (False, 20)])
def test_every_way_finds_the_same(spark, monkeypatch, small, hot):
    monkeypatch.setattr(proximity, "HOT_CELL_ROWS", hot)
    places, targets = crowd()
    p, m = points(spark, places), marks(spark, targets)
    got = ft.add_proximity_features(ids(p), p, [(ft.FEATURES["intersections"], m)], small=small)
    assert column(got, c.INTERSECTION_COLUMN) == brute(places, targets, 50)


def test_hot_cells_beyond_the_broadcast_are_joined(spark, monkeypatch):
    monkeypatch.setattr(proximity, "HOT_CELL_ROWS", 20)
    monkeypatch.setattr(proximity, "MAX_HOT_CELLS_BROADCAST", 0)
    places, targets = crowd(6)
    p, m = points(spark, places), marks(spark, targets)
    got = ft.add_proximity_features(ids(p), p, [(ft.FEATURES["intersections"], m)], small=False)
    assert column(got, c.INTERSECTION_COLUMN) == brute(places, targets, 50)


def links(spark, rows):
    df = spark.createDataFrame(
        [(i, s, float(a), float(b), float(e), float(f)) for i, s, a, b, e, f in rows],
        "LINK_ID string, MAX_SPD string, a double, b double, c double, d double",
    )
    return Layer(df.select("LINK_ID", "MAX_SPD", two_point_line("a", "b", "c", "d").alias("parts")), LINE)


def test_nearest_ties_go_to_the_smallest_id(spark):
    rows = [("L2", "50", 0, 0, 100, 0), ("L1", "60", 100, 0, 0, 0), ("L0", "n/a", 0, 0, 100, 0),
            (None, "30", 0, 0, 100, 0), ("K9", "70.5", 100, 0, 100, 100)]
    p = points(spark, [(50, 10), (130, -30)])
    assert column(ft.add_speed_limit(ids(p), p, links(spark, rows)), c.SPEED_LIMIT_COLUMN) == [60, 70]


def test_no_links_is_an_error(spark):
    p = points(spark, [(0, 0)])
    with pytest.raises(ValueError):
        ft.add_speed_limit(ids(p), p, links(spark, [("L", "50", 9000, 9000, 9100, 9000)]))


def test_bound_join_meets_at_most_nine_segments_a_cell(spark):
    from roadfeat.operators import nearest

    rng = random.Random(9)
    rows = [(f"L{i}", x := rng.uniform(0, 300), y := rng.uniform(0, 300), x + rng.uniform(-9, 9), y + rng.uniform(-9, 9)) for i in range(400)]
    sites = [(rng.uniform(-9000, 9000), rng.uniform(-9000, 9000)) for _ in range(80)]
    p = points(spark, sites)
    lines = spark.createDataFrame(rows, "LINK_ID string, x1 double, y1 double, x2 double, y2 double").selectExpr("LINK_ID", "1 as MAX_SPD", "x1", "y1", "x2", "y2")
    lines = lines.withColumn("parts", two_point_line("x1", "y1", "x2", "y2"))
    pieces = nearest._pieces(nearest._distinct_segments(lines, "LINK_ID", "MAX_SPD"), 50.0)
    homes = p.df.selectExpr("cast(floor(x / 50) as bigint) as _hx", "cast(floor(y / 50) as bigint) as _hy").selectExpr("_hx * 1000000 + _hy as _cell", "_hx", "_hy").distinct()
    homes = nearest._with_level(homes, pieces, 50.0, 10).cache()
    met = nearest._look_around(homes).join(nearest._samples(pieces, 50.0, nearest._levels(homes)), ["_level", "_key"])
    assert met.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 9
    box = [f(s[k] for s in sites) for f in (min, max) for k in (0, 1)]
    got = {r.POINT_ID: r.distance for r in nearest.nearest_line(p.df, lines, "LINK_ID", "MAX_SPD", tuple(box)).collect()}

    def gap(px, py, x1, y1, x2, y2):
        ex, ey = x2 - x1, y2 - y1
        t = min(1, max(0, ((px - x1) * ex + (py - y1) * ey) / (ex * ex + ey * ey)))
        return math.hypot(px - x1 - t * ex, py - y1 - t * ey)

    assert got == pytest.approx({i: min(gap(*s, *r[1:]) for r in rows) for i, s in enumerate(sites)})


def test_nearest_matches_brute_force(spark):
    """Clustered links, a very long one and points far from all of them."""
    rnd = random.Random(3)
    rows = []
    for i in range(120):
        x, y = (rnd.uniform(0, 300), rnd.uniform(0, 300)) if i % 2 else (rnd.uniform(0, 6000), rnd.uniform(0, 6000))
        rows.append((f"L{i:03d}", str(30 + i), x, y, x + rnd.uniform(-80, 80), y + rnd.uniform(-80, 80)))
    rows.append(("LONG", "999", -500, 6500, 6500, 6400))
    places = [(rnd.uniform(0, 6500), rnd.uniform(0, 6500)) for _ in range(200)] + [(900, 5500), (6500, 0)]

    def distance(p, r):
        _, _, x1, y1, x2, y2 = r
        t = ((p[0] - x1) * (x2 - x1) + (p[1] - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)
        t = min(1, max(0, t))
        return math.hypot(p[0] - x1 - t * (x2 - x1), p[1] - y1 - t * (y2 - y1))

    want = [int(min(rows, key=lambda r: (distance(p, r), r[0]))[1]) for p in places]
    p = points(spark, places)
    assert column(ft.add_speed_limit(ids(p), p, links(spark, rows)), c.SPEED_LIMIT_COLUMN) == want


def test_incremental_run_keeps_saved_columns(spark):
    p = points(spark, [(950000, 1950000)])
    m = marks(spark, [("a", 950001, 1950001)])
    saved = pl.build_features(p, {"intersections": m}).withColumn(c.INTERSECTION_COLUMN, F.lit(7).cast("long"))
    row = pl.build_features(p, {"intersections": m, "crosswalk_warnings": m}, existing=saved).first()
    assert (row[c.INTERSECTION_COLUMN], row[c.CROSSWALK_WARNING_COLUMN]) == (7, 1)


def test_accident_extracts(spark):
    a = spark.createDataFrame([(2020, "1")], "yr int, x string")
    b = spark.createDataFrame([(2023, "2"), (2023, "3")], "yr int, x string")
    counts = {r["yr"]: r["accidents"] for r in pl.accidents_by_year(pl.union_accidents(a, b), "yr").collect()}
    assert counts == {2020: 1, 2023: 2}


def test_diagnostics_come_with_the_run(spark):
    rows = [("a", 37.5, 127.0), ("b", 127.0, 37.5), ("c", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "`관리번호` string, `위도` double, `경도` double")
    seen = Diagnostics()
    p = points(spark, [(0, 0)])
    ft.add_streetlight_counts(ids(p), p, df, diagnostics=seen).collect()
    assert seen["streetlights: rows"] == {"rows": 3, "in_scope": 3, "swapped": 1, "excluded": 1, "used": 2}


@pytest.mark.parametrize("small", [True, False])
def test_plans_have_no_cross_join_and_no_python(spark, small):
    places, targets = crowd()
    p, m = points(spark, places), marks(spark, targets)
    df = ft.add_proximity_features(ids(p), p, [(ft.FEATURES["intersections"], m)], small=small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert word not in plan


def test_diagnostics_of_layers_links_and_flagged_points(spark):
    seen = Diagnostics()
    box = spark.createDataFrame([("a", 0), ("b", 900)], "MGRNU string, x long").withColumn("parts", rectangle("x", "0D", "x + 5", "5D"))
    box = box.unionByName(spark.sql("select 'c' as MGRNU, 0L as x, cast(null as array<array<struct<x: double, y: double>>>) as parts"))
    markets = box.selectExpr("parts", "if(MGRNU = 'a', '전통시장', '골목상권') as TRDAR_SE_1")
    p = points(spark, [(0, 0), (40, 0), (500, 0)])
    lines = spark.range(3).select(F.col("id").cast("string").alias("LINK_ID"), F.when(F.col("id") > 0, 30).alias("MAX_SPD"), two_point_line("0D", "0D", "9D", "9D").alias("parts"))
    sources = {"crosswalks": Layer(box, POLYGON), "market": Layer(markets, POLYGON), "intersections": marks(spark, [("m", 1, 1)]), "speed_limit": Layer(lines, LINE)}
    pl.build_features(p, sources, diagnostics=seen).collect()
    assert seen["crosswalks: rows"] == {"rows": 3, "empty": 1, "used": 2}
    assert seen["markets: rows"] == {"rows": 3, "empty": 1, "used": 1}
    assert seen["intersections: rows"] == {"rows": 1, "empty": 0, "used": 1}
    assert seen["links: rows"] == {"used": 2}
    flagged = {k: v for n in seen.names() if n.endswith(": points") for k, v in seen[n].items()}
    assert flagged == {"points": 3, "crosswalks": 2, "market": 2, "intersections": 2}


def test_declaring_a_source_starts_no_job(spark, tmp_path):
    rows = "관리번호,위도,경도\n" + "".join(f"{i},37.5,127.0{k}\n" for k, i in enumerate(("007", "7", "8.0", "8")))
    (tmp_path / "lights.csv").write_text(rows, encoding="cp949")
    mixed = rows + "A8,37.5,127.0\n8 ,37.5,127.0\n"
    (tmp_path / "mixed.csv").write_text(mixed, encoding="cp949")
    spark.sparkContext.setJobGroup("declare", "")
    layers = [places.load_streetlights(str(tmp_path / f)) for f in ("lights.csv", "mixed.csv")]
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("declare")
    spark.sparkContext.setJobGroup("", "")
    # Reading a header takes a job; the ids' type is found out when they are used.
    assert len(jobs) <= 2
    got = [sorted(r["관리번호"] for r in layer.df.collect()) for layer in layers]
    assert got == [["7", "7", "8", "8"], ["007", "7", "8", "8 ", "8.0", "A8"]]


def ring(*xy):
    return "array(" + ", ".join(f"named_struct('x', {x}D, 'y', {y}D)" for x, y in [*xy, xy[0]]) + ")"


@pytest.mark.parametrize("small", [True, False])
def test_outlines_with_holes_parts_and_notches(spark, small):
    frame = f"array({ring((0, 0), (400, 0), (400, 400), (0, 400))}, {ring((60, 60), (340, 60), (340, 340), (60, 340))}, {ring((900, 0), (910, 0), (910, 10), (900, 10))})"
    notch = f"array({ring((2000, 0), (2300, 0), (2300, 300), (2150, 100), (2000, 300))})"
    bow = f"array({ring((4000, 0), (4200, 200), (4200, 0), (4000, 200))})"
    df = spark.sql(f"select 'f' as MGRNU, {frame} as parts union all select 'n', {notch} union all select 'b', {bow}")
    # Two overlapping shapes of one id: inside both is inside, not twice across.
    df = df.unionByName(spark.sql(f"select 'n' as MGRNU, array({ring((1900, -100), (2400, -100), (2400, 400), (1900, 400))}) as parts"))
    places_ = {(200, 200): 0, (30, 200): 1, (112, 112): 0, (109, 200): 1, (905, 5): 1, (700, 5): 0, (2150, 50): 1, (2150, 280): 1, (4100, 100): 1, (4190, 100): 1, (4100, 190): 0, (4100, 130): 1, (4100, 260): 0, (-300, 5): 0, (-500, 90): 0, (1600, 200): 0, (3700, 100): 0}
    p = points(spark, list(places_))
    got = ft.add_proximity_features(ids(p), p, [(ft.FEATURES["crosswalks"], Layer(df, POLYGON))], small=small)
    assert column(got, c.CROSSWALK_COLUMN) == list(places_.values())


def test_an_outline_of_a_million_vertices(spark):
    n = 1_000_000
    # A wave around a circle: the radius at angle t is 50000 + 20000 sin(9 t).
    angle = f"(2 * pi() * i / {n})"
    radius = f"(50000 + 20000 * sin(9 * {angle}))"
    vertices = f"array(transform(sequence(0, {n}), i -> named_struct('x', {radius} * cos({angle}), 'y', {radius} * sin({angle}))))"
    shape = Layer(spark.range(1).selectExpr("'m' as MGRNU", f"{vertices} as parts"), POLYGON)
    rnd, places_ = random.Random(3), []
    while len(places_) < 400:
        x, y = rnd.uniform(-75000, 75000), rnd.uniform(-75000, 75000)
        off = math.hypot(x, y) - (50000 + 20000 * math.sin(9 * math.atan2(y, x)))
        if abs(off) > 1500:  # farther from the outline than any buffer reaches
            places_.append((x, y, int(off < 0)))
    p = points(spark, [xy[:2] for xy in places_])
    got = ft.add_proximity_features(ids(p), p, [(ft.FEATURES["crosswalks"], shape)])
    assert column(got, c.CROSSWALK_COLUMN) == [k for *_, k in places_]


def test_one_join_for_all_radii(spark):
    rnd = random.Random(11)
    spots = [(rnd.uniform(0, 900), rnd.uniform(0, 900)) for _ in range(120)]
    targets = [(f"t{i % 90}", rnd.uniform(0, 900), rnd.uniform(0, 900)) for i in range(150)]
    p, m = points(spark, spots), marks(spark, targets)
    near = replace(ft.FEATURES["intersections"], key="near", output="near")
    far = replace(near, key="far", output="far", radius=300.0)
    for small in (True, False):
        df = ft.add_proximity_features(ids(p), p, [(near, m), (far, m)], small=small)
        assert column(df, "near") == brute(spots, targets, 50) and column(df, "far") == brute(spots, targets, 300)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join Inner") == 1


def test_tables_are_published_whole(spark, tmp_path, monkeypatch):
    from roadfeat.sources import tables

    path = str(tmp_path / "out")
    df = spark.range(2000).select((F.lit(1999) - F.col("id")).alias(c.POINT_ID), F.lit("a,\"b").alias("x,y")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tables.write_table(df, path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = [spark.read.parquet(str(f)) for f in sorted(tmp_path.glob("out/part-*"))]
    ends = [d.agg(F.min(c.POINT_ID), F.max(c.POINT_ID)).first() for d in parts]
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    broken = df.withColumn("z", F.raise_error(F.lit("killed")))
    with pytest.raises(Exception, match="killed"):
        tables.write_table(broken, path)
    assert spark.read.parquet(path).count() == 2000
    # Killed between the two renames: the next call finds the old table again.
    (tmp_path / "out").rename(tmp_path / ".out_old-1")
    with pytest.raises(FileExistsError):
        tables.write_table(df, path, mode="errorifexists")
    assert spark.read.parquet(path).count() == 2000
    one = str(tmp_path / "one.csv")
    for _ in range(2):
        tables.write_table(df, one, "csv", single=True)
    lines = (tmp_path / "one.csv").read_text().splitlines()
    assert lines[0] == f'{c.POINT_ID},"x,y"' and [int(x.split(",")[0]) for x in lines[1:]] == list(range(2000))
    assert pl.read_table(one, file_format="csv").count() == 2000
    assert not [f for f in tmp_path.iterdir() if f.name.startswith((".out", ".one")) and f.suffix != ".crc"]


def test_quoted_line_feeds(spark, tmp_path):
    from roadfeat.sources.tables import read_table

    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    assert [r.b for r in read_table(str(tmp_path / "t.csv"), multi_line=True).orderBy("a").collect()] == ["x\ny", "z"]


def test_sizes_near_the_limit_are_counted(spark):
    def sized(rows, limit):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            targets = proximity.point_targets(spark.range(rows).selectExpr("id * 1D as x", "0D as y"), 0)
            same, small = proximity.checked_size(targets)
            return same is targets, small
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")

    assert sized(1000, "64MB") == (True, True)  # far below: trusted
    assert sized(20_000, "4MB") == (False, True)  # near: counted, fits
    assert sized(20_000, "3MB") == (False, False)
    assert sized(20_000, "1KB") == (True, False)  # hopeless: not written
    assert sized(10, "-1") == (True, False)
