import struct

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, IsNotNull, LessThan

from roadfeat.layer import LINE, POINT, POLYGON
from roadfeat.sources import places, shapefile
from roadfeat.sources.shapefile import Bound
from roadfeat.sources.tables import ingest_layer, read_layer, within_box


def write_shapefile(stem, shapes, rows, fields, code, encoding="cp949", prj=None):
    """A small shapefile: ``shapes`` are record bodies, ``fields`` are (name, kind, width, decimals)."""
    head = struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, 0) + struct.pack("<ii8d", 1000, code, *[0.0] * 8)
    shp, shx, at = b"", b"", 100
    for i, body in enumerate(shapes):
        shx += struct.pack(">ii", at // 2, len(body) // 2)
        shp += struct.pack(">ii", i + 1, len(body) // 2) + body
        at += 8 + len(body)
    stem.with_suffix(".shp").write_bytes(head + shp)
    stem.with_suffix(".shx").write_bytes(head + shx)
    width = 1 + sum(f[2] for f in fields)
    dbf = struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(fields), width)
    for name, kind, size, decimals in fields:
        dbf += name.encode().ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([size, decimals]) + b"\0" * 14
    dbf += b"\r"
    for row in rows:
        dbf += b" " + b"".join(str(v).encode(encoding).ljust(f[2]) for v, f in zip(row, fields))
    stem.with_suffix(".dbf").write_bytes(dbf)
    if prj:
        stem.with_suffix(".prj").write_text(prj)
    return str(stem.with_suffix(".shp"))


def outline(code, *parts, box=(0, 0, 0, 0)):
    flat = [v for part in parts for xy in part for v in xy]
    starts, n = [], 0
    for part in parts:
        starts.append(n)
        n += len(part)
    return struct.pack(f"<i4dii{len(parts)}i{2 * n}d", code, *box, len(parts), n, *starts, *[float(v) for v in flat])


NULL = struct.pack("<i", 0)
GRS80_GEOGCS = 'GEOGCS["y",DATUM["D_Korea_2000",SPHEROID["GRS_1980",6378137.0,298.257222101]]]'
PRJ_5186 = (
    f'PROJCS["x",{GRS80_GEOGCS},PROJECTION["Transverse_Mercator"],PARAMETER["False_Easting",200000.0],'
    'PARAMETER["False_Northing",600000.0],PARAMETER["Central_Meridian",127.0],PARAMETER["Scale_Factor",1.0],'
    'PARAMETER["Latitude_Of_Origin",38.0],UNIT["Meter",1.0]]'
)


def test_folder_reads_merge_the_schemas(spark, tmp_path):
    cell = outline(5, [(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)])
    for name, value, field in (("a", "5", ("N", 10, 0)), ("b", "2.50", ("N", 10, 2)), ("c", " 7 ", ("C", 5, 0))):
        extra = [("only_b", "N", 4, 0)] if name == "b" else []
        write_shapefile(tmp_path / name, [cell], [(value, *["3"] * len(extra))], [("val", *field), *extra], 5, "utf-8")
    layer = places.load_population_grid(str(tmp_path))
    got = {r.source_file[-5:]: (r["val"], r.only_b) for r in layer.df.collect()}
    assert got == {"a.shp": (5.0, None), "b.shp": (2.5, 3), "c.shp": (7.0, None)}


def test_large_shapes_are_read_in_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shapefile, "BYTES_AT_ONCE", 100)
    bodies = [outline(3, [(i, 0), (i, 1)]) for i in range(7)]
    path = write_shapefile(tmp_path / "lines", bodies, [(i,) for i in range(7)], [("k", "N", 3, 0)], 3)
    assert [high - low for low, high in shapefile._runs([(50 * i, 40) for i in range(7)])] == [2, 2, 2, 1]
    got = shapefile.read_shapefile(spark, path, "line").orderBy("record_number").collect()
    assert [(r.k, r.parts[0][0].x) for r in got] == [(i, float(i)) for i in range(7)]


def test_coordinate_systems(tmp_path):
    def code(prj):
        write_shapefile(tmp_path / "p", [NULL], [("1",)], [("k", "N", 3, 0)], 1, prj=prj)
        return shapefile.crs_of_shapefile(str(tmp_path / "p.shp"))

    names = ["Longitude of natural origin", "Latitude of natural origin", "Scale factor at natural origin", "False easting", "False northing"]
    wkt2 = lambda *v: 'PROJCRS["x",BASEGEOGCRS["Korea 2000",DATUM["Geocentric datum of Korea",ELLIPSOID["GRS 1980",6378137,298.257222101,LENGTHUNIT["metre",1]]]],CONVERSION["y",METHOD["Transverse Mercator",ID["EPSG",9807]],' + ",".join(f'PARAMETER["{n}",{x}]' for n, x in zip(names, v)) + '],CS[Cartesian,2],LENGTHUNIT["metre",1]]'
    assert code(PRJ_5186) == 5186
    assert code(wkt2(129.0, 38.0, 1.0, 200000, 600000)) == 5187
    assert code(wkt2(127.0, 38.0, 1.0, 200000, 550000)) == 5182
    assert code('GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]]]') == 4326
    assert code('GEOGCS["Tokyo",DATUM["Tokyo",SPHEROID["Bessel 1841",6377397.155,299.1528128]]]') == 4301
    bessel = 'GEOGCS["y",DATUM["D_Korean_Datum_1985",SPHEROID["Bessel_1841",6377397.155,299.1528128]]]'
    assert code(PRJ_5186.replace(GRS80_GEOGCS, bessel).replace("600000.0", "500000.0")) == 2097
    for prj in ('GEOGCS["unknown"]', 'GEOGCS["u",DATUM["u",SPHEROID["u",6377000.0,299.0]]]', PRJ_5186.replace('UNIT["Meter",1.0]', 'UNIT["Foot",0.3048]'), PRJ_5186.replace("Transverse_Mercator", "Lambert"), "nothing ["):
        with pytest.raises(ValueError, match="not supported"):
            code(prj)


def test_roads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shapefile, "BYTES_PER_TASK", 200)
    bodies = [outline(3, [(0, 0), (50, 0)]), NULL, outline(3, [(0, 0), (10, 0)], [(10, 0), (10, 30)])]
    rows = [("11110", "3", "세종로", "10.5"), ("11110", "4", "종로", "1"), ("11110", "4", "길", "")]
    fields = [("SIG_CD", "C", 5, 0), ("ROA_CLS_SE", "C", 1, 0), ("RN", "C", 20, 0), ("ROAD_LT", "N", 8, 2)]
    path = write_shapefile(tmp_path / "roads", bodies, rows, fields, 3)
    layer = places.load_road_segments(path)
    got = layer.df.orderBy("ord").collect()
    assert [r["ord"] for r in got] == [0, 1, 2]
    assert [r["RN"] for r in got] == ["세종로", "종로", "길"]
    assert [r["ROAD_LT"] for r in got] == [10.5, 1.0, None]
    assert got[1]["parts"] is None and len(got[2]["parts"]) == 2
    from roadfeat.plans.pipeline import road_points

    assert road_points(layer).df.count() == 3 + 2 + 3


def test_points_and_known_projection(spark, tmp_path):
    bodies = [struct.pack("<i2d", 1, 1.0, 2.0), NULL]
    path = write_shapefile(tmp_path / "p", bodies, [("A",), ("B",)], [("MGRNU", "C", 4, 0)], 1, prj=PRJ_5186)
    layer = places.load_intersections(path)
    assert layer.crs == 5186 and layer.kind == POINT
    assert [(r["MGRNU"], r["x"], r["y"]) for r in layer.df.collect()] == [("A", 1.0, 2.0)]


def test_open_rings_are_closed(spark, tmp_path):
    body = outline(5, [(0, 0), (0, 1), (1, 1)])
    path = write_shapefile(tmp_path / "b", [body], [("A",)], [("MGRNU", "C", 4, 0)], 5)
    ring = places.load_speed_bumps(path).df.first()["parts"][0]
    assert len(ring) == 4 and ring[0] == ring[-1]


def test_population_folder(spark, tmp_path):
    ring = outline(5, [(0, 0), (0, 1), (1, 1), (0, 0)])
    for district in ("a", "b"):
        (tmp_path / district).mkdir()
        write_shapefile(tmp_path / district / "grid", [ring], [("3.5",)], [("val", "N", 8, 2)], 5)
    cells = places.load_population_grid(str(tmp_path)).df.collect()
    assert [r["val"] for r in cells] == [3.5, 3.5]
    assert len({r["source_file"] for r in cells}) == 2
    with pytest.raises(FileNotFoundError):
        places.load_population_grid(str(tmp_path / "absent"))


def test_ingested_layer_is_pruned_by_box(spark, tmp_path):
    lines = [outline(3, [(i * 1000, 0), (i * 1000 + 10, 0)]) for i in range(5)]
    path = write_shapefile(tmp_path / "l", lines, [(str(i),) for i in range(5)], [("LINK_ID", "C", 4, 0)], 3)
    ingest_layer(read_layer(path, LINE), str(tmp_path / "layer"))
    stored = read_layer(str(tmp_path / "layer"), LINE)
    boxed = within_box(stored, (900.0, -1.0, 2005.0, 1.0)).df
    assert sorted(r["LINK_ID"] for r in boxed.collect()) == ["1", "2"]
    assert "PushedFilters: [IsNotNull" in boxed._jdf.queryExecution().executedPlan().toString()


def test_polygon_kind_is_checked(spark, tmp_path):
    path = write_shapefile(tmp_path / "k", [outline(3, [(0, 0), (1, 1)])], [("A",)], [("MGRNU", "C", 4, 0)], 3)
    assert read_layer(path, POLYGON).drop_empty().df.count() == 0


def links(tmp_path, n=200, **kw):
    lines = [outline(3, [(i * 10, 0), (i * 10 + 5, 1)], box=(i * 10, 0, i * 10 + 5, 1)) for i in range(n)]
    rows = [(f"L{i}", "name", str(30 + i % 5)) for i in range(n)]
    fields = [("LINK_ID", "C", 8, 0), ("ROAD_NAME", "C", 10, 0), ("MAX_SPD", "N", 4, 0)]
    return write_shapefile(tmp_path / "links", lines, rows, fields, 3, prj=PRJ_5186, **kw)


def test_only_what_is_asked_for_is_decoded(spark, tmp_path, monkeypatch):
    path = links(tmp_path)
    shapes, attributes = [], []
    parts, column = shapefile.decode_parts, shapefile.decode_column
    monkeypatch.setattr(shapefile, "decode_parts", lambda data, at, known: shapes.append(int(known.sum())) or parts(data, at, known))
    monkeypatch.setattr(shapefile, "decode_column", lambda rows, f, *a: attributes.append((f.name, len(rows))) or column(rows, f, *a))
    options = {"paths": path, "kind": "line", "columns": "MAX_SPD"}
    schema = shapefile.ShapefileSource(options).schema()
    assert schema.names == ["record_number", "source_file", "parts", "xmin", "ymin", "xmax", "ymax", "MAX_SPD"]
    reader = shapefile.PushingReader(schema, options)
    left = [EqualTo(("MAX_SPD",), 31), GreaterThan(("source_file",), "a")]
    pushed = [IsNotNull(("xmax",)), GreaterThanOrEqual(("xmax",), 995.0), LessThan(("xmin",), 1030.0)]
    assert list(reader.pushFilters([*pushed, *left])) == left
    rows = [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
    assert [r["record_number"] for r in rows] == [99, 100, 101, 102] and [r["MAX_SPD"] for r in rows] == [34, 30, 31, 32]
    assert shapes == [4] and attributes == [("MAX_SPD", 4)]
    # A file whose own box is out of reach is not decoded at all.
    raw = bytearray((tmp_path / "links.shp").read_bytes())
    raw[36:68] = struct.pack("<4d", 0, 0, 2000, 1)
    (tmp_path / "links.shp").write_bytes(raw)
    far = shapefile.PushingReader(schema, options)
    assert not list(far.pushFilters([GreaterThan(("xmin",), 2000.0)]))
    assert [b for part in far.partitions() for b in far.read(part)] == [] and len(shapes) == 1


def test_catalyst_pushes_the_box(spark, tmp_path):
    layer = places.load_links(links(tmp_path))
    boxed = within_box(layer, (995.0, -1.0, 1029.0, 2.0)).df
    assert sorted(r["LINK_ID"] for r in boxed.collect()) == ["L100", "L101", "L102", "L99"]
    plan = boxed._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "").replace("RuntimeFilters", "")
    # Records without a box of their own get one from their vertices; null shapes are in no box.
    bare = [outline(3, [(i, 0), (i + 0.5, 1)]) for i in range(9)] + [NULL]
    path = write_shapefile(tmp_path / "bare", bare, [(f"B{i}", "5") for i in range(10)], [("LINK_ID", "C", 4, 0), ("MAX_SPD", "N", 4, 0)], 3)
    near = within_box(places.load_links(path), (6.6, 0.0, 8.1, 0.5)).df
    assert sorted(r["LINK_ID"] for r in near.collect()) == ["B7", "B8"]
    assert places.load_links(path).df.where("parts is null").count() == 1


def test_nan_and_bounds():
    nan = float("nan")
    for bound in (Bound("x"), Bound("x", True, 2.0), Bound("x", True, 2.0, True), Bound("x", False, 2.0), Bound("x", False, 2.0, True)):
        got = bound.holds(np.array([1.0, 2.0, 3.0, nan])).tolist()
        want = {
            (True, None, False): [True] * 4, (True, 2.0, False): [False, True, True, True], (True, 2.0, True): [False, False, True, True],
            (False, 2.0, False): [True, True, False, False], (False, 2.0, True): [True, False, False, False],
        }
        assert got == want[bound.at_least, bound.value, bound.strict]


def test_ranges_are_cut_by_bytes_and_small_files_share_a_task(tmp_path):
    big = [outline(3, [(i, 0), (i, 1)] * (200 if i == 3 else 1), box=(i, 0, i, 1)) for i in range(8)]
    path = write_shapefile(tmp_path / "big", big, [(i,) for i in range(8)], [("k", "N", 3, 0)], 3)
    small = [write_shapefile(tmp_path / f"s{i}", big[:1], [(i,)], [("k", "N", 3, 0)], 3) for i in range(5)]
    options = {"paths": "\n".join([path, *small]), "kind": "line", "bytesPerTask": "400"}
    reader = shapefile.ShapefileReader(shapefile.ShapefileSource(options).schema(), options)
    tasks = [t.ranges for t in reader.partitions()]
    assert [t[0][1:] for t in tasks if t[0][0] == path] == [(0, 3), (3, 1), (4, 4)]
    assert [len(t) for t in tasks if t[0][0] != path] == [2, 2, 1]
    rows = [r for t in reader.partitions() for b in reader.read(t) for r in b.to_pylist()]
    assert sorted(r["k"] for r in rows) == sorted([*range(8), *range(5)])


def test_values_of_every_kind(spark, tmp_path):
    rows = [("7", "1.50", "é"), ("", "", ""), ("****", "nan", " x "), ("123456789012345678", "-2e3", "y"), ("2.0", ".5", None)]
    fields = [("whole", "N", 18, 0), ("real", "N", 10, 2), ("text", "C", 6, 0)]
    path = write_shapefile(tmp_path / "v", [NULL] * 5, [tuple(v or "" for v in r) for r in rows], fields, 3, encoding="utf-8")
    got = shapefile.read_shapefile(spark, path, "line").orderBy("record_number").collect()
    assert [r.whole for r in got] == [7, None, None, 123456789012345678, 2]
    assert [r.real for r in got] == [1.5, None, None, -2000.0, 0.5]
    assert [r.text for r in got] == ["é", None, "x", "y", None]


def test_layers_are_written_and_read_back(spark, tmp_path):
    line = "array(array(named_struct('x', id * 1D, 'y', 2D), named_struct('x', id + 0.1D, 'y', 3D)), array(named_struct('x', 5D, 'y', 5D), named_struct('x', 6D, 'y', 6D)))"
    df = spark.range(50).repartition(3).selectExpr("id", "concat('도로', id) as name", "id / 3 as share", f"if(id = 7, null, {line}) as parts")
    path = str(tmp_path / "out.shp")
    shapefile.write_shapefiles(df, path, "line", 5186, "cp949")
    layer = read_layer(path, LINE, encoding="cp949")
    assert layer.crs == 5186
    got = {r["id"]: r for r in layer.df.collect()}
    want = {r["id"]: r for r in df.collect()}
    assert got.keys() == want.keys() and len({r["source_file"] for r in got.values()}) == 3
    for k, r in got.items():
        assert (r["name"], r["parts"]) == (want[k]["name"], want[k]["parts"])
        assert r["share"] == pytest.approx(want[k]["share"], rel=1e-9)
        assert r["xmin"] == (None if k == 7 else min(float(k), 5.0))
    with pytest.raises(Exception, match="out.shp"):
        shapefile.write_shapefiles(df, path, "line")
    shapefile.write_shapefiles(df.where("id < 5"), path, "line", 5186, "cp949", mode="overwrite")
    assert read_layer(path, LINE, encoding="cp949").df.count() == 5
    points = spark.range(4).selectExpr("id", "id * 1D as x", "if(id = 2, null, 1D) as y")
    shapefile.write_shapefiles(points, str(tmp_path / "p.shp"), "point")
    back = read_layer(str(tmp_path / "p.shp"), POINT).df.orderBy("id").collect()
    assert [(r.x, r.y) for r in back] == [(0, 1), (1, 1), (None, None), (3, 1)]


def test_headers_of_many_files_are_merged_by_a_job(spark, tmp_path):
    kinds = [("N", 10, 0), ("N", 10, 2), ("C", 5, 0)]
    for i in range(30):
        fields = [("val", *kinds[i % 3]), *([("late", "N", 4, 0)] if i == 20 else []), *([("wide", *kinds[i % 2])] if i > 10 else [])]
        write_shapefile(tmp_path / f"f{i:02}", [NULL], [("1",) * len(fields)], fields, 5, "utf-8", prj=PRJ_5186 if i % 2 else None)
    paths = shapefile.find_shapefiles(str(tmp_path))
    headers = shapefile.header_rows(spark, paths, "utf-8")
    one_by_one = shapefile.shapefile_schema([shapefile.read_dbf_header(p[:-4] + ".dbf", "utf-8") for p in paths], "polygon")
    merged = shapefile.merged_schema(headers, "polygon")
    assert {f.name: f.dataType for f in merged} == {f.name: f.dataType for f in one_by_one} and merged.names[-1] == "late"
    assert {shapefile.crs_of_text(r[0], "") for r in headers.select("prj").distinct().collect()} == {None, 5186}
    write_shapefile(tmp_path / "g", [NULL], [("1",)], [("other", "N", 4, 0)], 5)
    with pytest.raises(ValueError, match="g.shp: missing columns"):
        places.load_population_grid(str(tmp_path))


def test_a_task_writes_files_of_bounded_size(spark, tmp_path):
    df = spark.range(5000).coalesce(1).selectExpr("id", "array(array(named_struct('x', id * 1D, 'y', 0D), named_struct('x', 5D, 'y', id * 1D))) as parts")
    spark.dataSource.register(shapefile.ShapefileSource)
    path = str(tmp_path / "many.shp")
    options = {"kind": "line", "encoding": "utf-8", "prj": "", "bytesPerFile": "100000"}
    df.write.format(shapefile.ShapefileSource.name()).options(**options).mode("append").save(path)
    found = shapefile.find_shapefiles(path)
    assert len(found) == 3
    got = read_layer(path, LINE).df.select("id", "parts").orderBy("id").collect()
    assert got == df.orderBy("id").collect()
