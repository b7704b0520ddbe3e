import math
import struct

import pytest
from pyspark.sql import functions as F

from roadfeat.functions import crs
from roadfeat.functions.crs import Datum, Ellipsoid, Projection
from roadfeat.layer import POLYGON, Layer
from roadfeat.sources import places, shapefile

# Published worked examples of the EPSG guidance note on conversions (7, part 2).
AIRY = Ellipsoid(6377563.396, 299.32496)
NATIONAL_GRID = Projection(-2.0, 49.0, 0.9996012717, 400_000.0, -100_000.0, Datum(AIRY, (1.0,) * 7))


def test_published_plane_coordinates():
    x, y = crs.forward_scalar(0.5, 50.5, NATIONAL_GRID)
    assert (x, y) == (pytest.approx(577274.99, abs=0.01), pytest.approx(69740.50, abs=0.01))
    lon, lat = crs.inverse_scalar(577274.99, 69740.50, NATIONAL_GRID)
    assert (lon, lat) == (pytest.approx(0.5, abs=1e-7), pytest.approx(50.5, abs=1e-7))


def test_published_geocentric_coordinates():
    e = Ellipsoid(6378137.0, 298.2572236)
    lat, lon = 53 + 48 / 60 + 33.820 / 3600, 2 + 7 / 60 + 46.380 / 3600
    assert crs.geocentric_scalar(lon, lat, e, 73.0) == pytest.approx((3771793.968, 140253.342, 5124304.349), abs=0.002)
    assert crs.geodetic_scalar(crs.geocentric_scalar(lon, lat, e), e) == pytest.approx((lon, lat), abs=1e-11)


def test_published_seven_parameters():
    shift = (0.0, 0.0, 4.5, 0.0, 0.0, 0.554, 0.219)
    assert crs.shift_scalar((3657660.66, 255768.55, 5201382.11), shift) == pytest.approx((3657660.78, 255778.43, 5201387.75), abs=0.01)


def test_utm_of_a_known_place():
    # A landmark whose published place is 17N 630084 4833438, to the metre.
    x, y = crs.project_scalar(-79.387139, 43.642566, 4326, 32617)
    assert (x, y) == (pytest.approx(630084, abs=1), pytest.approx(4833438, abs=1))
    assert crs.project_scalar(151.0, -33.0, 4326, 32756)[1] > 6e6
    with pytest.raises(ValueError):
        crs.projection(32661)


SYSTEMS = [4326, 5179, 5186, 2097, 5174, 4162, 4301, 32652, NATIONAL_GRID]


@pytest.mark.parametrize("system", SYSTEMS)
def test_columns_equal_scalars_and_come_back(spark, system):
    lonlat = [(126.9 + 0.01 * i, 37.4 + 0.013 * i) for i in range(12)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(lonlat)], "i int, x double, y double")
    there = crs.project_points(df, "x", "y", 4326, system)
    line = F.array(F.array(F.struct("x", "y")))
    parts = df.withColumn("parts", line).withColumn("parts", crs.project_parts("parts", 4326, system))
    back = crs.project_points(there, "x", "y", system, 4326)
    rows = zip(*[f.orderBy("i").collect() for f in (there, parts, back)], strict=True)
    for (lon, lat), (a, b, c) in zip(lonlat, rows, strict=True):
        want = crs.project_scalar(lon, lat, 4326, system)
        unit = 1e-9 if crs.projection(system) is None else 1e-4
        assert (a.x, a.y) == pytest.approx(want, abs=unit)
        assert (b.parts[0][0].x, b.parts[0][0].y) == pytest.approx(want, abs=unit)
        # There and back: the shift's reversal is good to millimetres.
        assert (c.x, c.y) == pytest.approx((lon, lat), abs=1e-7)


def test_the_old_datum_lies_hundreds_of_metres_off():
    x, y = crs.project_scalar(127.0, 37.5, 4326, 5174)
    a, b = crs.project_scalar(127.0, 37.5, 4326, 5181)
    assert 200 < math.hypot(x - a, y - b) < 600


def test_well_known_text_tree():
    node = crs.parse_wkt('A["x ""y""", B[1, -2.5e3], C(D, "z")]')
    assert node.args[0] == 'x "y"' and node.child("B").args == (1.0, -2500.0) and node.all("D")[0].args == ()
    for bad in ('A["x"', "", '"text"', "A[,]"):
        with pytest.raises(ValueError):
            crs.parse_wkt(bad)
    shifted = 'GEOGCS["x",DATUM["any",SPHEROID["s",6377397.155,299.1528128],TOWGS84[1,2,3]],PRIMEM["Greenwich",0]]'
    assert crs.crs_from_wkt(shifted) == Datum(Ellipsoid(6377397.155, 299.1528128), (1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 0.0))
    both = f'COMPD_CS["c",PROJCS["p",{shifted},PROJECTION["Gauss_Kruger"],PARAMETER["central_meridian",9]],VERT_CS["v"]]'
    assert crs.crs_from_wkt(both).lon0 == 9.0 and crs.crs_from_wkt(both).false_easting == 0.0
    with pytest.raises(ValueError):
        crs.crs_from_wkt(shifted.replace('"Greenwich",0', '"Paris",2.33'))


@pytest.mark.parametrize("system", [5174, 32652, Projection(127.25, 37.0, 0.9999, 10.0, 20.0, crs.KOREAN_1985)])
def test_files_in_other_systems_lead_to_the_same_places(spark, tmp_path, system):
    lon, lat = 127.01, 37.51
    corners = [crs.project_scalar(lon + dx, lat + dy, 4326, system) for dx, dy in ((0, 0), (0, 0.001), (0.001, 0.001), (0.001, 0), (0, 0))]
    ring = F.array(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in corners]))
    cells = spark.range(1).select(F.lit("7").alias("val"), ring.alias("parts"))
    shapefile.write_shapefiles(cells, str(tmp_path / "grid.shp"), POLYGON, system)
    layer = places.load_population_grid(str(tmp_path))
    assert layer.crs == system
    corner = layer.to_crs(5179).df.first()["parts"][0][0]
    assert (corner.x, corner.y) == pytest.approx(crs.project_scalar(lon, lat, 4326, 5179), abs=0.01)
    assert isinstance(layer, Layer) and struct.calcsize("<d") == 8
