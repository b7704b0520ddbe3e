"""The engine's operators as queries over the fixture tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadfeat import config as c
from roadfeat.functions.crs import project_points
from roadfeat.functions.geometry import line_of, rectangle, two_point_line
from roadfeat.layer import LINE, POINT, POLYGON, Layer
from roadfeat.operators.roads import create_point_buffers, create_road_points, filter_target_roads, make_road_summary
from roadfeat.operators.storage import work_path
from roadfeat.plans import features as ft
from roadfeat.plans import pipeline as pl
from roadfeat.sources.places import load_road_segments
from roadfeat.sources.shapefile import write_shapefiles
from roadfeat.sources.tables import write_table
from workload.fixtures import fixture

ENGLISH = {
    c.POINT_ID: "point_id",
    c.LAT_COLUMN: "lat",
    c.LON_COLUMN: "lon",
    c.SPEED_LIMIT_COLUMN: "speed_limit",
    c.RISK_COLUMN: "risk",
    c.ELDERLY_POPULATION_COLUMN: "elderly_population",
    c.SOCIAL_WELFARE_COLUMN: "welfare_count",
    c.TRADITIONAL_MARKET_COLUMN: "has_market",
    c.BUS_STOP_COLUMN: "bus_stop_count",
    c.BUS_RIDE_ALIGHT_TOTAL_COLUMN: "bus_passengers",
    c.SUBWAY_STATION_COLUMN: "subway_count",
    c.STREETLIGHT_COLUMN: "streetlight_count",
    c.CCTV_COLUMN: "cctv_count",
    c.SPEED_BUMP_COLUMN: "speed_bump_count",
    c.INTERSECTION_COLUMN: "intersection_count",
    c.CROSSWALK_COLUMN: "crosswalk_count",
    c.CROSSWALK_WARNING_COLUMN: "has_crosswalk_warning",
    c.TRAFFIC_SIGNAL_COLUMN: "has_signal",
    c.PEDESTRIAN_PRIORITY_ROAD_COLUMN: "has_priority_road",
    c.PUBLIC_PARKING_COLUMN: "parking_count",
    c.SENIOR_DISABLED_PROTECTION_ZONE_COLUMN: "has_protection_zone",
}


def english(df: DataFrame) -> DataFrame:
    df = df.withColumnsRenamed(ENGLISH)
    rounded = {k: F.round(k, 6) for k in ("lat", "lon", "risk") if k in df.columns}
    return df.withColumns(rounded)


class Sources:
    """Fixture tables under the column names the engine's loaders expect."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def fx(self, name: str) -> DataFrame:
        return fixture(self.spark, self.sf_dir, name)

    def renamed(self, name: str, names: dict[str, str]) -> DataFrame:
        return self.fx(name).select(*[F.col(a).alias(b) for a, b in names.items()])

    def roads(self) -> Layer:
        line = line_of(("x0", "y0"), ("x0 + dx", "y0"), ("x0 + dx", "y0 + dy"))
        df = self.fx("fx_roads").withColumn("parts", line).drop("x0", "y0", "dx", "dy")
        names = {n: n.upper() for n in ("sig_cd", "roa_cls_se", "rn", "rn_cd", "road_lt", "road_bt")}
        return Layer(df.withColumnsRenamed(names), LINE)

    def points(self) -> Layer:
        return create_road_points(filter_target_roads(self.roads())[1])

    def accidents(self) -> DataFrame:
        return self.fx("fx_accidents")

    def links(self) -> Layer:
        line = two_point_line("x1", "y1", "x2", "y2")
        df = self.fx("fx_links").withColumn("parts", line)
        return Layer(df.withColumnsRenamed({"link_id": "LINK_ID", "road_name": "ROAD_NAME", "max_spd": "MAX_SPD"}), LINE)

    def shops(self) -> DataFrame:
        return self.renamed(
            "fx_shops",
            {"sido": "시도명", "major": "상권업종대분류명", "middle": "상권업종중분류명", "lon": "경도", "lat": "위도"},
        )

    def population(self) -> Layer:
        cell = rectangle("xmin", "ymin", "xmin + 250", "ymin + 250")
        return Layer(self.fx("fx_population").select("val", cell.alias("parts")), POLYGON)

    def polygons(self, kind_column: str | None = None) -> Layer:
        box = rectangle("xmin", "ymin", "xmax", "ymax").alias("parts")
        df = self.fx("fx_polygons")
        kept = [F.col("mgrnu").alias("MGRNU")] if kind_column is None else [F.col("kind").alias(kind_column)]
        return Layer(df.select(*kept, box), POLYGON)

    def stops(self) -> DataFrame:
        return self.renamed("fx_stops", {"node_id": "NODE_ID", "stop_type": "정류소타입", "lon": "X좌표", "lat": "Y좌표"})

    def passengers(self) -> DataFrame:
        return self.renamed(
            "fx_passengers",
            {"use_date": "사용일자", "stop_id": "표준버스정류장ID", "boarding": "승차총승객수", "alighting": "하차총승객수"},
        )

    def devices(self, id_column: str) -> DataFrame:
        return self.renamed("fx_devices", {"device_id": id_column, "lat": "위도", "lon": "경도"})

    def facilities(self, names: dict[str, str]) -> DataFrame:
        return self.renamed("fx_facilities", {**names, "lon": "경도", "lat": "위도"})

    def welfare(self) -> DataFrame:
        return self.facilities({"facility_id": "시설ID", "status": "지오코딩상태"})

    def subway(self) -> DataFrame:
        return self.facilities({"facility_id": "고유역번호(외부역코드)"})

    def zones(self) -> DataFrame:
        return self.facilities({"sido": "시도명", "facility_name": "대상시설명"})

    def priority_roads(self) -> DataFrame:
        return self.renamed(
            "fx_facilities",
            {
                "sido": "시도명",
                "facility_name": "보행자우선도로명",
                "lat": "보행자우선도로시작점위도",
                "lon": "보행자우선도로시작점경도",
                "lat2": "보행자우선도로종료점위도",
                "lon2": "보행자우선도로종료점경도",
            },
        )

    def signals(self) -> DataFrame:
        """Facilities in the signals' own plane coordinates."""
        df = self.fx("fx_facilities").select(F.col("lon").alias("X좌표"), F.col("lat").alias("Y좌표"))
        return project_points(df, "X좌표", "Y좌표", c.LONLAT_CRS, c.SIGNAL_CRS)

    def planar(self) -> Layer:
        return Layer(self.fx("fx_planar_points").withColumnRenamed("mgrnu", "MGRNU"), POINT)

    def all(self) -> dict[str, object]:
        return {
            "accident_risk": self.accidents(),
            "speed_limit": self.links(),
            "business_counts": self.shops(),
            "population": self.population(),
            "welfare": self.welfare(),
            "market": self.polygons("TRDAR_SE_1"),
            "bus_stops": self.stops(),
            "bus_passengers": (self.stops(), self.passengers()),
            "subway": self.subway(),
            "streetlights": self.devices("관리번호"),
            "cctv": self.devices("고정형CCTV지번주소"),
            "speed_bumps": self.polygons(),
            "intersections": self.planar(),
            "crosswalks": self.polygons(),
            "crosswalk_warnings": self.planar(),
            "signals": self.signals(),
            "priority_roads": self.priority_roads(),
            "parking": self.devices("주차장코드"),
            "protection_zones": self.zones(),
        }


Query = Callable[[SparkSession, str], DataFrame]


def _file(layer: Layer, label: str, encoding: str, crs: int | None) -> str:
    """The layer as a folder of shapefiles in the shared folder."""
    path = f"{work_path(layer.df.sparkSession, label)}.shp"
    write_shapefiles(layer.df, path, layer.kind, crs, encoding)
    return path


def _ids(points: Layer) -> DataFrame:
    return points.df.select(c.POINT_ID)


def _feature(add: Callable[[DataFrame, Layer, Sources], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = Sources(spark, sf_dir)
        points = s.points()
        return english(add(_ids(points), points, s))

    return run


def r1_filter_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = filter_target_roads(Sources(spark, sf_dir).roads())
    cols = ("ord", "sig_cd", "roa_cls_se", "rn", "rn_cd", "road_lt", "road_bt")
    return target.df.select(*[F.col(n).alias(n) for n in cols])


def r2_road_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    region, target = filter_target_roads(Sources(spark, sf_dir).roads())
    return make_road_summary(region, target).withColumnsRenamed({"항목": "item", "값": "value"})


def r4_road_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = Sources(spark, sf_dir).points().df
    return df.select(*[F.col(n).alias(n.lower()) for n in df.columns])


def r5_point_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    buffers = create_point_buffers(Sources(spark, sf_dir).points())
    ring = buffers.df.select(F.col(c.POINT_ID).alias("point_id"), F.posexplode(F.get("parts", 0)).alias("vertex_no", "v"))
    return ring.select("point_id", "vertex_no", F.round("v.x", 3).alias("x"), F.round("v.y", 3).alias("y"))


def f1_base_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return english(ft.make_base_point_df(Sources(spark, sf_dir).points()))


def _extracts(s: Sources) -> DataFrame:
    accidents = s.accidents()
    return pl.union_accidents(accidents.where("yr <= 1994"), accidents.where("yr > 1994"))


def p1_accident_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracts(Sources(spark, sf_dir))


def p2_accidents_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.accidents_by_year(_extracts(Sources(spark, sf_dir)), "yr")


def p3_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with one feature is written as CSV, read back, and gets two more."""
    s = Sources(spark, sf_dir)
    sources, path = s.all(), work_path(spark, "saved")
    write_table(pl.build_features(s.points(), sources, ["accident_risk"]), path, "csv")
    saved = pl.read_saved(path, "csv")
    return english(pl.extend_saved(saved, sources, ["accident_risk", "parking", "signals"]))


def s1_roads_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points along roads that are read from shapefiles."""
    s = Sources(spark, sf_dir)
    roads = load_road_segments(_file(s.roads(), "roads", "cp949", c.PROJECT_CRS))
    df = create_road_points(filter_target_roads(roads)[1]).df
    return df.select(*[F.col(n).alias(n.lower()) for n in df.columns])


def s3_links_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speed limit from shapefiles that name no coordinate system; the points' box limits what is decoded."""
    s = Sources(spark, sf_dir)
    points = s.points()
    return english(ft.add_speed_limit(_ids(points), points, _file(s.links(), "links", "cp949", None)))


def s5_population_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The population from a folder whose files disagree on the type and order of their columns."""
    s = Sources(spark, sf_dir)
    points, folder = s.points(), work_path(spark, "population")
    cell = rectangle("xmin", "ymin", "xmin + 250", "ymin + 250").alias("parts")
    cells = s.fx("fx_population")
    write_shapefiles(cells.where("ci < 20").select("val", "ci", cell), f"{folder}/west/grid.shp", POLYGON, c.PROJECT_CRS, "utf-8")
    east = cells.where("ci >= 20").select(F.col("val").try_cast("double").alias("val"), "cj", cell)
    write_shapefiles(east, f"{folder}/east/grid.shp", POLYGON, c.PROJECT_CRS, "utf-8")
    return english(ft.add_elderly_population_300m(_ids(points), points, folder))


def s15_outlines_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crosswalks from shapefiles: frames with a hole and a second part, notched outlines, plain ones and missing ones."""
    s = Sources(spark, sf_dir)
    points = s.points()

    def ring(*xy: tuple[int, int]) -> str:
        return "array(" + ", ".join(f"named_struct('x', x + {a}, 'y', y + {b})" for a, b in (*xy, xy[0])) + ")"

    def box(x0: int, y0: int, x1: int, y1: int) -> str:
        return ring((x0, y0), (x0, y1), (x1, y1), (x1, y0))

    frame = f"array({box(0, 0, 320, 300)}, {box(40, 40, 280, 260)}, {box(400, 0, 430, 25)})"
    notch = f"array({ring((0, 0), (0, 60), (20, 60), (20, 20), (60, 20), (60, 0))})"
    parts = f"case form when 0 then {frame} when 1 then {notch} when 2 then array({box(0, 0, 9, 4)}) end as parts"
    layer = Layer(s.fx("fx_outlines").selectExpr("mgrnu as MGRNU", parts), POLYGON)
    return english(ft.add_crosswalk_counts(_ids(points), points, _file(layer, "crosswalks", "euc-kr", c.PROJECT_CRS)))


def p5_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Sources(spark, sf_dir)
    return english(pl.build_features(s.points(), s.all()))


QUERIES: dict[str, Query] = {
    "r1_filter_roads": r1_filter_roads,
    "r2_road_summary": r2_road_summary,
    "r4_road_points": r4_road_points,
    "r5_point_buffers": r5_point_buffers,
    "f1_base_points": f1_base_points,
    "f2_accident_risk": _feature(lambda d, p, s: ft.add_accident_risk(d, p, s.accidents())),
    "f3_speed_limit": _feature(lambda d, p, s: ft.add_speed_limit(d, p, s.links())),
    "f4_business_counts": _feature(lambda d, p, s: ft.add_business_category_counts(d, p, s.shops())),
    "f5_population": _feature(lambda d, p, s: ft.add_elderly_population_300m(d, p, s.population())),
    "f6_welfare": _feature(lambda d, p, s: ft.add_social_welfare_facility_counts(d, p, s.welfare())),
    "f7_market_presence": _feature(lambda d, p, s: ft.add_traditional_market_presence(d, p, s.polygons("TRDAR_SE_1"))),
    "f8_bus_stops": _feature(lambda d, p, s: ft.add_bus_stop_counts(d, p, s.stops())),
    "f9_bus_passengers": _feature(lambda d, p, s: ft.add_bus_passenger_totals(d, p, s.stops(), s.passengers())),
    "f10_subway": _feature(lambda d, p, s: ft.add_subway_station_counts(d, p, s.subway())),
    "f11_streetlights": _feature(lambda d, p, s: ft.add_streetlight_counts(d, p, s.devices("관리번호"))),
    "f12_cctv": _feature(lambda d, p, s: ft.add_cctv_counts(d, p, s.devices("고정형CCTV지번주소"))),
    "f13_speed_bumps": _feature(lambda d, p, s: ft.add_speed_bump_counts(d, p, s.polygons())),
    "f14_intersections": _feature(lambda d, p, s: ft.add_intersection_counts(d, p, s.planar())),
    "f15_crosswalks": _feature(lambda d, p, s: ft.add_crosswalk_counts(d, p, s.polygons())),
    "f16_crosswalk_warnings": _feature(lambda d, p, s: ft.add_crosswalk_warning_presence(d, p, s.planar())),
    "f17_signals": _feature(lambda d, p, s: ft.add_traffic_signal_presence(d, p, s.signals())),
    "f18_priority_roads": _feature(
        lambda d, p, s: ft.add_pedestrian_priority_road_presence(d, p, s.priority_roads())
    ),
    "f19_parking": _feature(lambda d, p, s: ft.add_public_parking_counts(d, p, s.devices("주차장코드"))),
    "f20_protection_zones": _feature(
        lambda d, p, s: ft.add_senior_disabled_protection_zone_presence(d, p, s.zones())
    ),
    "p1_accident_union": p1_accident_union,
    "p2_accidents_by_year": p2_accidents_by_year,
    "p3_incremental": p3_incremental,
    "p5_all_features": p5_all_features,
    "s1_roads_file": s1_roads_file,
    "s3_links_file": s3_links_file,
    "s5_population_files": s5_population_files,
    "s15_outlines_file": s15_outlines_file,
}
