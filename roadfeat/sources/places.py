"""The public datasets: one declaration per source, one cleaning routine for all.

Loaders return a :class:`Layer` whose rows are clean; nothing runs until it is used.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadfeat.config import (
    BUS_RIDE_ALIGHT_TOTAL_COLUMN,
    LONLAT_CRS,
    PROJECT_CRS,
    SIGNAL_CRS,
    TARGET_SIDO_NAME,
)
from roadfeat.diagnostics import Diagnostics, watch
from roadfeat.functions import clean
from roadfeat.functions.clean import name, trimmed
from roadfeat.functions.crs import Crs
from roadfeat.functions.geometry import has_vertices, representative_point, two_point_line
from roadfeat.layer import LINE, POINT, POLYGON, Layer
from roadfeat.operators.storage import stored
from roadfeat.sources.shapefile import SOURCE_FILE, crs_of_text, find_shapefiles, header_rows, merged_schema, read_shapefile
from roadfeat.sources.tables import is_text_file, read_layer, read_table


@dataclass(frozen=True)
class PointSource:
    """How a point table is read. ``only`` are conditions on raw columns: (column, value, trim, equal)."""

    what: str
    x: str
    y: str
    crs: int = LONLAT_CRS
    encoding: str = "utf-8"
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    only: tuple[tuple[str, str, bool, bool], ...] = field(default=())
    repair_swapped: bool = False
    in_city: bool = False
    ident: str | None = None


def load_points(
    spec: PointSource, source, diagnostics: Diagnostics | None = None, id_type: str = "infer"
) -> Layer:
    """Read, coerce, repair and filter; adds ``x, y`` in the source's coordinate system.

    A ``Layer`` is taken as clean already: it needs ``x, y`` and is not filtered again.
    ``id_type`` says how the ids of a CSV file compare; typed tables say it themselves.
    """
    if isinstance(source, Layer):
        clean.require_columns(source.df, ["x", "y"], spec.what)
        return source
    needed = dict.fromkeys([*spec.required, spec.x, spec.y, *spec.numbers])
    df = read_table(source, needed, spec.optional, spec.encoding, what=spec.what)
    if spec.ident is not None and is_text_file(source):
        df = clean.canonical_ids(df, spec.ident, id_type)
    in_scope = F.lit(True)
    for column, value, trim, equal in spec.only:
        if column in df.columns:
            in_scope = in_scope & _matches(name(column), value, trim, equal)
    df = clean.with_numbers(df, dict.fromkeys([spec.x, spec.y, *spec.numbers]))
    swapped = F.lit(False)
    if spec.repair_swapped:
        swapped = F.coalesce(clean.is_swapped(spec.y, spec.x), F.lit(False))
    df = df.withColumns({"_scope": in_scope, "_swapped": swapped})
    if spec.repair_swapped:
        df = clean.swap_lat_lon(df, spec.y, spec.x)
    ok = F.col("_scope")
    for column in (spec.x, spec.y, *spec.not_null):
        ok = ok & name(column).isNotNull()
    if spec.in_city:
        ok = ok & F.coalesce(clean.in_city_range(spec.y, spec.x), F.lit(False))
    df = df.withColumn("_ok", ok)
    df = watch(
        diagnostics,
        df,
        f"{spec.what}: rows",
        {
            "rows": F.count(F.lit(1)),
            "in_scope": F.count_if("_scope"),
            "swapped": F.count_if(F.col("_swapped") & F.col("_scope")),
            "excluded": F.count_if(~F.col("_ok")),
            "used": F.count_if("_ok"),
        },
    )
    kept = df.where("_ok").drop("_scope", "_swapped", "_ok")
    return Layer(kept.withColumns({"x": name(spec.x), "y": name(spec.y)}), POINT, spec.crs)


def _matches(col: Column, value: str, trim: bool, equal: bool) -> Column:
    text = trimmed(col) if trim else col.cast("string")
    same = F.coalesce(text == value, F.lit(False))
    return same if equal else ~same


# Column names and encodings of the public datasets.
ACCIDENTS = PointSource(
    "accidents", "x_crdnt", "y_crdnt", crs=PROJECT_CRS, numbers=("dprs_cnt", "sep_cnt", "slp_cnt")
)
SHOPS = PointSource(
    "shops",
    "경도",
    "위도",
    required=("시도명", "상권업종대분류명", "상권업종중분류명"),
    optional=("상가업소번호", "시군구명"),
    only=(("시도명", TARGET_SIDO_NAME, False, True),),
)
WELFARE = PointSource(
    "welfare facilities",
    "경도",
    "위도",
    required=("시설ID",),
    optional=("지오코딩상태",),
    only=(("지오코딩상태", "OK", False, True),),
    ident="시설ID",
)
BUS_STOPS = PointSource(
    "bus stops",
    "X좌표",
    "Y좌표",
    required=("NODE_ID", "정류소타입"),
    only=(("정류소타입", "가상정류장", True, False),),
    ident="NODE_ID",
)
SUBWAY = PointSource(
    "subway stations",
    "경도",
    "위도",
    encoding="cp949",
    required=("고유역번호(외부역코드)",),
    not_null=("고유역번호(외부역코드)",),
    ident="고유역번호(외부역코드)",
)
STREETLIGHTS = PointSource(
    "streetlights",
    "경도",
    "위도",
    encoding="cp949",
    required=("관리번호",),
    not_null=("관리번호",),
    repair_swapped=True,
    in_city=True,
    ident="관리번호",
)
CCTV = PointSource(
    "cctv",
    "경도",
    "위도",
    encoding="cp949",
    required=("고정형CCTV지번주소",),
    optional=("단속지점명",),
    not_null=("고정형CCTV지번주소",),
    repair_swapped=True,
    in_city=True,
)
SIGNALS = PointSource("pedestrian signals", "X좌표", "Y좌표", crs=SIGNAL_CRS, encoding="cp949")
PARKING = PointSource(
    "public parking",
    "경도",
    "위도",
    encoding="cp949",
    required=("주차장코드",),
    not_null=("주차장코드",),
    repair_swapped=True,
    in_city=True,
    ident="주차장코드",
)
PROTECTION_ZONES = PointSource(
    "protection zones",
    "경도",
    "위도",
    encoding="cp949",
    required=("시도명", "대상시설명"),
    not_null=("대상시설명",),
    only=(("시도명", TARGET_SIDO_NAME, True, True),),
    repair_swapped=True,
    in_city=True,
)


def load_accidents(source, crs: int | None = None, diagnostics: Diagnostics | None = None) -> Layer:
    """Accident coordinates are in the points' system, whatever it is, unless ``crs`` names theirs."""
    layer = load_points(ACCIDENTS, source, diagnostics)
    return Layer(layer.df, POINT, crs if not isinstance(source, Layer) else layer.crs)


def load_shops(source, diagnostics: Diagnostics | None = None) -> Layer:
    layer = load_points(SHOPS, source, diagnostics)
    if isinstance(source, Layer):
        return layer
    major, middle = "상권업종대분류명", "상권업종중분류명"
    df = layer.df.withColumns({major: trimmed(name(major)), middle: trimmed(name(middle))})
    # A missing name never makes a listed category.
    return Layer(df.withColumn("업종_중분류", F.concat(name(major), F.lit("_"), name(middle))), POINT, layer.crs)


def load_geocoded_social_welfare_facilities(source, diagnostics: Diagnostics | None = None) -> Layer:
    return load_points(WELFARE, source, diagnostics)


def load_bus_stops(source, diagnostics: Diagnostics | None = None) -> Layer:
    """Stops without the virtual ones; a missing type keeps its stop."""
    return load_points(BUS_STOPS, source, diagnostics)


def load_bus_passenger_stops(stops, passengers, diagnostics: Diagnostics | None = None) -> Layer:
    """Stops with the passengers of all days, summed per stop id before the join."""
    if isinstance(stops, Layer):
        return stops
    layer = load_bus_stops(stops, diagnostics)
    located = (
        layer.df.select(clean.to_long(name("NODE_ID")).alias("NODE_ID"), "x", "y")
        .where(name("NODE_ID").isNotNull())
        # Copies of a stop stay, as a number: each of them counts.
        .groupBy("NODE_ID", "x", "y")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    columns = ["사용일자", "표준버스정류장ID", "승차총승객수", "하차총승객수"]
    rides = read_table(passengers, columns, encoding="cp949", what="bus passengers")
    rides = clean.with_numbers(rides, columns[2:]).withColumn(columns[1], clean.to_long(name(columns[1])))
    rides = rides.where(name(columns[1]).isNotNull())
    rides = watch(
        diagnostics,
        rides,
        "bus passengers: rows",
        {"rows": F.count(F.lit(1)), "first_day": F.min("사용일자"), "last_day": F.max("사용일자")},
    )
    zero = F.lit(0.0)
    total = F.coalesce(name("승차총승객수"), zero) + F.coalesce(name("하차총승객수"), zero)
    per_stop = rides.groupBy(name(columns[1]).alias("NODE_ID")).agg(
        F.bround(F.sum(total)).cast("long").alias(BUS_RIDE_ALIGHT_TOTAL_COLUMN)
    )
    return Layer(located.join(per_stop.hint("merge"), "NODE_ID"), POINT, LONLAT_CRS, size_bound=located)


def passenger_days(passengers) -> DataFrame:
    """First day, last day and number of days of the passenger table."""
    rides = clean.with_numbers(
        read_table(passengers, ["사용일자", "표준버스정류장ID"], encoding="cp949", what="bus passengers"),
        ["표준버스정류장ID"],
    ).where(name("표준버스정류장ID").isNotNull())
    return rides.agg(
        F.min("사용일자").alias("first_day"),
        F.max("사용일자").alias("last_day"),
        F.count_distinct("사용일자").alias("days"),
        F.count(F.lit(1)).alias("rows"),
    )


def load_subway_stations(source, diagnostics: Diagnostics | None = None) -> Layer:
    return load_points(SUBWAY, source, diagnostics)


def load_streetlights(source, diagnostics: Diagnostics | None = None) -> Layer:
    return load_points(STREETLIGHTS, source, diagnostics)


def load_cctv_points(source, diagnostics: Diagnostics | None = None) -> Layer:
    """Every row is a camera of its own; ``CCTV_ID`` only has to be unique."""
    layer = load_points(CCTV, source, diagnostics)
    if isinstance(source, Layer):
        return layer
    place = trimmed(name("단속지점명")) if "단속지점명" in layer.df.columns else F.lit("")
    ident = F.concat_ws(
        "_",
        trimmed(name("고정형CCTV지번주소")),
        F.coalesce(place, F.lit("nan")),
        F.monotonically_increasing_id().cast("string"),
    )
    return Layer(layer.df.withColumn("CCTV_ID", ident), POINT, layer.crs)


def load_pedestrian_signals(source, diagnostics: Diagnostics | None = None) -> Layer:
    layer = load_points(SIGNALS, source, diagnostics)
    return layer if isinstance(source, Layer) else _numbered(layer, "보행자신호등ID")


def load_public_parking(source, diagnostics: Diagnostics | None = None) -> Layer:
    return load_points(PARKING, source, diagnostics)


def load_senior_disabled_protection_zones(source, diagnostics: Diagnostics | None = None) -> Layer:
    layer = load_points(PROTECTION_ZONES, source, diagnostics)
    return layer if isinstance(source, Layer) else _numbered(layer, "노인장애인보호구역ID")


def _numbered(layer: Layer, column: str) -> Layer:
    """A unique id per row; the features count or flag, so its value never matters."""
    return Layer(layer.df.withColumn(column, F.monotonically_increasing_id()), layer.kind, layer.crs)


# Columns of the pedestrian priority road table.
PRIORITY_ROAD_ENDS = (
    "보행자우선도로시작점위도",
    "보행자우선도로시작점경도",
    "보행자우선도로종료점위도",
    "보행자우선도로종료점경도",
)


def load_pedestrian_priority_roads(source, diagnostics: Diagnostics | None = None) -> Layer:
    """Two-point lines in lon/lat; all four coordinates must lie in the city's range."""
    if isinstance(source, Layer):
        return source
    columns = ["시도명", "보행자우선도로명", *PRIORITY_ROAD_ENDS]
    df = read_table(source, columns, encoding="cp949", what="pedestrian priority roads")
    df = clean.with_numbers(df, PRIORITY_ROAD_ENDS)
    lat1, lon1, lat2, lon2 = PRIORITY_ROAD_ENDS
    in_scope = _matches(name("시도명"), TARGET_SIDO_NAME, True, True)
    ok = in_scope & F.coalesce(clean.in_city_range(lat1, lon1) & clean.in_city_range(lat2, lon2), F.lit(False))
    df = watch(
        diagnostics,
        df.withColumns({"_scope": in_scope, "_ok": ok}),
        "pedestrian priority roads: rows",
        {"rows": F.count(F.lit(1)), "in_scope": F.count_if("_scope"), "used": F.count_if("_ok")},
    )
    kept = df.where("_ok").drop("_scope", "_ok")
    line = two_point_line(*[f"`{n}`" for n in (lon1, lat1, lon2, lat2)])
    return _numbered(Layer(kept.withColumn("parts", line), LINE, LONLAT_CRS), "보행자우선도로ID")


def load_road_segments(source, encoding: str = "cp949", crs: int | None = None) -> Layer:
    """Road centre-lines; the record number of a shapefile is the input order ``ord``."""
    layer = read_layer(source, LINE, crs, encoding, what="roads")
    df = layer.df
    if "ord" not in df.columns and "record_number" in df.columns:
        df = df.withColumnRenamed("record_number", "ord")
    return Layer(df, LINE, layer.crs)


def load_links(source, encoding: str = "cp949", crs: int | None = None) -> Layer:
    return read_layer(source, LINE, crs, encoding, columns=("LINK_ID", "ROAD_NAME", "MAX_SPD"), what="links")


def _kept(layer: Layer, what: str, diagnostics: Diagnostics | None, wanted: Column | None = None) -> Layer:
    """The rows that have a geometry (and are ``wanted``); how many there were is counted in the same pass."""
    present = F.col("x").isNotNull() & F.col("y").isNotNull() if layer.kind == POINT else has_vertices("parts")
    used = present if wanted is None else present & wanted
    metrics = {"rows": F.count(F.lit(1)), "empty": F.count_if(~present), "used": F.count_if(used)}
    return replace(layer, df=watch(diagnostics, layer.df, f"{what}: rows", metrics).where(used))


def load_traditional_markets(source, crs: int | None = None, diagnostics: Diagnostics | None = None) -> Layer:
    layer = read_layer(source, POLYGON, crs, "utf-8", columns=("TRDAR_CD", "TRDAR_SE_1"), what="markets")
    known = "TRDAR_SE_1" in layer.df.columns
    return _kept(layer, "markets", diagnostics, _matches(name("TRDAR_SE_1"), "전통시장", False, True) if known else None)


def _load_managed(source, kind: str, crs: int | None, what: str, diagnostics: Diagnostics | None) -> Layer:
    return _kept(read_layer(source, kind, crs, "euc-kr", columns=("MGRNU",), what=what), what, diagnostics)


def load_speed_bumps(source, crs: int | None = None, diagnostics: Diagnostics | None = None) -> Layer:
    return _load_managed(source, POLYGON, crs, "speed bumps", diagnostics)


def load_crosswalks(source, crs: int | None = None, diagnostics: Diagnostics | None = None) -> Layer:
    return _load_managed(source, POLYGON, crs, "crosswalks", diagnostics)


def load_intersections(source, crs: int | None = None, diagnostics: Diagnostics | None = None) -> Layer:
    return _load_managed(source, POINT, crs, "intersections", diagnostics)


def load_crosswalk_warnings(source, crs: int | None = None, diagnostics: Diagnostics | None = None) -> Layer:
    return _load_managed(source, POINT, crs, "crosswalk warnings", diagnostics)


def load_population_grid(source, source_crs: int = PROJECT_CRS, diagnostics: Diagnostics | None = None) -> Layer:
    """Grid cells of all files below a folder, or of a layer; copies of a cell all stay.

    ``source_file`` tells where a cell came from. Missing numbers become 0.
    """
    if isinstance(source, Layer):
        layer = source
    elif isinstance(source, DataFrame):
        layer = Layer(source, POLYGON, source_crs)
    else:
        layer = _population_files(str(source), source_crs)
    clean.require_columns(layer.df, ["val"], "population grid")
    df = clean.with_numbers(layer.df, ["val"]).fillna(0.0, ["val"])
    return _kept(Layer(df, POLYGON, layer.crs), "population grid", diagnostics)


def _population_files(folder: str, source_crs: int) -> Layer:
    from roadfeat.sources.tables import active_session

    spark = active_session()
    paths = find_shapefiles(folder)
    if not paths:
        options = {"recursiveFileLookup": True, "pathGlobFilter": "*.parquet", "mergeSchema": True}
        files = spark.read.options(**options).parquet(folder)
        return Layer(files.withColumn(SOURCE_FILE, F.col("_metadata.file_path")), POLYGON, source_crs)
    headers = stored(header_rows(spark, paths, "utf-8"), "headers")
    # Every file needs the column, so files are told by those that have it.
    valued = headers.groupBy("no", "path", "prj").agg(F.max((F.col("field") == "val").cast("int")).alias("has"))
    lacking = valued.where("has is null or has = 0").orderBy("no").first()
    if lacking is not None:
        raise ValueError(f"{lacking['path']}: missing columns ['val']")
    schema = merged_schema(headers, POLYGON)
    by_text = valued.groupBy("prj").agg(F.min("no").alias("first"), F.array_sort(F.collect_list("no")).alias("files"))
    groups: dict[Crs, list[int]] = {}
    for r in by_text.orderBy("first").collect():
        groups.setdefault(crs_of_text(r["prj"], paths[r["first"]]) or source_crs, []).extend(r["files"])
    base = next(iter(groups))
    merged = None
    for code, files in groups.items():
        cells = read_shapefile(spark, [paths[i] for i in files], POLYGON, "utf-8", schema=schema)
        part = Layer(clean.with_numbers(cells, ["val"]), POLYGON, code).to_crs(base).df
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return Layer(merged, POLYGON, base)


def population_points(cells: Layer) -> Layer:
    """Each cell as its representative point."""
    df = cells.df.withColumn("_at", representative_point("parts"))
    return Layer(df.withColumns({"x": F.col("_at.x"), "y": F.col("_at.y")}).drop("_at", "parts"), POINT, cells.crs)
