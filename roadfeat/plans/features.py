"""The features: one declaration each, one planner-friendly way to run any set of them.

Features with the same kind of target run as one proximity join. Each target
row carries its radius and a feature code, so the aggregation tells them apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadfeat import config as c
from roadfeat.diagnostics import Diagnostics, watch
from roadfeat.functions import clean
from roadfeat.functions.clean import name
from roadfeat.functions.crs import project_points, project_scalar
from roadfeat.layer import Layer
from roadfeat.operators.nearest import nearest_line
from roadfeat.operators.storage import materialize
from roadfeat.operators.proximity import (
    TRUSTED,
    Pairs,
    broadcast_limit,
    dense_per_point,
    estimated_bytes,
    near_points,
    near_shapes,
    per_point,
    point_targets,
    shape_targets,
    with_radius,
)
from roadfeat.sources import places
from roadfeat.sources.tables import within_box

POINT_ID = c.POINT_ID
CODES_PER_FEATURE = 1_000

ROWS, IDS, PRESENCE, SUM, RISK, CATEGORIES = "rows", "ids", "presence", "sum", "risk", "categories"


@dataclass(frozen=True)
class Feature:
    """One proximity feature.

    ``how`` says what is made of the targets around a point: a row count, a count of
    distinct ids, a 0/1 flag, a rounded sum, the accident risk or the category counts.
    ``load`` turns the source into a clean layer.
    """

    key: str
    output: str
    radius: float
    how: str
    load: Callable[..., Layer]
    ident: str | None = None
    value: str | None = None
    copies: str | None = None
    shapes: bool = False

    def outputs(self) -> list[str]:
        return list(c.BUSINESS_CATEGORY_COLUMNS) if self.how == CATEGORIES else [self.output]

    def counts_ids(self, layer: Layer) -> bool:
        # Without an id column every row would get its own id: counting rows is the same.
        return self.how == IDS and self.ident in layer.df.columns

    def targets(self, layer: Layer, code: int) -> DataFrame:
        df, ident = layer.df, None
        if self.counts_ids(layer):
            ident = name(self.ident)
        if self.shapes:
            return shape_targets(df, layer.kind, code, ident)
        if self.how == CATEGORIES:
            listed = ", ".join(f"'{v}'" for v in c.BUSINESS_CATEGORY_COLUMNS)
            middle, major = (f"nullif(array_position(array({listed}), `{v}`), 0)" for v in ("업종_중분류", "상권업종대분류명"))
            at = F.expr(f"{code} + coalesce({middle}, {major})").alias("_at")
            return point_targets(df.select("x", "y", at).where("_at is not null"), F.col("_at"))
        if self.how == RISK:
            return point_targets(df, code, values=[name(v) for v in ("dprs_cnt", "sep_cnt", "slp_cnt")])
        if self.how == SUM:
            value = name(self.value).cast("double")
            return point_targets(df, code, values=[value * name(self.copies) if self.copies else value])
        return point_targets(df, code, ident)

    def aggregates(self, layer: Layer, code: int) -> dict[str, Column]:
        mine = f"_f = {code}"
        n = F.expr(f"sum(if({mine}, _n, null))")
        if self.how == CATEGORIES:
            return self._category_counts(code)
        if self.how == RISK:
            sums = {f"{self.output}_{i}": F.expr(f"sum(if({mine}, _v{i}, null))") for i in (1, 2, 3)}
            return {f"{self.output}_0": n, **sums}
        if self.how == SUM:
            return {self.output: F.expr(f"sum(if({mine}, _v1, null))")}
        if self.how == PRESENCE:
            return {self.output: F.expr(f"max(if({mine}, 1, null))")}
        if self.counts_ids(layer):
            return {self.output: F.expr(f"sum(if({mine}, _ids, null))")}
        return {self.output: n}

    def _category_counts(self, code: int) -> dict[str, Column]:
        listed = c.BUSINESS_CATEGORY_COLUMNS
        out = {}
        for at, label in enumerate(listed, code + 1):
            # A shop carries its finest listed category; a major one sums up its own.
            own = [at] + [code + 1 + i for i, v in enumerate(listed) if v.startswith(label + "_")]
            out[label] = F.expr(f"sum(if(_f in ({', '.join(map(str, own))}), _n, null))")
        return out

    def finished(self) -> dict[str, Column]:
        """The outputs from the aggregates: points without targets are filled and types settled."""
        if self.how == RISK:
            parts = [F.coalesce(F.col(f"`{self.output}_{i}`"), F.lit(0)).cast("long") for i in range(4)]
            n, deaths, serious, slight = parts
            # Weights of the risk score.
            risk = 10 * n * (deaths + F.lit(0.1168) * serious + F.lit(0.0068) * slight)
            return {self.output: risk.cast("double")}
        if self.how == SUM:
            return {self.output: F.bround(F.coalesce(name(self.output), F.lit(0.0))).cast("long")}
        return {o: F.expr(f"cast(coalesce(`{o}`, 0) as bigint)") for o in self.outputs()}


def _sum_points(source, **kw) -> Layer:
    return places.population_points(places.load_population_grid(source, **kw))


def _passengers(source, diagnostics: Diagnostics | None = None) -> Layer:
    if isinstance(source, Layer):
        return source
    stops, passengers = source
    return places.load_bus_passenger_stops(stops, passengers, diagnostics)


R50, R300 = float(c.BUFFER_50M), float(c.BUFFER_300M)

FEATURES: dict[str, Feature] = {
    f.key: f
    for f in (
        Feature("accident_risk", c.RISK_COLUMN, R50, RISK, places.load_accidents),
        Feature("business_counts", "상가", R300, CATEGORIES, places.load_shops),
        Feature("population", c.ELDERLY_POPULATION_COLUMN, R300, SUM, _sum_points, value="val"),
        Feature("welfare", c.SOCIAL_WELFARE_COLUMN, R300, IDS, places.load_geocoded_social_welfare_facilities, "시설ID"),
        Feature("market", c.TRADITIONAL_MARKET_COLUMN, R50, PRESENCE, places.load_traditional_markets, shapes=True),
        Feature("bus_stops", c.BUS_STOP_COLUMN, R300, IDS, places.load_bus_stops, "NODE_ID"),
        Feature(
            "bus_passengers", c.BUS_RIDE_ALIGHT_TOTAL_COLUMN, R300, SUM, _passengers,
            value=c.BUS_RIDE_ALIGHT_TOTAL_COLUMN, copies="copies",
        ),
        Feature("subway", c.SUBWAY_STATION_COLUMN, R300, IDS, places.load_subway_stations, "고유역번호(외부역코드)"),
        Feature("streetlights", c.STREETLIGHT_COLUMN, R50, IDS, places.load_streetlights, "관리번호"),
        Feature("cctv", c.CCTV_COLUMN, R50, ROWS, places.load_cctv_points),
        Feature("speed_bumps", c.SPEED_BUMP_COLUMN, R50, IDS, places.load_speed_bumps, "MGRNU", shapes=True),
        Feature("intersections", c.INTERSECTION_COLUMN, R50, IDS, places.load_intersections, "MGRNU"),
        Feature("crosswalks", c.CROSSWALK_COLUMN, R50, IDS, places.load_crosswalks, "MGRNU", shapes=True),
        Feature("crosswalk_warnings", c.CROSSWALK_WARNING_COLUMN, R50, PRESENCE, places.load_crosswalk_warnings),
        Feature("signals", c.TRAFFIC_SIGNAL_COLUMN, R50, PRESENCE, places.load_pedestrian_signals),
        Feature(
            "priority_roads", c.PEDESTRIAN_PRIORITY_ROAD_COLUMN, R50, PRESENCE,
            places.load_pedestrian_priority_roads, shapes=True,
        ),
        Feature("parking", c.PUBLIC_PARKING_COLUMN, R300, IDS, places.load_public_parking, "주차장코드"),
        Feature(
            "protection_zones", c.SENIOR_DISABLED_PROTECTION_ZONE_COLUMN, R300, PRESENCE,
            places.load_senior_disabled_protection_zones,
        ),
    )
}
SPEED_LIMIT = "speed_limit"
ALL_FEATURES = (*FEATURES, SPEED_LIMIT)


def make_base_point_df(points: Layer) -> DataFrame:
    """``POINT_ID`` with latitude and longitude."""
    df = project_points(points.df.select(POINT_ID, "x", "y"), "x", "y", points.crs, c.LONLAT_CRS)
    return df.select(POINT_ID, F.col("y").alias(c.LAT_COLUMN), F.col("x").alias(c.LON_COLUMN))


def attach(base: DataFrame, feature_rows: DataFrame) -> DataFrame:
    """Left join by point; columns the base already has are replaced."""
    fresh = [col for col in feature_rows.columns if col != POINT_ID]
    kept = [col for col in base.columns if col not in fresh]
    return base.select(*[name(col) for col in kept]).join(feature_rows, POINT_ID, "left")


def add_proximity_features(
    final_df: DataFrame,
    points: Layer,
    wanted: Iterable[tuple[Feature, Layer]],
    quad_segs: int | None = c.QUAD_SEGS,
    small: bool | None = None,
    diagnostics: Diagnostics | None = None,
) -> DataFrame:
    """Add the features' columns; one join for each kind of target, whatever their radii."""
    result = final_df
    groups: dict[bool, list[tuple[Feature, Layer]]] = {}
    for feature, layer in wanted:
        result = result.drop(*feature.outputs())
        groups.setdefault(feature.shapes, []).append((feature, layer.to_crs(points.crs)))
    for shapes, members in groups.items():
        coded = [(f, layer, i * CODES_PER_FEATURE) for i, (f, layer) in enumerate(members)]
        framed = [(f, layer, code, with_radius(f.targets(layer, code), f.radius)) for f, layer, code in coded]
        for batch, is_small in _by_size(framed, small):
            targets = reduce(DataFrame.unionByName, [item[3] for item in batch])
            radii = [item[0].radius for item in batch]
            columns: dict[str, Column] = {}
            for f, layer, code, _ in batch:
                columns.update(f.aggregates(layer, code))
            by_feature = any(f.counts_ids(layer) for f, layer, _, _ in batch)
            # Diagnostics count pairs, so the pairs are made for them.
            rows = dense_per_point(points.df, targets, radii, columns, by_feature, shapes, quad_segs) if diagnostics is None else None
            if rows is None:
                near = near_shapes if shapes else near_points
                pairs = near(points.df, targets, radii, quad_segs, is_small)
                if diagnostics is not None:
                    matches = {f.key: F.sum(F.when(_codes_of(f, code), F.col("_n"))) for f, _, code, _ in batch}
                    keys = "+".join(matches)
                    pairs = Pairs(watch(diagnostics, pairs.df, f"{keys}: pairs", matches), pairs.keys)
                rows = per_point(pairs, columns, by_feature, shapes)
            kept = [name(col) for col in result.columns]
            made = [value.alias(o) for f, _, _, _ in batch for o, value in f.finished().items()]
            result = attach(result, rows).select(*kept, *made)
            if diagnostics is not None:
                flagged = {f.key: F.count_if(reduce(Column.__or__, [name(o) > 0 for o in f.outputs()])) for f, *_ in batch}
                result = watch(diagnostics, result, f"{keys}: points", {"points": F.count(F.lit(1)), **flagged})
    return result


def _codes_of(feature: Feature, code: int) -> Column:
    return F.col("_f").between(code, code + CODES_PER_FEATURE - 1)


def _by_size(framed: list, small: bool | None):
    """Split the layers of one join: those that seem to fit a broadcast together (None: to be measured), and the rest."""
    if small is not None or not framed:
        return [(framed, small)]
    room = broadcast_limit(framed[0][3])
    unbounded = [item[3] for item in framed if item[1].size_bound is None]
    bounds = [item[1].size_bound for item in framed if item[1].size_bound is not None]
    together = [reduce(DataFrame.unionByName, unbounded)] if unbounded else []
    whole = sum(estimated_bytes(df) for df in together + bounds)
    if whole <= room:
        return [(framed, True if whole * TRUSTED <= room else None)]
    sized = sorted(
        ((estimated_bytes(item[1].size_bound if item[1].size_bound is not None else item[3]), i, item)
         for i, item in enumerate(framed)),
        key=lambda t: t[:2],
    )
    fit, rest = [], []
    for size, _, item in sized:
        if size <= room:
            fit.append(item)
            room -= size
        else:
            rest.append(item)
    return [(batch, flag) for batch, flag in ((fit, None), (rest, False)) if batch]


def add_speed_limit(
    final_df: DataFrame, points: Layer, nodelink, output_col: str = c.SPEED_LIMIT_COLUMN, diagnostics: Diagnostics | None = None
) -> DataFrame:
    """``MAX_SPD`` of the nearest link; ties go to the smallest ``LINK_ID``."""
    links = places.load_links(nodelink)
    clean.require_columns(links.df, ["LINK_ID", "MAX_SPD"], "links")
    points = store_points(points)
    box = points.df.selectExpr("min(x)", "min(y)", "max(x)", "max(y)").first()
    if box[0] is None:
        return attach(final_df, points.df.selectExpr(POINT_ID, f"cast(null as bigint) as `{output_col}`"))
    links = within_box(links, _link_box(box, points.crs, links.crs))
    usable = clean.with_numbers(links.df, ["MAX_SPD"]).where(name("MAX_SPD").isNotNull())
    links = replace(links, df=usable).drop_empty()
    links = replace(links, df=watch(diagnostics, links.df, "links: rows", {"used": F.count(F.lit(1))})).to_crs(points.crs)
    speeds = nearest_line(points.df, links.df, "LINK_ID", "MAX_SPD", tuple(box))
    if speeds is None:
        raise ValueError(f"no link around the points of {c.TARGET_REGION_NAME}")
    limit = F.bround("MAX_SPD").cast("long").alias(output_col)
    return attach(final_df, speeds.select(POINT_ID, limit))


def store_points(points: Layer) -> Layer:
    """Id and place of the points, written once; they are read by every join."""
    if points.stored:
        return points
    return Layer(materialize(points.df.select(POINT_ID, "x", "y")), crs=points.crs, stored=True)


def _link_box(box, source: int, target: int) -> tuple[float, float, float, float]:
    xmin, ymin, xmax, ymax = box
    corners = [project_scalar(x, y, source, target) for x in (xmin, xmax) for y in (ymin, ymax)]
    margin = c.LINK_BBOX_MARGIN_M
    xs, ys = [p[0] for p in corners], [p[1] for p in corners]
    return min(xs) - margin, min(ys) - margin, max(xs) + margin, max(ys) + margin


def _add(key: str, final_df: DataFrame, points: Layer, source, radius_m: float, output_col: str | None,
         diagnostics: Diagnostics | None = None, **changes) -> DataFrame:
    feature = replace(FEATURES[key], radius=float(radius_m), **changes)
    if output_col is not None:
        feature = replace(feature, output=output_col)
    layer = load_feature_source(feature, source, diagnostics)
    return add_proximity_features(final_df, points, [(feature, layer)], diagnostics=diagnostics)


def load_feature_source(feature: Feature, source, diagnostics: Diagnostics | None = None) -> Layer:
    return feature.load(source, diagnostics=diagnostics)


def add_accident_risk(final_df, points, accidents, radius_m=c.BUFFER_50M, output_col=c.RISK_COLUMN, diagnostics=None):
    """10 * accidents * (deaths + 0.1168 * serious + 0.0068 * slight) within the radius."""
    return _add("accident_risk", final_df, points, accidents, radius_m, output_col, diagnostics)


def add_business_category_counts(final_df, points, shops, radius_m=c.BUFFER_300M, diagnostics=None):
    """Shops per category, 85 columns."""
    return _add("business_counts", final_df, points, shops, radius_m, None, diagnostics)


def add_elderly_population_300m(
    final_df, points, population, radius_m=c.BUFFER_300M, output_col=c.ELDERLY_POPULATION_COLUMN, diagnostics=None
):
    return _add("population", final_df, points, population, radius_m, output_col, diagnostics)


def add_social_welfare_facility_counts(
    final_df, points, facilities, radius_m=c.BUFFER_300M, output_col=c.SOCIAL_WELFARE_COLUMN, diagnostics=None
):
    return _add("welfare", final_df, points, facilities, radius_m, output_col, diagnostics)


def add_traditional_market_presence(
    final_df, points, markets, radius_m=c.BUFFER_50M, output_col=c.TRADITIONAL_MARKET_COLUMN, diagnostics=None
):
    return _add("market", final_df, points, markets, radius_m, output_col, diagnostics)


def add_bus_stop_counts(
    final_df, points, stops, radius_m=c.BUFFER_300M, output_col=c.BUS_STOP_COLUMN, diagnostics=None
):
    return _add("bus_stops", final_df, points, stops, radius_m, output_col, diagnostics)


def add_bus_passenger_totals(final_df, points, stops, passengers, radius_m=c.BUFFER_300M, diagnostics=None):
    return _add("bus_passengers", final_df, points, (stops, passengers), radius_m, None, diagnostics)


def add_subway_station_counts(
    final_df, points, stations, radius_m=c.BUFFER_300M, output_col=c.SUBWAY_STATION_COLUMN, diagnostics=None
):
    return _add("subway", final_df, points, stations, radius_m, output_col, diagnostics)


def add_streetlight_counts(
    final_df, points, streetlights, radius_m=c.BUFFER_50M, output_col=c.STREETLIGHT_COLUMN, diagnostics=None
):
    return _add("streetlights", final_df, points, streetlights, radius_m, output_col, diagnostics)


def add_cctv_counts(final_df, points, cctv, radius_m=c.BUFFER_50M, output_col=c.CCTV_COLUMN, diagnostics=None):
    return _add("cctv", final_df, points, cctv, radius_m, output_col, diagnostics)


def add_speed_bump_counts(
    final_df, points, speed_bumps, radius_m=c.BUFFER_50M, output_col=c.SPEED_BUMP_COLUMN, diagnostics=None
):
    return _add("speed_bumps", final_df, points, speed_bumps, radius_m, output_col, diagnostics)


def add_intersection_counts(
    final_df, points, intersections, radius_m=c.BUFFER_50M, output_col=c.INTERSECTION_COLUMN, diagnostics=None
):
    return _add("intersections", final_df, points, intersections, radius_m, output_col, diagnostics)


def add_crosswalk_counts(
    final_df, points, crosswalks, radius_m=c.BUFFER_50M, output_col=c.CROSSWALK_COLUMN, diagnostics=None
):
    return _add("crosswalks", final_df, points, crosswalks, radius_m, output_col, diagnostics)


def add_crosswalk_warning_presence(
    final_df, points, warnings, radius_m=c.BUFFER_50M, output_col=c.CROSSWALK_WARNING_COLUMN, diagnostics=None
):
    return _add("crosswalk_warnings", final_df, points, warnings, radius_m, output_col, diagnostics)


def add_traffic_signal_presence(
    final_df, points, signals, radius_m=c.BUFFER_50M, output_col=c.TRAFFIC_SIGNAL_COLUMN, diagnostics=None
):
    return _add("signals", final_df, points, signals, radius_m, output_col, diagnostics)


def add_pedestrian_priority_road_presence(
    final_df, points, priority_roads, radius_m=c.BUFFER_50M, output_col=c.PEDESTRIAN_PRIORITY_ROAD_COLUMN,
    diagnostics=None,
):
    return _add("priority_roads", final_df, points, priority_roads, radius_m, output_col, diagnostics)


def add_public_parking_counts(
    final_df, points, parking, radius_m=c.BUFFER_300M, output_col=c.PUBLIC_PARKING_COLUMN, diagnostics=None
):
    return _add("parking", final_df, points, parking, radius_m, output_col, diagnostics)


def add_senior_disabled_protection_zone_presence(
    final_df, points, zones, radius_m=c.BUFFER_300M, output_col=c.SENIOR_DISABLED_PROTECTION_ZONE_COLUMN,
    diagnostics=None,
):
    return _add("protection_zones", final_df, points, zones, radius_m, output_col, diagnostics)

