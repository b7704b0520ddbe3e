"""Road selection, summary, evenly spaced points and buffers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadfeat.config import (
    BUFFER_50M,
    INCLUDED_ROAD_CLASSES,
    POINT_ID,
    POINT_INTERVAL_M,
    QUAD_SEGS,
    TARGET_REGION_NAME,
    TARGET_SIG_CD_PREFIX,
)
from roadfeat.functions.clean import require_columns
from roadfeat.functions.crs import crs_name
from roadfeat.functions.geometry import PARTS_TYPE, buffer_polygon, cumulative_lengths
from roadfeat.layer import LINE, POLYGON, Layer
from roadfeat.operators.ranking import with_starts
from roadfeat.operators.storage import stored

ROAD_ATTRIBUTES = ("RN", "RN_CD", "ROAD_LT", "ROAD_BT", "ROA_CLS_SE")

# Points of a segment are made in runs of this many, so that no row holds them all.
POINTS_PER_RUN = 4_096


def filter_target_roads(
    roads: Layer,
    sig_cd_prefix: str = TARGET_SIG_CD_PREFIX,
    included_road_classes: Iterable[str] = INCLUDED_ROAD_CLASSES,
    target_region_name: str = TARGET_REGION_NAME,
) -> tuple[Layer, Layer]:
    """All roads of the region, and those of the wanted classes."""
    require_columns(roads.df, ["SIG_CD", "ROA_CLS_SE"], "roads")
    classes = sorted(included_road_classes)
    region = roads.df.where(F.col("SIG_CD").cast("string").startswith(sig_cd_prefix)).withColumn(
        "ROA_CLS_SE", F.col("ROA_CLS_SE").cast("string")
    )
    target = region.where(F.col("ROA_CLS_SE").isin(*classes))
    if target.isEmpty():
        raise ValueError(
            f"no road of class {', '.join(classes)} in {target_region_name} (SIG_CD prefix {sig_cd_prefix})"
        )
    return replace(roads, df=region), replace(roads, df=target)


def make_road_summary(
    all_roads: Layer, target_roads: Layer, target_region_name: str = TARGET_REGION_NAME
) -> DataFrame:
    """Five label/value rows about the selected roads."""
    empty = F.lit(None)
    region = all_roads.df.agg(
        F.count(F.lit(1)).alias("n_region"),
        empty.cast("long").alias("n_target"),
        empty.cast("double").alias("km"),
        empty.cast("double").alias("width"),
    )
    target = target_roads.df.agg(
        empty.cast("long").alias("n_region"),
        F.count(F.lit(1)).alias("n_target"),
        (F.coalesce(F.sum("ROAD_LT").cast("double"), F.lit(0.0)) / 1000).alias("km"),
        F.avg("ROAD_BT").cast("double").alias("width"),
    )
    # Two one-row frames made one by union and aggregation, not by a cross join.
    both = region.unionByName(target).agg(*[F.max(c).alias(c) for c in region.columns])
    # The labels of the summary.
    rows = [
        ("시각화 대상 도로구간 수", F.format_number("n_target", 0)),
        (f"전체 {target_region_name} 도로구간 수", F.format_number("n_region", 0)),
        ("총 연장(km)", F.format_number("km", 1)),
        ("평균 도로폭(m)", F.coalesce(F.format_number("width", 1), F.lit("nan"))),
        ("좌표계", F.lit(crs_name(target_roads.crs))),
    ]
    pairs = F.array(*[F.struct(F.lit(label).alias("항목"), value.alias("값")) for label, value in rows])
    return both.select(F.inline(pairs))


def make_points(roads: Layer, order_by: str, distance: int = POINT_INTERVAL_M) -> Layer:
    """Points every ``distance`` metres along each road, with dense ids.

    ``order_by`` is a unique numeric column giving the input order. ``POINT_ID`` counts
    the points in that order; ``ROAD_IDX`` counts the roads, also those without points.
    """
    if int(distance) != distance or distance <= 0:
        raise ValueError("distance must be a positive whole number")
    require_columns(roads.df, [order_by], "roads")
    lines = _walkable_lines(roads, order_by, int(distance))
    numbered = _number_roads(lines)
    return Layer(_walk(numbered, int(distance)), crs=roads.crs)


def create_road_points(target_roads: Layer, distance: int = POINT_INTERVAL_M, order_by: str = "ord") -> Layer:
    return make_points(target_roads, order_by, distance)


def points_along_line(df: DataFrame, parts: str, distance: int = POINT_INTERVAL_M) -> DataFrame:
    """The walk alone: every row of ``df`` gives its points as ``POINT_SEQ, x, y``."""
    keep = [c for c in df.columns if c != parts]
    lines = df.select(*keep, _parts_with_lengths(parts, distance).alias("_lines"))
    return _walk_segments(lines, keep, distance)


def _parts_with_lengths(parts: str, distance: int) -> Column:
    """Per line part: vertices, running length, number of points and of points before it."""
    measured = (
        f"transform(filter({parts}, p -> size(p) >= 2), "
        f"p -> named_struct('v', p, 'cum', {cumulative_lengths('p')}))"
    )
    steps = f"floor(element_at(m.cum, -1) / {distance})"
    points = f"{steps} + 1 + if({steps} * {distance} < element_at(m.cum, -1), 1, 0)"
    counted = f"transform({measured}, m -> named_struct('v', m.v, 'cum', m.cum, 'n', {points}))"
    part = "struct<v:array<struct<x:double,y:double>>,cum:array<double>,n:bigint,first:bigint>"
    return F.expr(
        f"aggregate({counted}, named_struct('n', 0L, 'l', cast(array() as array<{part}>)), "
        "(acc, m) -> named_struct('n', acc.n + m.n, 'l', concat(acc.l, array("
        "named_struct('v', m.v, 'cum', m.cum, 'n', m.n, 'first', acc.n)))), acc -> acc.l)"
    )


def _walkable_lines(roads: Layer, order_by: str, distance: int) -> DataFrame:
    attributes = [c for c in ROAD_ATTRIBUTES if c in roads.df.columns]
    parts = "parts" if roads.kind == LINE else f"cast(null as {PARTS_TYPE})"
    return roads.df.select(
        F.col(order_by).alias("_ord"), *attributes, _parts_with_lengths(parts, distance).alias("_lines")
    ).withColumn("_n", F.expr("coalesce(aggregate(_lines, 0L, (acc, m) -> acc + m.n), 0L)"))


def _number_roads(lines: DataFrame) -> DataFrame:
    """Add ``ROAD_IDX`` and the id of each road's first point, by running sums over ranges of the order column.

    Only the order column and the number of points are ranged; the lines meet them once.
    """
    sizes = stored(lines.select("_ord", "_n"), "road-sizes")
    numbered = with_starts(sizes, [], ["_ord"], {"ROAD_IDX": None, "_first_id": "_n"})
    placed = numbered.select(F.col("_ord").alias("_o"), "ROAD_IDX", "_first_id")
    return lines.join(placed, F.col("_ord").eqNullSafe(F.col("_o"))).drop("_o")


def _walk(numbered: DataFrame, distance: int) -> DataFrame:
    attributes = [c for c in ROAD_ATTRIBUTES if c in numbered.columns]
    keep = ["_first_id", "ROAD_IDX", *attributes]
    points = _walk_segments(numbered.select(*keep, "_lines"), keep, distance)
    return points.select(
        (F.col("_first_id") + F.col("POINT_SEQ")).alias(POINT_ID), "ROAD_IDX", "POINT_SEQ", *attributes, "x", "y"
    )


def _walk_segments(lines: DataFrame, keep: list[str], distance: int) -> DataFrame:
    """Explode lines to segments and segments to the points that fall on them.

    A segment owns the multiples of ``distance`` in (start, end] of its running length;
    the first one also owns 0, and the last one the end point if it is no multiple.
    """
    d, run = distance, POINTS_PER_RUN
    segment = (
        "named_struct('x1', _l.v[i - 1].x, 'y1', _l.v[i - 1].y, 'x2', _l.v[i].x, 'y2', _l.v[i].y, "
        "'a', _l.cum[i - 1], 'b', _l.cum[i], 'first', i = 1, 'last', i = size(_l.v) - 1)"
    )
    segments = lines.select(*keep, F.explode("_lines").alias("_l")).selectExpr(
        *keep,
        "_l.first as _before",
        "element_at(_l.cum, -1) as _total",
        f"explode(transform(sequence(1, size(_l.v) - 1), i -> {segment})) as _s",
    )
    # One more step stands for the end point of the line.
    steps = segments.selectExpr(
        *keep,
        "_before",
        "_total",
        "_s",
        f"if(_s.first, 0L, floor(_s.a / {d}) + 1) as _lo",
        f"floor(_s.b / {d}) + if(_s.last and floor(_total / {d}) * {d} < _total, 1, 0) as _hi",
    ).where("_hi >= _lo")
    runs = steps.selectExpr("*", f"explode(sequence(0L, (_hi - _lo) div {run})) as _run")
    stepped = runs.selectExpr(
        "*", f"explode(sequence(_lo + _run * {run}, least(_hi, _lo + _run * {run} + {run - 1}))) as _k"
    ).withColumn("_at", F.expr(f"least(_k * {float(d)}D, _total)"))

    def along(axis: str) -> str:
        a, b = f"_s.{axis}1", f"_s.{axis}2"
        return (
            f"case when _s.b <= _s.a then {a} when _at >= _s.b then {b} "
            f"else {a} + ({b} - {a}) * ((_at - _s.a) / (_s.b - _s.a)) end as {axis}"
        )

    return stepped.selectExpr(*keep, "cast(_before + _k as int) as POINT_SEQ", along("x"), along("y"))


def create_point_buffers(
    points: Layer, buffer_distance_m: float = BUFFER_50M, quad_segs: int = QUAD_SEGS
) -> Layer:
    """Points replaced by their buffer polygons; joins never need this, exports do."""
    df = points.df.withColumn("parts", buffer_polygon("x", "y", buffer_distance_m, quad_segs))
    return Layer(df.drop("x", "y"), kind=POLYGON, crs=points.crs)
