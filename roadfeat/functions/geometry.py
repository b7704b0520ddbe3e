"""Geometry as Spark SQL expressions.

Functions take expression texts and return expression texts (or a Column where that is
what callers put into a frame). A line or polygon is ``parts``: an array of vertex
arrays. Polygons are read by the even-odd rule over all rings, which is right for holes
and for multi-polygons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS_TYPE = "array<array<struct<x:double,y:double>>>"
EDGE_TYPE = "struct<x1:double,y1:double,x2:double,y2:double>"


def double(value: float) -> str:
    return f"{float(value)!r}D"


def vertex(x: str, y: str) -> str:
    return f"named_struct('x', cast({x} as double), 'y', cast({y} as double))"


def line_of(*vertices: tuple[str, str]) -> Column:
    """A one-part line or ring from coordinate expressions."""
    return F.expr(f"array(array({', '.join(vertex(x, y) for x, y in vertices)}))")


def two_point_line(x1: str, y1: str, x2: str, y2: str) -> Column:
    return line_of((x1, y1), (x2, y2))


def rectangle(xmin: str, ymin: str, xmax: str, ymax: str) -> Column:
    return line_of((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))


def close_rings(parts: str) -> Column:
    """Repeat the first vertex at the end of rings that are left open."""
    return F.expr(
        f"transform({parts}, r -> case when size(r) < 2 or r[0] = r[size(r) - 1] then r "
        "else concat(r, array(r[0])) end)"
    )


def has_vertices(parts: str) -> Column:
    return F.expr(f"coalesce(exists({parts}, p -> size(p) > 0), false)")


def edges(parts: str) -> str:
    """All segments of all parts; parts of a single vertex have none."""
    edge = "named_struct('x1', p[i - 1].x, 'y1', p[i - 1].y, 'x2', p[i].x, 'y2', p[i].y)"
    return (
        f"flatten(transform(filter({parts}, p -> size(p) >= 2), "
        f"p -> transform(sequence(1, size(p) - 1), i -> {edge})))"
    )


def bounds(parts: str) -> dict[str, Column]:
    """Bounding box columns of a parts column; null when it has no vertex."""
    out = {}
    for axis in ("x", "y"):
        values = f"flatten(transform({parts}, p -> transform(p, v -> v.{axis})))"
        out[f"{axis}min"] = F.expr(f"array_min({values})")
        out[f"{axis}max"] = F.expr(f"array_max({values})")
    return out


def cumulative_lengths(part: str) -> str:
    """Distance from the start at every vertex of one line; starts with 0."""
    dx, dy = f"({part}[i].x - {part}[i - 1].x)", f"({part}[i].y - {part}[i - 1].y)"
    step = f"sqrt({dx} * {dx} + {dy} * {dy})"
    return (
        f"aggregate(sequence(1, size({part}) - 1), array(0.0D), "
        f"(acc, i) -> concat(acc, array(element_at(acc, -1) + {step})))"
    )


def apothem(radius: float, quad_segs: int) -> float:
    """Distance from a buffer polygon's centre to the middle of its sides."""
    return radius * math.cos(math.pi / (4 * quad_segs))


def _circles(radius: float | str, quad_segs: int) -> tuple[str, str, str]:
    """Squared circumradius, apothem and squared apothem, of a number or of a column's radius."""
    if isinstance(radius, str):
        inner = f"({radius} * {double(apothem(1.0, quad_segs))})"
        return f"({radius} * {radius})", inner, f"({inner} * {inner})"
    inner = apothem(radius, quad_segs)
    return double(float(radius) ** 2), double(inner), double(inner * inner)


def inside_buffer(dx: str, dy: str, radius: float | str, quad_segs: int | None) -> str:
    """Strictly inside the buffer polygon around the origin (a disc for ``quad_segs=None``).

    Only offsets between the inscribed and the circumscribed circle need the angle.
    """
    d2 = f"(({dx}) * ({dx}) + ({dy}) * ({dy}))"
    outer2, inner, inner2 = _circles(radius, quad_segs or 1)
    if quad_segs is None:
        return f"{d2} < {outer2}"
    wedge = math.pi / (2 * quad_segs)
    angle = f"pmod(atan2({dy}, {dx}), {double(wedge)}) - {double(wedge / 2)}"
    return f"({d2} < {inner2} or ({d2} < {outer2} and sqrt({d2}) * cos({angle}) < {inner}))"


def buffer_polygon(x: str, y: str, radius: float, quad_segs: int) -> Column:
    """Closed ring of the buffer polygon, clockwise from angle 0, as ``parts``."""
    n = 4 * quad_segs
    ring = []
    for k in range(n + 1):
        angle = -2 * math.pi * (k % n) / n
        ring.append((f"{x} + {double(radius * math.cos(angle))}", f"{y} + {double(radius * math.sin(angle))}"))
    return line_of(*ring)


def point_segment_d2(px: str, py: str, x1: str, y1: str, x2: str, y2: str) -> str:
    """Squared distance from a point to a segment.

    Past either end the end itself is measured, so that segments meeting in a vertex
    give the same number.
    """
    ex, ey = f"({x2} - {x1})", f"({y2} - {y1})"
    len2 = f"({ex} * {ex} + {ey} * {ey})"
    along = f"(({px} - {x1}) * {ex} + ({py} - {y1}) * {ey})"
    fx = f"({px} - ({x1} + {along} / {len2} * {ex}))"
    fy = f"({py} - ({y1} + {along} / {len2} * {ey}))"

    def square(x: str, y: str) -> str:
        return f"(({px} - {x}) * ({px} - {x}) + ({py} - {y}) * ({py} - {y}))"

    return (
        f"(case when {along} <= 0 then {square(x1, y1)} when {along} >= {len2} then {square(x2, y2)} "
        f"else {fx} * {fx} + {fy} * {fy} end)"
    )


def inside_rings(px: str, py: str, edge_array: str) -> str:
    """Even-odd test; the boundary itself is left to the distance test."""
    at_x = f"e.x1 + ({py} - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0D)"
    return (
        f"size(filter({edge_array}, e -> ((e.y1 > {py}) != (e.y2 > {py})) and {px} < {at_x})) % 2 = 1"
    )


def ray_crosses(px: str, py: str, x1: str, y1: str, x2: str, y2: str) -> str:
    """Whether the ray from a point to greater x crosses an edge; its lower end belongs to it, its upper one doesn't."""
    return f"({y1} > {py}) != ({y2} > {py}) and {px} < {x1} + ({py} - {y1}) * ({x2} - {x1}) / ({y2} - {y1})"


def segment_meets_buffer(
    px: str, py: str, x1: str, y1: str, x2: str, y2: str, radius: float | str, quad_segs: int | None
) -> str:
    """Whether a segment touches the closed buffer polygon around a point.

    Between inscribed and circumscribed circle the segment is clipped by every side;
    elsewhere the distance decides.
    """
    d2 = point_segment_d2(px, py, x1, y1, x2, y2)
    outer2, inner, inner2 = _circles(radius, quad_segs or 1)
    if quad_segs is None:
        return f"{d2} <= {outer2}"
    n = 4 * quad_segs
    sides = ", ".join(
        f"named_struct('nx', {double(math.cos(2 * math.pi * (k + 0.5) / n))}, "
        f"'ny', {double(math.sin(2 * math.pi * (k + 0.5) / n))})"
        for k in range(n)
    )
    margins = (
        f"transform(array({sides}), s -> named_struct("
        f"'a', {inner} - (s.nx * ({x1} - {px}) + s.ny * ({y1} - {py})), "
        f"'b', {inner} - (s.nx * ({x2} - {px}) + s.ny * ({y2} - {py}))))"
    )
    clipped = (
        f"aggregate({margins}, named_struct('lo', 0D, 'hi', 1D), (acc, m) -> named_struct("
        "'lo', case when m.a < 0 and m.b < 0 then 2D when m.a < 0 then greatest(acc.lo, m.a / (m.a - m.b)) else acc.lo end, "
        "'hi', case when m.b < 0 and m.a >= 0 then least(acc.hi, m.a / (m.a - m.b)) else acc.hi end), "
        "acc -> acc.lo <= acc.hi)"
    )
    return f"({d2} <= {inner2} or ({d2} <= {outer2} and {clipped}))"


def representative_point(parts: str) -> Column:
    """A point inside a polygon: the middle of the widest cut at half height.

    The cut of a part (an outer ring and its holes) lies midway between the vertex heights next below
    and above the middle of its bounding box, so it meets no vertex; the widest cut of
    all parts counts. For a rectangle it is the centre. A polygon without height has no cut; its
    first vertex stands for it. A ring is a hole if it lies within an odd number of other rings.
    """

    def within(ring: str, other: str) -> str:
        return f"coalesce({inside_rings(f'{ring}[0].x', f'{ring}[0].y', edges(f'array({other})'))}, false)"

    rings = f"filter({parts}, r -> size(r) > 0)"
    ranked = (
        f"transform(array({rings}), rs -> transform(rs, (r, k) -> named_struct('r', r, "
        f"'hole', size(filter(rs, (o, j) -> j != k and {within('r', 'o')})) % 2 = 1)))[0]"
    )
    own = f"concat(array(a.r), transform(filter(ps, h -> h.hole and {within('h.r', 'a.r')}), h -> h.r))"
    cut = f"transform(array({own}), g -> {_widest_cut('g')})[0]"
    best = f"transform(array({ranked}), ps -> array_max(transform(filter(ps, a -> not a.hole), a -> {cut})))[0]"
    return F.expr(f"transform(array({best}), b -> named_struct('x', b.x, 'y', b.y))[0]")


def _widest_cut(rings: str) -> str:
    """``w, x, y`` of one part's widest cut at half height; its first vertex with width -1 if it has no height."""
    ys = f"flatten(transform({rings}, p -> transform(p, v -> v.y)))"
    # One-element arrays bind intermediate values to a lambda variable.
    middle = f"transform(array({ys}), h -> named_struct('h', h, 'm', (array_min(h) + array_max(h)) / 2))[0]"
    height = (
        f"transform(array({middle}), q -> (array_max(filter(q.h, v -> v <= q.m)) "
        "+ coalesce(array_min(filter(q.h, v -> v > q.m)), q.m)) / 2)[0]"
    )
    crossings = (
        f"array_sort(transform(filter({edges(rings)}, e -> (e.y1 > c) != (e.y2 > c)), "
        "e -> e.x1 + (c - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)))"
    )
    widest = (
        f"transform(array({crossings}), xs -> case when size(xs) >= 2 then array_max(transform("
        "sequence(1, size(xs) - 1, 2), i -> named_struct('w', xs[i] - xs[i - 1], 'x', (xs[i] + xs[i - 1]) / 2, 'y', c))) end)[0]"
    )
    first = f"named_struct('w', -1D, 'x', {rings}[0][0].x, 'y', {rings}[0][0].y)"
    return f"transform(array({height}), c -> coalesce({widest}, {first}))[0]"
