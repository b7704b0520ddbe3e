"""Brute-force SQL twins of the queries, for DuckDB.

The projection here is the classical power series (Snyder 1987), not the engine's, and
the joins compare every point with every target.
"""

from __future__ import annotations

import math

from roadfeat.config import BUSINESS_CATEGORY_COLUMNS
from workload.fixtures import duckdb_sql

A = 6378137.0
F_ = 1 / 298.257222101
E2 = F_ * (2 - F_)
EP2 = E2 / (1 - E2)
SEGS = 16
LAT_OK, LON_OK = "between 37 and 38", "between 126 and 128"

TM = {5179: (127.5, 38.0, 0.9996, 1e6, 2e6), 5186: (127.0, 38.0, 1.0, 2e5, 6e5)}


def _arc(phi: str) -> str:
    """Meridian arc length as SQL over the latitude in radians."""
    m0 = 1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256 - 175 * E2**4 / 16384
    m2 = 3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024 + 105 * E2**4 / 4096
    m4 = 15 * E2**2 / 256 + 45 * E2**3 / 1024 + 525 * E2**4 / 16384
    m6 = 35 * E2**3 / 3072 + 175 * E2**4 / 12288
    return (
        f"{A!r} * ({m0!r} * {phi} - {m2!r} * sin(2 * {phi}) + {m4!r} * sin(4 * {phi}) - {m6!r} * sin(6 * {phi}))"
    )


def project(table: str, lon: str = "lon", lat: str = "lat", code: int = 5179, x: str = "x", y: str = "y") -> str:
    """Subquery adding planar coordinates to a table with lon/lat columns."""
    lon0, lat0, k0, fe, fn = TM[code]
    at0 = f"({math.radians(lat0)!r})"
    terms = (
        f"(select *, radians({lat}) as _p, tan(radians({lat})) ** 2 as _t, {EP2!r} * cos(radians({lat})) ** 2 as _c, "
        f"radians({lon} - {lon0!r}) * cos(radians({lat})) as _a, "
        f"{A!r} / sqrt(1 - {E2!r} * sin(radians({lat})) ** 2) as _nu from {table})"
    )
    east = f"_a + (1 - _t + _c) * _a ** 3 / 6 + (5 - 18 * _t + _t ** 2 + 72 * _c - 58 * {EP2!r}) * _a ** 5 / 120"
    north = (
        f"{_arc('_p')} - {_arc(at0)} + _nu * tan(_p) * (_a ** 2 / 2 + (5 - _t + 9 * _c + 4 * _c ** 2) * _a ** 4 / 24 "
        f"+ (61 - 58 * _t + _t ** 2 + 600 * _c - 330 * {EP2!r}) * _a ** 6 / 720)"
    )
    return (
        f"(select * exclude (_p, _t, _c, _a, _nu), {fe!r} + {k0!r} * _nu * ({east}) as {x}, "
        f"{fn!r} + {k0!r} * ({north}) as {y} from {terms})"
    )


ROADS = f"(select * from {duckdb_sql('fx_roads')} where sig_cd like '11%' and roa_cls_se in ('3', '4'))"

POINTS = f"""(
select row_number() over (order by ord, k) - 1 as point_id, road_idx, k as point_seq, rn, rn_cd, road_lt, road_bt,
       roa_cls_se, x0 + least(d, dx) as px, y0 + greatest(d - dx, 0) as py
from (select *, least(k * 25.0::double, dx + dy) as d
      from (select *, unnest(generate_series(0, cast(ceil((dx + dy) / 25) as bigint))) as k
            from (select *, row_number() over (order by ord) - 1 as road_idx from {ROADS}))))"""


def inside(dx: str, dy: str, r: float) -> str:
    """Strictly inside the 64-gon."""
    w = math.pi / (2 * SEGS)
    a = r * math.cos(math.pi / (4 * SEGS))
    t = f"(atan2({dy}, {dx}) + {2 * math.pi!r})"
    return (
        f"sqrt(({dx}) * ({dx}) + ({dy}) * ({dy})) * cos({t} - {w!r} * floor({t} / {w!r}) - {w / 2!r}) < {a!r}"
    )


def number(col: str) -> str:
    return f"try_cast({col} as double)"


def swapped(table: str) -> str:
    """Repair swapped coordinates and keep those in the city."""
    swap = f"(lat {LON_OK} and lon {LAT_OK})"
    return (
        f"(select * from (select * replace (case when {swap} then lon else lat end as lat, "
        f"case when {swap} then lat else lon end as lon) from {table}) where lat {LAT_OK} and lon {LON_OK})"
    )


def aggregate(targets: str, r: float, agg: str, out: str, final: str) -> str:
    """Per point: ``agg`` over the targets inside, ``final`` after the left join."""
    return f"""
with pts as materialized {POINTS},
tgt as materialized {targets},
agg as (select point_id, {agg} from pts join tgt
        on abs(tgt.x - px) < {r!r} and abs(tgt.y - py) < {r!r} and {inside('tgt.x - px', 'tgt.y - py', r)}
        group by point_id)
select pts.point_id, {final} as {out} from pts left join agg using (point_id)"""


def ids(targets: str, r: float, out: str) -> str:
    return aggregate(targets, r, "count(distinct id) as v", out, "cast(coalesce(v, 0) as bigint)")


def flag(targets: str, r: float, out: str) -> str:
    return aggregate(targets, r, "1 as v", out, "cast(coalesce(v, 0) as bigint)")


ACCIDENTS = (
    f"(select {number('x_crdnt')} as x, {number('y_crdnt')} as y, {number('dprs_cnt')} as d, {number('sep_cnt')} as s, "
    f"{number('slp_cnt')} as l from {duckdb_sql('fx_accidents')} where {number('x_crdnt')} is not null)"
)
DEVICES = f"(select *, device_id as id from {swapped(duckdb_sql('fx_devices'))} where device_id is not null)"
FACILITIES = duckdb_sql("fx_facilities")
PLANAR = f"(select mgrnu as id, x, y from {duckdb_sql('fx_planar_points')})"
STOPS = f"(select *, node_id as id from {duckdb_sql('fx_stops')} where trim(coalesce(stop_type, 'nan')) <> '가상정류장')"
SHOPS = f"(select *, trim(major) as ma, trim(major) || '_' || trim(middle) as mi from {duckdb_sql('fx_shops')} where sido = '서울특별시')"
CITY = "trim(sido) = '서울특별시'"
# Signals come in 5186; forward from lon/lat and back is the identity, so lon/lat to 5179 is the same place.
POPULATION = f"(select coalesce({number('val')}, 0) as v, xmin + 125 as x, ymin + 125 as y from {duckdb_sql('fx_population')})"
PASSENGERS = f"""(select s.lon, s.lat, t.total from {STOPS} s join (
  select cast(stop_id as bigint) as sid, cast(round_even(sum(coalesce({number('boarding')}, 0)
         + coalesce({number('alighting')}, 0)), 0) as bigint) as total
  from {duckdb_sql('fx_passengers')} where {number('stop_id')} is not null group by 1) t on cast(s.node_id as bigint) = t.sid)"""


def business() -> str:
    columns = ", ".join(
        f"count(*) filter (where {'mi' if '_' in n else 'ma'} = '{n}') as \"{n}\"" for n in BUSINESS_CATEGORY_COLUMNS
    )
    filled = ", ".join(f'cast(coalesce("{n}", 0) as bigint) as "{n}"' for n in BUSINESS_CATEGORY_COLUMNS)
    return f"""
with pts as materialized {POINTS},
tgt as materialized (select ma, mi, x, y from {project(SHOPS)}),
agg as (select point_id, {columns} from pts join tgt
        on abs(tgt.x - px) < 300 and abs(tgt.y - py) < 300 and {inside('tgt.x - px', 'tgt.y - py', 300.0)}
        group by point_id)
select pts.point_id, {filled} from pts left join agg using (point_id)"""


def sides(value: str) -> str:
    """Largest of an expression over the 64 side normals ``(nx, ny)`` of the buffer polygon."""
    nx, ny = "cos(2 * pi() * (i + 0.5) / 64)", "sin(2 * pi() * (i + 0.5) / 64)"
    return f"list_max(list_transform(generate_series(0, 63), lambda i: {value.replace('nx', nx).replace('ny', ny)}))"


def rectangles(targets: str, r: float, agg: str, out: str) -> str:
    """Rectangles that meet the 64-gon: no side of either separates them."""
    gx, gy = "greatest(xmin - px, px - xmax, 0)", "greatest(ymin - py, py - ymax, 0)"
    low = "least(nx * (xmin - px), nx * (xmax - px)) + least(ny * (ymin - py), ny * (ymax - py))"
    a = r * math.cos(math.pi / (4 * SEGS))
    return f"""
with pts as materialized {POINTS},
tgt as materialized {targets},
near as materialized (select * from pts join tgt on {gx} * {gx} + {gy} * {gy} <= {r * r!r}),
agg as (select point_id, {agg} as v from near where {sides(low)} <= {a!r} group by point_id)
select pts.point_id, cast(coalesce(v, 0) as bigint) as {out} from pts left join agg using (point_id)"""


def outlines() -> str:
    """Outlines as rectangles: a frame is met where its outer rectangle is and the polygon isn't within the hole."""
    boxes = "(0, 0, 0, 320, 300), (0, 400, 0, 430, 25), (1, 0, 0, 60, 20), (1, 0, 0, 20, 60), (2, 0, 0, 9, 4)"
    table = f"""(select mgrnu, x + a as xmin, y + b as ymin, x + c as xmax, y + d as ymax, form = 0 and a = 0 as framed, x, y
        from {duckdb_sql('fx_outlines')} join (values {boxes}) v(f, a, b, c, d) on form = f)"""
    gx, gy = "greatest(xmin - px, px - xmax, 0)", "greatest(ymin - py, py - ymax, 0)"
    low = "least(nx * (xmin - px), nx * (xmax - px)) + least(ny * (ymin - py), ny * (ymax - py))"
    # The buffer polygon has corners at its box's sides, and the hole is a rectangle.
    in_hole = "framed and px - 50 > x + 40 and px + 50 < x + 280 and py - 50 > y + 40 and py + 50 < y + 260"
    return f"""
with pts as materialized {POINTS},
tgt as materialized {table},
near as materialized (select * from pts join tgt on {gx} * {gx} + {gy} * {gy} <= 2500 and not ({in_hole})),
agg as (select point_id, count(distinct mgrnu) as v from near where {sides(low)} <= {50 * math.cos(math.pi / (4 * SEGS))!r} group by point_id)
select pts.point_id, cast(coalesce(v, 0) as bigint) as crosswalk_count from pts left join agg using (point_id)"""


def segment_d2(px: str = "px", py: str = "py") -> str:
    len2 = "((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
    dot = f"(({px} - x1) * (x2 - x1) + ({py} - y1) * (y2 - y1))"
    fx, fy = f"({px} - (x1 + {dot} / {len2} * (x2 - x1)))", f"({py} - (y1 + {dot} / {len2} * (y2 - y1)))"
    return (
        f"(case when {dot} <= 0 then ({px} - x1) * ({px} - x1) + ({py} - y1) * ({py} - y1) "
        f"when {dot} >= {len2} then ({px} - x2) * ({px} - x2) + ({py} - y2) * ({py} - y2) "
        f"else {fx} * {fx} + {fy} * {fy} end)"
    )


def speed_limit() -> str:
    return f"""
with pts as materialized {POINTS},
box as (select min(px) - 1000 as bx0, min(py) - 1000 as by0, max(px) + 1000 as bx1, max(py) + 1000 as by1 from pts),
lnk as materialized (select link_id, {number('max_spd')} as spd, x1, y1, x2, y2 from {duckdb_sql('fx_links')}, box
        where {number('max_spd')} is not null and greatest(x1, x2) >= bx0 and least(x1, x2) <= bx1
          and greatest(y1, y2) >= by0 and least(y1, y2) <= by1)
select point_id, cast(round_even(spd, 0) as bigint) as speed_limit
from (select point_id, spd, row_number() over (partition by point_id order by sqrt({segment_d2()}), link_id) as rnk
      from pts, lnk) where rnk = 1"""


def priority_roads() -> str:
    first = project(f"(select * from {FACILITIES} where {CITY})", x="x1", y="y1")
    both = project(first, "lon2", "lat2", x="x2", y="y2")
    low = "least(nx * (x1 - px) + ny * (y1 - py), nx * (x2 - px) + ny * (y2 - py))"
    a = 50 * math.cos(math.pi / (4 * SEGS))
    # The line through the segment must meet the polygon too: compare with its corners.
    length = "sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)"
    off_line = f"abs((x1 - px) * (y2 - y1) - (y1 - py) * (x2 - x1)) / {length}"
    corner = "50 * abs(cos(2 * pi() * i / 64) * (y2 - y1) - sin(2 * pi() * i / 64) * (x2 - x1))"
    reach = f"list_max(list_transform(generate_series(0, 63), lambda i: {corner})) / {length}"
    return f"""
with pts as materialized {POINTS},
tgt as materialized (select x1, y1, x2, y2 from {both} where lat {LAT_OK} and lat2 {LAT_OK} and lon {LON_OK} and lon2 {LON_OK}),
near as materialized (select * from pts join tgt on {segment_d2()} <= 2500),
agg as (select point_id, 1 as v from near where {sides(low)} <= {a!r} and {off_line} <= {reach} group by point_id)
select pts.point_id, cast(coalesce(v, 0) as bigint) as has_priority_road from pts left join agg using (point_id)"""


def base_points() -> str:
    """Inverse projection by fixed-point search for the latitude of the meridian arc."""
    lon0, lat0, k0, fe, fn = TM[5179]
    at0 = f"({math.radians(lat0)!r})"
    steps = f"(select *, (py - {fn!r}) / {k0!r} + {_arc(at0)} as _m from pts)"
    steps = f"(select *, _m / {A * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256 - 175 * E2**4 / 16384)!r} as _f from {steps})"
    for _ in range(4):
        slope = f"({A * (1 - E2)!r} / (1 - {E2!r} * sin(_f) ** 2) ** 1.5)"
        steps = f"(select * replace (_f - ({_arc('_f')} - _m) / {slope} as _f) from {steps})"
    steps = (
        f"(select *, tan(_f) ** 2 as _t, {EP2!r} * cos(_f) ** 2 as _c, {A!r} / sqrt(1 - {E2!r} * sin(_f) ** 2) as _nu, "
        f"{A * (1 - E2)!r} / (1 - {E2!r} * sin(_f) ** 2) ** 1.5 as _ro from {steps})"
    )
    steps = f"(select *, (px - {fe!r}) / (_nu * {k0!r}) as _d from {steps})"
    lat = (
        f"_f - (_nu * tan(_f) / _ro) * (_d ** 2 / 2 - (5 + 3 * _t + 10 * _c - 4 * _c ** 2 - 9 * {EP2!r}) * _d ** 4 / 24 "
        f"+ (61 + 90 * _t + 298 * _c + 45 * _t ** 2 - 252 * {EP2!r} - 3 * _c ** 2) * _d ** 6 / 720)"
    )
    lon = (
        f"(_d - (1 + 2 * _t + _c) * _d ** 3 / 6 + (5 - 2 * _c + 28 * _t - 3 * _c ** 2 + 8 * {EP2!r} + 24 * _t ** 2) "
        f"* _d ** 5 / 120) / cos(_f)"
    )
    return f"""
with pts as materialized {POINTS}
select point_id, round(degrees({lat}), 6) as lat, round({lon0!r} + degrees({lon}), 6) as lon from {steps}"""


def road_summary() -> str:
    region = f"(select * from {duckdb_sql('fx_roads')} where sig_cd like '11%')"
    return f"""
select '시각화 대상 도로구간 수' as item, (select format('{{:,}}', count(*)) from {ROADS}) as value
union all select '전체 서울시 도로구간 수', (select format('{{:,}}', count(*)) from {region})
union all select '총 연장(km)', (select format('{{:,.1f}}', sum(road_lt) / 1000) from {ROADS})
union all select '평균 도로폭(m)', (select format('{{:,.1f}}', avg(road_bt)) from {ROADS})
union all select '좌표계', 'EPSG:5179'"""


def _tables() -> dict[str, str]:
    polygons = duckdb_sql("fx_polygons")
    city = f"(select *, facility_id as id from {FACILITIES} where {CITY})"
    every = f"(select *, facility_id as id from {FACILITIES})"
    risk = (
        "round(cast(10 * coalesce(n, 0) * (coalesce(cast(d as bigint), 0) + 0.1168::double * coalesce(cast(s as bigint), 0) "
        "+ 0.0068::double * coalesce(cast(l as bigint), 0)) as double), 6)"
    )
    oracle = {
        "r1_filter_roads": f"select ord, sig_cd, roa_cls_se, rn, rn_cd, road_lt, road_bt from {ROADS}",
        "r2_road_summary": road_summary(),
        "r4_road_points": (
            "select point_id, road_idx, cast(point_seq as integer) as point_seq, rn, rn_cd, road_lt, road_bt, "
            f"roa_cls_se, px as x, py as y from {POINTS}"
        ),
        "r5_point_buffers": (
            f"select point_id, cast(k as integer) as vertex_no, round(px + 50 * cos(-2 * pi() * (k % 64) / 64), 3) as x, "
            f"round(py + 50 * sin(-2 * pi() * (k % 64) / 64), 3) as y from {POINTS}, "
            "(select unnest(generate_series(0, 64)) as k)"
        ),
        "f1_base_points": base_points(),
        "f2_accident_risk": aggregate(
            ACCIDENTS, 50.0, "count(*) as n, sum(d) as d, sum(s) as s, sum(l) as l", "risk", risk
        ),
        "f3_speed_limit": speed_limit(),
        "f4_business_counts": business(),
        "f5_population": aggregate(
            POPULATION, 300.0, "sum(v) as v", "elderly_population", "cast(round_even(coalesce(v, 0), 0) as bigint)"
        ),
        "f6_welfare": ids(project(f"(select * from {every} where status = 'OK')"), 300.0, "welfare_count"),
        "f7_market_presence": rectangles(f"(select * from {polygons} where kind = '전통시장')", 50.0, "1", "has_market"),
        "f8_bus_stops": ids(project(STOPS), 300.0, "bus_stop_count"),
        "f9_bus_passengers": aggregate(
            project(PASSENGERS), 300.0, "sum(total) as v", "bus_passengers", "cast(coalesce(v, 0) as bigint)"
        ),
        "f10_subway": ids(project(every), 300.0, "subway_count"),
        "f11_streetlights": ids(project(DEVICES), 50.0, "streetlight_count"),
        "f12_cctv": aggregate(
            project(DEVICES), 50.0, "count(*) as v", "cctv_count", "cast(coalesce(v, 0) as bigint)"
        ),
        "f13_speed_bumps": rectangles(polygons, 50.0, "count(distinct mgrnu)", "speed_bump_count"),
        "f14_intersections": ids(PLANAR, 50.0, "intersection_count"),
        "f15_crosswalks": rectangles(polygons, 50.0, "count(distinct mgrnu)", "crosswalk_count"),
        "f16_crosswalk_warnings": flag(PLANAR, 50.0, "has_crosswalk_warning"),
        "f17_signals": flag(project(every), 50.0, "has_signal"),
        "f18_priority_roads": priority_roads(),
        "f19_parking": ids(project(DEVICES), 300.0, "parking_count"),
        "f20_protection_zones": flag(
            project(f"(select * from {swapped(city)} where facility_name is not null)"), 300.0, "has_protection_zone"
        ),
        "p1_accident_union": f"select * from {duckdb_sql('fx_accidents')}",
        "p2_accidents_by_year": f"select yr, count(*) as accidents from {duckdb_sql('fx_accidents')} group by yr",
    }
    oracle |= {"s1_roads_file": oracle["r4_road_points"], "s3_links_file": oracle["f3_speed_limit"], "s5_population_files": oracle["f5_population"]}
    oracle["s15_outlines_file"] = outlines()
    oracle["p3_incremental"] = _joined(oracle, ["f1_base_points", "f2_accident_risk", "f19_parking", "f17_signals"])
    oracle["p5_all_features"] = _joined(oracle, [k for k in oracle if k.startswith("f")])
    return oracle


def _joined(oracle: dict[str, str], names: list[str]) -> str:
    first, *rest = names
    tables = [f"({oracle[first]}) as t0"] + [
        f"join ({oracle[n]}) as t{i} using (point_id)" for i, n in enumerate(rest, 1)
    ]
    return "select * from " + "\n".join(tables)


ORACLES: dict[str, str] = _tables()
