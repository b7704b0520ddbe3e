"""Transverse Mercator projections and datum shifts as plain column arithmetic (Krüger series, seven parameters).

A coordinate system is an EPSG code, or a ``Projection`` or ``Datum`` (longitudes and latitudes on it) where none is known. Between
systems of different datums, places go through geocentric coordinates of WGS 84; heights are taken as zero.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadfeat.config import LONLAT_CRS


@dataclass(frozen=True)
class Ellipsoid:
    semi_major: float
    inverse_flattening: float

    @property
    def flattening(self) -> float:
        return 1 / self.inverse_flattening if self.inverse_flattening else 0.0

    @property
    def n(self) -> float:
        """Third flattening."""
        return self.flattening / (2 - self.flattening)

    @property
    def radius(self) -> float:
        n = self.n
        return self.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    @property
    def ecc(self) -> float:
        return 2 * math.sqrt(self.n) / (1 + self.n)

    @property
    def semi_minor(self) -> float:
        return self.semi_major * (1 - self.flattening)

    @property
    def same_as_grs80(self) -> bool:
        """Also WGS 84, whose axis differs by a tenth of a millimetre."""
        return abs(self.semi_major - 6378137.0) < 1e-3 and abs(self.inverse_flattening - 298.257222101) < 1e-4


# Ellipsoids.
GRS80, BESSEL = Ellipsoid(6378137.0, 298.257222101), Ellipsoid(6377397.155, 299.1528128)

# Order-4 series in the third flattening (Karney 2011, eqs. 35, 36; inverse latitude series), each
# harmonic's coefficient as (power of n, numerator, denominator).
_ALPHA = (
    ((1, 1, 2), (2, -2, 3), (3, 5, 16), (4, 41, 180)),
    ((2, 13, 48), (3, -3, 5), (4, 557, 1440)),
    ((3, 61, 240), (4, -103, 140)),
    ((4, 49561, 161280),),
)
_BETA = (
    ((1, 1, 2), (2, -2, 3), (3, 37, 96), (4, -1, 360)),
    ((2, 1, 48), (3, 1, 15), (4, -437, 1440)),
    ((3, 17, 480), (4, -37, 840)),
    ((4, 4397, 161280),),
)
_DELTA = (
    ((1, 2, 1), (2, -2, 3), (3, -2, 1), (4, 116, 45)),
    ((2, 7, 3), (3, -8, 5), (4, -227, 45)),
    ((3, 56, 15), (4, -136, 35)),
    ((4, 4279, 630),),
)


@lru_cache(maxsize=None)
def series(ellipsoid: Ellipsoid) -> tuple[tuple[float, ...], ...]:
    """Coefficients of the forward, inverse and latitude series."""
    n = ellipsoid.n
    return tuple(tuple(sum(num / den * n**power for power, num, den in row) for row in rows) for rows in (_ALPHA, _BETA, _DELTA))


@dataclass(frozen=True)
class Datum:
    """``shift`` leads to WGS 84: three metres, three rotations in arc seconds (position vector), parts per million."""

    ellipsoid: Ellipsoid = GRS80
    shift: tuple[float, ...] = (0.0,) * 7


WGS84 = Datum()
# Published shifts (EPSG registry); stated accuracy 1 m for the first, 10 m or less for the others.
KOREAN_1985 = Datum(BESSEL, (-115.80, 474.99, 674.11, 1.16, -2.31, -1.63, 6.43))
TOKYO = Datum(BESSEL, (-147.0, 506.0, 687.0, 0.0, 0.0, 0.0, 0.0))


@dataclass(frozen=True)
class Projection:
    lon0: float
    lat0: float
    scale: float
    false_easting: float
    false_northing: float
    datum: Datum = field(default=WGS84)

    @property
    def radius(self) -> float:
        return self.scale * self.datum.ellipsoid.radius

    @property
    def origin_northing(self) -> float:
        """Northing of the origin latitude before the false northing is added."""
        s, ecc = math.sin(math.radians(self.lat0)), self.datum.ellipsoid.ecc
        xi = math.atan(math.sinh(math.atanh(s) - ecc * math.atanh(ecc * s)))
        return self.radius * (xi + sum(a * math.sin(2 * j * xi) for j, a in enumerate(series(self.datum.ellipsoid)[0], 1)))


Crs = int | Projection | Datum

# EPSG registry parameters.
GEOGRAPHIC = {LONLAT_CRS: WGS84, 4737: WGS84, 4162: KOREAN_1985, 4301: TOKYO}
PROJECTIONS = {
    5179: Projection(127.5, 38.0, 0.9996, 1_000_000.0, 2_000_000.0),
    5180: Projection(125.0, 38.0, 1.0, 200_000.0, 500_000.0),
    5181: Projection(127.0, 38.0, 1.0, 200_000.0, 500_000.0),
    5182: Projection(127.0, 38.0, 1.0, 200_000.0, 550_000.0),
    5183: Projection(129.0, 38.0, 1.0, 200_000.0, 500_000.0),
    5184: Projection(131.0, 38.0, 1.0, 200_000.0, 500_000.0),
    5185: Projection(125.0, 38.0, 1.0, 200_000.0, 600_000.0),
    5186: Projection(127.0, 38.0, 1.0, 200_000.0, 600_000.0),
    5187: Projection(129.0, 38.0, 1.0, 200_000.0, 600_000.0),
    5188: Projection(131.0, 38.0, 1.0, 200_000.0, 600_000.0),
    2096: Projection(129.0, 38.0, 1.0, 200_000.0, 500_000.0, KOREAN_1985),
    2097: Projection(127.0, 38.0, 1.0, 200_000.0, 500_000.0, KOREAN_1985),
    2098: Projection(125.0, 38.0, 1.0, 200_000.0, 500_000.0, KOREAN_1985),
    5173: Projection(125.0028902777778, 38.0, 1.0, 200_000.0, 500_000.0, KOREAN_1985),
    5174: Projection(127.0028902777778, 38.0, 1.0, 200_000.0, 500_000.0, KOREAN_1985),
    5175: Projection(127.0028902777778, 38.0, 1.0, 200_000.0, 550_000.0, KOREAN_1985),
    5176: Projection(129.0028902777778, 38.0, 1.0, 200_000.0, 500_000.0, KOREAN_1985),
    5177: Projection(131.0028902777778, 38.0, 1.0, 200_000.0, 500_000.0, KOREAN_1985),
    5178: Projection(127.5, 38.0, 0.9996, 1_000_000.0, 2_000_000.0, KOREAN_1985),
}
# Universal Transverse Mercator on WGS 84: 326 and the zone in the north, 327 in the south.
PROJECTIONS |= {
    base + zone: Projection(6.0 * zone - 183.0, 0.0, 0.9996, 500_000.0, northing)
    for base, northing in ((32600, 0.0), (32700, 10_000_000.0))
    for zone in range(1, 61)
}


def crs_name(code: Crs | None) -> str:
    return "None" if code is None else f"EPSG:{code}" if isinstance(code, int) else str(code)


def projection(code: Crs) -> Projection | None:
    """The plane of a system; None for longitudes and latitudes."""
    if isinstance(code, Projection):
        return code
    if isinstance(code, Datum) or code in GEOGRAPHIC:
        return None
    if code not in PROJECTIONS:
        raise ValueError(f"unsupported coordinate system {crs_name(code)}")
    return PROJECTIONS[code]


def datum(code: Crs) -> Datum:
    plane = projection(code)
    if plane is not None:
        return plane.datum
    return code if isinstance(code, Datum) else GEOGRAPHIC[code]


def known_code(system: Projection | Datum) -> Crs:
    """The code of a system, if it has one here; parameters may differ in their last digits."""

    def near(a: Projection, b: Projection) -> bool:
        return a.datum == b.datum and all(
            abs(getattr(a, k) - getattr(b, k)) < 1e-6 for k in ("lon0", "lat0", "scale", "false_easting", "false_northing")
        )

    if isinstance(system, Datum):
        return next((code for code, d in GEOGRAPHIC.items() if d == system), system)
    return next((code for code, p in PROJECTIONS.items() if near(p, system)), system)


Step = tuple[str, ...]


def _sphere_forward(at: Step, p: Projection) -> Step:
    (lon, lat), ecc = at, p.datum.ellipsoid.ecc
    s = f"sin(radians({lat}))"
    t = f"sinh(atanh({s}) - {ecc!r}D * atanh({ecc!r}D * {s}))"
    d = f"radians({lon} - {p.lon0!r}D)"
    return f"atan2({t}, cos({d}))", f"atanh(sin({d}) / sqrt(1 + {t} * {t}))"


def _plane_forward(at: Step, p: Projection) -> Step:
    (xi, eta), terms = at, list(enumerate(series(p.datum.ellipsoid)[0], 1))
    east = " + ".join(f"{a!r}D * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, a in terms)
    north = " + ".join(f"{a!r}D * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, a in terms)
    x = f"{p.false_easting!r}D + {p.radius!r}D * ({eta} + {east})"
    y = f"{p.false_northing - p.origin_northing!r}D + {p.radius!r}D * ({xi} + {north})"
    return x, y


def _plane_scaled(at: Step, p: Projection) -> Step:
    x, y = at
    xi = f"({y} - {p.false_northing - p.origin_northing!r}D) / {p.radius!r}D"
    eta = f"({x} - {p.false_easting!r}D) / {p.radius!r}D"
    return xi, eta


def _plane_inverse(at: Step, p: Projection) -> Step:
    (xi, eta), terms = at, list(enumerate(series(p.datum.ellipsoid)[1], 1))
    south = " + ".join(f"{b!r}D * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, b in terms)
    west = " + ".join(f"{b!r}D * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, b in terms)
    return f"{xi} - ({south})", f"{eta} - ({west})"


def _sphere_conformal(at: Step, p: Projection) -> Step:
    xi, eta = at
    lon = f"{p.lon0!r}D + degrees(atan2(sinh({eta}), cos({xi})))"
    return lon, f"asin(sin({xi}) / cosh({eta}))"


def _sphere_inverse(at: Step, p: Projection) -> Step:
    (lon, chi), terms = at, enumerate(series(p.datum.ellipsoid)[2], 1)
    return lon, f"degrees({chi} + " + " + ".join(f"{d!r}D * sin({2 * j} * {chi})" for j, d in terms) + ")"


def _geocentric(at: Step, e: Ellipsoid) -> Step:
    (lon, lat), e2 = at, e.ecc**2
    across = f"{e.semi_major!r}D / sqrt(1 - {e2!r}D * sin(radians({lat})) * sin(radians({lat})))"
    return (
        f"{across} * cos(radians({lat})) * cos(radians({lon}))",
        f"{across} * cos(radians({lat})) * sin(radians({lon}))",
        f"{across} * {1 - e2!r}D * sin(radians({lat}))",
    )


def _shifted(at: Step, shift: tuple[float, ...]) -> Step:
    x, y, z = at
    (tx, ty, tz), (rx, ry, rz), m = shift[:3], [math.radians(r / 3600) for r in shift[3:6]], 1 + shift[6] * 1e-6
    return (
        f"{tx!r}D + {m!r}D * ({x} - {rz!r}D * {y} + {ry!r}D * {z})",
        f"{ty!r}D + {m!r}D * ({rz!r}D * {x} + {y} - {rx!r}D * {z})",
        f"{tz!r}D + {m!r}D * ({-ry!r}D * {x} + {rx!r}D * {y} + {z})",
    )


def _geodetic(at: Step, e: Ellipsoid) -> Step:
    """Bowring's formula, exact to far below a millimetre near the ground."""
    (x, y, z), a, b, e2 = at, e.semi_major, e.semi_minor, e.ecc**2
    across = f"sqrt({x} * {x} + {y} * {y})"
    t = f"atan2({z} * {a!r}D, {across} * {b!r}D)"
    up, out = f"{z} + {e2 / (1 - e2) * b!r}D * power(sin({t}), 3)", f"{across} - {e2 * a!r}D * power(cos({t}), 3)"
    return f"degrees(atan2({y}, {x}))", f"degrees(atan2({up}, {out}))"


@lru_cache(maxsize=None)
def _steps(source: Crs, target: Crs) -> tuple:
    """The expression builders that lead from one system to the other, in order, with their constants."""
    if source == target:
        return ()
    steps: list = []
    if (p := projection(source)) is not None:
        steps += [(f, p) for f in (_plane_scaled, _plane_inverse, _sphere_conformal, _sphere_inverse)]
    here, there = datum(source), datum(target)
    if here != there:
        back = tuple(-v for v in there.shift)
        steps += [(_geocentric, here.ellipsoid), (_shifted, here.shift), (_shifted, back), (_geodetic, there.ellipsoid)]
    if (p := projection(target)) is not None:
        steps += [(f, p) for f in (_sphere_forward, _plane_forward)]
    return tuple(steps)


def _struct(names: tuple[str, ...], values: Step) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(names, values, strict=False)) + ")"


def _bound(a: str, b: str, source: Crs, target: Crs) -> str:
    """One expression for the projected pair; each step is bound to a lambda variable.

    Without that, every step would be written out at every use by the next one, and the
    expression would grow by an order of magnitude per step.
    """
    value, size = _struct(("x", "y"), (a, b)), 2
    for i, (step, constants) in enumerate(_steps(source, target)):
        found = step(tuple(f"s{i}.{c}" for c in ("x", "y", "z")[:size]), constants)
        value, size = f"transform(array({value}), s{i} -> {_struct(('x', 'y', 'z'), found)})[0]", len(found)
    return value


def project_points(df: DataFrame, x: str, y: str, source: Crs, target: Crs) -> DataFrame:
    """Replace the columns ``x, y`` (lon, lat where there is no plane) by their projected values.

    Each step is one generated row, which keeps the planner from writing it out at
    every use by the next step; all steps stay inside generated code.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (x, y)]
    names = (x, y)
    for step, constants in _steps(source, target):
        found = step(tuple(f"`{n}`" for n in names), constants)
        names = (x, y, "_geocentric_z")[: len(found)]
        df = df.select(*kept, F.expr(f"inline(array({_struct(names, found)}))").alias(*names))
    return df


def project_parts(parts: str, source: Crs, target: Crs) -> Column:
    """Vertex arrays in the target system."""
    return F.expr(f"transform({parts}, p -> transform(p, v -> {_bound('v.x', 'v.y', source, target)}))")


def forward_scalar(lon: float, lat: float, code: Crs) -> tuple[float, float]:
    """One lon/lat of the plane's datum in the plane; for bounding boxes, not for data."""
    p = projection(code)
    ecc, alpha = p.datum.ellipsoid.ecc, series(p.datum.ellipsoid)[0]
    s = math.sin(math.radians(lat))
    t = math.sinh(math.atanh(s) - ecc * math.atanh(ecc * s))
    d = math.radians(lon - p.lon0)
    xi, eta = math.atan2(t, math.cos(d)), math.atanh(math.sin(d) / math.sqrt(1 + t * t))
    east = eta + sum(a * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, a in enumerate(alpha, 1))
    north = xi + sum(a * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, a in enumerate(alpha, 1))
    return p.false_easting + p.radius * east, p.false_northing - p.origin_northing + p.radius * north


def inverse_scalar(x: float, y: float, code: Crs) -> tuple[float, float]:
    p = projection(code)
    _, beta, delta = series(p.datum.ellipsoid)
    xi = (y - p.false_northing + p.origin_northing) / p.radius
    eta = (x - p.false_easting) / p.radius
    xi1 = xi - sum(b * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, b in enumerate(beta, 1))
    eta1 = eta - sum(b * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, b in enumerate(beta, 1))
    chi = math.asin(math.sin(xi1) / math.cosh(eta1))
    lat = chi + sum(d * math.sin(2 * j * chi) for j, d in enumerate(delta, 1))
    return p.lon0 + math.degrees(math.atan2(math.sinh(eta1), math.cos(xi1))), math.degrees(lat)


def geocentric_scalar(lon: float, lat: float, e: Ellipsoid, height: float = 0.0) -> tuple[float, float, float]:
    phi, lam, e2 = math.radians(lat), math.radians(lon), e.ecc**2
    across = e.semi_major / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    out = (across + height) * math.cos(phi)
    return out * math.cos(lam), out * math.sin(lam), (across * (1 - e2) + height) * math.sin(phi)


def shift_scalar(place: tuple[float, float, float], shift: tuple[float, ...]) -> tuple[float, float, float]:
    (x, y, z), (rx, ry, rz), m = place, [math.radians(r / 3600) for r in shift[3:6]], 1 + shift[6] * 1e-6
    return (
        shift[0] + m * (x - rz * y + ry * z),
        shift[1] + m * (rz * x + y - rx * z),
        shift[2] + m * (-ry * x + rx * y + z),
    )


def geodetic_scalar(place: tuple[float, float, float], e: Ellipsoid) -> tuple[float, float]:
    (x, y, z), a, b, e2 = place, e.semi_major, e.semi_minor, e.ecc**2
    across = math.hypot(x, y)
    t = math.atan2(z * a, across * b)
    lat = math.atan2(z + e2 / (1 - e2) * b * math.sin(t) ** 3, across - e2 * a * math.cos(t) ** 3)
    return math.degrees(math.atan2(y, x)), math.degrees(lat)


def project_scalar(x: float, y: float, source: Crs, target: Crs) -> tuple[float, float]:
    if source == target:
        return x, y
    if projection(source) is not None:
        x, y = inverse_scalar(x, y, source)
    here, there = datum(source), datum(target)
    if here != there:
        place = shift_scalar(geocentric_scalar(x, y, here.ellipsoid), here.shift)
        x, y = geodetic_scalar(shift_scalar(place, tuple(-v for v in there.shift)), there.ellipsoid)
    return (x, y) if projection(target) is None else forward_scalar(x, y, target)


# Well-known text --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """One element of well-known text: a keyword and what stands in its brackets."""

    name: str
    args: tuple

    def all(self, *names: str) -> list[Node]:
        """Elements of these names below this one, this one included, in order."""
        own = [self] if self.name in names else []
        return own + [x for a in self.args if isinstance(a, Node) for x in a.all(*names)]

    def child(self, *names: str) -> Node | None:
        return next((a for a in self.args if isinstance(a, Node) and a.name in names), None)


def parse_wkt(text: str) -> Node:
    tokens = [m for m in _TOKEN.finditer(text) if m.lastgroup != "space"]
    at = 0

    def value():  # noqa: ANN202
        nonlocal at
        kind, word = tokens[at].lastgroup, tokens[at].group()
        at += 1
        if kind == "text":
            return word[1:-1].replace('""', '"')
        if kind == "number":
            return float(word)
        if kind != "word":
            raise ValueError(f"unexpected {word!r}")
        args = []
        if at < len(tokens) and tokens[at].group() in "[(":
            at += 1
            while tokens[at].group() not in "])":
                args.append(value())
                if tokens[at].group() == ",":
                    at += 1
            at += 1
        return Node(word.upper(), tuple(args))

    try:
        node = value()
    except IndexError:
        raise ValueError("the text ends too early") from None
    if not isinstance(node, Node):
        raise ValueError("no coordinate system")
    return node


_TOKEN = re.compile(
    r'(?P<text>"(?:[^"]|"")*")|(?P<number>[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)'
    r"|(?P<word>[A-Za-z_][A-Za-z_0-9]*)|(?P<mark>[][(),])|(?P<space>\s+)"
)
_GEOGRAPHIC = ("GEOGCS", "GEOGCRS", "GEODCRS", "GEODETICCRS", "GEOGRAPHICCRS", "BASEGEOGCRS", "BASEGEODCRS")
_PROJECTED = ("PROJCS", "PROJCRS", "PROJECTEDCRS")
# Datums within a metre of WGS 84, and others with a known shift (names without marks).
_NEAR_WGS84 = ("wgs1984", "wgs84", "worldgeodeticsystem1984", "korea2000", "koreandatum2000", "geocentricdatumofkorea", "itrf2000", "grs1980", "koreandatum1995", "korean1995")
_WITH_SHIFT = {"korean1985": KOREAN_1985, "koreandatum1985": KOREAN_1985, "tokyo": TOKYO}
# Names of the parameters, older and newer.
_PARAMETERS = {
    "central_meridian": "lon0", "longitude_of_natural_origin": "lon0", "longitude_of_origin": "lon0",
    "latitude_of_origin": "lat0", "latitude_of_natural_origin": "lat0",
    "scale_factor": "scale", "scale_factor_at_natural_origin": "scale",
    "false_easting": "false_easting", "false_northing": "false_northing",
}


def _plain(text: str) -> str:
    return re.sub(r"[^a-z0-9]", "", text.lower()).removeprefix("d")


def _datum_of(node: Node) -> Datum:
    shape = next(iter(node.all("SPHEROID", "ELLIPSOID")), None)
    named = next(iter(node.all("DATUM", "GEODETICDATUM", "TRF", "ENSEMBLE")), None)
    meridian = next(iter(node.all("PRIMEM", "PRIMEMERIDIAN")), None)
    if shape is None or named is None or (meridian is not None and meridian.args[1] != 0):
        raise ValueError("no datum, or a prime meridian other than Greenwich")
    ellipsoid = Ellipsoid(float(shape.args[1]), float(shape.args[2]))
    if shift := node.all("TOWGS84"):
        values = [float(v) for v in shift[0].args]
        given = Datum(ellipsoid, tuple(values + [0.0] * (7 - len(values))))
        return WGS84 if ellipsoid.same_as_grs80 and not any(given.shift) else given
    label = _plain(str(named.args[0]))
    if ellipsoid.same_as_grs80 and any(label.startswith(_plain(x)) for x in _NEAR_WGS84):
        return WGS84
    for start, found in _WITH_SHIFT.items():
        if label.startswith(start) and abs(found.ellipsoid.semi_major - ellipsoid.semi_major) < 1:
            return found
    raise ValueError(f"no shift is known for the datum {named.args[0]!r}")


def crs_from_wkt(text: str) -> Crs:
    """The system that well-known text (of either version) describes, as a code where it has one."""
    root = parse_wkt(text)
    plane = next(iter(root.all(*_PROJECTED)), None)
    if plane is None:
        if not root.all(*_GEOGRAPHIC):
            raise ValueError("no coordinate system")
        return known_code(_datum_of(root))
    found = _datum_of(plane)
    method = next(iter(plane.all("PROJECTION", "METHOD")), None)
    if method is None or not any(x in _plain(str(method.args[0])) for x in ("transversemercator", "gausskruger")):
        raise ValueError("only Transverse Mercator planes are supported")
    unit = plane.child("UNIT", "LENGTHUNIT") or next(iter(plane.all("LENGTHUNIT")), None)
    if unit is not None and abs(float(unit.args[1]) - 1) > 1e-9:
        raise ValueError("only metres are supported")
    given = {"lat0": 0.0, "scale": 1.0, "false_easting": 0.0, "false_northing": 0.0}
    for p in plane.all("PARAMETER"):
        label = str(p.args[0]).lower().replace(" ", "_")
        if label in _PARAMETERS:
            given[_PARAMETERS[label]] = float(p.args[1])
    if "lon0" not in given:
        raise ValueError("no central meridian")
    return known_code(Projection(**given, datum=found))
