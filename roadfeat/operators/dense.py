"""Sums over what lies around points, for places where points and targets are both many.

Pairs of a point and a target grow with the square of a dense place's rows. Here points and targets meet in square tiles, each target
being copied to the tiles in its reach. Inside a tile the points lie in level strips, sorted by x: a target surely counts for one run of a
strip's points, which gets its sums by two entries of a running sum, and surely not for those beyond another run. Only the points between
the two runs, at the rim of a buffer, take the exact test, so the results are the same as those of all pairs. Spark shuffles the tiles; NumPy
works on one group of bounded size at a time: a tile with more rows is dealt to several groups, whose sums are added.

An *object* is what counts once: a target without an id, or all targets of an id that one point can meet. The targets of an id are
first cut into clusters more than two radii apart, which no point sees together. Objects of many places or edges, or too wide
for tiles, are left to the join of pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from roadfeat.config import POINT_ID
from roadfeat.functions.geometry import double
from roadfeat.operators.storage import stored

# Pairs of rows in neighbouring cells from which the tiles are taken; below it the join of pairs is quicker.
DENSE_PAIRS = 30_000_000
# Exact tests made at once, and points or places of one group.
EXACT_PAIRS, GROUP_ROWS = 1 << 19, 200_000
# Features whose rows a group of that many points returns.
GROUP_FEATURES = 10
# Radii that an object of points, one of shapes, and a tile may span; parts or edges of an object.
SPAN, SHAPE_SPAN, TILE, OBJECT_PARTS = 4, 16, 4, 64

IDS, SUMS = ("_id", "_id2"), ("_ids", "_n", "_v1", "_v2", "_v3")
BOX = ("_x0", "_y0", "_x1", "_y1")
_LIMIT = 1 << 30


def _cell(value: str, radii: float = TILE) -> str:
    size = f"(_r * {double(radii)})"
    return f"greatest(least(floor(({value}) / {size}), {_LIMIT}L), -{_LIMIT}L)"


def is_dense(points: DataFrame, targets: DataFrame, radii: list[float], shapes: bool) -> bool:
    """Whether neighbouring cells hold many pairs of rows; counted by cell, no pair is made."""
    at = ("_c[0].x", "_c[0].y") if shapes else ("_tx", "_ty")
    homes = points.selectExpr("x", "y", f"explode(array({', '.join(map(double, radii))})) as _r")
    count = F.count(F.lit(1))

    def by_cell(df: DataFrame, x: str, y: str, name: str) -> DataFrame:
        cells = df.selectExpr("_r", f"{_cell(x, 2)} as _cx", f"{_cell(y, 2)} as _cy")
        return cells.groupBy("_r", "_cx", "_cy").agg(count.cast("double").alias(name))

    nearby = by_cell(targets, *at, "_nt").selectExpr("_r", "_nt", "explode(sequence(_cx - 1, _cx + 1)) as _cx", "_cy")
    nearby = nearby.selectExpr("_r", "_nt", "_cx", "explode(sequence(_cy - 1, _cy + 1)) as _cy")
    nearby = nearby.groupBy("_r", "_cx", "_cy").agg(F.sum("_nt").alias("_nt"))
    met = by_cell(homes, "x", "y", "_np").join(nearby.hint("merge"), ["_r", "_cx", "_cy"])
    return (met.agg(F.sum(F.col("_np") * F.col("_nt"))).first()[0] or 0) >= DENSE_PAIRS


def _clustered(rows: DataFrame, shared: list[str]) -> DataFrame:
    """Rows with ids and a box get the number of their cluster (``_gx, _gy``); clusters lie more than two radii apart."""
    keys = ["_f", "_r", *IDS]
    for low, high, group in (("_x0", "_x1", "_gx"), ("_y0", "_y1", "_gy")):
        order = Window.partitionBy(*keys).orderBy(low)
        reached = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
        # A little more than two radii, so that rounding parts none that a point can see together.
        rows = rows.withColumn("_new", (F.col(low) > reached + F.col("_r") * 2.001).cast("int"))
        rows = rows.withColumn(group, F.coalesce(F.sum("_new").over(order), F.lit(0)))
        keys.append(group)
    whole = Window.partitionBy(*keys)
    return rows.withColumns(
        {
            "_parts": F.sum("_weight").over(whole),
            **{c: (F.min if c in BOX[:2] else F.max)(c).over(whole) for c in BOX},
        }
    ).select(*shared, "_gx", "_gy", "_parts", *BOX)


# Neither holds for boxes with NaN or without bounds.
def _small(span: int) -> str:
    return f"_parts <= {OBJECT_PARTS} and _x1 - _x0 <= {span} * _r and _y1 - _y0 <= {span} * _r"


def _point_objects(targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Objects of point targets, with their places as ``_e``, and the targets that belong to none."""
    sums = ["_n", "_v1", "_v2", "_v3"]
    shared = ["_tx", "_ty", "_f", "_r", *IDS, *sums]
    boxed = targets.where("_tx is not null and _ty is not null").selectExpr(*shared, "_tx as _x0", "_ty as _y0", "_tx as _x1", "_ty as _y1", "1 as _weight")
    known = _clustered(boxed.where("_id is not null"), shared)
    alone = boxed.where("_id is null").selectExpr(*shared, "0L as _gx", "0L as _gy", "1L as _parts", *BOX)
    rows = stored(known.unionByName(alone), "placed")
    small = rows.where(_small(SPAN))
    single = small.where("_parts = 1").selectExpr(
        "_f", "_r", *BOX, "if(_id is null, 0L, 1L) as _ids", *sums, "array(named_struct('x', _tx, 'y', _ty)) as _e"
    )
    several = small.where("_parts > 1").groupBy("_f", "_r", *IDS, "_gx", "_gy").agg(
        F.collect_list(F.struct(F.col("_tx").alias("x"), F.col("_ty").alias("y"))).alias("_e"),
        *[F.first(c).alias(c) for c in BOX],
        *[F.sum(c).alias(c) for c in sums],
    )
    several = several.selectExpr("_f", "_r", *BOX, "1L as _ids", *sums, "_e")
    return single.unionByName(several), rows.where(f"({_small(SPAN)}) is not true").select(*shared)


def _shape_objects(targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Objects of shapes, with their edges as ``_e``, and the chunks of shapes that belong to none; shapes without an id are counted nowhere.

    An edge's ``s`` is twice its shape's number in the object, and one more for edges of the ray test.
    """
    shared = list(targets.columns)
    ends = {"_x0": "array_min(_c.x)", "_y0": "array_min(_c.y)", "_x1": "array_max(_c.x)", "_y1": "array_max(_c.y)"}
    chunks = targets.where("_id is not null").selectExpr("*", "size(_c) - 1 as _weight", *[f"{e} as {c}" for c, e in ends.items()])
    shape = Window.partitionBy("_f", "_r", *IDS, "_shape")
    boxed = chunks.withColumns({c: (F.min if c in BOX[:2] else F.max)(c).over(shape) for c in BOX})
    rows = stored(_clustered(boxed, shared), "placed")
    edges = (
        "transform(sequence(1, size(_c) - 1), i -> named_struct('x1', _c[i - 1].x, 'y1', _c[i - 1].y, "
        "'x2', _c[i].x, 'y2', _c[i].y, 's', if(_left is not null and _c[i - 1].y != _c[i].y, 1, 0)))"
    )
    small = rows.where(_small(SHAPE_SPAN)).withColumn("_edges", F.expr(edges))
    keys = ["_f", "_r", *IDS, "_gx", "_gy"]
    whole = small.groupBy(*keys, "_shape").agg(
        F.flatten(F.collect_list("_edges")).alias("_edges"), F.max("_n").alias("_n"), *[F.first(c).alias(c) for c in BOX]
    )
    objects = whole.groupBy(*keys).agg(
        F.collect_list("_edges").alias("_shapes"), F.max("_n").alias("_n"), *[F.first(c).alias(c) for c in BOX]
    )
    numbered = "named_struct('x1', e.x1, 'y1', e.y1, 'x2', e.x2, 'y2', e.y2, 's', 2 * i + e.s)"
    zeros = [f"0D as _v{i}" for i in (1, 2, 3)]
    objects = objects.selectExpr(
        "_f", "_r", *BOX, "1L as _ids", "_n", *zeros, f"flatten(transform(_shapes, (s, i) -> transform(s, e -> {numbered}))) as _e"
    )
    return objects, rows.where(f"({_small(SHAPE_SPAN)}) is not true").select(*shared)


def object_sums(
    points: DataFrame, targets: DataFrame, radii: list[float], quad_segs: int | None, shapes: bool
) -> tuple[DataFrame, DataFrame] | None:
    """``(POINT_ID, _f, sums)`` of objects, and the targets that the join of pairs has to take; None if ids of points repeat.

    The rows of a point and a feature are several, to be added up.
    """
    sites = points.selectExpr(POINT_ID, "x as _px", "y as _py").where("_px - _px = 0 and _py - _py = 0")
    sites = stored(sites, "sites")
    if sites.groupBy(POINT_ID).count().where("count > 1").take(1):
        return None
    objects, rest = _shape_objects(targets) if shapes else _point_objects(targets)
    objects = stored(objects, "objects")
    homes = sites.selectExpr("*", f"explode(array({', '.join(map(double, radii))})) as _r")
    homes = homes.selectExpr("*", f"{_cell('_px')} as _cx", f"{_cell('_py')} as _cy")
    # A little more than the radius, so that rounding parts none that are within reach.
    for axis in "xy":
        ends = _cell(f"_{axis}0 - _r * 1.01D"), _cell(f"_{axis}1 + _r * 1.01D")
        objects = objects.selectExpr("*", f"explode(sequence({ends[0]}, {ends[1]})) as _c{axis}")
    keys = ["_r", "_cx", "_cy", "_ps", "_ts"]
    homes, objects = _in_groups(homes, objects.drop(*BOX), keys[:3])
    # Few bytes, but much work each: these parts must not be put together by their size.
    parts = int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at_once = EXACT_PAIRS

    def met(key: tuple, homes: pa.Table, objects: pa.Table) -> pa.Table:
        if not homes.num_rows or not objects.num_rows:
            kinds = [homes.schema.field(POINT_ID).type, pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 3]
            return pa.table([pa.array([], k) for k in kinds], [POINT_ID, "_f", *SUMS])
        return _Group(homes, objects, key[0].as_py(), quad_segs, shapes, at_once).sums()

    out = StructType([
        homes.schema[POINT_ID], StructField("_f", IntegerType()),
        *[StructField(c, LongType() if c in ("_ids", "_n") else DoubleType()) for c in SUMS],
    ])
    grouped = [df.repartition(parts, *keys).groupBy(*keys) for df in (homes, objects)]
    return grouped[0].cogroup(grouped[1]).applyInArrow(met, out), rest


def _in_groups(homes: DataFrame, objects: DataFrame, tile: list[str]) -> tuple[DataFrame, DataFrame]:
    """Deal the points and the objects of a full tile to groups; each group of points (``_ps``) meets each of objects (``_ts``) once."""
    points = homes.groupBy(*tile).agg(F.count(F.lit(1)).alias("_np"))
    targets = objects.groupBy(*tile).agg(F.sum(F.size("_e")).alias("_nt"), F.count_distinct("_f").alias("_nf"))
    full = points.join(targets.hint("merge"), tile).selectExpr(
        *tile,
        f"cast(ceil(_np * greatest(1, _nf / {GROUP_FEATURES}) / {GROUP_ROWS}) as int) as _pn",
        f"cast(ceil(_nt / {GROUP_ROWS}) as int) as _tn",
    )
    full = stored(full.where("_pn > 1 or _tn > 1"), "full")
    if not full.take(1):
        return tuple(df.selectExpr("*", "0 as _ps", "0 as _ts") for df in (homes, objects))

    def deal(df: DataFrame, own: str, n: str, other: str, m: str, digest: str) -> DataFrame:
        sized = df.join(full, tile, "left").selectExpr(*df.columns, f"coalesce({n}, 1) as _own", f"coalesce({m}, 1) as _other")
        return sized.selectExpr(
            *df.columns, f"cast(pmod({digest}, _own) as int) as {own}", f"explode(sequence(0, _other - 1)) as {other}"
        )

    plain = ", ".join(c for c in objects.columns if c not in tile)
    return deal(homes, "_ps", "_pn", "_ts", "_tn", f"xxhash64({POINT_ID})"), deal(objects, "_ts", "_tn", "_ps", "_pn", f"xxhash64({plain})")


def _runs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all runs in a row, and which run each is of."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(which)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes), which


def _sweep(owner: np.ndarray, first: np.ndarray, end: np.ndarray, kind: np.ndarray, room: int):
    """Runs ``(owner, first, end, kind)`` laid over each other: those that are surely met, and those to be tested.

    Kinds: 0 surely met, 1 unsure, 2 crossed by a ray, which counts where their number is odd and nothing is unsure.
    """
    keep = first < end
    owner, first, end, kind = owner[keep], first[keep], end[keep], kind[keep]
    at = np.concatenate([owner * room + first, owner * room + end])
    step = np.repeat([1, -1], len(owner))
    order = np.argsort(at, kind="stable")
    at, step, kind = at[order], step[order], np.tile(kind, 2)[order]
    sure, unsure, crossed = (np.cumsum(step * (kind == k))[:-1] for k in range(3))
    met = (sure > 0) | ((unsure == 0) & (crossed % 2 == 1))
    some = at[1:] > at[:-1]

    def runs(where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high = at[:-1][where], at[1:][where]
        return low // room, low % room, low % room + high - low

    return runs(met & some), runs(~met & (unsure > 0) & some)


class _Group:
    """The points and objects of one tile, or of a part of its rows."""

    def __init__(self, homes: pa.Table, objects: pa.Table, radius: float, quad_segs: int | None, shapes: bool, at_once: int):
        self.ids, self.r, self.quad_segs, self.shapes, self.at_once = homes[POINT_ID], radius, quad_segs, shapes, at_once
        self.px, self.py = (homes[c].to_numpy() for c in ("_px", "_py"))
        places = objects["_e"].combine_chunks()
        offsets = places.offsets.to_numpy().astype(np.int64)
        self.first, self.sizes = offsets[:-1] - offsets[0], np.diff(offsets)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        flat = places.flatten()
        fields = {flat.type.field(i).name: v.to_numpy(zero_copy_only=False) for i, v in enumerate(flat.flatten())}
        self.codes, self.code = np.unique(objects["_f"].to_numpy(), return_inverse=True)
        self.weights = {c: objects[c].to_numpy() for c in SUMS}
        names = ("x1", "y1", "x2", "y2") if shapes else ("x", "y", "x", "y")
        ends = np.stack([fields[n] for n in names]).astype(np.float64)
        # An edge without one of its coordinates is met by no point.
        ends[:, np.isnan(ends).any(axis=0)] = np.nan
        self.x1, self.y1, self.x2, self.y2 = ends
        self.shape = self.ray = None
        if shapes:
            marks = fields["s"].astype(np.int64)
            starts = np.append(True, (np.diff(marks >> 1) != 0) | (np.diff(self.owner) != 0))[: len(marks)]
            self.shape, self.ray = np.cumsum(starts) - 1, marks % 2 == 1

    def sums(self) -> pa.Table:
        self._prepare()
        n = len(self.px)
        made = {c: np.zeros((len(self.codes), n)) for c in ("met", *self.columns)}
        for low, high in zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist()):
            self._strip(low, high, made)
        code, at = np.nonzero(made["met"])
        values = [sum((made[p][code, at] for p in self.parts[c]), np.zeros(len(at))) for c in SUMS]
        values = [pa.array(v.astype(np.int64) if c in ("_ids", "_n") else v) for c, v in zip(SUMS, values, strict=True)]
        ids = self.ids.combine_chunks().take(pa.array(self.order[at]))
        return pa.table([ids, pa.array(self.codes[code], pa.int32()), *values], [POINT_ID, "_f", *SUMS])

    def _prepare(self) -> None:
        """Sort the points into strips, and find out what is needed of the objects."""
        r, n = self.r, len(self.px)
        wide, high = np.ptp(self.px), np.ptp(self.py)
        # So high that searching the strips takes about as long as testing the rim.
        strip = min(max(2 * math.sqrt(wide / n * high), r / 64), r / 4)
        number = np.floor((self.py - self.py.min()) / strip)
        self.order = np.lexsort((self.px, number))
        self.px, self.py, number = self.px[self.order], self.py[self.order], number[self.order]
        self.cuts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [n]])
        # Rounding of far coordinates, beside a little of the radius.
        self.margin = r * 1e-9 + 16 * np.finfo(float).eps * max(np.nanmax(np.abs(v), initial=0) for v in (self.px, self.py, self.x1, self.y1, self.x2, self.y2))
        self.inner = r * (math.cos(math.pi / (4 * self.quad_segs)) if self.quad_segs else 1.0)
        self.low, self.high = np.minimum(self.y1, self.y2), np.maximum(self.y1, self.y2)
        if self.shapes:
            starts = np.flatnonzero(np.append(True, np.diff(self.shape)))
            ends = [np.fmin.reduceat(np.minimum(self.x1, self.x2), starts), np.fmin.reduceat(self.low, starts),
                    np.fmax.reduceat(np.maximum(self.x1, self.x2), starts), np.fmax.reduceat(self.high, starts)]
            # What lies inside a narrow outline is near an edge.
            broad = np.minimum(ends[2] - ends[0], ends[3] - ends[1]) > 2 * (self.inner - 4 * self.margin)
            self.ray &= broad[self.shape]
            self.left, self.shape_owner = ends[0][self.shape], self.owner[starts]
        self.several = self.sizes > 1
        # Sums of rounded values are exact in a running sum, and rests are small; far greater values are added one by one.
        self.columns, self.parts = {}, {}
        bound = 2.0**42 / len(self.sizes)
        self.odd = np.zeros(len(self.sizes), bool)
        for c, v in self.weights.items():
            v = v.astype(np.float64)
            fits = np.abs(v) < bound
            self.odd |= ~fits
            even = np.where(fits, np.round(np.where(fits, v, 0) * 1024) / 1024, v)
            rest = np.where(fits, v - np.where(fits, even, 0), 0)
            made = {c: even, f"{c} rest": rest}
            self.parts[c] = []
            for label, part in made.items():
                if (part == 1).all():
                    self.parts[c].append("met")
                elif part.any():
                    self.parts[c].append(label)
                    self.columns[label] = part

    def _strip(self, low: int, high: int, made: dict[str, np.ndarray]) -> None:
        """Add what the points from ``low`` to ``high`` meet."""
        self.x0, self.y0 = self.px[low], self.py[low]
        xs, y = self.px[low:high] - self.x0, self.py[low:high]
        bottom, top = y.min() - self.y0, y.max() - self.y0
        reach = self.r + self.margin
        used = np.flatnonzero((self.high >= self.y0 + bottom - reach - self.margin) & (self.low <= self.y0 + top + reach + self.margin))
        if not len(used):
            return
        ends = [v[used] - o for v, o in ((self.x1, self.x0), (self.y1, self.y0), (self.x2, self.x0), (self.y2, self.y0))]
        room = high - low + 1
        sure, wide = self._cuts(ends, bottom, top)
        a, b = np.searchsorted(xs, sure[0], "left"), np.searchsorted(xs, sure[1], "right")
        c, d = np.searchsorted(xs, wide[0], "left"), np.searchsorted(xs, wide[1], "right")
        some = a < b
        a, b = np.where(some, a, c), np.where(some, b, c)
        c, d = np.minimum(c, a), np.maximum(d, b)
        one = np.zeros(len(used), np.int64)
        owners = np.tile(self.owner[used], 3)
        first, end, kind = np.concatenate([a, c, b]), np.concatenate([b, a, d]), np.concatenate([one, one + 1, one + 1])
        alone = np.tile(~self.several[self.owner[used]], 3)
        if self.shapes and self.ray[used].any():
            shapes = np.tile(self.shape[used], 3)
            rays = self._rays(used, ends, xs, bottom, top)
            first, end, kind = (np.concatenate([v, w]) for v, w in zip((first, end, kind), rays[1:], strict=True))
            met, unsure = _sweep(np.concatenate([shapes, rays[0]]), first, end, kind, room)
            owners = self.shape_owner[np.concatenate([met[0], unsure[0]])]
            first, end = (np.concatenate([met[i], unsure[i]]) for i in (1, 2))
            kind = np.repeat([0, 1], [len(met[0]), len(unsure[0])])
            alone = np.zeros(len(owners), bool)
        some = alone & (first < end)
        met, unsure = ((owners[k], first[k], end[k]) for k in (some & (kind == 0), some & (kind == 1)))
        if not alone.all():
            laid = _sweep(owners[~alone], first[~alone], end[~alone], kind[~alone], room)
            met, unsure = (tuple(map(np.concatenate, zip(*two, strict=True))) for two in ((met, laid[0]), (unsure, laid[1])))
        self._add(made, low, high, *met)
        self._test(made, low, high, *unsure)

    def _cuts(self, ends: list[np.ndarray], bottom: float, top: float):
        """Ends of the runs of a strip that surely lie within the buffer of an edge (or place), and of those that may.

        What is near an edge is convex: the surely met run is that of the strip's lower and upper side alike.
        """
        y1, y2 = ends[1], ends[3]
        safe = max(self.inner - 2 * self.margin, 0.0)
        lower, upper = (self._level(ends, y, safe) for y in (bottom, top))
        sure = np.maximum(lower[0], upper[0]), np.minimum(lower[1], upper[1])
        reach = self.r + 2 * self.margin
        lower, upper = (self._level(ends, y, reach) for y in (bottom, top))
        left, right = np.minimum(lower[0], upper[0]), np.maximum(lower[1], upper[1])
        for x, y in ((ends[0], y1), (ends[2], y2)):
            within = (y >= bottom) & (y <= top)
            left = np.where(within, np.minimum(left, x - reach), left)
            right = np.where(within, np.maximum(right, x + reach), right)
        return sure, (left, right)

    def _level(self, ends: list[np.ndarray], y: float, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Where a level line is within the radius of the edges; an empty run from infinity elsewhere."""
        left, right = np.full(len(ends[0]), np.inf), np.full(len(ends[0]), -np.inf)
        for x, at in (ends[:2], ends[2:]) if self.shapes else (ends[:2],):
            square = radius * radius - (at - y) ** 2
            half = np.sqrt(np.maximum(square, 0))
            left = np.where(square >= 0, np.minimum(left, x - half), left)
            right = np.where(square >= 0, np.maximum(right, x + half), right)
        if self.shapes:
            dx, dy = ends[2] - ends[0], ends[3] - ends[1]
            length = np.hypot(dx, dy)
            with np.errstate(divide="ignore", invalid="ignore"):
                for side in (radius, -radius):
                    # The sides of the band: ends moved by the radius at a right angle.
                    share = (y - ends[1] - side * dx / length) / dy
                    x = ends[0] + share * dx - side * dy / length
                    on = (share >= 0) & (share <= 1) & np.isfinite(x)
                    left, right = np.where(on, np.minimum(left, x), left), np.where(on, np.maximum(right, x), right)
        return left, right

    def _rays(self, used: np.ndarray, ends: list[np.ndarray], xs: np.ndarray, bottom: float, top: float):
        """Runs of a strip's points whose ray to greater x crosses an edge: surely, and perhaps; none is left of the outline."""
        at = np.flatnonzero(self.ray[used] & (self.high[used] > self.y0 + bottom - self.margin) & (self.low[used] <= self.y0 + top + self.margin))
        x1, y1, x2, y2 = (v[at] for v in ends)
        low, high, span = np.minimum(y1, y2), np.maximum(y1, y2), self.margin
        full = (low <= bottom - span) & (high > top + span)
        with np.errstate(divide="ignore", invalid="ignore"):
            cross = [x1 + (y - y1) * (x2 - x1) / (y2 - y1) for y in (bottom, top)]
        near = np.where(full, np.minimum(*cross), -np.inf) - span
        far = np.where(full, np.maximum(*cross), np.maximum(x1, x2)) + span
        start = np.searchsorted(xs, self.left[used[at]] - self.x0 - span, "left")
        outline = np.searchsorted(xs, self.left[used[at]] - self.x0 + span, "right")
        a, b = np.searchsorted(xs, near, "left"), np.searchsorted(xs, far, "right")
        a = np.maximum(a, outline)
        owner, one = self.shape[used[at]], np.ones(len(at), np.int64)
        sure = full & (a > outline)
        middle = np.where(sure, a, start)
        # Where the outline's left end itself is near, the exact test decides.
        return (
            np.tile(owner, 3),
            np.concatenate([outline, middle, start]),
            np.concatenate([np.where(sure, a, outline), b, np.where(sure, outline, start)]),
            np.concatenate([2 * one, one, one]),
        )

    def _add(self, made, low: int, high: int, owner, first, end) -> None:  # noqa: ANN001
        """Add the objects' sums to runs of points."""
        odd = self.odd[owner]
        if odd.any():
            self._single(made, low, high, owner[odd], first[odd], end[odd], test=False)
            owner, first, end = owner[~odd], first[~odd], end[~odd]
        room, size = high - low + 1, len(self.codes)
        a, b = self.code[owner] * room + first, self.code[owner] * room + end
        for label, values in made.items():
            w = None if label == "met" else self.columns[label][owner]
            steps = np.bincount(a, w, size * room).astype(np.float64) - np.bincount(b, w, size * room)
            values[:, low:high] += np.cumsum(steps.reshape(size, room), axis=1)[:, :-1]

    def _test(self, made, low: int, high: int, owner, first, end) -> None:  # noqa: ANN001
        self._single(made, low, high, owner, first, end, test=True)

    def _single(self, made, low: int, high: int, owner, first, end, test: bool) -> None:  # noqa: ANN001
        """Points of runs one by one, as many at once as tests are allowed."""
        # No run is longer than what is done at once.
        count = -(-(end - first) // self.at_once)
        part, which = _runs(np.zeros(len(count), np.int64), count)
        owner, first, end = owner[which], first[which] + part * self.at_once, end[which]
        end = np.minimum(end, first + self.at_once)
        size = end - first
        done = np.cumsum(size * (self.sizes[owner] if test else 1))
        room = len(self.codes) * (high - low)
        begin = 0
        while begin < len(owner):
            until = max(begin + 1, int(np.searchsorted(done, (done[begin - 1] if begin else 0) + self.at_once, "right")))
            some = slice(begin, until)
            at, which = _runs(first[some], size[some])
            which = owner[some][which]
            if test:
                met = self._meets(low + at, which)
                at, which = at[met], which[met]
            key = self.code[which] * (high - low) + at
            for label, values in made.items():
                w = None if label == "met" else self.columns[label][which]
                values[:, low:high] += np.bincount(key, w, room).reshape(len(self.codes), high - low)
            begin = until

    def _meets(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Whether points meet objects, by the same arithmetic as the join of pairs."""
        sizes = self.sizes[owner]
        place, pair = _runs(self.first[owner], sizes)
        starts = np.cumsum(sizes) - sizes
        px, py = self.px[at][pair], self.py[at][pair]
        if not len(pair):
            return np.zeros(0, bool)
        x1, y1 = self.x1[place], self.y1[place]
        if not self.shapes:
            return np.logical_or.reduceat(self._inside(x1 - px, y1 - py), starts)
        x2, y2 = self.x2[place], self.y2[place]
        met = np.logical_or.reduceat(self._touches(px, py, x1, y1, x2, y2), starts)
        ray = self.ray[place]
        if ray.any():
            with np.errstate(divide="ignore", invalid="ignore"):
                crossed = ray & ((y1 > py) != (y2 > py)) & (px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)) & (px >= self.left[place])
            shape = self.shape[place]
            cuts = np.flatnonzero(np.append(True, (np.diff(shape) != 0) | (np.diff(pair) != 0)))
            odd = np.add.reduceat(crossed.astype(np.int64), cuts) % 2 == 1
            met |= np.logical_or.reduceat(odd, np.searchsorted(cuts, starts))
        return met

    def _inside(self, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
        """``geometry.inside_buffer``."""
        d2, r = dx * dx + dy * dy, self.r
        if self.quad_segs is None:
            return d2 < r * r
        inner, wedge = r * math.cos(math.pi / (4 * self.quad_segs)), math.pi / (2 * self.quad_segs)
        met = d2 < inner * inner
        rim = np.flatnonzero(~met & (d2 < r * r))
        angle = np.fmod(np.arctan2(dy[rim], dx[rim]), wedge)
        angle = np.where(angle < 0, np.fmod(angle + wedge, wedge), angle) - wedge / 2
        met[rim] = np.sqrt(d2[rim]) * np.cos(angle) < inner
        return met

    def _touches(self, px, py, x1, y1, x2, y2) -> np.ndarray:  # noqa: ANN001
        """``geometry.segment_meets_buffer``."""
        ex, ey = x2 - x1, y2 - y1
        length2, along = ex * ex + ey * ey, (px - x1) * ex + (py - y1) * ey
        with np.errstate(divide="ignore", invalid="ignore"):
            fx, fy = px - (x1 + along / length2 * ex), py - (y1 + along / length2 * ey)
        starts, stops = along <= 0, along >= length2
        dx, dy = (np.where(starts, p - a, np.where(stops, p - b, f)) for p, a, b, f in ((px, x1, x2, fx), (py, y1, y2, fy)))
        d2, r = dx * dx + dy * dy, self.r
        if self.quad_segs is None:
            return d2 <= r * r
        inner = r * math.cos(math.pi / (4 * self.quad_segs))
        met = d2 <= inner * inner
        rim = np.flatnonzero(~met & (d2 <= r * r))
        ax, ay, bx, by = ((v - p)[rim] for v, p in ((x1, px), (y1, py), (x2, px), (y2, py)))
        low, high = np.zeros(len(rim)), np.ones(len(rim))
        n = 4 * self.quad_segs
        for k in range(n if len(rim) else 0):
            nx, ny = math.cos(2 * math.pi * (k + 0.5) / n), math.sin(2 * math.pi * (k + 0.5) / n)
            a, b = inner - (nx * ax + ny * ay), inner - (nx * bx + ny * by)
            with np.errstate(divide="ignore", invalid="ignore"):
                share = a / (a - b)
            low = np.where((a < 0) & (b < 0), 2.0, np.where(a < 0, np.maximum(low, share), low))
            high = np.where((b < 0) & (a >= 0), np.minimum(high, share), high)
        met[rim] = low <= high
        return met
