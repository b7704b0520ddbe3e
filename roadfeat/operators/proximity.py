"""The proximity join: what lies within a radius of every point, aggregated per point.

All features share one target schema, and the radius is one of its columns, so that all features of a kind (points, or lines
and polygons) run as one join. Rows of a join are grouped by ``(point, feature, id)`` and then
by point. Cells of square grids, one grid for each radius or size, are the join key; the exact test is part of the join
condition, so no row that fails it leaves the join.

Two ways, chosen by the size of the targets:

* small targets are broadcast. Points are hashed by id once; every later step (the
  look-up of cells, the aggregations, the join onto the feature table) keeps
  that partitioning, so pairs are never shuffled.
* otherwise both sides are hashed by cell, targets being copied to the nine cells
  around. A point has one cell on a grid, and grouping by ``(cell, point)`` keeps the cell
  partitioning, so no pair is shuffled; with several grids one row of results for each of them is. Cells with too
  many rows are first cut into tiles of bounded size (``_tile_hot_cells``); then partial results of a point are
  merged by one more shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadfeat.config import POINT_ID, QUAD_SEGS
from roadfeat.functions.geometry import double, has_vertices, inside_buffer, ray_crosses, segment_meets_buffer
from roadfeat.layer import POLYGON
from roadfeat.operators import dense
from roadfeat.operators.storage import stored

# Rows of one cell, on either side, that one task joins; larger cells are tiled.
HOT_CELL_ROWS = 50_000
# Hot cells sent to every task as a table; with more of them the tiling is a join.
MAX_HOT_CELLS_BROADCAST = 100_000
CELL_LIMIT = 1 << 30
# Bytes in memory of a row of a shape's copies, and of a point target.
COPY_BYTES, TARGET_BYTES = 256, 192
# Times that an estimate of a size may fall short, or exceed what it stands for.
TRUSTED, HOPELESS = 8, 256
# Grids of a shape join: doublings of a cell's size, from the smallest radius up; heights also shrink, in so many halvings.
MAX_LEVEL, HALVINGS = 40, 12
# Edges of an outline in one strip of the ray test, on average, and in one row of a shape at most.
STRIP_EDGES, CHUNK = 64, 1024

IDS, VALUE_FIELDS = ("_id", "_id2"), ("_n", "_v1", "_v2", "_v3")
# What a row of a shape stands for: a segment that may touch a buffer, or an edge that a point's ray may cross.
TOUCH, RAY = 0, 1


@dataclass(frozen=True)
class Pairs:
    """Joined rows and the columns that group them by point without a shuffle.

    With ``merged`` a point's rows lie under several such keys, but those of one feature only under one.
    """

    df: DataFrame
    keys: tuple[str, ...]
    merged: bool = False


def estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate, from file sizes and row widths; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    """Bytes that may be sent to every task; a negative setting switches broadcasts off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip()
    if text.startswith("-"):
        return 0
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def checked_size(targets: DataFrame) -> tuple[DataFrame, bool]:
    """The targets, and whether they may be broadcast.

    An estimate from file sizes may fall short by a few times: one under a ``TRUSTED`` part of the limit is taken as it is; otherwise
    the targets are written and their rows counted. Far larger ones are not even written.
    """
    estimate, limit = estimated_bytes(targets), broadcast_limit(targets)
    if estimate * TRUSTED <= limit or estimate > limit * HOPELESS:
        return targets, estimate <= limit
    targets = stored(targets, "targets")
    return targets, targets.count() * TARGET_BYTES <= limit


def point_targets(
    df: DataFrame,
    code: int | Column,
    ident: Column | None = None,
    count: Column | None = None,
    values: Iterable[Column] = (),
) -> DataFrame:
    """Bring a point layer (``x, y``) to the shared schema, copies merged.

    Targets at one place with one id are one row that carries their number and sums;
    a place that holds a large part of all rows is thus merged before any join.
    """
    sums = list(values) + [F.lit(0.0)] * (3 - len(list(values)))
    rows = df.select(
        F.col("x").alias("_tx"),
        F.col("y").alias("_ty"),
        (F.lit(code) if isinstance(code, int) else code).cast("int").alias("_f"),
        *_keys((F.lit(None) if ident is None else ident).cast("string")),
        (F.lit(1) if count is None else count).cast("long").alias("_n"),
        *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(f"_v{i}") for i, v in enumerate(sums, 1)],
    )
    return rows.groupBy("_tx", "_ty", "_f", *IDS).agg(*[F.sum(c).alias(c) for c in VALUE_FIELDS])


def _keys(ident: Column) -> list[Column]:
    """An id as 128 bits of two numbers: pairs are grouped by numbers of fixed width, not by texts; null stays null."""
    known = ident.isNotNull()
    return [F.when(known, F.xxhash64(ident)).alias(IDS[0]), F.when(known, F.xxhash64(F.lit(1), ident)).alias(IDS[1])]


def shape_targets(df: DataFrame, kind: str, code: int, ident: Column | None = None) -> DataFrame:
    """Bring a line or polygon layer (``parts``) to the shared schema, copies merged.

    A shape becomes rows of at most ``CHUNK`` edges each: ``_c`` are consecutive vertices of one part. ``_shape`` tells
    shapes apart, ``_id`` their ids; a layer without ids gets a digest of the geometry, and ``_n`` says how many copies
    it has. Polygons also have ``_left``, the least x of the outline, and ``_strip``, the height of a strip with some dozens of edges.
    """
    own = _keys(F.col("parts") if ident is None else ident.cast("string"))
    rows = df.where(has_vertices("parts")).select("parts", F.lit(code).alias("_f"), *own)
    merged = rows.groupBy("parts", "_f", *IDS).agg(F.count(F.lit(1)).alias("_n"))

    def end(pick: str, axis: str) -> str:
        return f"array_{pick}(transform(filter(parts, p -> size(p) > 0), p -> array_{pick}(transform(p, v -> v.{axis}))))"

    n_edges = "aggregate(parts, 0, (n, p) -> n + greatest(size(p) - 1, 0))"
    outline = [f"{end('min', 'x')} as _left", f"({end('max', 'y')} - {end('min', 'y')}) * {STRIP_EDGES} / greatest({n_edges}, {STRIP_EDGES}) as _strip"]
    none = [f"cast(null as double) as {c}" for c in ("_left", "_strip")]
    shared = ["_f", *IDS, "_n", "_shape", "_left", "_strip"]
    whole = merged.selectExpr("_f", *IDS, "_n", "xxhash64(parts) as _shape", *(outline if kind == POLYGON else none), "explode(parts) as _p")
    cut = f"transform(sequence(0, (size(_p) - 2) div {CHUNK}), k -> slice(_p, k * {CHUNK} + 1, {CHUNK + 1}))"
    return whole.where("size(_p) >= 2").selectExpr(*shared, f"explode({cut}) as _c")


def _pieces(chunks: DataFrame) -> DataFrame:
    """One row for each segment that may touch a buffer and, of polygons, one for each edge that is not level.

    The ray test counts the edges that the ray from a point to greater x crosses, and an odd number is inside. So no row
    holds more than one edge, however long the outline, and the tests are plain arithmetic.
    """
    shared = [c for c in chunks.columns if c != "_c"]
    edge = "transform(sequence(1, size(_c) - 1), i -> named_struct('a', _c[i - 1], 'b', _c[i]))"
    rows = chunks.selectExpr(*shared, f"explode({edge}) as _s").selectExpr(
        *shared, "_s.a.x as x1", "_s.a.y as y1", "_s.b.x as x2", "_s.b.y as y2", f"explode(array({TOUCH}, {RAY})) as _k"
    )
    kept = rows.where(f"_k = {TOUCH} or (_left is not null and y1 != y2)")
    left = f"if(_k = {RAY}, _left, least(x1, x2))"
    return kept.selectExpr(
        "*", f"{left} as xmin", "least(y1, y2) as ymin", "greatest(x1, x2) as xmax", "greatest(y1, y2) as ymax"
    ).drop("_left")


def with_radius(targets: DataFrame, radius: float) -> DataFrame:
    return targets.withColumn("_r", F.lit(float(radius)))


def near_points(
    points: DataFrame,
    targets: DataFrame,
    radius: float | Sequence[float],
    quad_segs: int | None = QUAD_SEGS,
    small: bool | None = None,
) -> Pairs:
    """Pairs of a point and a target strictly inside its buffer polygon.

    ``targets`` has the schema of :func:`point_targets`; with several radii its column ``_r`` says which is a row's.
    ``small`` overrides the size check (:func:`checked_size`).
    """
    radii, targets = _radii(targets, radius)
    sites = points.selectExpr(POINT_ID, "x as _px", "y as _py")
    exact = inside_buffer("_tx - _px", "_ty - _py", "_r", quad_segs)
    at = ["_r as _grid", f"{grid_index('_tx', '_r')} as _cx", f"{grid_index('_ty', '_r')} as _cy"]
    if small is None:
        targets, small = checked_size(targets)
    if small:
        own = ", ".join(
            f"named_struct('_grid', {double(r)}, '_cx', {grid_index('_px', r)}, '_cy', {grid_index('_py', r)})" for r in radii
        )
        # Two small steps: generated methods beyond 8000 byte codes would not be compiled further.
        gridded = _by_point(sites).selectExpr("*", f"inline(array({own}))")
        probes = gridded.selectExpr(POINT_ID, "_px", "_py", "_grid", f"explode({block_of('_cx', '_cy')}) as _cell")
        placed = targets.selectExpr("*", *at).selectExpr("*", f"{pack_cell('_cx', '_cy')} as _cell").drop("_cx", "_cy")
        return Pairs(_join(probes, F.broadcast(placed), ["_grid", "_cell"], exact), (POINT_ID,))
    homes = sites.selectExpr(
        "*", f"inline(array({', '.join(_home(double(r), r, r) for r in radii)}))"
    )
    placed = targets.selectExpr("*", *at)
    copies = placed.selectExpr(*targets.columns, "_grid", f"explode({block_of('_cx', '_cy')}) as _cell")
    # Copies are counted without being made: by own cell, then spread.
    own = placed.groupBy("_grid", "_cx", "_cy").agg(F.count(F.lit(1)).alias("_nt"))
    counts = own.selectExpr("_grid", "_nt", f"explode({block_of('_cx', '_cy')}) as _cell")
    return join_by_cell(homes, copies, ["_grid", "_cell"], exact, counts, several=len(radii) > 1)


def near_shapes(
    points: DataFrame,
    targets: DataFrame,
    radius: float | Sequence[float],
    quad_segs: int | None = QUAD_SEGS,
    small: bool | None = None,
) -> Pairs:
    """Pairs of a point and a segment that touches its buffer polygon, or an edge that its ray crosses.

    ``targets`` has the schema of :func:`shape_targets` (and ``_r`` with several radii); :func:`per_point` makes shapes of the
    pairs. Segments of any length meet few cells: there are grids of doubling cell size, and a segment uses the one at
    which its box, widened by the radius, spans at most 3 x 3 cells. Edges of the ray test use grids whose cells are as wide
    as the way from the outline's left end to the edge, and as high as the edge or its outline's strips. Points look up one cell of every
    grid in use.

    Shapes are written once, in chunks, as they are both counted and joined; ``small=False`` rules a broadcast out.
    """
    radii, targets = _radii(targets, radius)
    targets = _pieces(stored(targets, "chunks"))
    base = 2.0 * min(radii)
    wide = f"case when _k = {RAY} then xmax - xmin else greatest(xmax - xmin, ymax - ymin) + 2 * _r end"
    high = f"case when _k = {RAY} then greatest(ymax - ymin, _strip) else 0D end"

    def level(size: str, least: int) -> str:
        return f"cast(least(greatest(ceil(log2(greatest({size}, 1e-9D) / {double(2 * base)})), {least}), {MAX_LEVEL}) as int)"

    # A grid by one number: the doublings of its width, and for rays those of its height too.
    span_x, span_y = level(wide, 0), level(high, -HALVINGS)
    per = MAX_LEVEL + HALVINGS + 2
    grid = f"_lx * {per} + case when _k = {RAY} then _ly + {HALVINGS + 1} else 0 end"
    placed = targets.selectExpr("*", f"{span_x} as _lx", f"{span_y} as _ly").selectExpr("*", f"{grid} as _grid")
    size_x = f"({double(base)} * power(2D, _lx))"
    size_y = f"({double(base)} * power(2D, case when _k = {RAY} then _ly else _lx end))"
    reach = f"case when _k = {RAY} then 0D else _r end"
    ends = {
        "_cx0": grid_index(f"xmin - {reach}", size_x), "_cx1": grid_index(f"xmax + {reach}", size_x),
        "_cy0": grid_index(f"ymin - {reach}", size_y), "_cy1": grid_index(f"ymax + {reach}", size_y),
    }
    pieces = placed.selectExpr("*", *[f"{e} as {c}" for c, e in ends.items()]).drop("_lx", "_ly")

    def spread(df: DataFrame) -> DataFrame:
        cells = df.selectExpr("*", "explode(sequence(_cx0, _cx1)) as _cx").selectExpr("*", "explode(sequence(_cy0, _cy1)) as _cy")
        return cells.selectExpr("*", f"{pack_cell('_cx', '_cy')} as _cell").drop(*ends, "_cx", "_cy")

    copies = F.sum((F.col("_cx1") - F.col("_cx0") + 1) * (F.col("_cy1") - F.col("_cy0") + 1)) * COPY_BYTES
    # At most one row per pair of doublings of the extent.
    measured = {r[0]: r[1] for r in pieces.groupBy("_grid").agg(copies).collect() if r[0] is not None}
    gap_x, gap_y = "greatest(xmin - _px, _px - xmax, 0D)", "greatest(ymin - _py, _py - ymax, 0D)"
    on_segment = segment_meets_buffer("_px", "_py", "x1", "y1", "x2", "y2", "_r", quad_segs)
    exact = (
        # Left of an outline a point may share a cell with some of its edges only: it is outside.
        f"case when _k = {RAY} then _px >= xmin and {ray_crosses('_px', '_py', 'x1', 'y1', 'x2', 'y2')} "
        f"else {gap_x} * {gap_x} + {gap_y} * {gap_y} <= _r * _r and {on_segment} end"
    )
    sites = points.selectExpr(POINT_ID, "x as _px", "y as _py")
    is_small = small is not False and sum(measured.values()) <= broadcast_limit(targets)
    if is_small:
        sites = _by_point(sites)
    homes = []
    for code in sorted(measured) or [0]:
        lx, ly = divmod(code, per)
        height = lx if ly == 0 else ly - HALVINGS - 1
        homes.append(_home(str(code), base * 2.0**lx, base * 2.0**height))
    probes = sites.selectExpr("*", f"inline(array({', '.join(homes)}))")
    keys = ["_grid", "_cell"]
    if is_small:
        return Pairs(_join(probes, F.broadcast(spread(pieces)), keys, exact), (POINT_ID,))
    own = pieces.groupBy("_grid", *ends).agg(F.count(F.lit(1)).alias("_nt"))
    pairs = join_by_cell(probes, spread(pieces), keys, exact, spread(own), several=False)
    # Rows of one shape lie on several grids: they meet by point.
    return pairs if len(homes) <= 1 else Pairs(pairs.df, (POINT_ID,))


def _radii(targets: DataFrame, radius: float | Sequence[float]) -> tuple[list[float], DataFrame]:
    radii = sorted({float(r) for r in (radius if isinstance(radius, (list, tuple, set)) else [radius])})
    if "_r" not in targets.columns:
        if len(radii) != 1:
            raise ValueError("several radii need targets with a radius each")
        targets = with_radius(targets, radii[0])
    return radii, targets


def _home(code: str, size_x: float, size_y: float) -> str:
    cell = pack_cell(grid_index("_px", size_x), grid_index("_py", size_y))
    return f"named_struct('_grid', {code}, '_cell', {cell})"


def _by_point(sites: DataFrame) -> DataFrame:
    """Hash by point id, into as many parts as any join; few bytes, but much work each."""
    return sites.repartition(int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions")), POINT_ID)


def per_point(pairs: Pairs, columns: dict[str, Column], by_feature: bool, shapes: bool = False) -> DataFrame:
    """One row per matched point.

    ``columns`` aggregate rows ``_f, _ids, _n, _v1.._v3``, one for each feature code. With ``by_feature`` the pairs
    are first reduced to one row per point, feature and id; distinct counts and shapes need
    that, plain sums do not. A shape counts if a segment of it touches or the number
    of its edges that the ray crosses is odd; its copies count once however many segments touch. Only the few rows of a
    point's features meet the many expressions of ``columns``.
    """
    keys = (POINT_ID,) if pairs.merged else pairs.keys
    return _outputs(_by_point_and_feature(pairs, by_feature, shapes), keys, columns)


def _by_point_and_feature(pairs: Pairs, by_feature: bool, shapes: bool) -> DataFrame:
    """The sums of one point and feature, and the number of its ids."""
    rows = pairs.df
    if shapes:
        met = rows.groupBy(*pairs.keys, "_f", *IDS, "_shape").agg(
            F.max("_n").alias("_n"), F.count_if(F.col("_k") == TOUCH).alias("_touches"), F.count_if(F.col("_k") == RAY).alias("_crossed")
        )
        rows = met.where("_touches > 0 or _crossed % 2 = 1").groupBy(*pairs.keys, "_f", *IDS).agg(F.max("_n").alias("_n"))
    elif by_feature:
        rows = rows.groupBy(*pairs.keys, "_f", *IDS).agg(*[F.sum(c).alias(c) for c in VALUE_FIELDS])
    sums = [F.sum(c).alias(c) for c in VALUE_FIELDS if c in rows.columns]
    return rows.groupBy(*pairs.keys, "_f").agg(F.count("_id").alias("_ids"), *sums)


def _outputs(rows: DataFrame, keys: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    out = rows.groupBy(*keys).agg(*[c.alias(name) for name, c in columns.items()])
    return out.drop(*[k for k in keys if k != POINT_ID])


def dense_per_point(
    points: DataFrame,
    targets: DataFrame,
    radius: float | Sequence[float],
    columns: dict[str, Column],
    by_feature: bool,
    shapes: bool = False,
    quad_segs: int | None = QUAD_SEGS,
) -> DataFrame | None:
    """:func:`per_point` by sums over cells (``operators/dense.py``), or None where the join of pairs does.

    Objects that are too wide for cells go through that join, and their rows are added to the others'.
    """
    radii, targets = _radii(targets, radius)
    if not dense.is_dense(points, targets, radii, shapes):
        return None
    made = dense.object_sums(points, targets, radii, quad_segs, shapes)
    if made is None:
        return None
    rows, rest = made
    if rest.take(1):
        pairs = (near_shapes if shapes else near_points)(points, rest, radii, quad_segs)
        others = _by_point_and_feature(pairs, by_feature, shapes).select(POINT_ID, "_f", *[c for c in dense.SUMS if c == "_ids" or not shapes or c == "_n"])
        rows = rows.unionByName(others, allowMissingColumns=True)
    merged = rows.groupBy(POINT_ID, "_f").agg(*[F.sum(c).alias(c) for c in dense.SUMS])
    return _outputs(merged, (POINT_ID,), columns)


def grid_index(value: str, size: float | str) -> str:
    """Grid index of a coordinate, kept within bounds so that junk cannot overflow.

    Clamping keeps neighbours neighbours; far-out values only share border cells.
    """
    size = size if isinstance(size, str) else double(size)
    return f"greatest(least(floor(({value}) / {size}), {CELL_LIMIT}L), -{CELL_LIMIT}L)"


def pack_cell(cx: str, cy: str) -> str:
    return f"(shiftleft({cx}, 32) ^ (({cy}) & {0xFFFFFFFF}L))"


def cell_of(x: str, y: str, size: float) -> str:
    return pack_cell(grid_index(x, size), grid_index(y, size))


def block_of(cx: str, cy: str) -> str:
    """Cells of the 3 x 3 block around a cell."""
    steps = (-1, 0, 1)
    return f"array({', '.join(pack_cell(f'({cx} + {dx}L)', f'({cy} + {dy}L)') for dx in steps for dy in steps)})"


def _join(left: DataFrame, right: DataFrame, keys: list[str], exact: str) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"{k}_t" for k in keys})
    on = " and ".join([f"{k} = {k}_t" for k in keys] + [f"({exact})"])
    return left.join(renamed, F.expr(on)).drop(*[f"{k}_t" for k in keys])


def join_by_cell(
    homes: DataFrame, copies: DataFrame, keys: list[str], exact: str, counts: DataFrame | None = None, several: bool = False
) -> Pairs:
    """Join by cell; ``counts`` has ``_nt`` copies for each cell, in any number of rows, if there is a cheaper way to count them.

    ``several``: a point has a cell on each of several grids, and a feature's rows are on one. Both sides are shuffled: the
    planner knows the files' sizes but not how many copies are made of a row, and a broadcast begun by such an estimate is never taken back.
    """
    tiled = _tile_hot_cells(homes, copies, keys, counts)
    if tiled is None:
        return Pairs(_join(homes, copies.hint("merge"), keys, exact), (*keys, POINT_ID), several)
    homes, copies, keys = tiled
    return Pairs(_join(homes, copies.hint("merge"), keys, exact), (POINT_ID,))


def _tile_hot_cells(homes: DataFrame, copies: DataFrame, keys: list[str], counts: DataFrame | None):
    """Cut cells with more than ``HOT_CELL_ROWS`` rows on a side into tiles.

    The points of a hot cell are dealt to ``_ps`` groups and its targets to ``_ts``
    groups; every point group meets every target group once, each in its own key, so
    all pairs are found and no key holds more than about ``HOT_CELL_ROWS`` rows a side.
    Returns ``None`` when no cell is hot.
    """
    count = F.count(F.lit(1))
    at_home = homes.groupBy(*keys).agg(count.alias("_np"))
    nearby = copies.groupBy(*keys).agg(count.alias("_nt")) if counts is None else counts.groupBy(*keys).agg(F.sum("_nt").alias("_nt"))
    hot = (
        at_home.join(nearby.hint("merge"), keys)
        .select(
            *keys,
            F.ceil(F.col("_np") / HOT_CELL_ROWS).cast("int").alias("_ps"),
            F.ceil(F.col("_nt") / HOT_CELL_ROWS).cast("int").alias("_ts"),
        )
        .where("_ps > 1 or _ts > 1")
    )
    found = hot.take(MAX_HOT_CELLS_BROADCAST + 1)
    if not found:
        return None
    if len(found) <= MAX_HOT_CELLS_BROADCAST:
        hot = F.broadcast(homes.sparkSession.createDataFrame(found, hot.schema))

    def deal(df: DataFrame, own: str, other: str, own_slot: str, other_slot: str, row_hash: Column) -> DataFrame:
        sized = df.join(hot, keys, "left").withColumns(
            {own: F.coalesce(own, F.lit(1)), other: F.coalesce(other, F.lit(1))}
        )
        return (
            sized.withColumn(own_slot, F.pmod(row_hash, F.col(own)).cast("int"))
            .withColumn(other_slot, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop(own, other)
        )

    plain = [c for c in copies.columns if c not in keys]
    homes = deal(homes, "_ps", "_ts", "_pslot", "_tslot", F.xxhash64(POINT_ID))
    copies = deal(copies, "_ts", "_ps", "_tslot", "_pslot", F.xxhash64(*plain))
    return homes, copies, [*keys, "_pslot", "_tslot"]
