"""Near-duplicate embeddings by a robust-pruned flat graph, built on overlapping cluster shards and searched by range."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadfeat.llm.components import components
from roadfeat.llm.shared import store
from roadfeat.llm.simhash import spanning

#: A shard above this many vectors is divided, and a shard that cannot be is searched in blocks of so many.
SHARD = 1024
#: Vectors of a shard (about, chosen by hash) from which its pivots are picked, and the most pivots.
SAMPLE, PIVOTS = 256, 64
#: Pivots are less alike than this, so that vectors in range of each other are not divided among many.
APART = 0.9
#: Nearest pivots whose shards a vector joins.
OVERLAP = 2
#: A division is made only if none of its parts holds more than this share of the sample.
LARGEST = 0.5
#: Divisions one after another.
LEVELS = 6
#: Vectors that meet in a task to be divided.
DEALT = 8192
#: Neighbours of a vector in a shard's graph, and how much longer a detour may be before an edge is kept.
DEGREE, SLACK = 24, 1.2
#: Candidates kept by the greedy search, and how far below the threshold the range search still expands.
BEAM, MARGIN = 16, 0.03


def _matrix(column) -> np.ndarray:
    """Unit vectors, in double precision, of a list column with lists of one length."""
    n = len(column)
    flat = np.asarray(pa.concat_arrays(column.chunks).flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(), np.float64)
    x = flat.reshape(n, -1)
    largest = np.abs(x).max(axis=1, initial=0.0)
    odd = (largest > 1e100) | (largest < 1e-100)
    if odd.any():  # squares would overflow or vanish
        x = np.where(odd[:, None], x / np.where(largest > 0, largest, 1)[:, None], x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _pick_pivots(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("node")
    x = _matrix(table["vec"])
    most = max(OVERLAP + 2, min(PIVOTS, -(-2 * table["n"][0].as_py() // SHARD)))
    chosen: list[int] = []
    for i in range(len(x)):
        if len(chosen) < most and (not chosen or (x[chosen] @ x[i]).max() < APART):
            chosen.append(i)
    share = np.bincount((x @ x[chosen].T).argmax(axis=1)).max() / len(x)
    k = len(chosen) if len(chosen) > OVERLAP + 1 and share <= LARGEST else 0
    return pa.table({"cell": [key[0].as_py()], "pivots": [x[chosen].ravel().tolist()], "k": [k]})


def _deal(key: tuple, nodes: pa.Table, pivots: pa.Table) -> pa.Table:
    x = _matrix(nodes["vec"])
    p = np.array(pivots["pivots"][0].as_py()).reshape(-1, x.shape[1])
    best = np.argsort(-(x @ p.T), axis=1, kind="stable")[:, :OVERLAP]
    take = pa.array(np.repeat(np.arange(len(x)), best.shape[1]))
    return pa.table({"node": nodes["node"].take(take), "m": nodes["m"].take(take), "vec": nodes["vec"].take(take), "cell": nodes["cell"].take(take), "pivot": best.ravel()})


_NODE = "node long, m long, vec array<{kind}>, cell long"


def overlapping_shards(nodes: DataFrame) -> DataFrame:
    """``(node, m, vec, cell)``: each node in every shard that it joins.

    Shards begin as all vectors of one label and length. One with over ``SHARD`` vectors is divided among pivots picked from
    about ``SAMPLE`` of its vectors; a vector joins its nearest ``OVERLAP`` pivots. A shard stays whole if its sample has too few
    pivots or most of it is near one of them, and after ``LEVELS`` divisions; such shards are searched in blocks.
    """
    kind = dict(nodes.dtypes)["vec"].removeprefix("array<").removesuffix(">")
    open_rows, done = nodes.withColumn("cell", F.xxhash64("label", F.size("vec"))).select("node", "m", "vec", "cell"), None
    for _ in range(LEVELS):
        open_rows = store(open_rows, "graph-cells")
        sizes = open_rows.groupBy("cell").agg(F.count("*").alias("n"))
        big = store(sizes.where(F.col("n") > SHARD), "graph-big")
        if big.isEmpty():
            break
        marked = open_rows.join(big, "cell").where(F.pmod(F.xxhash64(F.lit("pivot"), "node"), F.col("n")) < SAMPLE)
        pivots = marked.select("node", "vec", "cell", "n").groupBy("cell").applyInArrow(_pick_pivots, "cell long, pivots array<double>, k long")
        pivots = store(pivots.where("k > 1").join(big, "cell"), "graph-pivots")
        parts = F.ceil(F.col("n") / DEALT)
        dealt = pivots.select("cell", "pivots", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        members = open_rows.join(pivots.select("cell", "n"), "cell").withColumn("part", F.pmod(F.xxhash64("node"), parts)).drop("n")
        children = members.groupBy("cell", "part").cogroup(dealt.groupBy("cell", "part")).applyInArrow(_deal, _NODE.format(kind=kind) + ", pivot long")
        stay = open_rows.join(pivots, "cell", "left_anti").select("node", "m", "vec", "cell")
        done = stay if done is None else done.union(stay)
        open_rows = children.withColumn("cell", F.xxhash64("cell", "pivot")).select("node", "m", "vec", "cell")
    return open_rows if done is None else done.union(open_rows)


def robust_prune(x: np.ndarray, degree: int = DEGREE, slack: float = SLACK) -> np.ndarray:
    """Out-neighbours of every row of unit vectors ``x``, -1 where there are fewer than ``degree``.

    The nearest candidate left becomes a neighbour; candidates that are ``slack`` times nearer to it than to the row go.
    """
    n = len(x)
    distance = np.sqrt(np.maximum(0, 2 - 2 * (x @ x.T))).astype(np.float32)
    left = distance.copy()
    np.fill_diagonal(left, np.inf)
    out = np.full((n, degree), -1)
    rows = np.arange(n)
    for k in range(min(degree, n - 1)):
        near = left.argmin(axis=1)
        has = np.isfinite(left[rows, near])
        if not has.any():
            break
        out[has, k] = near[has]
        left[slack * distance[near] <= distance] = np.inf
        left[rows, near] = np.inf
    return out


def _build(key: tuple, table: pa.Table) -> pa.Table:
    nodes = np.asarray(table["node"])
    out = robust_prune(_matrix(table["vec"]))
    back = [[] for _ in nodes]
    for i, row in enumerate(out):
        for j in row[row >= 0]:
            back[j].append(i)
    lists = [nodes[np.unique(np.r_[row[row >= 0], np.array(b[:DEGREE], np.int64)])].tolist() for row, b in zip(out, back, strict=True)]
    return pa.table({"node": nodes, "near": pa.array(lists, pa.list_(pa.int64()))})


def range_search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of rows of ``x`` found with cosine of at least ``least``.

    A greedy search walks from the medoid to each query's surroundings; then the neighbours of all rows found in range (less
    ``MARGIN``) are visited, and theirs, until no more are in range. ``links``: boolean adjacency.
    """
    n, q = len(x), len(queries)
    medoid = int((x @ x.mean(axis=0)).argmax())
    neighbours = [np.flatnonzero(row) for row in links]
    wide = max(1, max(map(len, neighbours), default=1))
    padded = np.full((n, wide), n)
    for i, row in enumerate(neighbours):
        padded[i, : len(row)] = row
    likeness = np.full((q, n + 1), -2.0)
    seen = np.zeros((q, n + 1), bool)
    expanded = np.zeros((q, n), bool)
    likeness[:, medoid] = queries @ x[medoid]
    seen[:, medoid] = seen[:, n] = True
    active = np.arange(q)
    while len(active):
        pool = np.where(expanded[active], -3.0, likeness[active, :n])
        best = pool.argmax(axis=1)
        value = pool[np.arange(len(active)), best]
        floor = np.partition(likeness[active, :n], n - BEAM, axis=1)[:, n - BEAM] if n > BEAM else np.full(len(active), -2.0)
        go = (value > -2) & (value >= floor)
        active, best = active[go], best[go]
        expanded[active, best] = True
        new = padded[best]
        row, col = np.nonzero(~seen[active[:, None], new])
        who, what = active[row], new[row, col]
        seen[who, what] = True
        likeness[who, what] = np.einsum("ij,ij->i", queries[who], x[what])
    flow = links.astype(np.float32)
    front = likeness[:, :n] >= least - MARGIN
    while front.any():
        fresh = (front.astype(np.float32) @ flow > 0) & ~seen[:, :n]
        who, what = np.nonzero(fresh)
        for k in range(0, len(who), 100_000):
            a, b = who[k : k + 100_000], what[k : k + 100_000]
            likeness[a, b] = np.einsum("ij,ij->i", queries[a], x[b])
        seen[who, what] = True
        front = fresh & (likeness[:, :n] >= least - MARGIN)
    return np.nonzero(likeness[:, :n] >= least)


def _search(least: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        cell, low, high = (k.as_py() for k in key)
        nodes, block, m = (np.asarray(table[c]) for c in ("node", "block", "m"))
        x = _matrix(table["vec"])
        at = {v: i for i, v in enumerate(nodes.tolist())}
        links = np.zeros((len(nodes), len(nodes)), bool)
        for i, near in enumerate(table["near"].to_pylist()):
            links[i, [at[v] for v in near if v in at]] = True
        a, b = [], []
        for index, asking in {(low, high), (high, low)}:
            rows, ask = np.flatnonzero(block == index), np.flatnonzero(block == asking)
            found = range_search(x[rows], links[np.ix_(rows, rows)], x[ask], least) if len(rows) and len(ask) else ([], [])
            a.append(ask[found[0]])
            b.append(rows[found[1]])
        a, b = np.concatenate(a), np.concatenate(b)
        pair = np.unique(np.minimum(a, b)[a != b] * len(nodes) + np.maximum(a, b)[a != b])
        a, b = np.divmod(pair, len(nodes))
        # A pair that meets in several shards counts in the first of them.
        smaller = [set(c[: c.index(cell)]) for c in table["cells"].to_pylist()]
        own = np.array([smaller[i].isdisjoint(smaller[j]) for i, j in zip(a, b, strict=True)], bool) if any(smaller) else np.ones(len(a), bool)
        count = np.bincount(a[own], m[b[own]], len(nodes)) + np.bincount(b[own], m[a[own]], len(nodes))
        member, root = spanning(a, b, len(nodes))
        linked = np.flatnonzero(count)
        return pa.table(
            {
                "a": np.r_[nodes[linked], nodes[member]],
                "b": pa.array(np.r_[np.full(len(linked), -1), nodes[root]]),
                "n": np.r_[count[linked], np.zeros(len(member))].astype(np.int64),
            }
        )

    return run


def embedding_nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, nodes)``: numbered rows with the node that stands for them (null if they cannot link), and one node for
    equal vectors of a label with their number ``m``."""
    # Single precision stays so, all else is double.
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    vec = F.col("embedding").cast(f"array<{kind}>")
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(vec, lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), vec.alias("vec"), usable.alias("usable"))
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "h1": F.xxhash64("label", "vec"), "h2": F.xxhash64(F.lit("second"), "label", "vec")})
    rows = store(rows, "graph-rows")
    firsts = rows.where("usable").groupBy("h1", "h2").agg(F.min("row").alias("node"), F.count("*").alias("m"))
    firsts = store(firsts, "graph-nodes")
    nodes = firsts.join(rows.select(F.col("row").alias("node"), "label", "vec"), "node").select("node", "m", "label", "vec")
    light = rows.select("row", "vec_id", "usable", "h1", "h2")
    named = light.where("usable").join(firsts, ["h1", "h2"]).select("vec_id", "node", "m")
    none = F.lit(None).cast("long")
    return named.union(light.where("not usable").select("vec_id", none.alias("node"), none.alias("m"))), nodes


def embedding_links(nodes: DataFrame, least: float) -> DataFrame:
    """``(a, b, n)``: with b = -1 the number ``n`` of vectors linked to node a; else edges (a, b) that span the links found."""
    placed = store(overlapping_shards(nodes), "graph-placed")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / SHARD).alias("blocks"))
    placed = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")))
    graph = placed.select("cell", "block", "node", "vec").groupBy("cell", "block").applyInArrow(_build, "node long, near array<long>")
    union = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    cells = placed.groupBy("node").agg(F.sort_array(F.collect_set("cell")).alias("cells"))
    known = store(union.join(cells, "node"), "graph-union")
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = other.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    met = pairs.select("cell", "low", "high", "block", "node", "m", "vec").join(known, "node")
    return met.groupBy("cell", "low", "high").applyInArrow(_search(least), "a long, b long, n long")


def embedding_groups(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Vectors of equal, non-null label link if their cosine in double precision is at least ``least``. Vectors that are
    null, empty, all zero, or hold null or non-finite components link with nothing and are their own component, as are those whose
    label is null. Equal vectors are one node of the graph, so any number of copies costs one search;
    copies count as links of each other. Rows with equal vec_id are vectors of their own. Further columns don't matter, whatever
    their names; no rows give no rows. A pair that the graph
    search does not reach is missed (``audit_recall`` measures how many); every link reported is verified.
    """
    rows, nodes = embedding_nodes(vectors)
    found = store(embedding_links(nodes, least), "graph-found")
    counts = found.where("b = -1").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b >= 0").select("a", "b"))
    named = rows.join(counts, "node", "left").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("component", "node"))
    named = store(named.select("vec_id", "root", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(1)) - 1).alias("n_links")), "graph-named")
    lows = named.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("component_id"))
    out = named.join(lows, "root", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("component_id")))
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def audit_recall(vectors: DataFrame, found: DataFrame, least: float = 0.98, every: int = 50, block: int = 256) -> DataFrame:
    """``(vec_id, n_links, n_found)`` of the vectors whose id is divisible by ``every``: links counted against all rows of the
    label in blocks, and those in ``found``. Recall is the sum of the last over that of the middle column."""
    rows, nodes = embedding_nodes(vectors)
    asked = rows.where((F.col("vec_id") % every == 0) & F.col("node").isNotNull())
    keyed = nodes.withColumn("cell", F.xxhash64("label", F.size("vec")))
    asks = asked.select("vec_id", "node").join(keyed.drop("m"), "node").select("cell", "vec_id", "vec")
    heavy = keyed.groupBy("cell").agg(F.ceil(F.count("*") / 4096).alias("parts"))
    parts = keyed.join(heavy, "cell").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    spread = asks.join(heavy, "cell").withColumn("asked", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.select(F.col("cell").alias("at"), "asked", F.col("vec_id").alias("vec_id"), F.col("vec").alias("vec"))

    def count(key: tuple, ask: pa.Table, all_rows: pa.Table) -> pa.Table:
        if not ask.num_rows or not all_rows.num_rows:
            return pa.table({"vec_id": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        q, x, m = _matrix(ask["vec"]), _matrix(all_rows["vec"]), np.asarray(all_rows["m"])
        n = [((q[k : k + block] @ x.T >= least) * m).sum(axis=1) for k in range(0, len(q), block)]
        return pa.table({"vec_id": ask["vec_id"], "n": np.concatenate(n).astype(np.int64)})

    counted = spread.groupBy("at", "asked").cogroup(parts.groupBy("cell", "part")).applyInArrow(count, "vec_id long, n long")
    true = counted.groupBy("vec_id").agg((F.sum("n") - 1).alias("n_links"))
    return true.join(found.select("vec_id", F.col("n_links").alias("n_found")), "vec_id")


ORACLE = """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e, row_number() over () as r from embeddings
), ok as (
  select * from v where label is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
  select a.r as a, b.r as b from ok a join ok b on a.label = b.label and len(a.e) = len(b.e) and a.r <> b.r
  where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), reach as (
  select r as a, r as b from v union select reach.a, links.b from reach join links on reach.b = links.a
), lows as (
  select reach.a, min(v.vec_id) as low from reach join v on reach.b = v.r group by reach.a
), n as (select a, count(*) as n from links group by a)
select v.vec_id, cast(coalesce(n.n, 0) as bigint) as n_links, lows.low as component_id, v.vec_id = lows.low as kept
from v join lows on v.r = lows.a left join n on v.r = n.a
"""
