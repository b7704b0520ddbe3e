"""Merkle manifest of a dataset: trees of hashes in a postorder log, proofs by closed-form positions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadfeat.llm.shared import store
from roadfeat.operators.ranking import with_starts

#: Consecutive nodes that make a parent.
RUN = 3
#: Levels that one aligned builder makes; it holds RUN ** LEVELS nodes of its lowest level.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOG = "tree string, n long, level int, at long, position long, hash string, is_root boolean"
_PATH = "tree string, at long, n long, doc_id long, hash string, path string, subroot string"
_ANSWER = "tree string, at long, doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
_OUT_ROWS = 2_000


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def subtree_size(level: int) -> int:
    """Nodes of a complete subtree."""
    return (RUN ** (level + 1) - 1) // (RUN - 1)


def position(level: int, at: int, n: int) -> int:
    """Place of a node in the log of a tree with ``n`` leaves; a node is written as soon as its last leaf is.

    A complete node follows all nodes that ended before its last leaf e, which are e leaves and e // RUN ** k nodes of each
    level k, and the ``level`` nodes that end with it. That place never changes when leaves are appended. Incomplete nodes,
    at most one on a level, are written last, from the lowest level up.
    """
    width = RUN**level
    if (at + 1) * width <= n:
        last, place = (at + 1) * width - 1, level
        while last:
            place, last = place + last, last // RUN
        return place
    place, left = 0, n
    while left:
        place, left = place + left, left // RUN
    return place + sum(1 for k in range(1, level) if n % RUN**k)


def digest_of(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def fold(leaf: str, pieces: list[str]) -> str:
    """The root from a leaf and, for each level, its place in its run and its siblings' hashes."""
    for piece in pieces:
        cut = 1 + 64 * int(piece[0])
        leaf = sha256((piece[1:cut] + leaf + piece[cut:]).encode()).hexdigest()
    return leaf


def leaf_hash(text: Column | None = None) -> Column:
    """Hash of a row: each of the five fields as '-' if null, else its byte count, ':' and its value."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    values = [F.col(c) if c != "text" or text is None else text for c in FIELDS]
    return F.sha2(F.concat(*map(field, values)), 256)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of batches sorted by their first two columns, by the values of these."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    return groupby(rows, key=lambda r: r[:2])


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    for row in rows:
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def _builder(base: int, levels: int):
    """Aligned builders: nodes of level ``base`` in blocks of RUN ** levels become the levels above, in log order."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (tree, _), rows in _grouped(batches):
            block = [(at, n, h) for _, _, at, n, h in rows]
            first, n = block[0][0], block[0][1]
            top, made, now = min(base + levels, height(n)), [], [h for _, _, h in block]
            if base == 0:
                made = [(position(0, first + i, n), 0, first + i, h) for i, h in enumerate(now)]
            for level in range(base + 1, top + 1):
                now, first = [digest_of(now[i : i + RUN]) for i in range(0, len(now), RUN)], first // RUN
                made += [(position(level, first + i, n), level, first + i, h) for i, h in enumerate(now)]
            for place, level, at, h in sorted(made):
                yield tree, n, level, at, place, h, level == height(n)

    return lambda batches: _batches(nodes(batches), _LOG)


def _blocks(df: DataFrame, levels: int, *then: str) -> DataFrame:
    """Rows dealt to builders: all rows of an aligned block, and only those, meet in order."""
    return df.repartition("tree", "block").sortWithinPartitions("tree", "block", *then)


@dataclass
class Forest:
    """Trees of one kind. ``leaves``: (tree, at, n, doc_id, hash, claimed). ``rounds``: the log, in tables of ``levels`` levels."""

    leaves: DataFrame
    rounds: list[DataFrame]
    levels: int

    @classmethod
    def build(cls, leaves: DataFrame, levels: int) -> Forest:
        """Builders of round r work on the nodes that end a block of round r - 1, until all trees have one node."""
        width = RUN**levels
        largest = leaves.agg(F.max("n")).first()[0] or 0
        rounds: list[DataFrame] = []
        for r in range(max(1, -(-height(largest) // levels))):
            below = leaves if r == 0 else cls._ends(rounds[-1], r * levels)
            dealt = below.select("tree", F.floor(F.col("at") / width).alias("block"), "at", "n", "hash")
            rounds.append(store(_blocks(dealt, levels, "at").mapInArrow(_builder(r * levels, levels), _LOG), f"merkle-{r}"))
        return cls(leaves, rounds, levels)

    @staticmethod
    def _ends(nodes: DataFrame, level: int) -> DataFrame:
        """The nodes of a level that have a parent."""
        return nodes.where((F.col("level") == level) & ~F.col("is_root"))

    def log(self) -> DataFrame:
        """Every node: tree, leaves of the tree, level, index in the level, position in the tree's log, hash."""
        return reduce(DataFrame.union, self.rounds)

    def roots(self) -> DataFrame:
        return self.log().where("is_root").select("tree", "n", "hash")

    def paths(self, crowns: DataFrame, root: str | None = None) -> DataFrame:
        """For each leaf the way to the top; ``crowns`` has (tree, n, path, subroot), what follows above each tree's root.

        From the top round down, a block's builder gets the path of its root, the block's part of the log and the
        nodes that ask; it addresses siblings by their positions. So a path is put together from parts that
        whole blocks share and no sibling is joined to a leaf. With ``root``, paths are folded at once and only
        digests leave the task.
        """
        width = RUN**self.levels
        nothing = F.lit(None)
        none, no_id = nothing.cast("string"), nothing.cast("long")

        def rows(df: DataFrame, kind: int, block: Column, at, place, doc_id, claimed, path, subroot) -> DataFrame:  # noqa: ANN001
            named = {"kind": F.lit(kind), "at": at, "n": F.col("n"), "position": place, "hash": F.col("hash"), "doc_id": doc_id, "claimed": claimed, "path": path, "subroot": subroot}
            return df.select("tree", block.cast("long").alias("block"), *[c.alias(k) for k, c in named.items()])

        asked: DataFrame | None = None
        for r in reversed(range(len(self.rounds))):
            base = r * self.levels
            # Trees that end in this round: their height is above base (or they end in round 0) and at most base + levels.
            least, most = (0 if r == 0 else RUN**base), RUN ** (base + self.levels)
            ending = crowns.where((F.col("n") > least) & (F.col("n") <= most)).withColumn("hash", none)
            inputs = rows(ending, 0, F.lit(0), no_id, no_id, no_id, none, F.col("path"), F.col("subroot"))
            if asked is not None:
                inputs = inputs.union(rows(asked, 0, F.col("at"), no_id, no_id, no_id, none, F.col("path"), F.col("subroot")))
            own = self.rounds[r]
            # Index, in its level, of the block a node belongs to; the highest level of a block is its own root.
            shift = F.pow(F.lit(float(RUN)), (base + self.levels - F.col("level")).cast("double"))
            inputs = inputs.union(rows(own, 1, F.floor(F.col("at") / shift), no_id, F.col("position"), no_id, none, none, none))
            below = F.floor(F.col("at") / width)
            if r == 0:
                asking = rows(self.leaves, 2, below, F.col("at"), no_id, F.col("doc_id"), F.col("claimed"), none, none)
            else:
                ends = self._ends(self.rounds[r - 1], base)
                inputs = inputs.union(rows(ends, 1, below, no_id, F.col("position"), no_id, none, none, none))
                asking = rows(ends, 2, below, F.col("at"), no_id, no_id, none, none, none)
            task = _answers(base, self.levels, root if r == 0 else None)
            found = _blocks(inputs.union(asking), self.levels, "kind").mapInArrow(task, _ANSWER if r == 0 and root else _PATH)
            asked = found if r == 0 else store(found, f"merkle-paths-{r}")
        return asked


def _answers(base: int, levels: int, root: str | None):
    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (tree, _), rows in _grouped(batches):
            nodes: dict[int, str] = {}
            runs: dict[tuple[int, int], list[str]] = {}
            upper: list[str] = []
            top_hash = None

            def piece(level: int, at: int, n: int, nodes=nodes, runs=runs) -> str:
                run, place = divmod(at, RUN)
                if (level, run) not in runs:
                    last = min(RUN * run + RUN, -(-n // RUN**level))
                    runs[level, run] = [nodes[position(level, i, n)] for i in range(RUN * run, last)]
                found = runs[level, run]
                return str(place) + "".join(found[:place] + found[place + 1 :])

            for _, _, kind, at, n, place, h, doc_id, claimed, path, subroot in rows:
                if kind == 0:
                    upper, top_hash = path.split(",") if path else [], subroot
                elif kind == 1:
                    nodes[place] = h
                else:
                    top = min(base + levels, height(n))
                    pieces = [piece(level, at // RUN ** (level - base), n) for level in range(base, top)] + upper
                    if root is None:
                        yield tree, at, n, doc_id, h, ",".join(pieces), top_hash
                    else:
                        proof = sha256("".join([p[1:] for p in pieces]).encode()).hexdigest()
                        yield tree, at, doc_id, h, top_hash, proof, fold(claimed, pieces)

    return lambda batches: _batches(answers(batches), _PATH if root is None else _ANSWER)


@dataclass
class Manifest:
    """``sources``: one tree for each source. ``top``: one tree over their roots. ``root``: its root, None without rows."""

    sources: Forest
    top: Forest
    root: str | None

    def crowns(self) -> DataFrame:
        """(tree, n, path, subroot): from each source's root to the top."""
        none = self.top.roots().select("tree", "n", F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"))
        found = self.top.paths(none)
        sizes = self.top.leaves.select("at", F.col("source").alias("_source"), F.col("size").alias("_size"))
        return found.join(sizes, "at").select(F.col("_source").alias("tree"), F.col("_size").alias("n"), "path", F.col("hash").alias("subroot"))

    def proofs(self) -> DataFrame:
        """Every leaf with its whole path: for each level a digit (place in its run) and its siblings' hashes, comma between levels."""
        return self.sources.paths(store(self.crowns(), "merkle-crowns"))

    def verify(self) -> DataFrame:
        """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``: every row's claimed leaf against its proof."""
        if self.root is None:
            empty = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
            return self.sources.leaves.sparkSession.createDataFrame([], empty)
        found = self.sources.paths(store(self.crowns(), "merkle-crowns"), self.root)
        root = F.lit(self.root)
        return found.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def build_manifest(docs: DataFrame, claimed_text: Column | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of the five fields of ``docs``; ``claimed_text`` is the text to verify against it (default: the same).

    Leaves of a source stand in order of ``doc_id``, null first, then of their hashes, so the manifest doesn't depend on how
    the table is split. A null source is a source; null fields are told from empty ones; repeated rows are leaves of their
    own; texts are hashed whole; further columns don't count, whatever their names; no rows make no root. A source may
    hold any share of the rows: its leaves are numbered by ranges and built in blocks of RUN ** levels.
    """
    fields = docs.select(*[F.col(f"`{c}`") for c in FIELDS])
    leaf = leaf_hash()
    claimed = leaf if claimed_text is None else F.coalesce(leaf_hash(claimed_text), leaf)
    base = fields.select(F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("hash"), claimed.alias("claimed"))
    hashed = store(base, "merkle-rows")
    leaves = store(with_starts(hashed, ["tree"], ["doc_id", "hash"], {"at": None}, "n"), "merkle-leaves")
    sources = Forest.build(leaves, levels)
    subroots = store(sources.roots(), "merkle-subroots").select(F.col("tree").alias("source"), F.col("n").alias("size"), "hash")
    ranked = with_starts(subroots, [], ["source"], {"at": None}, "n")
    unset = {"tree": F.lit(""), "doc_id": F.lit(None).cast("long"), "claimed": F.lit(None).cast("string")}
    top = Forest.build(store(ranked.withColumns(unset), "merkle-top"), levels)
    found = top.roots().first()
    return Manifest(sources, top, found["hash"] if found else None)


def tampered_text() -> Column:
    """The text without line feeds where the checksum of the decimal ``doc_id`` is even, else as it is."""
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def merkle_oracle() -> str:
    """DuckDB SQL for the query's rows: levels by recursion, proofs and folding by joins on indexes."""
    field = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
    fields = lambda text: " || ".join(field.format(c if c != "text" else text) for c in FIELDS)
    crc_step = "lambda c, i: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end"
    byte_step = f"lambda c, x: list_reduce([xor(c, x), 1, 2, 3, 4, 5, 6, 7, 8], {crc_step})"
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), {byte_step}), 4294967295)"
    width = lambda level: f"({RUN} ** ({level}))::bigint"
    # One level up: consecutive nodes of a run become one.
    above = f"level + 1, i // {RUN}, sha256(string_agg(h, '' order by i)), (n + {RUN - 1}) // {RUN}"

    def siblings(leaf: str, level: str) -> str:
        own = f"{leaf}.i // {width(level)}"
        return f"string_agg(e.h, '' order by e.i) filter (e.i < {own}) as before, string_agg(e.h, '' order by e.i) filter (e.i > {own}) as after"

    return f"""
with recursive rows as (select *, case when {crc} % 2 = 0 then replace(text, chr(10), '') else text end as changed from documents),
hashed as (select doc_id, source, sha256({fields("text")}) as leaf, sha256({fields("changed")}) as claimed from rows),
leaves as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
    count(*) over (partition by source) as n from hashed),
nodes(source, level, i, h, n) as (select source, 0, i, leaf, n from leaves
    union all select source, {above} from nodes where n > 1 group by source, level, i // {RUN}, n),
subroots as (select source, h, row_number() over (order by source nulls first) - 1 as i, count(*) over () as n from nodes where n = 1),
tops(level, i, h, n) as (select 0, i, h, n from subroots
    union all select {above} from tops where n > 1 group by level, i // {RUN}, n),
heights as (select source, max(level) as top from nodes group by source),
steps as (
    select l.source, l.i, e.level, {siblings("l", "e.level")}
    from leaves l join nodes e on e.source is not distinct from l.source and e.n > 1
        and e.i // {RUN} = l.i // {width("e.level")} // {RUN}
    group by all
    union all
    select l.source, l.i, x.top + e.level, {siblings("s", "e.level")}
    from leaves l join heights x on l.source is not distinct from x.source join subroots s on s.source is not distinct from l.source
        join tops e on e.n > 1 and e.i // {RUN} = s.i // {width("e.level")} // {RUN}
    group by all),
folded(source, i, level, h) as (select source, i, 0, claimed from leaves
    union all select f.source, f.i, f.level + 1, sha256(coalesce(before, '') || h || coalesce(after, ''))
    from folded f join steps s on s.source is not distinct from f.source and s.i = f.i and s.level = f.level),
ends as (select source, i, arg_max(h, level) as folded_root from folded group by all),
proofs as (select source, i, sha256(string_agg(coalesce(before, '') || coalesce(after, ''), '' order by level)) as proof from steps group by all),
root as (select h from tops where n = 1)
select l.doc_id, l.leaf, s.h as subroot, r.h as root, coalesce(p.proof, sha256('')) as proof_sha256, f.folded_root, f.folded_root = r.h as verified
from leaves l join subroots s on s.source is not distinct from l.source join ends f on f.source is not distinct from l.source and f.i = l.i
    left join proofs p on p.source is not distinct from l.source and p.i = l.i, root r
"""
