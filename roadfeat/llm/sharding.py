"""Sharding by a hierarchical weighted hash tree: region, rack and shard are drawn level by level from the key."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadfeat.llm.shared import new_path
from roadfeat.operators.ranking import in_order, starts

#: Bytes of texts and rows of one range partition of the shards' writer.
PART_BYTES, PART_ROWS = 128 << 20, 1_000_000
#: Hexadecimal digits of a draw; 52 bits are exact in a double.
DIGITS = 13


@dataclass(frozen=True)
class Leaf:
    """A shard, the named subtrees that hold it from the top down, and its weight."""

    path: tuple[str, ...]
    shard: int
    weight: float = 1.0

    @property
    def name(self) -> str:
        return "/".join((*self.path, f"shard{self.shard}"))


@dataclass(frozen=True)
class Topology:
    """The tree as its leaves. A subtree weighs what its leaves weigh together.

    At every node each child draws a number from the key and its own full name, and the child with the least
    -ln(draw) / weight takes the key. A child's draw doesn't depend on its siblings, so a changed weight moves keys
    only into or out of the subtrees on its path: a heavier subtree only takes, a lighter one only gives.
    """

    leaves: tuple[Leaf, ...]

    def __post_init__(self) -> None:
        names = [leaf.name for leaf in self.leaves]
        if not names or len(set(names)) < len(names) or len({leaf.shard for leaf in self.leaves}) < len(names):
            raise ValueError("a topology needs leaves with shards of their own")
        if any(not leaf.weight > 0 for leaf in self.leaves):
            raise ValueError("weights must be positive")
        if {"/".join(leaf.path[:i]) for leaf in self.leaves for i in range(1, len(leaf.path) + 1)} & set(names):
            raise ValueError("a shard can't hold others")

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> Topology:
        """``regions`` x ``racks`` x ``shards`` leaves of equal weight, numbered from 0."""
        paths = [(f"region{r}", f"rack{r * racks + k}") for r in range(regions) for k in range(racks) for _ in range(shards)]
        return cls(tuple(Leaf(path, shard) for shard, path in enumerate(paths)))

    def grown(self, weight: float = 1.0) -> Topology:
        """With one more shard, as a region of its own below the root.

        Below an old region, the keys that its greater weight draws in would be dealt to all of its shards. As a subtree of the
        root the new shard takes keys only into itself, and no key moves between old shards, at any size.
        """
        shard = max(leaf.shard for leaf in self.leaves) + 1
        regions = {leaf.path[0] for leaf in self.leaves if leaf.path}
        new = next(f"region{i}" for i in range(len(regions) + 1) if f"region{i}" not in regions)
        return Topology((*self.leaves, Leaf((new, f"rack-of-{new}"), shard, weight)))

    def reweighted(self, shard: int, weight: float) -> Topology:
        return Topology(tuple(Leaf(x.path, x.shard, weight if x.shard == shard else x.weight) for x in self.leaves))

    def children(self) -> dict[str, dict[str, float]]:
        """Of every inner node by full name (the root is ''), its children's full names and weights."""
        found: dict[str, dict[str, float]] = {}
        for leaf in self.leaves:
            steps = leaf.name.split("/")
            for i in range(len(steps)):
                below = found.setdefault("/".join(steps[:i]), {})
                name = "/".join(steps[: i + 1])
                below[name] = below.get(name, 0.0) + leaf.weight
        return found

    def place(self, key: Column) -> Column:
        """The full name of the leaf that takes ``key`` (a string column); the topology is a literal of the plan."""
        inner = self.children()
        deepest = max(leaf.name.count("/") for leaf in self.leaves) + 1
        options = F.create_map(
            *[x for name, below in inner.items() for x in (F.lit(name), F.array(*[
                F.struct(F.lit(c).alias("name"), F.lit(w).alias("weight")) for c, w in sorted(below.items())
            ]))]
        )

        def draw(child: Column) -> Column:
            digits = F.substring(F.md5(F.concat(key, F.lit("@"), child["name"])), 1, DIGITS)
            uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**DIGITS))
            return F.struct((-F.ln(uniform) / child["weight"]).alias("score"), child["name"].alias("name"))

        def descend(node: Column, _level: Column) -> Column:
            below = F.try_element_at(options, node)
            return F.when(below.isNull(), node).otherwise(F.array_min(F.transform(below, draw))["name"])

        return F.aggregate(F.array(*map(F.lit, range(deepest))), F.lit(""), descend)


def shard_of(leaf: Column) -> Column:
    return F.regexp_extract(leaf, r"shard(\d+)$", 1).cast("int")


def placed(docs: DataFrame, topology: Topology, grown: Topology | None = None) -> DataFrame:
    """``docs`` with ``_place``: a struct of leaf (full name), shard and grown_shard.

    The key is the decimal ``doc_id``; a null one has the key '-'. Rows with equal ``doc_id`` share a shard; texts have no
    say. Other columns stay as they are, whatever their names.
    """
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-"))
    leaf = topology.place(key)
    more = F.lit(None).cast("int") if grown is None else shard_of(grown.place(key))
    return docs.withColumn("_place", F.struct(leaf.alias("leaf"), shard_of(leaf).alias("shard"), more.alias("grown_shard")))


@dataclass
class Shards:
    """Where the shards were written, and ``rows``: every row read back with its ``slot``."""

    path: str
    rows: DataFrame

    def shard(self, number: int) -> DataFrame:
        """The rows of one shard in slot order; only its folder is read."""
        return self.rows.where(F.col("shard") == number).orderBy("slot")


def write_shards(docs: DataFrame, topology: Topology, grown: Topology | None = None, path: str | None = None) -> Shards:
    """Write whole documents into a Parquet folder for each shard, in slot order, and read them back.

    A row keeps its columns in the struct ``doc``, so that no name of theirs clashes with ``leaf, shard, slot,
    grown_shard``. Slots count a shard's rows from 0 by (doc_id, text hash); rows equal in both stand in any order. The texts
    are shuffled once, by range of (shard, doc_id): a shard is as many tasks as its size needs, and one
    ``doc_id`` with many rows is spread too. Null texts, empty texts and repeated rows are rows like others, a null
    ``doc_id`` comes first; a text is whole in its row however long; no rows give no shards.
    """
    spark = docs.sparkSession
    n_rows, n_bytes = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n_rows // PART_ROWS), -(-n_bytes // PART_BYTES), min(n_rows // 1000 + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = placed(docs, topology, grown).select(
        "_place.shard",
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64("text").alias("_hash"),
        "_place.leaf",
        "_place.grown_shard",
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    )
    path = path or new_path(spark, "shards")
    ranged = in_order(rows, ["shard"], ["_id", "_hash"], parts).drop("_id", "_hash")
    ranged.write.partitionBy("shard").parquet(path)
    schema = ranged.schema
    written = spark.read.schema(schema).parquet(path)
    return Shards(path, starts(written, ["shard"], {"slot": None}))


def sharding_oracle(topology: Topology, grown: Topology) -> str:
    """DuckDB SQL for the query's rows: the same draws, one level after the other, and the checksum byte by byte."""

    def nodes(tree: Topology) -> str:
        listed = [(parent, name, weight) for parent, below in tree.children().items() for name, weight in below.items()]
        return ", ".join(f"('{parent}', '{name}', {weight!r}::double)" for parent, name, weight in listed)

    def descent(tree: Topology, label: str) -> str:
        levels = max(leaf.name.count("/") for leaf in tree.leaves) + 1
        steps = [f"{label}_nodes(parent, name, weight) as (values {nodes(tree)})", f"{label}_0 as (select key, '' as node from keys)"]
        for i in range(levels):
            score = f"-ln((('0x' || substr(md5(key || '@' || name), 1, {DIGITS}))::bigint::double + 0.5) / {16**DIGITS}.0::double) / weight"
            steps.append(
                f"{label}_{i + 1} as (select key, arg_min(name, {score}) as node from {label}_{i} join {label}_nodes on parent = node group by key)"
            )
        return ", ".join(steps) + f", {label} as (select key, node, regexp_extract(node, 'shard(\\d+)$', 1)::int as shard from {label}_{levels})"

    return f"""
with docs as (select *, coalesce(doc_id::varchar, '-') as key, coalesce(text, '') as body from documents),
keys as (select distinct key from docs),
{descent(topology, "now")}, {descent(grown, "later")},
bits(k) as (select unnest(range(256))),
crcs as (select list(list_reduce([k, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, i: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by k) as t from bits),
bytes as (select body, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::bigint) as b
    from (select distinct body from docs)),
sums as (select body, xor(list_reduce(list_prepend(4294967295::bigint, b),
    lambda c, x: xor(t[1 + (xor(c, x) & 255)], c >> 8)), 4294967295) as crc from bytes, crcs)
select d.doc_id, strlen(d.body) + 1 as size, s.crc as text_crc32, 'key' as law, n.shard as shard,
    row_number() over (partition by n.shard order by d.doc_id) - 1 as slot, l.shard as grown_shard,
    split_part(n.node, '/', 1) as region, split_part(n.node, '/', 2) as rack
from docs d join sums s on s.body = d.body join now n on n.key = d.key join later l on l.key = d.key
"""


def digest(rows: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack)`` of rows of ``Shards``."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    return rows.select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
        F.split_part("leaf", F.lit("/"), F.lit(1)).alias("region"),
        F.split_part("leaf", F.lit("/"), F.lit(2)).alias("rack"),
        *extra,
    )
