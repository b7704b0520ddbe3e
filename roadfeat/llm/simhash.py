"""Near-duplicate documents by SimHash fingerprints, compared bit plane by bit plane."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadfeat.llm.components import components
from roadfeat.llm.shared import store, text_batches, whole_groups

SEED = 42
#: Shingles turned to bits at once, so that a very long text needs bounded memory.
SHINGLES_AT_ONCE = 1 << 16
#: Queries compared at once with a run of lanes.
TILE = 256
#: Groups above this size are divided by further equal bits.
GROUP = 4096


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """SimHash of the shingles of ``width`` words: a bit is 1 if set in over half the shingles' XXH64 values.

    A-Z are lower-cased, words end at ASCII white space, repeats count. Fewer words than ``width``
    make one shingle; null and texts without words give 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    if len(words) < width:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[:n], ends[width - 1 :]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        pairs = zip(starts[at : at + SHINGLES_AT_ONCE].tolist(), ends[at : at + SHINGLES_AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in pairs], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), width) for t in batch["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], pa.array(prints)], ["doc_id", "text_hash", "fp"])

    return run


def part_masks(mask: int, parts: int) -> list[int]:
    """``mask`` with one further part of its free bits fixed, for each of ``parts`` parts of them."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of 64-bit values: row b holds bit b of every value, 64 values to a word."""
    lanes = -(-len(values) // 64) * 64
    padded = np.zeros(lanes, "<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8").reshape(64, lanes // 64)


def close_lanes(queries: np.ndarray, planes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, lane) of all pairs within ``radius`` differing bits, by vertical saturating counters.

    The counters of all lanes are kept in binary, one word for each digit and 64 lanes, and a plane's
    differences are added with carries. Blocks of 64 lanes are abandoned once every lane is beyond
    the radius for every query.
    """
    digits = (radius + 1).bit_length()
    blocks = np.arange(planes.shape[1])
    counts = np.zeros((digits, len(queries), len(blocks)), np.uint64)
    far = np.zeros((len(queries), len(blocks)), np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for bit in range(64):
        ones = np.where(queries >> np.uint64(bit) & np.uint64(1), full, np.uint64(0))
        carry = planes[bit, blocks][None, :] ^ ones[:, None]
        for digit in range(digits):
            counts[digit], carry = counts[digit] ^ carry, counts[digit] & carry
        far |= carry
        if bit % 8 == 7:
            beyond = far | _above(counts, radius)
            alive = (beyond != full).any(axis=0)
            if not alive.all():
                blocks, counts, far = blocks[alive], counts[:, :, alive], far[:, alive]
                if not len(blocks):
                    break
    near = ~(far | _above(counts, radius))
    rows, cols = np.nonzero(near)
    bits = np.unpackbits(near[rows, cols].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    hit, lane = np.nonzero(bits)
    return rows[hit], blocks[cols[hit]] * 64 + lane


def _above(counts: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius``."""
    greater = np.zeros_like(counts[0])
    equal = ~greater
    for digit in reversed(range(len(counts))):
        if radius >> digit & 1:
            equal = equal & counts[digit]
        else:
            greater = greater | equal & counts[digit]
            equal = equal & ~counts[digit]
    return greater


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, smallest member) with the same components as the pairs (a, b) of 0..n-1."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def _link(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "group"):
            prints = np.asarray(table["fp"]).view(np.uint64)
            group = np.unique(np.asarray(table["group"]), return_inverse=True)[1]
            first = np.searchsorted(group, group, "left")
            last = np.searchsorted(group, group, "right")
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for at in range(0, len(prints), TILE):
                to = min(at + TILE, len(prints))
                low, high = first[at], last[to - 1]
                query, lane = close_lanes(prints[at:to], bit_planes(prints[low:high]), radius)
                query, lane = query + at, lane + low
                keep = (lane < high) & (lane > query)
                query, lane = query[keep], lane[keep]
                keep = group[query] == group[lane]
                member, root = spanning(query[keep], lane[keep], len(prints))
                found_a.append(member)
                found_b.append(root)
            member, root = spanning(np.concatenate(found_a), np.concatenate(found_b), len(prints))
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[member].view(np.int64)), pa.array(prints[root].view(np.int64))], ["a", "b"]
            )

    return run


def link_fingerprints(prints: DataFrame, radius: int = 2, group_size: int = GROUP) -> DataFrame:
    """Edges ``(a, b)`` that connect all different ``fp`` within ``radius`` bits of each other.

    Of radius + 1 parts of the bits at least one is equal in such a pair, so fingerprints meet in one
    group for each part. A group of more than ``group_size`` is divided again by parts of its other
    bits, until so few bits are free that a group is small in any case. Within a group all pairs are
    compared, and a spanning forest of those found is returned instead of the pairs.
    """
    spark = prints.sparkSession
    masks, rows, out = [0], prints.select("fp", F.lit(0).cast("long").alias("mask")), None
    while True:
        children = {m: part_masks(m, radius + 1) for m in masks}
        signed = lambda m: m - (1 << 64) if m >> 63 else m
        next_masks = F.create_map(
            *[x for m, c in children.items() for x in (F.lit(signed(m)).cast("long"), F.array(*[F.lit(signed(k)).cast("long") for k in c]))]
        )
        rows = rows.select("fp", F.explode(next_masks[F.col("mask")]).alias("mask")).withColumn(
            "value", F.col("fp").bitwiseAND(F.col("mask"))
        )
        masks = [k for c in children.values() for k in c]
        free = 64 - min(m.bit_count() for m in masks)
        sizes = store(rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1"), "simhash-groups")
        last = 1 << free <= group_size or free <= radius
        small = rows.join(sizes if last else sizes.where(F.col("n") <= group_size), ["mask", "value"])
        keyed = small.select("fp", F.xxhash64("mask", "value").alias("group"))
        edges = keyed.repartition("group").sortWithinPartitions("group").mapInArrow(_link(radius), "a long, b long")
        out = edges if out is None else out.union(edges)
        hot = sizes.where(F.col("n") > group_size)
        if last or hot.isEmpty():
            return out
        rows = store(rows.join(hot, ["mask", "value"]).select("fp", "mask"), "simhash-hot")


def simhash_groups(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row: its fingerprint and the smallest doc_id it is linked to.

    Documents link if their fingerprints differ in at most ``radius`` bits; links chain. Null and
    empty texts have fingerprint 0 and link like any other. Rows with equal fingerprints are one node,
    so thousands of copies cost one comparison. Repeated rows stay; a row whose doc_id is null has the
    smallest non-null doc_id of its group as component (null if there is none).
    """
    prints, named = _prints_and_roots(docs, width, radius)
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(named.join(lows, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _prints_and_roots(docs: DataFrame, width: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, text_hash, fp)``, and the different fingerprints ``(fp, low, root)`` with their smallest doc_id and the
    fingerprint that names their group."""
    text = F.col("text")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    prints = store(text_batches(base).mapInArrow(_fingerprints(width), "doc_id long, text_hash long, fp long"), "simhash-prints")
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    roots = components(link_fingerprints(nodes, radius)).select(F.col("node").alias("fp"), "component")
    return prints, nodes.join(roots, "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))


def one_of_each_group(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row of the smallest doc_id stays, null last, then of the
    smallest text hash; of rows with equal doc_id and text one stays."""
    prints, named = _prints_and_roots(docs, width, radius)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    chosen = prints.join(named.select("fp", "root"), "fp").groupBy("root").agg(first.alias("x")).select("x.doc_id", "x.text_hash")
    rows = prints.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    chosen = store(chosen.alias("a").join(rows.alias("b"), same).select("a.doc_id", "a.text_hash", "rows"), "simhash-chosen")
    named_docs = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))

    def among(ids: DataFrame) -> DataFrame:
        return named_docs.join(ids, doc_id.cast("long").eqNullSafe(ids.doc_id) & (F.xxhash64(text) == ids.text_hash), "left_semi")

    kept = among(chosen.where("rows = 1"))
    repeated = chosen.where("rows > 1")
    if not repeated.isEmpty():
        kept = kept.union(among(repeated).dropDuplicates([f"c{docs.columns.index(c)}" for c in ("doc_id", "text")]))
    return kept.toDF(*docs.columns)
