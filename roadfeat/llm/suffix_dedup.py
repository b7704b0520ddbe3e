"""Exact removal of long repeated byte strings, by a logarithmic family of sparse suffix arrays.

Sampled suffixes stand for all: of every window of ``LENGTH`` bytes the suffix whose first ``HEAD`` bytes have
the smallest hash is sampled, so equal windows sample the suffix at the same place of theirs. A
suffix array is a table of sampled suffixes sorted by the 64-bit fingerprint of their head; suffixes that agree
for ``HEAD`` bytes are neighbours. Each batch of documents gets such an array, which is merge-scanned against
every level of the family for heads that occur in both; levels of equal size are merged before the next batch.
What the scans find is then compared byte window by byte window around the sampled suffix.
"""

from __future__ import annotations

import gc
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadfeat.llm.shared import discard, give_back, new_path, store, text_batches, whole_groups

#: Bytes of a string that may not occur twice.
LENGTH = 200
#: Bytes of a sampled suffix that are fingerprinted for the scans.
HEAD = 48
#: Windows of ``LENGTH`` bytes that hold one sampled suffix: it starts at one of so many places.
PLACES = LENGTH - HEAD + 1
#: Batches that a table is divided into.
BATCHES = 4
#: A head with more different surroundings than this is compared window by window in many tasks.
VARIANTS = 20_000

_CHUNK = 1 << 17
_MASK = np.uint64((1 << 18) - 1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.cumprod(np.full(n - 1, base, np.uint64))
    return out


_POWER = _powers(_BASE, _CHUNK + LENGTH)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), _CHUNK + LENGTH)
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every string of ``width`` bytes, along the last axis."""
    n = data.shape[-1]
    sums = np.zeros((*data.shape[:-1], n + 1), np.uint64)
    np.cumsum(_BYTE[data] * _POWER[:n], axis=-1, out=sums[..., 1:])
    return _mix((sums[..., width:] - sums[..., :-width]) * _INVERSE[: n - width + 1])


def _sampled(heads: np.ndarray) -> np.ndarray:
    """For every window the place of its smallest head, the last one on ties."""
    order = np.arange(len(heads), 0, -1).astype(np.uint64)
    low, span = heads & ~_MASK | order, 1
    while 2 * span <= PLACES:
        low, span = np.minimum(low[:-span], low[span:]), 2 * span
    low = np.minimum(low[: len(low) - (PLACES - span)], low[PLACES - span :])
    return len(heads) - (low & _MASK).astype(np.int64)


def _chunks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, len(data) - LENGTH + 1, _CHUNK - LENGTH):
        yield at, data[at : at + _CHUNK - 1]


def spans_of(starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the runs covered by strings of ``length`` that begin at the sorted ``starts``."""
    if not len(starts):
        return starts, starts
    new = np.flatnonzero(np.diff(starts) > length) + 1
    return starts[np.r_[0, new]], starts[np.r_[new - 1, len(starts) - 1]] + length


def suffixes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and head fingerprints of a text's sampled suffixes, and the starts of its windows that it repeats itself.

    In a text with many equal heads (periodic text has one at every byte) all windows are compared at once,
    and only the suffixes of windows seen first are sampled: the others are repeats in any case.
    """
    data = np.frombuffer(text, np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none.astype(np.uint64), none
    places, prints = [], []
    for at, chunk in _chunks(data):
        heads = _window_hashes(chunk, HEAD)
        found = np.unique(_sampled(heads))
        places.append(found + at)
        prints.append(heads[found])
    place, first = np.unique(np.concatenate(places), return_index=True)
    prints = np.concatenate(prints)[first]
    if len(place) - len(np.unique(prints)) <= 8:
        return place, prints, none
    windows = np.concatenate([_window_hashes(chunk, LENGTH) for _, chunk in _chunks(data)])
    starts = np.concatenate([np.arange(at, at + len(chunk) - LENGTH + 1) for at, chunk in _chunks(data)])
    starts, once = np.unique(starts, return_index=True)
    _, seen, which, n = np.unique(windows[once], return_index=True, return_inverse=True, return_counts=True)
    chosen = np.zeros(len(starts), bool)
    chosen[seen] = True
    places = []
    for at, chunk in _chunks(data):
        sampled = _sampled(_window_hashes(chunk, HEAD))
        places.append(sampled[chosen[at : at + len(sampled)]] + at)
    keep = np.isin(place, np.concatenate(places))
    return place[keep], prints[keep], starts[n[which] > 1]


def _array_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            batch = whole.slice(at, 200)
            rows: list[list[np.ndarray]] = [[], [], [], []]
            for ref, number, text in zip(batch["ref"].to_pylist(), batch["batch"].to_pylist(), batch["text"], strict=True):
                place, prints, own = suffixes(text.as_py())
                low, high = spans_of(own)
                rows[0].append(np.concatenate([prints.view(np.int64), high]))
                rows[1].append(np.full(len(place) + len(low), ref))
                rows[2].append(np.concatenate([place, low]))
                rows[3].append(np.repeat([number, -1], [len(place), len(low)]))
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in rows]
            yield pa.RecordBatch.from_arrays(columns, ["head", "ref", "place", "batch"])
    give_back()


def _bucketed(df: DataFrame, buckets: int, label: str, *partition: str) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed and sorted by head, so that scans of two tables move no rows."""
    spark = df.sparkSession
    name, path = f"{label}_{uuid.uuid4().hex}", new_path(spark, label)
    writer = df.repartition(buckets, "head").write.bucketBy(buckets, "head").sortBy("head").option("path", path)
    (writer.partitionBy(*partition) if partition else writer).saveAsTable(name)
    out = spark.table(name)
    out._stored_at = path
    return out


class SuffixFamily:
    """Suffix arrays of sizes in geometric order; ``repeated`` gathers heads that occur at two places."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.levels: list[tuple[int, DataFrame]] = []
        self.repeated: list[DataFrame] = []

    def add(self, array: DataFrame) -> None:
        """Take in a batch's suffix array ``(head, ref, place)``, bucketed by head: merge what is due, then scan every level."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((rank + 1, _bucketed(a.unionByName(b), self.buckets, "suffix_level")))
        at = F.struct("ref", "place")
        heads = array.groupBy("head").agg((F.min(at) != F.max(at)).alias("twice"))
        found = heads.where("twice").select("head")
        for _, level in self.levels:
            found = found.union(heads.select("head").join(level.select("head"), "head", "left_semi"))
        self.repeated.append(store(found, "suffix-heads"))
        self.levels.append((0, array))

    def matches(self) -> DataFrame:
        """All sampled suffixes ``(head, ref, place)`` whose head occurs at another place too."""
        heads = self.repeated[0]
        for more in self.repeated[1:]:
            heads = heads.union(more)
        heads = store(heads.distinct(), "suffix-heads")
        out = None
        for _, level in self.levels:
            part = level.select("head", "ref", "place").join(heads, "head", "left_semi")
            out = part if out is None else out.union(part)
        return out


def _around(text: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of bytes around the places, and the bytes that there are before and from each, as far as windows reach."""
    data = np.frombuffer(text, np.uint8)
    padded = np.zeros(len(data) + 2 * LENGTH, np.uint8)
    padded[LENGTH:-LENGTH] = data
    index = places[:, None] + np.arange(LENGTH - PLACES + 1, 2 * LENGTH)[None, :]
    return padded[index], np.minimum(places, PLACES - 1), np.minimum(len(data) - places, LENGTH)


def _surroundings(with_bytes: bool):
    """Rows ``head, variant, ref, place, before, after`` for each text's places; with the bytes themselves too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ref, text, at in zip(batch["ref"], batch["text"], batch["at"], strict=True):
                text, ref = text.as_py(), ref.as_py()
                places = np.asarray(at.values.field("place"))
                heads = np.asarray(at.values.field("head"))
                for k in range(0, len(places), 4096):
                    rows, before, after = _around(text, places[k : k + 4096])
                    variant = _mix((_BYTE[rows] * _POWER[: rows.shape[1]]).sum(axis=1) + (before * 1_000 + after).astype(np.uint64))
                    columns = [heads[k : k + 4096], variant.view(np.int64), np.full(len(rows), ref), places[k : k + 4096], before, after]
                    columns = [pa.array(c) for c in columns]
                    names = ["head", "variant", "ref", "place", "before", "after"]
                    if with_bytes:
                        columns.append(pa.array([r.tobytes() for r in rows], pa.binary()))
                        names.append("bytes")
                    yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    return run


def _variant_windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window over the head, by place in the surroundings, and whether the text has it."""
    n = table.num_rows
    width = PLACES - 1 + LENGTH
    raw = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8).reshape(n, width)
    found = np.concatenate([_window_hashes(raw[k : k + 512], LENGTH) for k in range(0, n, 512)])
    head = np.asarray(table["head"]).view(np.uint64)
    place = np.arange(PLACES, dtype=np.uint64)
    found = _mix(found ^ _mix(head[:, None] + place[None, :] * np.uint64(_BASE)))
    back = PLACES - 1 - np.arange(PLACES)
    real = (back[None, :] <= np.asarray(table["before"])[:, None]) & (LENGTH - back[None, :] <= np.asarray(table["after"])[:, None])
    return found, real


def _run_rows(table: pa.Table, again: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``head, variant, low, high`` for each run of repeated windows, relative to the place of the head."""
    edge = np.zeros((len(again), 1), bool)
    step = np.diff(np.concatenate([edge, again, edge], axis=1).astype(np.int8), axis=1)
    row, first = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    take = pa.array(row)
    columns = [table["head"].take(take).combine_chunks(), table["variant"].take(take).combine_chunks()]
    columns += [pa.array(first - (PLACES - 1)), pa.array(end - PLACES + LENGTH)]
    yield pa.RecordBatch.from_arrays(columns, ["head", "variant", "low", "high"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, "head"):
        found, real = _variant_windows(table)
        values = found[real]
        order = np.sort(values)
        twice = np.unique(order[1:][order[1:] == order[:-1]])
        again = np.zeros(real.shape, bool)
        at = np.searchsorted(twice, values)
        again[real] = (at < len(twice)) & (twice[np.minimum(at, max(0, len(twice) - 1))] == values) if len(twice) else False
        again |= real & (np.asarray(table["n"]) > 1)[:, None]
        yield from _run_rows(table, again)
    give_back()


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            table = pa.Table.from_batches([batch.slice(k, 500)])
            found, real = _variant_windows(table)
            row, place = np.nonzero(real)
            columns = [table[c].take(pa.array(row)).combine_chunks() for c in ("head", "variant", "n")]
            columns += [pa.array(place - (PLACES - 1)), pa.array(found[real].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["head", "variant", "n", "low", "window"])


_ROWS = "head long, variant long, ref long, place long, before long, after long"
_RUNS = "head long, variant long, low long, high long"


def _release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that are done with, and let Spark drop the shuffle files of finished plans."""
    for t in tables:
        discard(t)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated_spans(texts: DataFrame, variants: int = VARIANTS) -> tuple[DataFrame, list[DataFrame]]:
    """``(ref, low, high)``, and the stored tables that it reads: runs of bytes covered by repeated windows, of ``texts`` ``(ref, text, at)`` with ``at``
    the places and heads of their matching suffixes. Runs may overlap.

    Suffixes with equal head and equal surroundings (all bytes that windows over the head reach) are one variant.
    A variant found twice repeats all its windows; different variants of a head are compared window by window.
    """
    rows = store(text_batches(texts).mapInArrow(_surroundings(False), _ROWS), "suffix-rows")
    kinds = rows.groupBy("head", "variant").agg(
        F.count("*").alias("n"), F.min(F.struct("ref", "place")).alias("one"), F.first("before").alias("before"), F.first("after").alias("after")
    )
    kinds = store(kinds, "suffix-variants")
    many = store(kinds.groupBy("head").agg(F.count("*").alias("kinds")).where("kinds > 1"), "suffix-many")
    alone = kinds.join(many, "head", "left_anti").where("n > 1 and before + after >= " + str(LENGTH))
    alone = alone.select("head", "variant", (-F.col("before")).alias("low"), F.col("after").alias("high"))
    chosen = kinds.join(many, "head").select("one.ref", F.struct("one.place", "head").alias("x"))
    chosen = chosen.groupBy("ref").agg(F.collect_list("x").alias("at"))
    shown = texts.select("ref", "text").join(chosen, "ref").mapInArrow(_surroundings(True), _ROWS + ", bytes binary")
    sized = kinds.join(many, "head").select("head", "variant", "n", "kinds")
    shown = shown.select("head", "variant", "before", "after", "bytes").join(sized, ["head", "variant"])
    read = [rows, kinds, many]
    hot = not many.where(F.col("kinds") > variants).isEmpty()
    if hot:
        shown = store(shown, "suffix-shown")
        read.append(shown)
    few = shown.where(F.col("kinds") <= variants).repartition("head").sortWithinPartitions("head")
    runs = alone.union(few.mapInArrow(_compare, _RUNS))
    if hot:
        spread = shown.where(F.col("kinds") > variants).mapInArrow(_spread, "head long, variant long, n long, low long, window long")
        spread = store(spread, "suffix-windows")
        read.append(spread)
        twice = spread.groupBy("head", "window").agg(F.sum("n").alias("all")).where("all > 1").select("head", "window")
        runs = runs.union(spread.join(twice, ["head", "window"]).select("head", "variant", "low", (F.col("low") + LENGTH).alias("high")))
    found = rows.join(runs, ["head", "variant"])
    return found.select("ref", (F.col("place") + F.col("low")).alias("low"), (F.col("place") + F.col("high")).alias("high")), read


def merged(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(low.tolist(), high.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for ref, text, spans in zip(batch["ref"].to_pylist(), batch["text"], batch["spans"], strict=True):
            text, at, kept = text.as_py(), 0, []
            runs = merged(np.asarray(spans.values.field("low")), np.asarray(spans.values.field("high")))
            for low, high in runs:
                kept.append(text[at:low])
                at = high
            left = b"".join([*kept, text[at:]])
            rows.append((ref, len(text) - len(left), [{"low": a, "high": b} for a, b in runs], left, hashlib.sha256(left).hexdigest()))
        run_type = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), run_type, pa.binary(), pa.string()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["ref", "n_removed", "runs", "left", "sha"])


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py().decode("utf-8", "ignore") for t in batch["left"]]
        yield pa.RecordBatch.from_arrays([batch["ref"], pa.array(texts, pa.string())], ["ref", "left"])


def changed_texts(docs: DataFrame, variants: int = VARIANTS) -> tuple[DataFrame, DataFrame]:
    """``(rows, changed)``: a light row for each document row, and what is left of texts that lose something.

    ``rows``: doc_id, ref (hash of the text), n_bytes, sha, copied (another row has the same text, of at least
    ``LENGTH`` bytes, so nothing is left). ``changed``: ref, n_removed, runs, left, sha for texts not copied or one
    of the copies.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("ref", F.xxhash64("text"))
    light = base.select("doc_id", "ref", F.xxhash64(F.lit("second"), "text").alias("ref2"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    light = store(light, "suffix-documents")
    copies = light.groupBy("ref", "ref2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))
    copies = store(copies, "suffix-copies")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batch = F.pmod(F.xxhash64("ref"), F.lit(BATCHES))
    arrays = text_batches(base).select("ref", batch.alias("batch"), "text").mapInArrow(_array_rows, "head long, ref long, place long, batch long")
    arrays = _bucketed(arrays, buckets, "suffix_batches", "batch")
    family = SuffixFamily(spark, buckets)
    for number in range(BATCHES):
        family.add(arrays.where(F.col("batch") == number).select("head", "ref", "place"))
    found = family.matches().groupBy("ref").agg(F.collect_list(F.struct("place", "head")).alias("at"))
    own = arrays.where("batch = -1").groupBy("ref").agg(F.collect_list(F.struct(F.col("place").alias("low"), F.col("head").alias("high"))).alias("own"))
    wanted = found.join(own, "ref", "full").join(copies.select("ref", "first_id"), "ref")
    wanted = store(wanted, "suffix-wanted")
    _release(spark, arrays, *(t for rank, t in family.levels if rank))
    same = (base.ref == wanted.ref) & base.doc_id.eqNullSafe(wanted.first_id)
    texts = store(base.join(wanted, same).select(base.ref, "text", "at", "own"), "suffix-texts")
    _release(spark, wanted)
    found, read = repeated_spans(texts.where("at is not null").select("ref", "text", "at"), variants)
    spans = found.union(texts.where("own is not null").select("ref", F.inline("own")))
    # Written, so that nothing of the search is on disk while texts are cut.
    spans = store(spans.distinct().groupBy("ref").agg(F.collect_list(F.struct("low", "high")).alias("spans")), "suffix-spans")
    _release(spark, *read)
    cut = texts.select("ref", "text").join(spans, "ref").mapInArrow(
        _cut, "ref long, n_removed long, runs array<struct<low:long,high:long>>, left binary, sha string"
    )
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    rows = light.join(copies, ["ref", "ref2"]).select("doc_id", "ref", "n_bytes", "sha", copied.alias("copied"))
    return rows, cut


def suffix_dedup(docs: DataFrame, variants: int = VARIANTS) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every document row.

    Every byte that lies in a string of ``LENGTH`` bytes which also starts at another place of any text, the same one
    included, is removed; strings are judged on the input. Texts are their UTF-8 bytes, null is empty,
    and texts under ``LENGTH`` bytes lose nothing. Rows with equal texts are copies of each other, also if their
    doc_ids are equal or null. Equal strings are told by 64-bit hashes.
    """
    rows, cut = changed_texts(docs, variants)
    changed = cut.select("ref", "n_removed", F.size("runs").cast("long").alias("n_spans"), F.col("sha").alias("cut_sha"))
    changed = changed.dropDuplicates(["ref"])
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.join(changed, "ref", "left").select(
        "doc_id",
        "n_bytes",
        F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copied"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("copied"), nothing).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    )


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with what ``suffix_dedup`` leaves of their texts; rows of which no word is left go.

    A character that loses a byte goes as a whole; ``n_chars`` is counted anew.
    """
    rows, cut = changed_texts(docs)
    gone = rows.where("copied").select("ref").distinct()
    left = cut.select("ref", "left").mapInArrow(_decoded, "ref long, left string").dropDuplicates(["ref"])
    named = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = F.col(f"c{docs.columns.index('text')}")
    keyed = named.withColumn("ref", F.xxhash64(F.coalesce(text.cast("binary"), F.lit(b""))))
    joined = keyed.join(gone, "ref", "left_anti").join(left, "ref", "left").withColumn("new", F.coalesce("left", text))
    joined = joined.where(F.col("new").rlike(r"[^\x20\x09-\x0D]"))
    made = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    return joined.select(*[made.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])
