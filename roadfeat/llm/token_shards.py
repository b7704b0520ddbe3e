"""Token ids in raw binary shards, reached by key through a minimal perfect hash index."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadfeat.llm.shared import new_path, store, text_batches
from roadfeat.llm.tokens import encoder

#: Keys of one index bucket, on average; a bucket is built and searched in one go.
KEYS_IN_BUCKET = 1 << 15
#: Bits of a hash level for each key that is still to be placed.
BITS_PER_KEY = 2
_SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u8")])


def _mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    x = h1 + np.uint64(2 * level + 1) * (h2 | np.uint64(1))
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(29)


class PerfectHash:
    """Minimal perfect hash of a set of 128-bit key hashes.

    A level gives every key left a place in a bit array; keys alone at their place stay, the others
    go to the next level. A key's slot is the number of set bits before its own, over all levels.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = [np.concatenate([[0], np.cumsum(bits)]) for bits in levels]

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        levels, left = [], np.arange(len(h1))
        while len(left):
            if len(levels) == 200:
                raise ValueError("two keys have the same hash")
            size = max(8, BITS_PER_KEY * len(left))
            place = (_mixed(h1[left], h2[left], len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size)[place] == 1
            bits = np.zeros(size, bool)
            bits[place[alone]] = True
            levels.append(bits)
            left = left[~alone]
        return cls(levels)

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that surely are not in the set."""
        out, left, base = np.full(len(h1), -1), np.arange(len(h1)), 0
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            place = (_mixed(h1[left], h2[left], level) % np.uint64(len(bits))).astype(np.int64)
            here = bits[place]
            out[left[here]] = base + rank[place[here]]
            left, base = left[~here], base + rank[-1]
        return out

    def dump(self) -> tuple[bytes, bytes]:
        sizes = np.array([len(b) for b in self.levels], "<u8").tobytes()
        return sizes, b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, sizes: bytes, bits: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in np.frombuffer(sizes, "<u8").tolist():
            n = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(bits, np.uint8, n, at), count=size).astype(bool))
            at += n
        return cls(levels)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write(path: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        shard, encode = task.partitionId(), encoder(tokenizer)
        end = np.array([end_id], encode.dtype).tobytes()
        files, root = _open(path)
        files.create_dir(root, recursive=True)
        name = f"{root}/shard-{shard:08d}.ids"
        draft = f"{name}.{task.taskAttemptId()}"
        at, last, copy = 0, object(), 0
        with files.open_output_stream(draft) as out:
            for batch in batches:
                offsets, counts, copies = [], [], []
                texts = encode.many(t.as_py() for t in batch["text"])
                for doc, ids in zip(batch["doc_id"].to_pylist(), texts, strict=True):
                    ids += end
                    out.write(ids)
                    copy, last = copy + 1 if doc == last else 0, doc
                    offsets.append(at)
                    counts.append(len(ids) // encode.dtype.itemsize)
                    copies.append(copy)
                    at += counts[-1]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(copies, pa.int64()), pa.array([shard] * len(copies), pa.int64()), pa.array(offsets, pa.int64()), pa.array(counts, pa.int64())],
                    ["doc_id", "copy", "shard", "offset", "n"],
                )
        files.move(draft, name)
        encode.release()

    return run


def _build(key: tuple, table: pa.Table) -> pa.Table:
    h1, h2 = (np.asarray(table[c]).view(np.uint64) for c in ("h1", "h2"))
    hashed = PerfectHash.build(h1, h2)
    slot = hashed.slots(h1, h2)
    entries = np.zeros(len(h1), _SLOT)
    entries["print"][slot] = h2 >> np.uint64(32)
    for c in ("shard", "offset", "n"):
        entries[c][slot] = np.asarray(table[c])
    sizes, bits = hashed.dump()
    return pa.table({"bucket": [key[0].as_py()], "sizes": [sizes], "bits": [bits], "slots": [entries.tobytes()]})


def _find(key: tuple, keys: pa.Table, index: pa.Table) -> pa.Table:
    found = keys.slice(0, 0) if not index.num_rows else keys
    slot = np.zeros(0, np.int64)
    entries = np.zeros(0, _SLOT)
    if index.num_rows:
        entries = np.frombuffer(index["slots"][0].as_py(), _SLOT)
        h1, h2 = (np.asarray(keys[c]).view(np.uint64) for c in ("h1", "h2"))
        slot = PerfectHash.load(index["sizes"][0].as_py(), index["bits"][0].as_py()).slots(h1, h2)
        known = (slot >= 0) & (entries["print"][slot] == h2 >> np.uint64(32))
        found, slot = keys.filter(pa.array(known)), slot[known]
    return pa.table(
        {"doc_id": found["doc_id"], "copy": found["copy"]} | {c: entries[c][slot].astype(np.int64) for c in ("shard", "offset", "n")}
    )


@dataclass
class TokenShards:
    """Shard files in ``path``, the index table over them, and the keys in file order."""

    path: str
    itemsize: int
    keys: DataFrame
    index: DataFrame
    buckets: int

    def find(self, keys: DataFrame) -> DataFrame:
        """``(doc_id, copy, shard, offset, n)`` of the keys ``(doc_id, copy)`` that the index holds.

        An absent key is refused by its fingerprint, but for one in 2**32.
        """
        hashed = _hashed(keys.select("doc_id", "copy"), self.buckets)
        return (
            hashed.groupBy("bucket")
            .cogroup(self.index.groupBy("bucket"))
            .applyInArrow(_find, "doc_id long, copy long, shard long, offset long, n long")
        )

    def read(self, places: DataFrame) -> DataFrame:
        """``(doc_id, copy, shard, offset, n, ids)``: the ids at those places as little-endian unsigned 32-bit integers."""
        path, itemsize = self.path, self.itemsize

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, root = _open(path)
            shard, source = None, None
            for whole in batches:
                for at in range(0, whole.num_rows, 1000):
                    batch = whole.slice(at, 1000)
                    ids = []
                    for s, offset, n in zip(*(batch[c].to_pylist() for c in ("shard", "offset", "n")), strict=True):
                        if s != shard:
                            shard, source = s, files.open_input_file(f"{root}/shard-{s:08d}.ids")
                        raw = source.read_at(n * itemsize, offset * itemsize)
                        ids.append(np.frombuffer(raw, f"<u{itemsize}").astype("<u4").tobytes())
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], [*batch.schema.names, "ids"])

        dealt = places.repartition("shard").sortWithinPartitions("shard", "offset")
        return dealt.mapInArrow(run, "doc_id long, copy long, shard long, offset long, n long, ids binary")


def _hashed(rows: DataFrame, buckets: int) -> DataFrame:
    name = F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("copy").cast("string"))
    return rows.withColumns({"h1": F.xxhash64(name), "h2": F.xxhash64(F.lit("second"), name)}).withColumn(
        "bucket", F.pmod(F.col("h1"), F.lit(buckets))
    )


def write_token_shards(docs: DataFrame, tokenizer: str, end_id: int) -> TokenShards:
    """Encode every whole text, end each document with ``end_id``, and write the ids in ascending doc_id order.

    Shards are consecutive ranges of doc_id and hold ids in the narrowest type that the vocabulary
    fits. Null and empty texts are a document of one id, a null doc_id sorts first. Rows that share a doc_id
    follow each other, ordered by text hash, and have keys (doc_id, 0), (doc_id, 1) and so on. An empty table
    gives an empty index. A task writes under a name of its own and renames in the end, so a
    repeated task leaves whole files. ``path`` needs a file system that pyarrow can open.
    """
    spark = docs.sparkSession
    path = new_path(spark, "token-shards")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = base.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = "doc_id long, copy long, shard long, offset long, n long"
    keys = store(text_batches(ordered).mapInArrow(_write(path, tokenizer, end_id), schema), "token-keys")
    buckets = -(-keys.count() // KEYS_IN_BUCKET) or 1
    entries = _hashed(keys, buckets).drop("doc_id", "copy")
    index = entries.groupBy("bucket").applyInArrow(_build, "bucket long, sizes binary, bits binary, slots binary")
    return TokenShards(path, encoder(tokenizer).dtype.itemsize, keys, store(index, "token-index"), buckets)


def shard_digests(shards: TokenShards) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, looked up in the index and read from the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = pa.array([zlib.crc32(x.as_py()) for x in b["ids"]], pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["shard"], b["offset"], b["n"], crc], ["doc_id", "shard", "offset", "n_tokens", "ids_crc32"])

    read = shards.read(shards.find(shards.keys))
    digests = read.mapInArrow(run, "doc_id long, shard long, offset long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        shards.keys.groupBy("shard")
        .agg(F.sum("n").alias("size"))
        .select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    )
    return digests.join(bases, "shard").select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
