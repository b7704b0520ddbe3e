"""Training sequences by power-of-two decomposition: no padding, and no sequence crosses documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadfeat.llm.shared import store, text_batches
from roadfeat.llm.tokens import encoder

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, shard long, rank long"


def binary_lengths(n: int, longest: int) -> list[int]:
    """``n`` as a sum of powers of two of at most ``longest``, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def _pieces(tokenizer: str, end_id: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, encode = TaskContext.get().partitionId(), encoder(tokenizer)
        end = np.array([end_id], encode.dtype).tobytes()
        made: dict[int, int] = {}
        for whole in batches:
            texts = encode.many(t.as_py() for t in whole["text"])
            for at in range(0, whole.num_rows, 1000):
                rows = []
                for doc, found in zip(whole["doc_id"].slice(at, 1000).to_pylist(), texts):
                    raw = np.frombuffer(found + end, encode.dtype)
                    wide, start = raw.astype("<u4").tobytes(), 0
                    for n in binary_lengths(len(raw), longest):
                        crc = zlib.crc32(wide[4 * start : 4 * (start + n)])
                        rank = made[n] = made.get(n, -1) + 1
                        rows.append((doc, start, n, crc, len(raw), raw[start : start + n].tobytes(), shard, rank))
                        start += n
                columns = list(zip(*rows, strict=True))
                kinds = [pa.binary() if i == 5 else pa.int64() for i in range(8)]
                names = [x.split()[0] for x in _SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        encode.release()

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, longest: int = 4096) -> DataFrame:
    """One row for each sequence: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    A document's ids (those of its whole text, then ``end_id``) are cut into pieces whose lengths are the binary
    digits of their number, in blocks of ``longest`` (a power of two) first. Each piece is a sequence of its own, so
    nothing is padded and ``offset`` is 0. Sequences of equal length form a bucket and have consecutive
    ids, the longest bucket first, so batches of one shape are ranges of ``sequence_id``. ``ids`` holds
    little-endian unsigned integers of 16 bits (32 if the vocabulary is larger). Null and empty texts are the end id
    alone; repeated rows are packed each; an empty table gives no rows. Texts are encoded where they are
    read; no ids are shuffled.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = store(text_batches(base).mapInArrow(_pieces(tokenizer, end_id, longest), _SCHEMA), "pieces")
    counts = pieces.groupBy("length", "shard").agg((F.max("rank") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy("length").agg(F.sum("n").alias("size"))
    buckets = buckets.select("length", F.coalesce(F.sum("size").over(longer), F.lit(0)).alias("bucket_start"))
    starts = counts.select("length", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shard_start"))
    bases = starts.join(buckets, "length").select("length", "shard", (F.col("bucket_start") + F.col("shard_start")).alias("base"))
    return pieces.join(bases, ["length", "shard"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("base") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids",
    )
