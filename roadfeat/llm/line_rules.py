"""Quality rules from line frequencies across the documents of a host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadfeat.llm.shared import store

#: A line goes if it stands in at least so many different documents of its host ...
LEAST_DOCUMENTS = 10
#: ... and in more than one in so many of the host's documents.
ONE_IN = 100

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the list."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    window = ids[:n]
    for k in range(1, width):
        window = np.unique(window * len(known) + ids[k : n + k], return_inverse=True)[1]
    again = np.bincount(window)[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k : n + k] |= again
    return int(covered.sum())


def base_counts(data: bytes) -> tuple[int, ...]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text's UTF-8 bytes."""
    words = data.split()
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = len(data) - seen[128:192].sum() - seen[9:14].sum() - seen[32]
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(words), int(chars), int(seen[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(words)


def line_key(line: bytes) -> int:
    """Hash of a normalised line: words joined by one blank, A-Z lower-cased."""
    return xxhash.xxh64_intdigest(b" ".join(line.lower().split())) - (1 << 63)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    line_type = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
    for batch in batches:
        counts, lines, texts = [], [], []
        for text in batch["text"]:
            data = text.as_py() or b""
            counts.append(base_counts(data))
            words: dict[int, int] = {}
            for line in data.split(b"\n"):
                if n := len(line.split()):
                    key = line_key(line)
                    words[key] = words.get(key, 0) + n
            lines.append([{"line": k, "words": n} for k, n in words.items()])
            texts.append(xxhash.xxh64_intdigest(data) - (1 << 63))
        columns = [batch["doc_id"], batch["host"], pa.array(texts, pa.int64()), pa.array(lines, line_type)]
        columns += [pa.array(c, pa.int64()) for c in (zip(*counts, strict=True) if counts else [[]] * 5)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "host", "text_hash", "lines", *_COUNTS])


def line_rules(docs: DataFrame, host: str = "source", least: int = LEAST_DOCUMENTS, one_in: int = ONE_IN) -> DataFrame:
    """One row for each document row: ``doc_id, text_hash, n_words`` and the other counts, ``n_removed_words, removed_lines,
    base_failed, kept``.

    Lines are normalised and hashed, and different texts that hold them are counted for each host (so exact
    copies of a page count once). A line found in at least ``least`` documents and in more than one in
    ``one_in`` documents of its host is removed there. A document is rejected if the base rules fail (under 50
    words, or over half its words in repeated windows), or if over half its words were in removed lines.

    Null texts have no words and fail; null hosts are one host; repeated rows are judged each; a text counts whole, however
    long; further columns don't matter, whatever their names; no rows give no rows.
    The heaviest host or line is no hot group: counts are partial sums before they are shuffled, and a document
    sends a line once.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col("text").cast("binary").alias("text")
    )
    schema = "doc_id long, host string, text_hash long, lines array<struct<line:long,words:long>>, " + ", ".join(f"{c} long" for c in _COUNTS)
    rows = store(base.mapInArrow(_rows, schema).withColumn("row", F.monotonically_increasing_id()), "line-rows")
    hosts = rows.groupBy("host").agg(F.count_distinct("text_hash").alias("host_documents"))
    lines = rows.select("row", "host", "text_hash", F.inline("lines"))
    counted = lines.groupBy("host", "line").agg(F.count_distinct("text_hash").alias("documents")).where(F.col("documents") >= least)
    frequent = counted.join(hosts, counted.host.eqNullSafe(hosts.host)).where(F.col("documents") * one_in > F.col("host_documents"))
    frequent = frequent.select(counted.host.alias("at"), F.col("line").alias("often"))
    removed = lines.join(frequent, (lines.line == frequent.often) & lines.host.eqNullSafe(frequent["at"]))
    removed = removed.groupBy("row").agg(F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("removed_lines"))
    judged = rows.drop("lines").join(removed, "row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~failed & (2 * F.col("n_removed_words") <= F.col("n_words"))
    return judged.select("doc_id", "text_hash", *_COUNTS, "n_removed_words", "removed_lines", failed.alias("base_failed"), kept.alias("kept"))


def without_lines(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """Documents that ``judged`` (from ``line_rules``) keeps, as ``(doc_id, text)`` without the removed lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [xxhash.xxh64_intdigest(t.as_py() or b"") - (1 << 63) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], pa.array(hashes, pa.int64())], ["doc_id", "text", "text_hash"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch["text"], batch["removed_lines"].to_pylist(), strict=True):
                drop = set(gone or ())
                texts.append(b"\n".join(x for x in text.as_py().split(b"\n") if not x.strip() or line_key(x) not in drop).decode())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    hashed = base.mapInArrow(run, "doc_id long, text binary, text_hash long")
    kept = judged.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"), "removed_lines")
    kept = kept.dropDuplicates(["kept_id", "kept_hash"])
    joined = hashed.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")))
    return joined.select("doc_id", "text", "removed_lines").mapInArrow(cut, "doc_id long, text string")


ORACLE = r"""
with d as (
  select doc_id, source as host, coalesce(text, '') as t, row_number() over () as r from documents
), w as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d
), windows as (
  select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g
  from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)
), again as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1
), repeats as (
  select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from again) group by r
), raw as (
  select r, host, t, unnest(string_split(t, chr(10))) as line from d
), lines as (
  select r, host, t, line, translate(array_to_string(ls, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm, len(ls) as n
  from (select *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as ls from raw) where len(ls) > 0
), dups as (
  select r, count(*) - count(distinct line) as n from lines group by r
), hosts as (
  select host, count(distinct t) as n from d group by host
), often as (
  select l.host, l.norm from (select host, norm, count(distinct t) as n from lines group by host, norm) l
  join hosts h on l.host is not distinct from h.host where l.n >= 10 and l.n * 100 > h.n
), gone as (
  select r, sum(n) as n from lines l join often o on l.norm = o.norm and l.host is not distinct from o.host group by r
), counted as (
  select w.doc_id, cast(len(ws) as bigint) as n_words, cast(len(array_to_string(ws, '')) as bigint) as word_chars,
         cast(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(dups.n, 0) as bigint) as n_dup_lines, cast(coalesce(repeats.n, 0) as bigint) as n_repeat_words,
         coalesce(gone.n, 0) as removed
  from w left join dups on w.r = dups.r left join repeats on w.r = repeats.r left join gone on w.r = gone.r
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 2 * removed <= n_words as kept
from counted
"""
