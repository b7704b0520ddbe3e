"""How sources of a language diverge in their words: counts by term digests, strings only for what is reported."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadfeat.llm.shared import store, text_batches

#: Fixed by the definition of a chance: chances are whole billionths.
UNIT = 1_000_000_000
#: Distinct terms of groups that a task counts before it hands them on, and entries and pairs of one block of the pair sums.
HELD_TERMS, BLOCK_ROWS, HELD_PAIRS = 300_000, 200_000, 1_000_000
#: Bytes of text for each bucket of digests; a bucket's records are added up in one task.
BUCKET_BYTES = 16 << 20
#: Bits of the filter of kept digests for each of them, and at most; more pass a full one, none are lost.
FILTER_BITS, MOST_FILTER_BITS = 32, 1 << 28
#: Groups of a language on the left of one key of the join of groups.
GROUPS_PER_KEY = 1_000
#: A-Z become lower case, all other single-byte characters but a-z end a term.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_PACKED = "bucket int, langs array<string>, sources array<string>, sizes array<long>, digests binary, n binary, docs binary, least array<string>, most array<string>"
_ENTRIES = "lang string, source string, digest long, n long, n_lang long, first boolean"
_EXACT = "lang string, source string, digest long, term string, n long, docs long"
_SUMS = "lang string, a string, b string, part long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: maximal runs of letters a-z, lower-cased, and of characters beyond ASCII."""
    return text.translate(_TERM_BYTES).split()


def _arrow(kind: str) -> pa.DataType:
    plain = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.list_(plain[kind[6:-1]]) if kind.startswith("array<") else plain[kind]


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _arrow(k)) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def digest_of(term: bytes, bits: int) -> int:
    """The low ``bits`` bits of a hash as a signed number."""
    from xxhash import xxh64_intdigest

    return (xxh64_intdigest(term) >> (64 - bits)) - (1 << (bits - 1))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Counts of terms and of documents for each (lang, source), handed on whenever they hold ``HELD_TERMS`` terms."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"], strict=True):
            words = terms_of(text.as_py())
            if words:
                times, docs = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(times)
                times.update(words)
                docs.update(set(words))
                size += len(times)
            if size >= HELD_TERMS:
                yield held
                held, size = {}, 0
    if held:
        yield held


def _packer(bits: int, buckets: int):
    """Each time a task hands on: for each bucket one row of packed records (digest, n, docs) of all groups, and one row that
    keeps, where it was read, the least and greatest string of each digest."""

    def pack(held: dict) -> Iterator[pa.RecordBatch]:
        digests: dict[bytes, int] = {}
        rows: list[list] = []
        groups = []
        for group, (times, docs) in held.items():
            terms = list(times)
            for t in terms:
                if t not in digests:
                    digests[t] = digest_of(t, bits)
            found = np.fromiter(map(digests.__getitem__, terms), np.int64, len(terms))
            n = np.fromiter(times.values(), np.uint32, len(terms))
            d = np.fromiter(map(docs.__getitem__, terms), np.uint32, len(terms))
            bucket = found % buckets
            order = np.argsort(bucket, kind="stable")
            groups.append((group, bucket[order], found[order], n[order], d[order]))
        for b in range(buckets):
            row: list[list] = [[], [], [], [], [], []]
            for (lang, source), bucket, found, n, d in groups:
                low, high = np.searchsorted(bucket, (b, b + 1))
                if high > low:
                    for kept, x in zip(row, (lang, source, high - low, found[low:high], n[low:high], d[low:high]), strict=True):
                        kept.append(x)
            if row[0]:
                rows.append([b, row[0], row[1], row[2], *[np.concatenate(x).tobytes() for x in row[3:]], None, None])
        if rows:
            yield _batch(_PACKED, list(zip(*rows, strict=True)))
        terms, found = list(digests), np.fromiter(digests.values(), np.int64, len(digests))
        least, most = terms, None
        if len(set(digests.values())) < len(terms):
            ends: dict[int, list[bytes]] = {}
            for t, x in digests.items():
                both = ends.setdefault(x, [t, t])
                both[:] = min(both[0], t), max(both[1], t)
            found = np.fromiter(ends, np.int64, len(ends))
            least, most = ([x[i] for x in ends.values()] for i in (0, 1))
        text = lambda x: None if x is None else [t.decode() for t in x]
        yield _batch(_PACKED, [[-1], [None], [None], [None], [found.tobytes()], [None], [None], [text(least)], [text(most)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _counted(batches):
            yield from pack(held)

    return run


def _adder(least_docs: int):
    """Adds up the packed records of whole buckets and keeps the digests that enough documents of a language have."""

    def add(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        ids, sizes = [], []
        for _, langs, sources, row_sizes, *_ in rows:
            ids += [names.setdefault(g, len(names)) for g in zip(langs, sources, strict=True)]
            sizes += row_sizes
        # Groups by language, so that one sort puts the groups of a language together.
        order = sorted(names)
        rank = np.empty(len(order), np.int64)
        rank[[names[g] for g in order]] = np.arange(len(order))
        lang_no = {lang: i for i, lang in enumerate(dict.fromkeys(g[0] for g in order))}
        lang_of = np.array([lang_no[g[0]] for g in order])
        group = np.repeat(rank[ids], sizes)
        digest, n, docs = (np.frombuffer(b"".join(r[i] for r in rows), k) for i, k in ((4, "<i8"), (5, "<u4"), (6, "<u4")))
        at = np.lexsort((group, digest))
        digest, group, n, docs = digest[at], group[at], n[at].astype(np.int64), docs[at].astype(np.int64)
        lang = lang_of[group]
        new_lang = np.append(True, (digest[1:] != digest[:-1]) | (lang[1:] != lang[:-1]))
        new = np.append(True, new_lang[1:] | (group[1:] != group[:-1]))
        starts, lang_starts = np.flatnonzero(new), np.flatnonzero(new_lang)
        whole, seen = np.add.reduceat(n, lang_starts), np.add.reduceat(docs, lang_starts)
        of = np.searchsorted(lang_starts, starts, side="right") - 1
        keep = seen[of] >= least_docs
        starts, of, own = starts[keep], of[keep], np.add.reduceat(n, starts)[keep]
        labels = [[g[i] for g in order] for i in (0, 1)]
        text = [pa.DictionaryArray.from_arrays(pa.array(group[starts].astype(np.int32)), pa.array(x, pa.string())).cast(pa.string()) for x in labels]
        yield _batch(_ENTRIES, [*text, digest[starts], own, whole[of], new_lang[starts]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns[:7]], strict=True):
                if held and row[0] != held[0][0]:
                    yield from add(held)
                    held = []
                held.append(row)
        if held:
            yield from add(held)

    return run


def _strings(mask: bytes):
    """The stored strings whose digest passes the filter, as rows (digest, least, most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(mask, "<u8")
        for batch in batches:
            for digests, least, most in zip(batch["digests"], batch["least"], batch["most"], strict=True):
                found = np.frombuffer(digests.as_py(), "<i8")
                bit = found & (64 * len(words) - 1)
                keep = pa.array(words[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1) == 1)
                low = least.values.filter(keep)
                high = most.values.filter(keep) if most.is_valid else low
                yield pa.RecordBatch.from_arrays([pa.array(found).filter(keep), low, high], ["digest", "least", "most"])

    return run


def _filter_of(digests: DataFrame, kept: int) -> bytes:
    """A bit for each kept digest by its low bits; its size is bounded by a parameter, whatever is kept."""
    bits = min(MOST_FILTER_BITS, 1 << max(16, (FILTER_BITS * kept).bit_length()))
    bit = F.col("digest").bitwiseAND(F.lit(bits - 1))
    word, mask = F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    words = np.zeros(bits // 64, np.int64)
    for r in digests.groupBy(word).agg(F.bit_or(mask).alias("mask")).toLocalIterator():
        words[r["word"]] = r["mask"]
    return words.tobytes()


def _by_string(bits: int):
    """Counts by the terms themselves: rows (lang, source, digest, term, n, docs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _counted(batches):
            for (lang, source), (times, docs) in held.items():
                rows = [(lang, source, digest_of(t, bits), t.decode(), n, docs[t]) for t, n in times.items()]
                yield _batch(_EXACT, list(zip(*rows, strict=True)))

    return run


def chance(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)), exact for any counts; null without terms."""
    wide = lambda c: c.cast("decimal(20,0)")
    # The product has up to 30 digits; a quotient of decimals would be rounded, div isn't.
    found = F.call_function("div", wide(n + 2) * F.lit(UNIT).cast("decimal(10,0)"), F.nullif(wide(total + 2 * terms), F.lit(0).cast("decimal(20,0)")))
    return (found + 1).cast("long")


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q are below 2^31, so the square is exact."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every pair of sources, over the terms that both have, what the gap of their chances differs from the sums that take one of them as absent.

    Rows come sorted by (lang, digest, term, source). Whole terms are gathered to blocks; inside a block, rows k apart
    are compared at once for k = 1, 2, ...
    """

    def code(column: pa.ChunkedArray) -> tuple[np.ndarray, list]:
        found = column.combine_chunks().dictionary_encode(null_encoding="encode")
        return found.indices.to_numpy().astype(np.int64), found.dictionary.to_pylist()

    def starts_of(table: pa.Table) -> np.ndarray:
        """First rows of the terms."""
        keys = [code(table["lang"])[0], table["digest"].to_numpy(), code(table["term"])[0]]
        return np.append(0, np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1)

    def blocks() -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                table = pa.Table.from_batches(held)
                last = int(starts_of(table)[-1])
                if last:
                    yield table.slice(0, last)
                held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield pa.Table.from_batches(held)

    def out(sums: dict) -> Iterator[pa.RecordBatch]:
        if sums:
            yield _batch(_SUMS, [*zip(*sums, strict=True), list(sums.values())])

    sums: dict[tuple[str, str, str], int] = {}
    for table in blocks():
        rows, starts = table.num_rows, starts_of(table)
        p, z = table["p"].to_numpy(), table["absent"].to_numpy()
        (lang, langs), (source, names) = code(table["lang"]), code(table["source"])
        ends = np.repeat(np.append(starts[1:], rows), np.diff(np.append(starts, rows)))
        at, step, width = np.arange(rows), 0, len(names)
        while True:
            step += 1
            at = at[at + step < ends[at]]
            if not len(at):
                break
            q, y = at, at + step
            value = _gap(p[q], p[y]) - _gap(p[q], z[y]) - _gap(z[q], p[y]) + _gap(z[q], z[y])
            cells, cell = np.unique((lang[q] * width + source[q]) * width + source[y], return_inverse=True)
            # Sums of a block stay far below 2^53, where doubles are exact.
            for c, v in zip(cells.tolist(), np.bincount(cell, value).astype(np.int64).tolist(), strict=True):
                key = (langs[c // width // width], names[c // width % width], names[c % width])
                sums[key] = sums.get(key, 0) + v
        if len(sums) >= HELD_PAIRS:
            yield from out(sums)
            sums = {}
    yield from out(sums)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


@dataclass
class Divergence:
    """``groups``: (lang, source, total, terms, absent), absent the chance of a term that the group lacks.
    ``entries``: (lang, source, digest, term, n, p, q, absent), one for each kept term of a group; ``term`` is null where the digest says it all.
    ``names``: (digest, least, most): strings of the digests of kept terms."""

    groups: DataFrame
    entries: DataFrame
    names: DataFrame

    def terms(self, top: int = 10) -> DataFrame:
        """The terms that a group has more of than its language, the ``top`` by gap; text is joined only to the digests that can be among them."""
        value = self.entries.where("p > q").select("lang", "source", "digest", "term", gap(F.col("p"), F.col("q")).alias("value"))
        by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        # With all that tie with the last one, as the order of ties needs the text.
        near = value.withColumn("_place", F.rank().over(by_value)).where(F.col("_place") <= top)
        named = near.join(self.names.select("digest", "least"), "digest", "left")
        item = F.coalesce("term", "least").alias("item")
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        found = named.select("lang", "source", item, "value").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
        return found.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    def pairs(self) -> DataFrame:
        """Every other source of the language by its distance, summed over all kept terms.

        The sum is taken as if no term were shared (by the distinct chances of each group against the chance of an absent
        term of the other) and mended by the terms that both have, whose pair sums are formed inside tasks. So what is
        shuffled is one row for each pair of sources and task, not for each term; the result itself has all pairs.
        """
        entries = self.entries.select("lang", "digest", "term", "source", "p", "absent")
        dealt = entries.repartition("lang", "digest").sortWithinPartitions("lang", "digest", "term", "source")
        shared = dealt.mapInArrow(_pair_sums, _SUMS).groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
        values = self.entries.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("times"))
        values = values.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "times")).alias("chances"), F.sum("times").alias("own"))
        none = F.array().cast("array<struct<p:bigint,times:bigint>>")
        groups = self.groups.join(values, ["lang", "source"], "left").select(
            "lang", "source", "terms", "absent", F.coalesce("own", F.lit(0)).alias("own"), F.coalesce("chances", none).alias("chances")
        )
        groups = store(groups, "divergence-groups")
        keys = max(1, groups.count() // GROUPS_PER_KEY)
        left = groups.withColumn("_key", F.pmod(F.xxhash64("source"), F.lit(keys))).alias("x")
        right = groups.withColumn("_key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(keys - 1).cast("long")))).alias("y")
        met = left.join(right, (F.col("x.lang") == F.col("y.lang")) & (F.col("x._key") == F.col("y._key")) & (F.col("x.source") != F.col("y.source")))

        def alone(of: str, absent: Column) -> Column:
            return F.aggregate(F.col(f"{of}.chances"), F.lit(0).cast("long"), lambda s, c: s + c["times"] * gap(c["p"], absent))

        x, y = F.col("x.absent"), F.col("y.absent")
        neither = (F.col("x.terms") - F.col("x.own") - F.col("y.own")) * gap(x, y)
        value = F.when(F.col("x.terms") > 0, alone("x", y) + alone("y", x) + neither).otherwise(F.lit(0))
        apart = met.select(
            F.col("x.lang").alias("lang"), F.col("x.source").alias("source"), F.col("y.source").alias("item"), value.alias("apart"),
            F.least("x.source", "y.source").alias("a"), F.greatest("x.source", "y.source").alias("b"),
        )
        whole = apart.join(shared, ["lang", "a", "b"], "left").withColumn("value", F.col("apart") + F.coalesce("part", F.lit(0)))
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return whole.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))


def divergence(docs: DataFrame, least_docs: int = 10, bits: int = 64) -> Divergence:
    """Counts and chances of the terms that at least ``least_docs`` documents of their language have.

    Terms are counted by digests of ``bits`` bits: tasks shuffle packed records (digest, counts), dealt by digest to as many
    buckets as the text needs. Strings stay where they were read, and those of kept digests are gathered as least and greatest only. Where
    these differ, two terms share the digest: the documents are read again and the terms of such digests, and only these, are
    counted by their strings. A digest's documents are at least those of each of its terms, so none that is kept is missed.

    Null text, lang and source count as ''. Texts without terms and languages without kept terms make groups too. Repeated
    rows are documents of their own; a text is taken whole however long; further columns don't matter; no rows give no
    rows. Tasks add up before they shuffle, so a group or a term with most of the rows sends a row for each task at most.
    """
    if not 1 <= bits <= 64:
        raise ValueError("bits must be from 1 to 64")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    base = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    n_bytes = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_bytes // BUCKET_BYTES)
    parts = store(text_batches(base).mapInArrow(_packer(bits, buckets), _PACKED), "divergence-parts")
    records = parts.where("bucket >= 0").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    entries = store(records.mapInArrow(_adder(least_docs), _ENTRIES), "divergence-entries")

    digests = store(entries.select("digest").distinct(), "divergence-digests")
    stored = parts.where("bucket < 0").select("digests", "least", "most")
    near = stored.mapInArrow(_strings(_filter_of(digests, digests.count())), "digest long, least string, most string")
    strings = near.join(digests, "digest", "left_semi")
    names = store(strings.groupBy("digest").agg(F.min("least").alias("least"), F.max("most").alias("most")), "divergence-names")
    shared = names.where("least != most").select("digest")
    entries = entries.withColumn("term", F.lit(None).cast("string"))
    if not shared.isEmpty():
        again = base.mapInArrow(_by_string(bits), _EXACT).join(shared, "digest", "left_semi")
        summed = again.groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        of_term = Window.partitionBy("lang", "digest", "term")
        wide = summed.select(
            "lang", "source", "digest", "n", F.sum("n").over(of_term).alias("n_lang"),
            (F.col("source") == F.min("source").over(of_term)).alias("first"), "term", F.sum("docs").over(of_term).alias("docs"),
        )
        split = wide.where(F.col("docs") >= least_docs).drop("docs")
        entries = store(entries.join(shared, "digest", "left_anti").unionByName(split), "divergence-split")

    langs = entries.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("terms"), F.sum("n").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = base.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("total", "terms", "lang_total")}
    groups = groups.withColumns(zero).withColumn("absent", chance(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
    groups = store(groups, "divergence-totals")
    p = chance(F.col("n"), F.col("total"), F.col("terms"))
    q = chance(F.col("n_lang"), F.col("lang_total"), F.col("terms"))
    wide = entries.join(groups, ["lang", "source"]).select("lang", "source", "digest", "term", "n", p.alias("p"), q.alias("q"), "absent")
    return Divergence(groups, store(wide, "divergence-chances"), names)


def report(found: Divergence, top: int = 10) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of both parts."""
    return found.pairs().unionByName(found.terms(top))


ORACLE = rf"""
with docs as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body from documents),
tokens as (select id, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as n from tokens group by all having count(distinct id) >= 10),
langs as (select lang, count(*) as v, sum(n) as total from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as n from tokens semi join kept using (lang, term) group by all),
totals as (select lang, source, sum(n) as total from counts group by all),
grid as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + {UNIT}::hugeint * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * v) as p, 1 + {UNIT}::hugeint * (k.n + 2) // (l.total + 2 * v) as q
    from groups g join kept k using (lang) join langs l using (lang) left join totals t using (lang, source) left join counts c using (lang, source, term)),
sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from grid a join grid b using (lang, term) where a.source != b.source group by all),
pairs as (select a.lang, a.source, b.source as item, coalesce(value, 0) as value from groups a join groups b using (lang)
    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source where a.source != b.source),
terms as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from grid where n > 0 and p > q),
ranked as (
    select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
    union all select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) as rank from terms
        qualify rank <= 10)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked
"""
