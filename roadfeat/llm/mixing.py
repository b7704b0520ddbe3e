"""Mix sources to target weights: blocks of words, multinomial draws for each shard, index permutations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadfeat.llm.shared import store
from roadfeat.operators.ranking import with_starts

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeated.
WEIGHTS = (3, 1, 2)
#: Words of a block.
BLOCK_WORDS = 128
#: Slots of an output shard as drawn.
SHARD_SLOTS = 4096
#: Rounds of the permutation; each swaps about half of all index pairs.
ROUNDS = 24
#: Cells of the table that finds a drawn number's source by equality.
GUIDE_CELLS = 1024


def source_targets(sized: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, source_no, source_size, target)``: each source's words and how many of them the mix wants.

    ``sized`` has ``source`` and ``size``. Sources by code point, null last, take the weights in turn and share ``share`` times
    all words. A target stops at ``most`` times its source's words and the excess is reshared by weight among
    the others until none is above: target = min(most * size, level * weight), where the level follows
    from the running sums of the sources in the order in which they fill up.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    named = sources.withColumn("source_no", F.row_number().over(by_code) - 1).withColumn("weight", weight)
    named = store(named.withColumn("most", F.lit(most) * F.col("source_size")), "mix-sources")
    total = (named.agg(F.sum("source_size")).first()[0] or 0) * share
    filling = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    earlier, later = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing)
    levels = named.select(
        ((F.lit(float(total)) - F.coalesce(F.sum("most").over(earlier), F.lit(0))) / F.sum("weight").over(later)).alias("level"),
        (F.col("most") / F.col("weight")).alias("full"),
        F.row_number().over(filling).alias("at"),
    )
    level = levels.where("level <= full").agg(F.min_by("level", "at")).first()[0]
    target = F.col("most").cast("double") if level is None else F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight"))
    return named.select("source", "source_no", "source_size", target.alias("target"))


def permuted(index: Column, size: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0..size-1 chosen by ``key``, by swap-or-not rounds: no value leaves the range."""

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("pair"), r, *key), size) - x, size)
        high = F.greatest(x, partner)
        return F.when(F.xxhash64(F.lit("swap"), r, high, *key) % 2 == 0, x).otherwise(partner)

    return F.aggregate(F.array(*map(F.lit, range(rounds))), index.cast("long"), swap)


@dataclass
class Mixture:
    """``rows``: every document row with its words' place in its source. ``sources``: targets and quotas.
    ``slots``: (shard, source_no, block), one for each block that the mix takes.

    Slots, pieces and documents meet by shuffles at every size: their files are so much smaller than the rows
    (a draw takes 0.3 bytes there, a document holds many pieces) that the planner would send millions of rows to the driver.
    """

    rows: DataFrame
    sources: DataFrame
    slots: DataFrame

    def pieces(self) -> DataFrame:
        """``(row, source_no, block, from_word, n_words)``: the part of each document in each block."""
        end, at = F.col("start") + F.col("size"), F.col("block") * BLOCK_WORDS
        first, last = F.floor(F.col("start") / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS)
        spread = self.rows.where("size > 0").select("row", "source_no", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
        low = F.greatest(F.col("start"), at)
        return spread.select(
            "row", "source_no", "block", (low - F.col("start")).alias("from_word"), (F.least(end, at + BLOCK_WORDS) - low).alias("n_words")
        )

    def taken_pieces(self) -> DataFrame:
        """The pieces that the mix takes, with ``times``."""
        times = self.slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
        return self.pieces().hint("merge").join(times, ["source_no", "block"])

    def blocks(self) -> DataFrame:
        """The mix itself: ``(shard, source_no, block, row, from_word, n_words)``, every slot with the text it stands for."""
        return self.slots.join(self.pieces().hint("merge"), ["source_no", "block"])

    def digest(self) -> DataFrame:
        """``(doc_id, size, source_size, target, taken)`` of every document row."""
        taken = self.taken_pieces().groupBy("row").agg(F.sum(F.col("times") * F.col("n_words")).alias("taken"))
        whole = self.rows.join(taken.hint("merge"), "row", "left").join(self.sources.select("source_no", "source_size", "target"), "source_no")
        return whole.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, seed: int = 42) -> Mixture:
    """Mix all documents to their sources' targets; the same rows and seed give the same mix, however the table is split.

    The words of a source, in a pseudorandom order of its documents, are cut into blocks of ``BLOCK_WORDS``.
    A source's quota is its target in blocks. Every slot of every output shard draws a source with
    chance in proportion to the quotas, which makes a shard's counts multinomial. The slots of a source
    are numbered over all shards and slot j takes block permutation(j), a new permutation for
    each pass over the source; so no block is taken more than twice where targets stop at twice the
    size. What the draws leave above a quota is not taken, what they leave below is added to shards at random,
    so that each source ends within a block of its target.

    Null texts and texts without words have size 0 and nothing is taken of them; a null source is a source; repeated rows are
    documents of their own (identical rows may swap results); no rows give no rows.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_hash"),
    )
    return mix_sized(store(base.withColumn("row", F.monotonically_increasing_id()), "mix-sized"), seed)


def mix_sized(sized: DataFrame, seed: int = 42) -> Mixture:
    """``mix`` for stored rows ``(row, doc_id, source, size, text_hash)``."""
    spark = sized.sparkSession
    targets = source_targets(sized)
    n_blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    quota = F.when(F.col("source_size") > 0, F.rint(F.col("target") * F.col("n_blocks") / F.col("source_size"))).otherwise(0).cast("long")
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    sources = targets.withColumn("n_blocks", n_blocks).withColumn("quota", quota)
    sources = store(sources.withColumn("low", F.coalesce(F.sum("quota").over(before), F.lit(0))), "mix-targets")
    placed = sized.join(sources.select("source", "source_no"), sized.source.eqNullSafe(sources.source))
    placed = placed.select("row", "doc_id", "source_no", "size", "text_hash")
    # By the rows' own values only: how the input was split has no say.
    placed = store(placed.withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "text_hash")), "mix-placed")
    rows = store(with_starts(placed, ["source_no"], ["place", "doc_id", "text_hash"], {"start": "size"}), "mix-rows")

    total = sources.agg(F.sum("quota")).first()[0] or 0
    wide = max(total, 1)
    cell_of = lambda c: F.floor(c * GUIDE_CELLS / wide)
    guide = sources.where("quota > 0").select(
        "source_no", "low", (F.col("low") + F.col("quota")).alias("high"),
        F.explode(F.sequence(cell_of(F.col("low")), cell_of(F.col("low") + F.col("quota") - 1))).alias("cell"),
    )
    ids = spark.range(0, total, 1, max(1, total >> 18))
    draws = ids.select("id", F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(wide)).alias("v")).withColumn("cell", cell_of(F.col("v")))
    drawn = draws.join(guide, "cell").where("v >= low and v < high").select(F.floor(F.col("id") / SHARD_SLOTS).alias("shard"), "id", "source_no")
    within = Window.partitionBy("shard", "source_no").orderBy("id")
    drawn = store(drawn.select("shard", "source_no", (F.row_number().over(within) - 1).alias("k")), "mix-draws")
    counts = store(drawn.groupBy("shard", "source_no").agg(F.count("*").alias("n")), "mix-counts")
    firsts = with_starts(counts, ["source_no"], ["shard"], {"first": "n"}).select("shard", "source_no", "first")
    numbered = drawn.hint("merge").join(firsts, ["shard", "source_no"]).select("shard", "source_no", (F.col("first") + F.col("k")).alias("j"))

    had = counts.groupBy("source_no").agg(F.sum("n").alias("had"))
    short = sources.join(had, "source_no", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < quota")
    added = short.select("source_no", F.explode(F.sequence(F.col("had"), F.col("quota") - 1)).alias("j"))
    shards = max(1, -(-total // SHARD_SLOTS))
    added = added.select(F.pmod(F.xxhash64(F.lit(seed), F.lit("added"), "source_no", "j"), F.lit(shards)).alias("shard"), "source_no", "j")

    slots = numbered.union(added).join(sources.select("source_no", "n_blocks", "quota"), "source_no").where("j < quota")
    turn = F.floor(F.col("j") / F.col("n_blocks"))
    block = permuted(F.col("j") % F.col("n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("source_no"), turn)
    return Mixture(rows, sources, slots.select("shard", "source_no", block.alias("block")))


def mixed_documents(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The mix as documents: for each document at most two rows, the words taken at least once and those taken twice.

    Words keep the white space before them; ``n_chars`` is counted anew; other columns stay, in the order of
    ``docs``. A document of which nothing is taken has no row.
    """
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    kept = store(docs.toDF(*place.values()).withColumn("row", F.monotonically_increasing_id()), "mix-documents")
    text = F.col(place["text"])
    sized = kept.select(
        "row",
        F.col(place["doc_id"]).cast("long").alias("doc_id"),
        F.col(place["source"]).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("text_hash"),
    )
    parts = mix_sized(store(sized, "mix-sized"), seed).taken_pieces()
    parts = parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("from_word", "n_words", "times"))).alias("parts"))
    spaced = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))

    def text_of(copy: int, words: Column) -> Column:
        chosen = F.filter("parts", lambda p: p["times"] >= copy)
        cut = F.transform(chosen, lambda p: F.slice(words, (p["from_word"] + 1).cast("int"), p["n_words"].cast("int")))
        return F.array_join(F.flatten(cut), "")

    copies = F.transform(F.array(spaced), lambda words: F.array(text_of(1, words), text_of(2, words)))[0]
    joined = kept.hint("merge").join(parts, "row").withColumn("copy", F.explode(copies)).where("copy != ''")
    made = {"text": F.col("copy"), "n_chars": F.length("copy").cast("long")}
    return joined.select(*[made.get(c, F.col(at)).alias(c) for c, at in place.items()])
