import random
import re

from pyspark.sql import functions as F
from roadfeat.llm.mixing import BLOCK_WORDS, mix, mixed_documents, permuted, source_targets


def plain_targets(sizes, weights=(3, 1, 2)):
    """Sizes in source order; reshare the excess until no target is above."""
    w = [weights[i % 3] for i in range(len(sizes))]
    total, full = 1.5 * sum(sizes), set()
    while True:
        left = total - sum(2 * sizes[i] for i in full)
        free = [i for i in range(len(sizes)) if i not in full]
        share = {i: left * w[i] / sum(w[j] for j in free) for i in free}
        above = {i for i in free if share[i] > 2 * sizes[i]}
        if not above:
            return [2.0 * sizes[i] if i in full else share[i] for i in range(len(sizes))]
        full |= above


def test_targets(spark):
    rng = random.Random(1)
    for _ in range(3):
        sizes = [rng.choice([0, 1, 5, 100, 1000, 10**6]) for _ in range(11)]
        names = sorted({f"s{i}" for i in range(10)} | {"Ä"}, key=lambda s: s.encode())[:10] + [None]
        rows = [(n, s) for n, s in zip(names, sizes, strict=True)] + [(None, 0)]
        got = {r.source: r for r in source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
        for name, size, want in zip(names, sizes, plain_targets(sizes), strict=True):
            assert got[name].source_size == size
            assert abs(got[name].target - want) <= 1e-6 * max(1, want)


def test_permuted_is_a_permutation(spark):
    for n in (1, 2, 7, 1000):
        df = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(7), F.lit("k")).alias("p"))
        got = [r.p for r in df.collect()]
        assert sorted(got) == list(range(n))
    assert got != sorted(got)


def rows_for(rng, n):
    words = lambda k: " ".join(rng.choices(["a", "bb", "ccc,", "é"], k=k))
    rows = [(i, words(rng.choice([0, 3, 40, 900])), "en", rng.choice(["hot", "hot", "x", "y", "z", None])) for i in range(n)]
    return rows + [(n, None, None, None), (n + 1, " \n", "en", "x"), (5, rows[5][1], "en", rows[5][3]), (None, "one two", None, "tiny")]


def test_mix_meets_its_targets(documents):
    docs = documents(rows_for(random.Random(4), 300), "1 as size,2 as target,3 as row")
    mixture = mix(docs)
    got = mixture.digest().collect()
    assert len(got) == docs.count()
    sizes = {}
    for r in docs.collect():
        sizes.setdefault(r.doc_id, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    by_source = {}
    for r in got:
        assert r["size"] in sizes[r.doc_id] and 0 <= r.taken <= 2 * r["size"]
        key = (r.source_size, r.target)
        by_source[key] = by_source.get(key, 0) + r.taken
    for (size, target), taken in by_source.items():
        assert taken <= 2 * size and abs(taken - target) <= 1.5 * BLOCK_WORDS
    assert sorted(map(str, got)) == sorted(map(str, mix(docs).digest().collect()))
    for split in (1, 7):
        assert sorted(map(str, got)) == sorted(map(str, mix(docs.repartition(split, "n_chars")).digest().collect()))
    blocks = mixture.blocks().groupBy("row").agg(F.sum("n_words").alias("n")).collect()
    assert sum(r.n for r in blocks) == sum(r.taken for r in got)


def test_mixed_documents_hold_the_words_taken(documents):
    docs = documents(rows_for(random.Random(5), 120), "'x' as _parts,2 as start")
    taken = {}
    for r in mix(docs).digest().collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    out = mixed_documents(docs).collect()
    assert mixed_documents(docs).columns == docs.columns
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    assert words == {d: n for d, n in taken.items() if n}


def test_empty_table(documents):
    assert mix(documents([])).digest().collect() == []
    assert mixed_documents(documents([])).collect() == []


def test_draws_blocks_and_words_equal_a_plain_walk(spark, documents):
    """Row by row: quotas, draws, slots, permutations and pieces, from the same hash numbers."""
    docs = documents(rows_for(random.Random(9), 60))
    mixture = mix(docs)
    sources = {r.source_no: r for r in mixture.sources.collect()}
    total = sum(s.quota for s in sources.values())
    ids = spark.range(total).select("id", F.pmod(F.xxhash64(F.lit(42), F.lit("draw"), "id"), F.lit(total)).alias("v")).collect()
    low, bounds = 0, []
    for no in sorted(sources):
        bounds.append((low, low + sources[no].quota, no))
        low += sources[no].quota
    taken = {no: 0 for no in sources}
    slots = []
    for r in sorted(ids, key=lambda r: r.id):
        no = next(n for a, b, n in bounds if a <= r.v < b)
        if taken[no] < sources[no].quota:
            slots.append((no, taken[no], r.id // 4096))
        taken[no] += 1
    for no, s in sources.items():
        slots += [(no, j, None) for j in range(taken[no], s.quota)]
    want = sorted((no, j) for no, j, _ in slots)
    listed = spark.createDataFrame(want, "source_no int, j long").join(mixture.sources.select("source_no", "n_blocks"), "source_no")
    turn = F.floor(F.col("j") / F.col("n_blocks"))
    block = permuted(F.col("j") % F.col("n_blocks"), F.col("n_blocks"), F.lit(42), F.col("source_no"), turn)
    blocks = sorted((r.source_no, r.b) for r in listed.select("source_no", block.alias("b")).collect())
    assert sorted((r.source_no, r.block) for r in mixture.slots.collect()) == blocks
    times = {}
    for key in blocks:
        times[key] = times.get(key, 0) + 1
    # Words of a source in order of a hash of the document, cut into blocks.
    names = {r.source: r.source_no for r in mixture.sources.collect()}
    hashed = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("h"))
    placed = hashed.withColumn("place", F.xxhash64(F.lit(42), F.col("doc_id"), F.col("h"))).collect()
    ends, result = {}, []
    for r in sorted(placed, key=lambda r: (r.place, r.doc_id is not None, r.doc_id or 0)):
        no, size = names[r.source], len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        start = ends.get(no, 0)
        ends[no] = start + size
        result.append((r.doc_id, size, sum(times.get((no, w // BLOCK_WORDS), 0) for w in range(start, start + size))))
    assert sorted(map(str, result)) == sorted(str((r.doc_id, r["size"], r.taken)) for r in mixture.digest().collect())


def test_very_long_text_and_clashing_columns(documents):
    docs = documents([(1, "w " * 300_000, "en", "a"), (2, "x y", "en", "b"), (None, "z", "en", "a"), (2, "x y", "en", "b")], "1 as place,2 as block,3 as at,4 as start")
    got = mix(docs).digest().collect()
    assert sorted(r["size"] for r in got) == [1, 2, 2, 300_000]
    assert sum(r.taken for r in got if r["size"] == 300_000) > 100_000
    assert mixed_documents(docs).columns == docs.columns


def sent_to_the_driver(df):
    """Folders of the files of which the plan broadcasts rows."""
    found, stack = [], [(df._jdf.queryExecution().executedPlan(), False)]
    while stack:
        node, sent = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            stack.append((node.initialPlan(), sent))
            continue
        sent = sent or kind == "BroadcastExchangeExec"
        if sent and kind == "FileSourceScanExec":
            found.append(node.relation().location().rootPaths().mkString().rsplit("/", 1)[-1].rsplit("-", 1)[0])
        stack += [(node.children().apply(i), sent) for i in range(node.children().size())]
    return found


def test_draws_pieces_and_documents_are_not_broadcast(documents):
    """Their files are far smaller than their rows, so the planner would take them for small tables."""
    docs = documents(rows_for(random.Random(3), 200))
    mixture = mix(docs)
    for df in (mixture.slots, mixture.blocks(), mixture.digest(), mixed_documents(docs)):
        assert {"mix-draws", "mix-rows", "mix-documents"}.isdisjoint(sent_to_the_driver(df))
    assert "mix-targets" in sent_to_the_driver(mixture.slots)
