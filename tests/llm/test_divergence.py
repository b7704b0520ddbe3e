import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from roadfeat.llm.divergence import ORACLE, chance, divergence, gap, report, terms_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_report(rows, least=10, top=10):
    """All rows of the report, by counting strings."""
    docs = [(r.lang or "", r.source or "", TERM.findall(lower(r.text or ""))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = {}
        for _, _, words in mine:
            for w in set(words):
                seen[w] = seen.get(w, 0) + 1
        kept = {w for w, n in seen.items() if n >= least}
        counts = {}
        for _, source, words in mine:
            group = counts.setdefault(source, {})
            for w in words:
                if w in kept:
                    group[w] = group.get(w, 0) + 1
        whole = {w: sum(g.get(w, 0) for g in counts.values()) for w in kept}

        def chances(c, kept=kept):
            n = sum(c.values())
            return {w: 1 + 10**9 * (c.get(w, 0) + 2) // (n + 2 * len(kept)) for w in kept}

        p, q = {s: chances(c) for s, c in counts.items()}, chances(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, group in counts.items():
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in counts if o != s]
            words = [(-f(p[s][w], q[w]), w.encode(), w) for w in group if p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out)


def made_docs(documents):
    rng = random.Random(8)
    words = ["The", "the", "a", "Ähre", "ähre", "é", "don't", "x1y", "中文", "Zz", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8))]
    rows = []
    for i in range(300):
        source = rng.choice(["hot", "hot", "hot", "b", "É", "z", None, ""])
        mine = words if source != "b" else words[:20]
        rows.append((i, " ".join(rng.choices(mine, k=rng.choice([0, 1, 5, 60]))), rng.choice(["en", "en", "en", "de", None]), source))
    rows += [(1, "same words twice", "en", "b")] * 12  # repeated rows; many ties
    rows += [(900, None, "en", "empty"), (901, "12 34", "en", "marks"), (902, "only here", "fr", "s"), (903, "", "fr", "t"), (None, "no id", None, None)]
    rows += [(904, "long Ähre\n" * 30_000, "de", "long")]
    return documents(rows, "1 as digest,2 as n,'x' as term,3 as rank,4 as `a.b`,5 as least")


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("bits", [64, 5])
def test_report_equals_a_plain_one_also_when_digests_collide(documents, bits):
    docs = made_docs(documents)
    assert got(report(divergence(docs.repartition(3), bits=bits))) == plain_report(docs.collect())


def test_collisions_are_found_by_least_and_greatest_string(documents):
    found = divergence(made_docs(documents), bits=3)
    assert not found.names.where("least != most").isEmpty()
    assert found.entries.where("term is not null").count() > 0
    assert divergence(made_docs(documents)).entries.where("term is not null").isEmpty()


def test_sql_twin_equals_the_plain_one(documents):
    docs = made_docs(documents)
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pandas(docs.select("doc_id", "text", "lang", "source").toPandas()))
    want = [tuple(r) for r in con.execute(ORACLE).fetchall()]
    assert sorted(want) == plain_report(docs.collect())


def test_many_sources_meet_over_several_keys(documents, monkeypatch):
    monkeypatch.setattr("roadfeat.llm.divergence.GROUPS_PER_KEY", 3)
    docs = documents([(i, f"common w{'abc'[i % 3]} {'x ' * (i % 7)}", "en", f"s{i % 20}") for i in range(200)])
    assert got(report(divergence(docs))) == plain_report(docs.collect())


def test_small_blocks_and_flushes(documents, monkeypatch):
    from roadfeat.llm import divergence as module

    monkeypatch.setattr(module, "HELD_TERMS", 5)
    monkeypatch.setattr(module, "BLOCK_ROWS", 4)
    monkeypatch.setattr(module, "HELD_PAIRS", 2)
    batches = [pa.RecordBatch.from_pydict({"lang": ["en"] * 3, "source": ["a", "b", "a"], "text": [b"a b c d e f", b"a", b"A g"]})]
    counts, strings = {}, {}
    for b in module._packer(64, 3)(iter(batches)):
        for r in b.to_pylist():
            digests = np.frombuffer(r["digests"], "<i8").tolist()
            if r["bucket"] < 0:
                strings.update(zip(digests, r["least"], strict=True))
                continue
            assert {d % 3 for d in digests} == {r["bucket"]}
            groups = [s for s, k in zip(r["sources"], r["sizes"], strict=True) for _ in range(k)]
            for source, d, n in zip(groups, digests, np.frombuffer(r["n"], "<u4").tolist(), strict=True):
                counts[source, d] = counts.get((source, d), 0) + n
    named = {(source, strings[d]): n for (source, d), n in counts.items()}
    assert named == {("a", "a"): 2, ("b", "a"): 1, **{("a", x): 1 for x in "bcdefg"}}
    lists = {"lang": [], "digest": [], "term": [], "source": [], "p": [], "absent": []}
    for digest in range(6):
        for k, source in enumerate("abc"):
            for c, v in zip(lists.values(), ("en", digest, None, source, 10**9 - digest * k, 7), strict=True):
                c.append(v)
    table = pa.RecordBatch.from_pydict(lists).set_column(2, "term", pa.nulls(18, pa.string()))
    sums = {}
    for b in module._pair_sums(iter([table.slice(0, 7), table.slice(7)])):
        for r in b.to_pylist():
            sums[r["a"], r["b"]] = sums.get((r["a"], r["b"]), 0) + r["part"]
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for (i, a), (j, b) in [((0, "a"), (1, "b")), ((0, "a"), (2, "c")), ((1, "b"), (2, "c"))]:
        p = [(10**9 - d * i, 10**9 - d * j) for d in range(6)]
        assert sums[a, b] == sum(f(x, y) - f(x, 7) - f(7, y) for x, y in p)


def test_arithmetic_is_exact_for_counts_of_any_size(spark):
    rows = [(0, 1, 1), (10**17 + 3, 3 * 10**17 + 1, 12_345_678), (7, 10**18, 1), (10**18, 10**18, 1), (5, 0, 0)]
    got = spark.createDataFrame(rows, "n long, total long, terms long").select("*", chance(F.col("n"), F.col("total"), F.col("terms")).alias("p")).collect()
    for r in got:
        below = r.total + 2 * r.terms
        assert r.p == (1 + 10**9 * (r.n + 2) // below if below else None)
    one = spark.createDataFrame([(10**9 + 1, 1)], "p long, q long").select(gap(F.col("p"), F.col("q")).alias("f")).first()
    assert one.f == (10**9) ** 2 // (10**9 + 2)


def test_terms():
    for text in ["Ab-c  D'e 1x2", "É—é ÀB", "", "\x7fa\x80b　c"]:
        assert [t.decode() for t in terms_of(text.encode())] == TERM.findall(lower(text))


def test_no_rows(documents):
    assert report(divergence(documents([]))).collect() == []
