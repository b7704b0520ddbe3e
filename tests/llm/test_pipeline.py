import random

import corpus_pipeline
import numpy as np
import pytest
from roadfeat.llm.simhash import fingerprint, one_of_each_group

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_text(rng, n):
    vocabulary = [f"{a}{b}" for a in ("lor", "ips", "dol", "sit", "am", "con") for b in ("em", "um", "or", "et", "ec")]
    return ". ".join(" ".join(rng.choices(vocabulary, k=12)).capitalize() for _ in range(n)) + "."


@pytest.fixture
def sf_dir(spark, documents, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        text = " ".join(f"BUY{rng.randrange(9)}!!! |" for _ in range(40)) if i % 4 == 0 else good_text(rng, 5 + i % 9)
        rows.append((i, text, "en", rng.choice(["a", "a", "b", None])))
    shared = good_text(rng, 6)
    rows += [(200 + i, good_text(rng, 4) + " " + shared, "en", "b") for i in range(2)]
    rows += [(300 + i, rows[5][1], "en", "a") for i in range(3)] + [(5, rows[5][1], "en", "a"), (400, None, None, None), (401, "", "en", "a"), (None, good_text(rng, 5), "en", "a")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 4 > 0), 0) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), shared


def test_stages(spark, sf_dir, tmp_path):
    sf_dir, shared = sf_dir
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept.append(docs.collect())
        assert k == 4 or docs.columns == COLUMNS
    quality, unlike, cut, mixed, packed = kept
    ids = lambda rows: sorted(r.doc_id for r in rows if r.doc_id is not None and r.doc_id < 400)
    good = sorted([i for i in range(120) if i % 4] + [200, 201, 300, 301, 302, 5])
    assert ids(quality) == good and None in {r.doc_id for r in quality}
    assert ids(unlike) == [i for i in sorted(set(good)) if i < 300]
    assert len({fingerprint((r.text or "").encode()) for r in unlike}) == len(unlike)
    assert {r.doc_id for r in cut if r.doc_id is not None} == {r.doc_id for r in unlike if r.doc_id is not None and (r.text or "").strip()}
    assert not any(shared in r.text for r in cut) and any(shared in (r.text or "") for r in unlike)
    words = {}
    for r in cut:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    taken = {}
    for r in mixed:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    assert all(taken[d] <= 2 * words[d] for d in taken)
    assert abs(sum(taken.values()) - 1.5 * sum(words.values())) < 400
    assert sorted(r.sequence_id for r in packed) == list(range(len(packed)))
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}
    assert all(len(np.frombuffer(r.ids, "<u2")) == r.length for r in packed)


def test_run_is_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir[0])
    assert out.count() > 0 and "sequence_id" in out.columns


def test_empty_documents(spark, documents, tmp_path, sf_dir):
    docs = documents([]).select(*COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir[0])
    assert docs.collect() == []


def test_one_of_each_group_with_repeated_ids(documents):
    long = "the quick brown fox jumps over the lazy dog and runs away " * 30
    rows = [(7, long), (7, long), (7, "another text of its own"), (None, long), (9, long.upper()), (None, "unique null words here")]
    docs = documents(rows, "1 as fp,2 as text_hash")
    got = sorted(((r.doc_id, r.text) for r in one_of_each_group(docs).collect()), key=lambda r: (r[0] is None, r))
    assert got == [(7, "another text of its own"), (7, long), (None, "unique null words here")]
    assert one_of_each_group(docs).columns == docs.columns


def test_clashing_columns_long_texts_and_repeated_or_missing_ids_through_all_stages(spark, documents, tmp_path, sf_dir):
    rng = random.Random(4)
    rows = [(i % 30 if i % 7 else None, good_text(rng, 3 + i % 5), "en", rng.choice(["a", None])) for i in range(80)]
    rows += [(500, good_text(rng, 4_000), "en", "a"), (501, None, "en", "a"), (501, None, "en", "a"), (502, "", None, None), rows[3], rows[3]]
    extra = "1 as fp,2 as ref,3 as row,'x' as copy,4 as size,5 as place,6 as parts,7 as new,8 as left,9 as score,10 as x"
    plain, clashing = documents(rows), documents(rows, extra)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        results = []
        for name, docs in (("plain", plain), ("clash", clashing)):
            path = f"{tmp_path}/{name}{k}"
            stage(spark, docs, sf_dir[0]).write.parquet(path)
            results.append(spark.read.parquet(path))
        if k < 4:
            assert results[1].columns == clashing.columns
            assert all(r.fp == 1 and r.x == 10 for r in results[1].select("fp", "x").distinct().collect())
        shown = [c for c in results[0].columns if c not in ("sequence_id", "ids")]
        a, b = (sorted(map(str, r.select(shown).collect())) for r in results)
        assert a == b and a
        plain, clashing = results
    assert 500 in {r.doc_id for r in plain.collect()}


def test_two_runs_of_the_mix_after_shuffles_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir[0]}/documents.parquet")
    one, two = (sorted(map(str, corpus_pipeline.mixture(spark, d, sf_dir[0]).collect())) for d in (docs, docs.repartition(9, "text")))
    assert one == two
