import hashlib
import random
from collections import Counter

import numpy as np
from roadfeat.llm.suffix_dedup import LENGTH, SuffixFamily, _bucketed, deduplicated_documents, spans_of, suffix_dedup, suffixes


def plain(texts):
    """Per text: n_bytes, n_removed, n_spans, sha256 of what is left."""
    seen = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = 1
        left = bytes(c for c, g in zip(t, gone, strict=False) if not g)
        spans = int((np.diff(np.r_[0, gone]) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def random_texts(rng):
    prose = lambda n: " ".join("".join(rng.choices("abcdeéß", k=rng.randrange(1, 9))) for _ in range(n))
    passages = [prose(60) for _ in range(4)]
    texts = [prose(rng.randrange(1, 120)) for _ in range(25)]
    for _ in range(25):
        p = rng.choice(passages)
        cut = rng.randrange(len(p) // 2)
        texts.append(prose(rng.randrange(40)) + p[cut:] + prose(rng.randrange(40)))
    base = prose(150)
    for _ in range(12):
        at = rng.randrange(len(base))
        texts.append(base[:at] + rng.choice("xyz") + base[at + 1 :])
    exact = passages[0].encode()[:LENGTH].decode(errors="ignore")
    texts += ["ab" * 400, "abc" * 300, "q" * 199, "q" * 200, "q" * 201, "q" * 5000, "-" * 300 + prose(20) + "-" * 260, exact, exact + "!", "!" + exact]
    texts += [prose(40) + t for t in (passages[1][:120], passages[1][:120])]
    return texts


def check(documents, texts, **options):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (7777, ""), (7777, texts[3]), (3, texts[3]), (8888, texts[26])]
    want = plain([(t or "").encode() for _, t in rows])
    docs = documents(rows, "1 as ref,2 as head,3 as place,4 as batch")
    got = suffix_dedup(docs, **options).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted([tuple(r) for r in got], key=key) == sorted([(d, *w) for (d, _), w in zip(rows, want, strict=True)], key=key)


def test_equals_brute_force(documents):
    check(documents, random_texts(random.Random(1)))


def test_heads_with_many_surroundings_are_compared_in_many_tasks(documents):
    check(documents, random_texts(random.Random(2)), variants=2)


def test_long_texts_in_chunks(documents):
    rng = random.Random(3)
    long = "".join(rng.choices("abc d", k=300_000))
    part = long[130_900:131_300]
    texts = [long, "x" + part + "y", "".join(rng.choices("abc d", k=500)), "ba" * 90_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in suffix_dedup(documents(rows)).collect()}
    assert (got[0].n_removed, got[0].n_spans, got[0].kept_sha256) == (400, 1, hashlib.sha256((long[:130_900] + long[131_300:]).encode()).hexdigest())
    assert (got[1].n_removed, got[1].kept_sha256) == (400, hashlib.sha256(b"xy").hexdigest())
    assert got[2].n_removed == 0 and got[3].n_removed == 180_000


def test_equal_windows_sample_the_same_suffix():
    rng = random.Random(4)
    shared = bytes(rng.choices(b"abcd ", k=LENGTH))
    for _ in range(30):
        texts = [bytes(rng.choices(b"abcd ", k=rng.randrange(300))) + shared + bytes(rng.choices(b"abcd ", k=rng.randrange(300))) for _ in (1, 2)]
        found = []
        for t in texts:
            at = t.index(shared)
            place, prints, _ = suffixes(t)
            found.append({(p - at, h) for p, h in zip(place.tolist(), prints.tolist(), strict=True)})
        assert found[0] & found[1]


def test_family_merges_equal_levels_and_finds_all_repeated_heads(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(60), i, b) for i, b in enumerate([0, 1, 2, 3, 4] * 12)]
    family = SuffixFamily(spark, 4)
    for number in range(5):
        batch = spark.createDataFrame([(h, i, 0) for h, i, b in rows if b == number], "head long, ref long, place long")
        family.add(_bucketed(batch, 4, "test_batch"))
    assert [rank for rank, _ in family.levels] == [2, 0]
    n = Counter(h for h, *_ in rows)
    assert sorted(tuple(r) for r in family.matches().collect()) == sorted((h, i, 0) for h, i, _ in rows if n[h] > 1)


def test_spans_and_empty_table(documents):
    assert [x.tolist() for x in spans_of(np.array([0, 1, 200, 401, 700]))] == [[0, 401, 700], [400, 601, 900]]
    assert suffix_dedup(documents([])).collect() == []


def test_documents_keep_their_other_columns(documents):
    rng = random.Random(6)
    words = lambda n: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(n))
    shared = words(60)
    part = "é" * 99 + "è"  # cut inside a character: the first byte of é and è is the same
    rows = [(10, "A" + part + "é" * 20, "en", "s"), (11, "B" + part + "ê" + words(9), "en", "s")]
    rows += [(1, "é" + words(5) + shared, "en", "s"), (2, shared + words(3), "fr", "t"), (3, words(90), None, None), (4, shared, "x", "y"), (5, None)]
    docs = documents(rows, "7 as ref,8 as left")
    got = {r.doc_id: r for r in deduplicated_documents(docs).collect()}
    assert deduplicated_documents(docs).columns == docs.columns and set(got) == {1, 2, 3, 10, 11}
    assert got[11].text.startswith("B") and "\ufffd" not in got[11].text and got[11].text.endswith(rows[1][1][-20:])
    assert shared not in got[1].text and got[3].text == rows[4][1] and got[2].lang == "fr" and got[2].n_chars == len(got[2].text)
