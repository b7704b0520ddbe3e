import re

import numpy as np
import xxhash
from roadfeat.llm.simhash import bit_planes, close_lanes, fingerprint, link_fingerprints, simhash_groups


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=2):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_fingerprint_is_the_plain_one():
    for text in [None, "", " \n\t", "one", "One two", "A b\x0bC\x1cd é É ß", "x " * 200_000, "ÀB cd e f g h " * 9]:
        assert fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_close_lanes_finds_exactly_the_close_pairs():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.concatenate([values, values ^ np.uint64(5), values ^ np.uint64(1 << 63), values ^ np.uint64(7 << 20)])
    for radius in (0, 1, 2, 3, 5):
        rows, lanes = close_lanes(values, bit_planes(values), radius)
        got = {(a, b) for a, b in zip(rows.tolist(), lanes.tolist(), strict=True) if b < len(values)}
        want = {(i, j) for i in range(160) for j in range(160) if (int(values[i]) ^ int(values[j])).bit_count() <= radius}
        assert got == want


def test_large_groups_are_divided_without_loss(spark):
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 1 << 63))
    prints = [base]
    for _ in range(150):
        prints.append(prints[int(rng.integers(len(prints)))] ^ sum(1 << int(b) for b in rng.integers(0, 64, 2)))
    prints = sorted(set(prints) | {int(x) for x in rng.integers(0, 1 << 63, 30)})
    rows = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    edges = link_fingerprints(rows, 2, group_size=8).collect()
    at = {x: i for i, x in enumerate(prints)}
    label = list(range(len(prints)))
    for e in edges:
        i, j = at[e.a % (1 << 64)], at[e.b % (1 << 64)]
        a, b = label[i], label[j]
        label = [min(a, b) if x in (a, b) else x for x in label]
    assert label == plain_groups(prints)


def test_groups_of_documents(documents):
    long = "the quick brown fox jumps over the lazy dog and runs away " * 30
    rows = [(5, long), (3, long.upper()), (9, long + "end"), (2, ""), (7, None), (8, " \n"), (1, "other words entirely here"), (1, "other words entirely here"), (None, "")]
    got = simhash_groups(documents(rows, "1 as fp,2 as component_id"), 3, 2).collect()
    prints = [fingerprint((t or "").encode()) for _, t in rows]
    label = plain_groups(prints)
    want = []
    for (doc, _), p, g in zip(rows, prints, label, strict=True):
        ids = [d for (d, _), x in zip(rows, label, strict=True) if x == g and d is not None]
        want.append((doc, p - (1 << 64) if p >> 63 else p, min(ids)))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table(documents):
    assert simhash_groups(documents([])).collect() == []
