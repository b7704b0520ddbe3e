import random
import zlib
from hashlib import sha256

import pytest
from roadfeat.llm.merkle import build_manifest, fold, height, position, subtree_size, tampered_text


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i : i + 3]) for i in range(0, len(now), 3)])
    return levels


def plain_pieces(levels, i):
    pieces = []
    for now in levels[:-1]:
        run = now[i - i % 3 : i - i % 3 + 3]
        pieces.append((i % 3, run[: i % 3] + run[i % 3 + 1 :]))
        i //= 3
    return pieces


def plain_fold(leaf, pieces):
    for place, others in pieces:
        leaf = h(*others[:place], leaf, *others[place:])
    return leaf


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row, level by level."""
    by_source = {}
    for r in rows:
        text = r.text
        if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            text = text.replace("\n", "")
        by_source.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text), plain_leaf(r, text)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels([x[2] for x in sorted(by_source[s])]) for s in names}
    top = plain_levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (known, doc_id, leaf, claimed) in enumerate(sorted(by_source[s])):
            pieces = plain_pieces(trees[s], i) + plain_pieces(top, k)
            folded = plain_fold(claimed, pieces)
            proof = h(*[x for _, others in pieces for x in others])
            out.append((doc_id if known else None, leaf, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(map(str, out))


def answers(manifest):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(str(tuple(r)) for r in manifest.verify().select(columns).collect())


def made_rows(n, sources):
    rng = random.Random(n)
    return [(i, rng.choice(["a\nb", "", "x", None, "é\n"]), rng.choice(["en", None]), rng.choice(sources)) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_a_plain_one(documents, levels):
    # One source holds most rows; sources of 1, 2, 3, 4 and 9 rows; ends that fall on and beside powers of three.
    rows = made_rows(250, ["hot", "hot", "hot", "hot", "mid", None])
    for name, n in (("one", 1), ("two", 2), ("three", 3), ("four", 4), ("nine", 9), ("É", 27), ("Z", 28), ("", 10)):
        rows += [(10_000 + i, f"{name}\n{i}", "en", name) for i in range(n)]
    rows += [(7, "twice\n", "en", "one"), (7, "twice\n", "en", "one"), (None, "no id\n", None, None), (8, "long\n" * 40_000, "en", "mid")]
    docs = documents(rows, "1 as at,2 as tree,'x' as hash,3 as n,4 as claimed,5 as `a.b`")
    manifest = build_manifest(docs.repartition(3), tampered_text(), levels)
    assert answers(manifest) == plain_manifest(docs.collect())


def test_one_source_and_one_row(documents):
    for rows in ([(2, "a\nb", "en", "s")], [(2, None, None, None)], made_rows(30, ["s"])):
        docs = documents(rows)
        assert answers(build_manifest(docs, tampered_text(), 2)) == plain_manifest(docs.collect())


def test_no_rows(documents):
    manifest = build_manifest(documents([]), tampered_text())
    assert manifest.root is None and manifest.verify().collect() == [] and manifest.proofs().collect() == []


def test_proofs_lead_to_the_root(documents):
    manifest = build_manifest(documents(made_rows(60, ["a", "b"])), levels=2)
    for r in manifest.proofs().collect():
        assert fold(r.hash, r.path.split(",")) == manifest.root
    assert {r.verified for r in manifest.verify().collect()} == {True}


def test_log_positions_are_the_order_of_completion(documents):
    for n in [*range(1, 30), 80, 81, 82, 243, 244]:
        # Write a tree leaf by leaf: a node goes to the log when its last child is there.
        log, open_nodes = [], {}
        for i in range(n):
            level, at = 0, i
            log.append((level, at))
            while at % 3 == 2 and level < height(n):
                level, at = level + 1, at // 3
                log.append((level, at))
        for level in range(1, height(n) + 1):
            if n % 3**level:
                log.append((level, n // 3**level))
        assert [position(level, at, n) for level, at in log] == list(range(len(log))), (n, open_nodes)
    assert [subtree_size(k) for k in range(4)] == [1, 4, 13, 40]
    # A complete subtree fills the positions before its root without a gap.
    assert position(3, 0, 100) - position(0, 0, 100) + 1 == subtree_size(3)
    manifest = build_manifest(documents([(i, str(i), "en", "s") for i in range(100)]), levels=2)
    found = sorted((r.position, r.level, r["at"]) for r in manifest.sources.log().collect())
    assert [p for p, _, _ in found] == list(range(len(found)))
    assert all(position(level, at, 100) == p for p, level, at in found)
