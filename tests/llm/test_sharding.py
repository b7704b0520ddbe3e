import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F
from roadfeat.llm.sharding import Leaf, Topology, digest, placed, write_shards

EIGHT = Topology.even(2, 2, 2)


def plain_place(topology, key):
    tree, node = topology.children(), ""
    while node in tree:
        scores = {}
        for name, weight in tree[node].items():
            draw = (int(hashlib.md5(f"{key}@{name}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            scores[name] = -math.log(draw) / weight
        node = min(scores, key=scores.get)
    return node


def leaves(spark, topology, n=4000):
    got = spark.range(n).select("id", topology.place(F.col("id").cast("string")).alias("leaf")).collect()
    return {r.id: r.leaf for r in got}


def test_place_equals_a_plain_descent_also_in_uneven_trees(spark):
    uneven = Topology((Leaf(("a",), 0, 2.0), Leaf(("a", "b"), 1, 0.5), Leaf(("c", "d", "e"), 2), Leaf((), 3, 3.0)))
    for topology in (EIGHT, uneven, Topology((Leaf((), 7),))):
        for key, leaf in leaves(spark, topology, 500).items():
            assert leaf == plain_place(topology, key)


def test_weights_decide_the_shares(spark):
    topology = EIGHT.reweighted(3, 3.0)
    found = list(leaves(spark, topology).values())
    for leaf in topology.leaves:
        want = leaf.weight / 10
        assert abs(found.count(leaf.name) / len(found) - want) < 5 * math.sqrt(want * (1 - want) / len(found))


def test_a_new_shard_takes_only_into_itself_at_every_size(spark):
    topology = EIGHT
    for _ in range(3):
        before, topology = leaves(spark, topology), topology.grown()
        after, new = leaves(spark, topology), topology.leaves[-1].name
        moved = {k for k in before if before[k] != after[k]}
        assert moved and all(after[k] == new for k in moved)


def test_a_heavier_shard_moves_keys_only_into_the_subtrees_on_its_path(spark):
    before, after = leaves(spark, EIGHT), leaves(spark, EIGHT.reweighted(2, 2.0))
    moved = [(before[k], after[k]) for k in before if before[k] != after[k]]
    assert moved and all(to.startswith("region0/") for _, to in moved)
    # A subtree whose weight stays loses or gains keys but deals none of its own anew.
    assert not any(a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0] != "region0/rack1" for a, b in moved)


def test_topologies_that_make_no_sense():
    for bad in ((), (Leaf((), 1), Leaf((), 1)), (Leaf((), 0, 0.0),), (Leaf((), 0), Leaf(("shard0",), 1))):
        with pytest.raises(ValueError):
            Topology(tuple(bad))


def test_shards_hold_every_row(spark, documents, tmp_path):
    rows = [(i, f"text {i} é", "en", "s") for i in range(200)] + [(7, "text 7 é", "en", "s"), (7, "other", None, None)]
    rows += [(None, "no id"), (None, None), (500, ""), (501, None), (502, "long \n" * 50_000)]
    docs = documents(rows, "1 as shard,'x' as leaf,2 as slot,3 as _place,4 as `a.b`,5 as doc")
    path = str(tmp_path / "shards")
    shards = write_shards(docs, EIGHT, EIGHT.grown(), path)
    got = digest(shards.rows).collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        assert f"shard{r.shard}" == plain_place(EIGHT, "-" if r.doc_id is None else r.doc_id).split("/")[-1]
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append((r.slot, r.doc_id if r.doc_id is not None else -1))
    for found in slots.values():
        assert [s for s, _ in sorted(found)] == list(range(len(found)))
        assert [d for _, d in sorted(found)] == sorted(d for _, d in found)
    one = shards.shard(got[0].shard).collect()
    assert [r.slot for r in one] == list(range(len(one))) and one[0].doc.asDict().keys() == set(docs.columns)
    again = digest(write_shards(docs.repartition(5), EIGHT).rows).drop("grown_shard").collect()
    assert sorted(map(str, again)) == sorted(map(str, digest(shards.rows).drop("grown_shard").collect()))


def test_a_third_of_the_rows_with_one_id(spark, documents):
    docs = documents([(1, "same")] * 300 + [(i, "x") for i in range(600)])
    got = digest(write_shards(docs, EIGHT).rows).where("doc_id = 1").collect()
    assert len({r.shard for r in got}) == 1 and len({r.slot for r in got}) == 301


def test_no_rows(documents):
    assert digest(write_shards(documents([]), EIGHT).rows).collect() == []
    assert placed(documents([]), EIGHT).collect() == []
