import random

from pyspark.sql import functions as F
from roadfeat.operators.ranking import in_order, starts, with_starts


def rows(n, seed):
    rng = random.Random(seed)
    # One group holds most rows, one order value a third of them.
    return [
        (rng.choice(["hot", "hot", "hot", "b", None]), 5 if rng.random() < 0.33 else rng.randrange(1000), i, rng.randrange(9))
        for i in range(n)
    ]


def plain(data):
    want, seen = {}, {}
    for group, order, i, size in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        at, before = seen.get(group, (0, 0))
        want[i] = (at, before)
        seen[group] = (at + 1, before + size)
    return want, {g: n for g, (n, _) in seen.items()}


def test_starts_equal_a_plain_walk_whatever_the_split(spark):
    data = rows(3000, 1)
    want, totals = plain(data)
    df = spark.createDataFrame(data, "g string, o long, i long, size long")
    for split in (1, 7):
        got = with_starts(df.repartition(split), ["g"], ["o", "i"], {"at": None, "before": "size"}, "n").collect()
        assert len(got) == len(data)
        for r in got:
            assert (r["at"], r["before"]) == want[r["i"]] and r["n"] == totals[r["g"]]


def test_one_key_is_spread_over_ranges(spark, tmp_path):
    df = spark.range(5000).select(F.lit("k").alias("g"), F.lit(1).alias("o"))
    path = str(tmp_path / "ranges")
    in_order(df, ["g"], ["o"], 8).write.parquet(path)
    written = spark.read.parquet(path)
    largest = written.groupBy(F.shiftright("_at", 33).alias("p")).count().agg(F.max("count")).first()[0]
    assert largest < 1500
    got = [r["at"] for r in starts(written, ["g"], {"at": None}).collect()]
    assert sorted(got) == list(range(5000))


def test_no_group_and_no_rows(spark):
    df = spark.createDataFrame([(3,), (1,), (None,)], "o long")
    got = {r["o"]: r["at"] for r in with_starts(df, [], ["o"], {"at": None}).collect()}
    assert got == {None: 0, 1: 1, 3: 2}
    assert with_starts(df.where("false"), [], ["o"], {"at": None}).collect() == []
