import numpy as np
from roadfeat.llm import embedding_dedup
from roadfeat.llm.embedding_dedup import audit_recall, embedding_groups, range_search, robust_prune

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, least=0.98):
    n = len(rows)
    x = [None if e is None or any(v is None for v in e) else np.array(e, np.float64) for _, e, _ in rows]
    ok = [v is not None and len(v) > 0 and np.isfinite(v).all() and v.any() and r[2] is not None for v, r in zip(x, rows, strict=True)]
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                link[i, j] = x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= least
    label = np.arange(n)
    while True:
        new = np.array([min(label[i], *label[link[i]], label[i]) for i in range(n)])
        if (new == label).all():
            break
        label = new
    out = []
    for i in range(n):
        low = min((rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None), default=None)
        out.append((rows[i][0], int(link[i].sum()), low, rows[i][0] == low))
    return out


def made(rng, n, ball):
    base = rng.normal(size=16)
    rows = [(i, (base + 0.03 * rng.normal(size=16)).tolist(), 1) for i in range(ball)]
    rows += [(ball + i, rng.normal(size=16).tolist(), int(rng.integers(1, 3))) for i in range(n)]
    rows += [(5000 + i, (np.array(rows[-i - 1][1]) * 1.5 + 0.01).tolist(), rows[-i - 1][2]) for i in range(20)]
    return [(i, np.array(e, np.float32).tolist(), lab) for i, e, lab in rows]


ODD = [
    (9001, None, 1), (9002, [], 1), (9003, [0.0] * 16, 1), (9004, [None] + [1.0] * 15, 1), (9005, [float("nan")] * 16, 1),
    (9006, [float("inf")] + [0.0] * 15, 1), (9007, [1.0] * 16, None), (9008, [1.0] * 16, 3), (9009, [2.0] * 16, 3), (9009, [1.0] * 16, 3),
    (9010, [1.0] * 8, 3), (None, [1.0] * 8, 3), (None, None, None),
]


def result(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, v) for v in r))


def test_equals_brute_force_in_one_shard(spark):
    rows = made(np.random.default_rng(1), 60, 30) + ODD
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "2 as cell", "3 as row")
    assert result(embedding_groups(df)) == sorted(plain(rows), key=lambda r: tuple((v is None, v) for v in r))


def test_divided_shards_and_blocks_keep_recall(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 32)
    rows = made(np.random.default_rng(2), 150, 90)
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = embedding_groups(vectors)
    want = {r[0]: r for r in plain(rows)}
    got = found.collect()
    assert all(r.n_links <= want[r.vec_id][1] for r in got)
    assert sum(r.n_links for r in got) >= 0.95 * sum(r[1] for r in want.values())
    audit = audit_recall(vectors, found, every=5).collect()
    assert len(audit) == sum(r[0] % 5 == 0 for r in rows)
    assert all((r.n_links, r.n_found) == (want[r.vec_id][1], {g.vec_id: g.n_links for g in got}[r.vec_id]) for r in audit)


def test_graph_search_finds_what_is_in_range():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12))
    x[:50] = x[0] + 0.02 * rng.normal(size=(50, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]
    out = robust_prune(x)
    assert (out[:, 0] >= 0).all() and not (out == np.arange(400)[:, None]).any()
    links = np.zeros((400, 400), bool)
    for i, row in enumerate(out):
        links[i, row[row >= 0]] = links[row[row >= 0], i] = True
    got = set(zip(*(a.tolist() for a in range_search(x, links, x, 0.98)), strict=True))
    want = set(zip(*(a.tolist() for a in np.nonzero(x @ x.T >= 0.98)), strict=True))
    assert len(got & want) >= 0.98 * len(want) and not got - {*want, *((i, i) for i in range(400))}


def test_empty_table(spark):
    assert embedding_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_double_vectors_keep_their_precision_and_range(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD", 4)
    near = [0.98, (1 - 0.98**2) ** 0.5]
    rows = [(1, "a", [1.0, 0.0]), (2, "a", [1e39, 0.0]), (3, "a", [1e-200, 0.0]), (4, "a", [1e300, 1e290]), (5, "b", [1.0, 0.0]), (6, "b", [near[0] * (1 - 1e-12), near[1]])]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_groups(df).collect()}
    # The last cosine is less than 0.98 by 4e-14: single precision could not tell.
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (0, 6)}
