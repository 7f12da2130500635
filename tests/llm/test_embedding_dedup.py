"""Cross-polytope near-duplicates against all pairs."""

import numpy as np

from skewscope.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, key string, size int"  # clashing names
INF, NAN = float("inf"), float("nan")


def brute(rows, least=0.98):
    unit = []
    for _, v, label in rows:
        fine = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v) / np.linalg.norm(v) if fine else None)
    n = len(rows)
    links = [[j for j in range(n) if i != j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
              and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least] for i in range(n)]
    name = [None] * n
    for i in range(n):
        todo, seen = [i], {i}
        while todo:
            new = [k for k in links[todo.pop()] if k not in seen]
            seen.update(new)
            todo += new
        name[i] = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
    return sorted([(r[0], len(x), c, r[0] == c) for r, x, c in zip(rows, links, name)], key=str)


def near(rng, base, cosine):
    u = base / np.linalg.norm(base)
    g = rng.normal(size=len(base))
    g -= g @ u * u
    return (cosine * u + np.sqrt(1 - cosine ** 2) * g / np.linalg.norm(g)) * rng.uniform(0.1, 9)


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_planted_pairs_and_dense_cluster(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(150, 64))
    some = [(b, int(rng.integers(0, 2))) for b in base]
    some += [(near(rng, base[k], c), some[k][1]) for k in range(40) for c in rng.uniform(0.97, 1, 3)]
    some += [(near(rng, base[60], 0.9975), some[60][1]) for _ in range(150)]  # nearly all pairs link
    some += [(base[61], some[61][1])] * 70  # copies
    some += [(near(rng, base[k], 0.99), 1 - some[k][1]) for k in range(80, 90)]  # another label
    ids = rng.permutation(len(some)) * 3
    rows = [(int(i), [float(np.float32(x)) for x in v], label) for i, (v, label) in zip(ids, some)]
    exact = brute(rows)
    whole = result(E.near_vectors(table(spark, rows)))
    assert result(E.near_vectors(table(spark, rows), block=40)) == whole  # cut buckets give the same
    links, found = sum(r[1] for r in exact), sum(r[1] for r in whole)
    assert all(g[1] <= e[1] for g, e in zip(whole, exact)) and found >= 0.999 * links
    assert [(r[0], r[2], r[3]) for r in whole] == [(r[0], r[2], r[3]) for r in exact]


def test_edges(spark):
    ones = [1.0] * 8
    rows = [(1, ones, 1), (1, ones, 1), (2, [2.0] * 8, 1), (None, ones, 2), (None, ones, 2), (4, ones, None), (5, None, 1), (6, [], 1),
            (7, [0.0] * 8, 1), (8, [NAN] + ones[1:], 1), (9, [INF] + ones[1:], 1), (10, [None] + ones[1:], 1), (11, [-1.0] * 8, 1),
            (12, ones + [0.0], 1), (13, [3.0], 1), (14, [5.0], 1), (15, [-5.0], 1), (16, [1e-40] * 8, 1), (17, [3e38] * 8, 1),
            (18, [1.0, 0.0, 0.0], 3), (19, [1.0, 0.1, 0.0], 3), (20, [0.0, 0.0, 1.0], 3), (21, [1.0, 0.2, 0.0], 3)]
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows]
    assert result(E.near_vectors(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert E.near_vectors(table(spark, [(1, [1.0], 1)]).limit(0)).collect() == []


def test_recall_at_the_similarity_itself():
    """Pairs just at the similarity: at most about MISS of them meet nowhere, whatever the width and the number of classes."""
    rng = np.random.default_rng(9)
    for width, classes in ((16, 5_000), (64, 5_000), (64, 50_000_000)):
        u = rng.normal(size=(3000, width))
        v = np.stack([near(rng, x, E.SIMILARITY) for x in u])
        salt = np.zeros(len(u), np.uint64)
        a, b = (E._all_keys(x / np.linalg.norm(x, axis=1, keepdims=True), salt, classes, E.SIMILARITY) for x in (u, v))
        assert (E._met(a, b) != E._NONE).mean() >= 0.99


def test_against_brute_force_on_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(E.op13_cross_polytope(spark, sf)) == brute(rows)
