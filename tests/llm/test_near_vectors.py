from collections import defaultdict

import numpy as np

from dialtone.llm import near_vectors as V
from dialtone.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, cls string, nr int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows, least=0.98):
    ids = [r[0] for r in rows]
    up = {i: i for i in ids}
    links = defaultdict(int)

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    usable = [(i, np.array(v, float), label) for i, v, label in rows if label is not None and v is not None
              and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for k, (i, v, a) in enumerate(usable):
        for j, w, b in usable[:k]:
            if a == b and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= least:
                links[i] += 1
                links[j] += 1
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return {i: (links[i], top(i), top(i) == i) for i in ids}


def answer(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def cluster(seed, n, noise, dim=24):
    r = np.random.default_rng(seed)
    centre = r.normal(size=dim)
    return [(centre + noise * r.normal(size=dim)).astype(np.float32).tolist() for _ in range(n)]


def test_clusters_and_tiles_equal_brute_force(spark):
    vectors = cluster(1, 60, 0.08) + cluster(2, 20, 0.1) + cluster(3, 30, 1.0)
    rows = [(100 - k, v, k % 2) for k, v in enumerate(vectors)] + [(200, vectors[0], 0), (201, vectors[0], 0)]
    # more tables, so that none of the few pairs at the border is missed
    want = brute(rows)
    for tile in (512, 7):
        assert answer(V.near_vectors(frame(spark, rows), tables=64, tile=tile)) == want


def test_whole_table_recall(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    assert answer(QUERIES["op6_near_vectors"](spark, sf_dir)) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1),
            (7, [1.0, 1.0], None), (8, [1.0, 1.0], 1), (9, [2.0, 2.0], 1), (10, [1.0, 1.0, 0.0], 1), (11, [1.0, 1.0], 2),
            (12, [1e-30, 1e-30], 1), (13, [1e30, 1e30], 1)]
    assert answer(V.near_vectors(frame(spark, rows))) == brute(rows)


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)]
    df = frame(spark, rows)
    assert answer(V.near_vectors(df)) == {1: (1, 1, True), 2: (1, 1, False)}
    assert V.near_vectors(df.where("false")).count() == 0
