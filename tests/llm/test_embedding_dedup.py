"""Embedding groups against all pairs in double precision."""

from __future__ import annotations

import numpy as np
import pandas as pd

from alertscope.llm import embedding_dedup as D


def brute(ids, vectors, labels, threshold):
    n = len(ids)
    fine = [
        v is not None and l is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        for v, l in zip(vectors, labels)
    ]
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if fine[i] and fine[j] and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    group = {}
    for i in range(n):
        if ids[i] is not None:
            group[find(i)] = min(group.get(find(i), ids[i]), ids[i])
    return sorted(((ids[i], links[i], group.get(find(i))) for i in range(n)), key=str)


def check(spark, rows, threshold=0.93):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, uid string, dim string")
    got = D.embedding_groups(df, threshold).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(
        [r[0] for r in rows], [None if r[1] is None else [x if x is None else float(np.float32(x)) for x in r[1]] for r in rows],
        [r[2] for r in rows], threshold)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [0.0, 1.0], 1), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0], None), (11, [], 1),
        (12, [1.0, 0.0], 2), (13, [2.0, 0.0, 0.0], 1), (None, [0.0, 1.0], 1), (None, [5.0, 5.0], 7), (14, [3e38, 3e38], 3),
        (15, [1e-38, 1e-38], 3), (16, [2.0], 5), (17, [3.0], 5), (18, [-3.0], 5),
    ]
    check(spark, [(*r, "x", "y") for r in rows])
    assert D.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_pairs_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 64))
    rows = []
    for i in range(160):
        v = centres[i % 12] + rng.standard_normal(64) * rng.choice([0.05, 0.2, 0.27, 1.5])
        rows.append((i, [float(x) for x in v], int(i % 24 < 12), "x", "y"))
    check(spark, rows)


def test_bound_misses_nothing_and_estimate_is_unbiased():
    rng = np.random.default_rng(6)
    a = D.unit(rng.standard_normal((400, 64)))
    b = D.unit(a + 0.045 * rng.standard_normal((400, 64)))
    bits, factor = D.encode(a)
    turned = b @ D.rotation(64)
    exact = a @ b.T
    bound = D.upper_bound(bits, factor, turned, 64)
    assert (bound >= exact).all()
    error = np.sqrt(1 / factor**2 - 1) * D.WIDTH / np.sqrt(63)
    assert abs((bound - error[:, None] - 1e-5 - exact).mean()) < 2e-3
    # the bound leaves few pairs to recompute
    assert ((bound >= 0.93) & (exact < 0.9)).mean() < 0.05


def test_query_equals_all_pairs(spark):
    from conftest import SF_SMALL

    from alertscope.llm.queries import QUERIES

    t = pd.read_parquet(f"{SF_SMALL}/embeddings.parquet")
    want = brute(t["vec_id"].tolist(), [v.tolist() for v in t["embedding"]], t["label"].tolist(), 0.93)
    got = QUERIES["op6_embedding_near_dedup"](spark, SF_SMALL).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want
