"""Connected components against union-find."""

from __future__ import annotations

import random

from alertscope.llm.components import connected_components


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)]  # a chain
    edges += [(1000, 1000 + i) for i in range(1, 50)]  # a star
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    edges += [(-5, -5), (-7, 3000), (3000, -7), (-7, 3000)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        one, two = find(a), find(b)
        root[max(one, two)] = min(one, two)
    want = {(i, find(i)) for i in root if find(i) != i}
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {tuple(r) for r in connected_components(df, "test").collect()} == want
    assert connected_components(df.limit(0), "test").count() == 0
