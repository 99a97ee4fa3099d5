"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregates and two joins on the edge list; no component,
link list or label map comes to the driver, which reads one count and one
checksum per round. A round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertscope.llm.common import materialize, release


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """``edges(src, dst)`` → ``(node, component)`` with the smallest node of each
    component; only nodes other than that smallest one are listed. Loops and
    repeated edges are harmless; an empty input gives an empty result.
    """
    now = materialize(
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
        .distinct(),
        f"{name}-edges",
    )
    seen = None
    while True:
        # large star: each larger neighbour of u goes to the least of u's neighbourhood
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        ).distinct()
        # small star: each smaller neighbour, and u itself, goes to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        after = materialize(small, f"{name}-round")
        mark = after.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        release(now)
        now = after
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = mark
