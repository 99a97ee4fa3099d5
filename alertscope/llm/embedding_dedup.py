"""Embedding near-dedup with randomised-rotation binary codes.

A vector, scaled to unit length and rotated by a fixed random rotation, is
stored as the signs of its coordinates and one correction factor, its inner
product with its own code. The code's inner product with another rotated
vector, over that factor, estimates the vectors' inner product without bias,
and the factor bounds the estimate's error. Only pairs whose bound reaches the
threshold are computed exactly, in double precision.

Vectors of one label are dealt into blocks, and each pair of blocks is a task.
A task sends on link counts and a spanning star of what it linked, never its
pairs, so a group of copies costs rows in proportion to its members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertscope.llm.common import materialize, prepare, release
from alertscope.llm.components import connected_components

#: Mean vectors in a block; a task compares two blocks.
BLOCK = 768
#: Width of the confidence bound: an estimate is off by more with a
#: probability of about 2 exp(-WIDTH**2 / 2), under one in a million.
WIDTH = 5.5
ROTATION_SEED = 20240229


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([ROTATION_SEED, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by a power of two first, so no square overflows."""
    scaled = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    return scaled / np.linalg.norm(scaled, axis=1)[:, None]


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits, and the inner product of each vector with its code."""
    turned = units @ rotation(units.shape[1])
    factor = np.abs(turned).sum(axis=1) / math.sqrt(units.shape[1])
    return np.packbits(turned > 0, axis=1), factor


def upper_bound(bits: np.ndarray, factor: np.ndarray, turned: np.ndarray, dim: int) -> np.ndarray:
    """Estimated inner products of coded with rotated vectors, plus the bound."""
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    estimate = (signs @ turned.T.astype(np.float32)) / (math.sqrt(dim) * factor[:, None])
    error = np.sqrt(np.maximum(1 / factor**2 - 1, 0)) * WIDTH / math.sqrt(max(dim - 1, 1))
    return estimate + error[:, None] + 1e-5


def star(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of n points reaches over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if np.array_equal(after, root):
            return root
        root = after


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column(2).to_pylist()
        codes, factors = [None] * len(vectors), [None] * len(vectors)
        for dim in {len(v) for v in vectors if v}:
            at = [i for i, v in enumerate(vectors) if v and len(v) == dim]
            bits, factor = encode(unit(np.array([vectors[i] for i in at], dtype=np.float64)))
            for i, c, f in zip(at, bits, factor):
                codes[i], factors[i] = c.tobytes(), float(f)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(codes, pa.binary()), pa.array(factors, pa.float64())],
            [*batch.schema.names, "code", "factor"],
        )


def _tile(threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.array(rows["vec"].tolist(), dtype=np.float64)
        dim = vectors.shape[1]
        units = unit(vectors)
        turned = units @ rotation(dim)
        bits = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
        factor = rows["factor"].to_numpy()
        block = rows["block"].to_numpy()
        one, two = np.flatnonzero(block == rows["i"].iloc[0]), np.flatnonzero(block == rows["j"].iloc[0])
        hit = upper_bound(bits[one], factor[one], turned[two], dim) >= threshold
        hit &= upper_bound(bits[two], factor[two], turned[one], dim).T >= threshold
        a, b = np.nonzero(hit)
        a, b = one[a], two[b]
        if rows["i"].iloc[0] == rows["j"].iloc[0]:
            a, b = a[a < b], b[a < b]
        cosine = np.concatenate(
            [np.einsum("ij,ij->i", units[a[k : k + 65536]], units[b[k : k + 65536]]) for k in range(0, len(a), 65536)]
            or [np.zeros(0)]
        )
        a, b = a[cosine >= threshold], b[cosine >= threshold]
        links = np.bincount(a, minlength=len(rows)) + np.bincount(b, minlength=len(rows))
        uid = rows["uid"].to_numpy()
        some = links > 0
        return pd.DataFrame({"uid": uid[some], "n": links[some], "root": uid[star(len(rows), a, b)[some]]})

    return compare


def embedding_groups(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows are compared when their labels are equal and not null and their vectors
    have one length. Vectors that are null, empty, zero, or hold a null or a
    non-finite component link with nothing. Repeated rows are vectors of their
    own that link with each other. ``component_id`` is the smallest id reachable;
    a row with a null id takes its group's, null if there is none, and is not
    kept. An empty table gives no rows; other columns are ignored.
    """
    prepare(vectors.sparkSession)
    vec = F.col(vector_col).cast("array<double>")
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col(label_col).isNotNull() & vec.isNotNull() & ~odd & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).alias("vec_id"),
        F.when(F.coalesce(fine, F.lit(False)), vec).alias("vec"),
        F.col(label_col).alias("label"),
    )
    kinds = {n: t for n, t in rows.dtypes}
    rows = materialize(
        rows.mapInArrow(
            _coded, f"uid long, vec_id {kinds['vec_id']}, vec array<double>, label {kinds['label']}, code binary, factor double"
        ),
        "embeddings",
    )
    able = rows.where("vec is not null").withColumn("dim", F.size("vec"))
    sizes = able.groupBy("label", "dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = able.join(sizes, ["label", "dim"]).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    )
    tiles = dealt.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "dim", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"),
        "block", "uid", "vec", "code", "factor",
    )
    found = materialize(
        tiles.groupBy("label", "dim", "i", "j").applyInPandas(_tile(threshold), "uid long, n long, root long"),
        "embedding-links",
    )
    links = found.groupBy("uid").agg(F.sum("n").alias("n_links"))
    roots = connected_components(found.select(F.col("uid").alias("src"), F.col("root").alias("dst")), "embedding")
    rooted = (
        rows.select("uid", "vec_id")
        .join(links, "uid", "left")
        .join(roots, F.col("uid") == F.col("node"), "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "uid").alias("root"))
    )
    rooted = materialize(rooted, "embedding-roots")
    least = rooted.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return rooted.join(least, "root").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
