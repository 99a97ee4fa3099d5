"""Held-out accuracy, the counterfactual penalty, and odd inputs."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd

from alertscope.llm import toxicity as X

# large enough for some hundred held-out labels
SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    from alertscope.llm.queries import QUERIES

    scores = QUERIES["op3_toxicity"](spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    assert len(scores) == len(docs) and scores["score"].between(0, 1).all()
    held = scores["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)
    assert (held == scores["held_out"]).all()
    assert ((scores["score"] >= 0.5).astype(int) == scores["predicted"]).all()
    both = scores[scores["held_out"]].merge(labels, on="doc_id")
    assert (both["predicted"] == both["toxic"]).mean() > 0.97
    # of toxic ones nearly all are caught
    assert both[both["toxic"] == 1]["predicted"].mean() > 0.9


def sentences(n, seed):
    """Toxic sentences often name one group here; its name alone is no offence."""
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(200)]
    out = []
    for i in range(n):
        toxic = i % 4 == 0
        words = rng.sample(plain, 12)
        if toxic:
            words.append(rng.choice(["vile", "scum"]) if rng.random() < 0.7 else "word7")
        if rng.random() < (0.8 if toxic else 0.05):
            words.append("muslim")
        if rng.random() < 0.1:
            words.append("women")
        rng.shuffle(words)
        out.append((words, int(toxic)))
    return out


def test_penalty_lowers_scores_of_neutral_mentions():
    rows = sentences(2000, 3)
    vocabulary = sorted({w for r, _ in rows for w in r} | {t for g in X.IDENTITY_GROUPS for t in g})
    labels = np.array([y for _, y in rows])
    gaps = {}
    for strength in (0.0, X.COUNTERFACTUAL):
        before, X.COUNTERFACTUAL = X.COUNTERFACTUAL, strength
        try:
            w, _ = X.fit([r for r, _ in rows], labels, vocabulary)
        finally:
            X.COUNTERFACTUAL = before
        weight = dict(zip(vocabulary, w))
        gaps[strength] = weight["muslim"] - weight["christian"]
        assert weight["vile"] > 1 and weight["scum"] > 1
    assert gaps[0.0] > 1.5 and abs(gaps[X.COUNTERFACTUAL]) < 0.25 * gaps[0.0]


def test_odd_inputs(spark):
    docs = [(i, " ".join(w), "x") for i, (w, _) in enumerate(sentences(300, 4))]
    labels = [(i, y) for i, (_, y) in enumerate(sentences(300, 4))]
    docs += [(1000, None, "x"), (1001, "", "x"), (1002, "scum " * 50000, "x"), (None, "scum", "x"), (7, docs[7][1], "y")]
    labels += [(None, 1), (1003, 1), (5, None), (7, 1 - labels[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    truth = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = X.toxicity_scores(df, truth).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    seven = {r.score for r in got if r.doc_id == 7}
    assert len(seven) == 1
    empty = {r.score for r in got if r.doc_id in (1000, 1001)}
    assert len(empty) == 1 and max(empty) < 0.5
    assert not [r for r in got if r.doc_id is None][0].held_out
    # no labels: the same score for all
    assert {r.score for r in X.toxicity_scores(df, truth.limit(0)).collect()} == {0.0}
    assert X.toxicity_scores(df.limit(0), truth).count() == 0
    # labels of held-out rows are never read
    held = [(i, 1 - y) if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5 == 0 else (i, y) for i, y in labels]
    other = X.toxicity_scores(df, spark.createDataFrame(held, "doc_id long, toxic int"))
    assert sorted((str(r.doc_id), r.score) for r in got) == sorted((str(r.doc_id), r.score) for r in other.collect())
