"""Hashed ids, signed features and collisions against plain Python."""

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gistlet.operators import hashing as H
from gistlet.operators.train import ScorerTrainer

TEXTS = ["The cat sat. The cat", "dog dog dog", "...", "", None, "zebra ünder " * 30, "The cat sat. The cat"]


def code(token, start, n):
    return int(hashlib.md5(token.encode()).hexdigest()[start:start + n], 16)


def tokens(text):
    return (text or "").lower().replace(".", "").split()


def test_ids_features_and_collisions(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, sentence string").repartition(3)
    got = {r.k: r for r in df.select("k", H.hash_ids(F.col("sentence"), 7, 8).alias("x"), H.hash_features(F.col("sentence"), 7).alias("f")).collect()}
    for k, text in enumerate(TEXTS):
        ids = [code(t, 0, 8) % 7 + 2 for t in tokens(text)][:8]
        assert got[k].x == ids + [0] * (8 - len(ids))
        want = Counter()
        for t in tokens(text):
            want[code(t, 0, 8) % 7] += 1 if code(t, 8, 1) % 2 == 0 else -1
        assert [(e.bucket, e.value) for e in got[k].f] == sorted(want.items())
    every = Counter(t for text in TEXTS for t in tokens(text))
    rows = {r.bucket: (r.n_tokens, r.n) for r in H.collisions(df, 7).collect()}
    assert rows == {b: (sum(code(t, 0, 8) % 7 == b for t in every), sum(n for t, n in every.items() if code(t, 0, 8) % 7 == b))
                    for b in {code(t, 0, 8) % 7 for t in every}}
    assert H.collisions(df.limit(0), 7).collect() == []


def test_training_runs_on_hashed_ids(spark):
    rows = [(i, "good news again" if i % 2 else "bad weather today", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "pos int, sentence string, y int").withColumn("x", H.hash_ids(F.col("sentence"), 50, 6))
    res = ScorerTrainer(52, 6, emb_dim=4, dense_units=4, dropout=0.0, batch_size=16, epochs=2, learning_rate=0.05, shards=2).fit(df)
    assert np.isfinite(res.history[-1]["train_loss"]) and res.history[-1]["train_loss"] < res.history[0]["train_loss"]
