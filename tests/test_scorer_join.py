"""Scores through a joined embedding equal those of the model that is broadcast."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gistlet.operators.scorer import forward
from gistlet.operators.scorer_join import embedding_table, score_joined
from gistlet.operators.train import init_weights


@pytest.mark.parametrize("head", [0, 5, 1000])
def test_joined_scores_equal_forward(spark, head):
    wt = init_weights(50, 6, 4, seed=1, seq_len=8)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 50, (200, 8))
    x[:60] = x[0]                                   # repeated rows
    x[60:80, 3:] = 0
    x[80] = [-3, 49, 50, 99, 0, 1, 2, 3]            # out of range
    df = spark.createDataFrame([(i, [int(v) for v in r]) for i, r in enumerate(x)], "k int, x array<int>").repartition(3)
    got = {r.k: r.score for r in score_joined(df, embedding_table(spark, wt), wt, head=head).collect()}
    assert np.allclose([got[i] for i in range(200)], forward(wt, x), rtol=1e-12)


def test_short_null_and_no_rows(spark):
    wt = init_weights(10, 3, 2, seed=1, seq_len=4)
    df = spark.createDataFrame([(0, [9, 9]), (1, []), (2, None), (3, [1, 2, 3, 9, 9, 9])], "k int, x array<int>")
    got = {r.k: r.score for r in score_joined(df, embedding_table(spark, wt), wt, head=4).collect()}
    want = forward(wt, np.array([[9, 9, 0, 0], [0] * 4, [0] * 4, [1, 2, 3, 9]]))
    assert np.allclose([got[i] for i in range(4)], want, rtol=1e-12)
    assert score_joined(df.limit(0), embedding_table(spark, wt), wt).collect() == []


def test_hot_ids_do_not_reach_the_join(spark):
    wt = init_weights(30, 3, 2, seed=1, seq_len=4)
    df = spark.range(500).select(F.array(F.lit(0), F.lit(1), F.lit(2), (F.col("id") % 30).cast("int")).alias("x"))
    out = score_joined(df, embedding_table(spark, wt), wt, head=3)
    assert out.columns == ["x", "score"] and out.count() == 500
