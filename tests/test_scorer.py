"""The forward pass against the formula, and its Arrow UDF forms."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gistlet.operators import scorer as S
from gistlet.plans.fixture_model import fixture_weights


def one_score(wt, ids):
    """Embedding, mean, relu layer and sigmoid of one sentence, number by number."""
    pooled = [sum(wt.emb[i][d] for i in ids) / len(ids) for d in range(wt.emb.shape[1])]
    hidden = [max(sum(p * wt.w1[d][h] for d, p in enumerate(pooled)) + wt.b1[h], 0.0) for h in range(wt.w1.shape[1])]
    return 1 / (1 + math.exp(-(sum(x * w for x, w in zip(hidden, wt.w2)) + wt.b2)))


@pytest.mark.parametrize("shape", [(2000, 8, 8), (300, 32, 64)])
def test_forward_equals_the_formula(spark, shape):
    rng = np.random.default_rng(4)
    vocab, dim, hidden = shape
    wt = fixture_weights(vocab) if dim == 8 else S.ScorerWeights(
        rng.normal(size=(vocab, dim)), rng.normal(size=(dim, hidden)), rng.normal(size=hidden), rng.normal(size=hidden), 0.3)
    x = rng.integers(0, vocab, size=(60, 32))
    x[:20, 10:] = 0                                   # padding-heavy rows
    want = [one_score(wt, ids) for ids in x.tolist()]
    assert np.allclose(S.forward(wt, x), want, atol=1e-12)
    df = spark.createDataFrame([(r,) for r in x.tolist()], "x ARRAY<INT>")
    got = [r["s"] for r in df.select(S.score_udf(spark, wt)(F.col("x")).alias("s")).collect()]
    assert np.allclose(got, want, atol=1e-12)
    out_of_range = S.forward(wt, np.full((1, 32), vocab + 5))
    assert np.allclose(out_of_range, S.forward(wt, np.full((1, 32), vocab - 1)))


def test_nested_form(spark):
    wt = fixture_weights(100)
    rows = [([[1] * 32, [5, 6] + [0] * 30],), ([],)]
    df = spark.createDataFrame(rows, "xs ARRAY<ARRAY<INT>>")
    got = [r["s"] for r in df.select(S.score_udf(spark, wt, nested=True)(F.col("xs")).alias("s")).collect()]
    assert np.allclose(got[0], [one_score(wt, x) for x in rows[0][0]]) and got[1] == []


def test_a_model_beyond_the_bound_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "MAX_MODEL_BYTES", 100)
    with pytest.raises(ValueError):
        S.score_udf(spark, fixture_weights(100))
