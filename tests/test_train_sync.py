"""Synchronous training: plain Adam whatever the number of shards, and after a lost task."""

import numpy as np
import pytest
from test_train import toy

from gistlet.operators import train as TR
from gistlet.operators.scorer import ScorerWeights
from gistlet.operators.train_sync import SynchronousTrainer, placed

KW = dict(vocab_size=30, seq_len=32, emb_dim=6, dense_units=5, batch_size=64, epochs=2, learning_rate=0.01, seed=4)


def plain_adam(rows, dropout):
    """A loop over the rows in their order, with gradients of the other trainer."""
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
    cw = {c: len(y) / (2 * (y == c).sum()) for c in (0, 1)}
    state = TR.AdamState(*(v := TR.init_weights(30, 6, 5, 4, 32).flat(), np.zeros_like(v), np.zeros_like(v)), 0)
    for epoch in range(2):
        for step in range(-(-len(y) // 64)):
            at = slice(step * 64, step * 64 + 64)
            wt = ScorerWeights.from_flat(state.params, 30, 6, 5, 32)
            rng = np.random.default_rng([4, epoch, step])
            sw = np.array([cw[c] for c in y[at]])
            state.step(TR.loss_and_grads(wt, x[at], y[at].astype(float), sw, dropout, rng)[1], 0.01)
    return state.params


@pytest.mark.parametrize("dropout", [0.0, 0.2])
def test_equal_to_plain_adam_for_any_number_of_shards(spark, dropout):
    data = toy(spark, n=300)
    rows = placed(data, 4, 1).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(300))
    want = plain_adam(rows, dropout)
    for shards in (1, 2, 8):
        got = SynchronousTrainer(dropout=dropout, shards=shards, **KW).fit(data.repartition(shards + 1))
        assert np.allclose(got.weights.flat(), want, rtol=1e-7, atol=1e-9)
        assert got.history[1]["train_loss"] < got.history[0]["train_loss"]


def test_a_lost_task_changes_nothing(spark, tmp_path):
    data = toy(spark, n=200)

    def fault(context, step):
        import os
        if context.partitionId() == 1 and step == 1 and not os.path.exists(f"{tmp_path}/failed"):
            open(f"{tmp_path}/failed", "w").close()
            raise RuntimeError("lost")

    want = SynchronousTrainer(shards=2, **KW).fit(data).weights.flat()
    got = SynchronousTrainer(shards=2, **KW).fit(data, fault=fault).weights.flat()
    assert (tmp_path / "failed").exists() and np.array_equal(got, want)


def test_more_shards_than_rows_and_no_rows(spark):
    data = toy(spark, n=3)
    one, many = (SynchronousTrainer(shards=s, **KW).fit(data).weights.flat() for s in (1, 8))
    assert np.allclose(one, many, rtol=1e-7)
    with pytest.raises(ValueError):
        SynchronousTrainer(**KW).fit(data.limit(0))
