"""G4/G5/G7 scorer training, D2 class weights, D10/D11 losses, A15 model store."""

import numpy as np
from pyspark.sql import functions as F

from gistlet.operators import train as TR
from gistlet.operators.scorer import ScorerWeights, forward
from gistlet.session import new_work_path


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(0)
    wt = TR.init_weights(20, 4, 5, seed=1, seq_len=6)
    x = rng.integers(0, 20, size=(7, 6))
    y = rng.integers(0, 2, size=7).astype(float)
    sw = np.where(y == 1, 3.0, 0.6)
    _, g = TR.loss_and_grads(wt, x, y, sw, 0.0, rng)
    p = wt.flat()
    for i in rng.choice(len(p), 25, replace=False):
        e = np.zeros_like(p); e[i] = 1e-6
        lp = TR.loss_and_grads(ScorerWeights.from_flat(p + e, 20, 4, 5, 6), x, y, sw, 0.0, rng)[0]
        lm = TR.loss_and_grads(ScorerWeights.from_flat(p - e, 20, 4, 5, 6), x, y, sw, 0.0, rng)[0]
        assert abs((lp - lm) / 2e-6 - g[i]) < 1e-5


def toy(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        ids = rng.integers(2, 10, size=12) if y else rng.integers(10, 30, size=12)
        rows.append((i, [int(v) for v in ids] + [0] * 20, y))
    return spark.createDataFrame(rows, "ord BIGINT, x ARRAY<INT>, y INT")


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y INT")
    w = {r["label"]: r["weight"] for r in TR.class_weights(df, "y").collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}


def test_training_learns_and_is_deterministic(spark):
    data = toy(spark)
    t = TR.ScorerTrainer(vocab_size=30, seq_len=32, emb_dim=8, dense_units=8, epochs=6, patience=3,
                         learning_rate=0.01, seed=3, shards=2)
    r1 = t.fit(data, data)
    r2 = t.fit(data, data)
    assert np.array_equal(r1.weights.flat(), r2.weights.flat())
    assert r1.history[-1]["train_loss"] < r1.history[0]["train_loss"]
    assert r1.history[r1.best_epoch - 1]["val_accuracy"] > 0.9
    assert set(r1.class_weight) == {0, 1}


def test_losses(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 0), (0.6, 0), (1.0, 1)], "p DOUBLE, y INT")
    acc = TR.accuracy(df, "p", "y").first()["accuracy"]
    assert acc == 0.75
    bce = TR.bce_loss(df, "p", "y").first()["bce"]
    exp = -np.mean([np.log(0.9), np.log(0.8), np.log(0.4), np.log(1 - 1e-7)])
    assert abs(bce - exp) < 1e-6


def test_model_roundtrip(spark):
    wt = TR.init_weights(15, 4, 3, seed=2, seq_len=32)
    path = new_work_path(spark, "model")
    TR.save_weights(spark, wt, path)
    back = TR.load_weights(spark, path)
    x = np.random.default_rng(0).integers(0, 15, size=(5, 32))
    assert np.array_equal(forward(wt, x), forward(back, x))


def test_resume_from_checkpoint_equals_uninterrupted(spark):
    data = toy(spark, n=300, seed=2)
    kw = dict(vocab_size=30, seq_len=32, emb_dim=6, dense_units=6, patience=10, learning_rate=0.01, seed=5, shards=2)
    full = TR.ScorerTrainer(epochs=4, **kw).fit(data, data)
    ck = new_work_path(spark, "train-ck")
    TR.ScorerTrainer(epochs=2, **kw).fit(data, data, checkpoint_dir=ck)          # "lost" after 2 epochs
    resumed = TR.ScorerTrainer(epochs=4, **kw).fit(data, data, checkpoint_dir=ck, resume=True)
    assert [h["epoch"] for h in resumed.history] == [1, 2, 3, 4]
    assert np.allclose(resumed.weights.flat(), full.weights.flat())


def test_spark_ml_baseline_learns(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(400):
        y = int(rng.random() < 0.25)
        words = ["alpha", "beta", "gamma"] if y else ["delta", "eps", "zeta"]
        rows.append(([str(w) for w in rng.choice(words, 6)], y))
    df = spark.createDataFrame(rows, "tokens ARRAY<STRING>, y INT")
    model = TR.train_baseline(df, vocab_size=20)
    acc = TR.accuracy(TR.baseline_probability(model, df), "p", "y").first()["accuracy"]
    assert acc > 0.95


def test_empty_validation_runs_all_epochs(spark):
    data = toy(spark, n=120)
    kw = dict(vocab_size=30, seq_len=32, emb_dim=4, dense_units=4, epochs=5, patience=2, shards=2, seed=1)
    with_none = TR.ScorerTrainer(**kw).fit(data)
    empty = TR.ScorerTrainer(**kw).fit(data, data.where("ord < 0"))
    assert [h["epoch"] for h in empty.history] == [1, 2, 3, 4, 5] and empty.best_epoch == 5
    assert np.array_equal(empty.weights.flat(), with_none.weights.flat())


def test_weights_do_not_depend_on_the_partitions(spark):
    data = toy(spark, n=200)
    kw = dict(vocab_size=30, seq_len=32, emb_dim=4, dense_units=4, epochs=2, shards=3, seed=1)
    a, b = (TR.ScorerTrainer(**kw).fit(data.repartition(n)).weights.flat() for n in (1, 7))
    assert np.array_equal(a, b)


def test_one_shard_is_plain_adam(spark):
    data = toy(spark, n=100)
    t = TR.ScorerTrainer(vocab_size=30, seq_len=32, emb_dim=4, dense_units=4, epochs=1, shards=1, seed=1, dropout=0.0,
                         batch_size=1000, learning_rate=0.01)
    got = t.fit(data.repartition(6), class_weight=None).weights.flat()
    rows = data.collect()
    state = TR.AdamState(TR.init_weights(30, 4, 4, 1, 32).flat().astype(np.float32).astype(float), 0.0, 0.0)
    TR.train_shard(state, np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]), None, (30, 4, 4, 32), 1000, 0.0,
                   0.01, np.random.default_rng(0))
    assert np.allclose(got, state.params, atol=1e-6)


def test_averaging_over_many_shards_equals_one_mean(spark):
    data = toy(spark, n=400).repartition(1)
    kw = dict(vocab_size=30, seq_len=32, emb_dim=4, dense_units=4, epochs=1, seed=1, dropout=0.0, batch_size=1000)
    t = TR.ScorerTrainer(shards=20, **kw)
    sharded = t._sharded(data)
    parts = sharded.rdd.glom().collect()
    assert len(parts) == 20
    total, n = 0.0, 0
    start = TR.init_weights(30, 4, 4, 1, 32).flat().astype(np.float32).astype(float)
    for rows in parts:
        if rows:
            state = TR.AdamState(start.copy(), np.zeros_like(start), np.zeros_like(start))
            TR.train_shard(state, np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]), None, (30, 4, 4, 32), 1000,
                           0.0, 1e-3, np.random.default_rng(0))
            total, n = total + state.params * len(rows), n + len(rows)
    assert np.allclose(t.fit(data, class_weight=None).weights.flat(), total / n, atol=1e-6)


def test_half_written_epoch_is_not_a_checkpoint(spark):
    data = toy(spark, n=100)
    kw = dict(vocab_size=30, seq_len=32, emb_dim=4, dense_units=4, shards=2, seed=1)
    ck = new_work_path(spark, "train-ck")
    assert TR.load_train_state(spark, ck) is None
    TR.ScorerTrainer(epochs=2, **kw).fit(data, checkpoint_dir=ck)
    spark.range(1).write.parquet(f"{ck}/epoch=000003/state")          # lost before its meta was written
    assert len(TR.load_train_state(spark, ck)["history"]) == 2
    spark.range(1).selectExpr("'{broken' AS value").coalesce(1).write.text(f"{ck}/epoch=000004/meta")
    try:
        TR.load_train_state(spark, ck)
    except ValueError:
        pass
    else:
        raise AssertionError("a broken checkpoint is an error, not a new start")


def test_step_touches_only_rows_with_a_gradient_and_equals_the_dense_step():
    """The embedding's gradient is not made for all of the vocabulary; what a step does to the others is their decay."""
    rng = np.random.default_rng(4)
    wt = TR.init_weights(500, 8, 6, 2, 16)
    x, y = rng.integers(0, 500, (300, 16)) * (rng.random((300, 16)) < 0.4), rng.integers(0, 2, 300).astype(np.int64)
    x[0] = 0
    start = wt.flat()
    plain = TR.AdamState(start, np.zeros_like(start), np.zeros_like(start))
    parts = TR.AdamState(start, np.zeros_like(start), np.zeros_like(start))
    sw = np.where(y == 1, 3.0, 0.5)
    order, draws = np.random.default_rng(9).permutation(300), np.random.default_rng(9)
    draws.permutation(300)
    for s in range(0, 300, 20):
        at = order[s:s + 20]
        loss, head, ids, rows, rest = TR._gradient(TR.ScorerWeights.from_flat(plain.params, 500, 8, 6, 16), x[at], y[at].astype(float), sw[at],
                                                   0.2, np.random.default_rng(s))
        assert len(head) == TR.HEAD and len(ids) <= len(np.unique(x[at])) and (ids >= TR.HEAD).all() and rows.shape == (len(ids), 8)
        plain.step(TR.loss_and_grads(TR.ScorerWeights.from_flat(plain.params, 500, 8, 6, 16), x[at], y[at].astype(float), sw[at], 0.2, draws)[1], 0.01)
    TR.train_shard(parts, x, y, {0: 0.5, 1: 3.0}, (500, 8, 6, 16), 20, 0.2, 0.01, np.random.default_rng(9))
    for a, b in ((plain.params, parts.params), (plain.m, parts.m), (plain.v, parts.v)):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-12)
    assert parts.t == 15 and np.array_equal(start, wt.flat())


def test_shards_are_stored_as_a_row_for_each_buffer(spark, monkeypatch):
    monkeypatch.setattr(TR, "SHUFFLE_BUFFER", 50)
    rows = [([int(i % 7), 0, int(i % 3), 0][:4], i % 2, i) for i in range(230)] + [([0, 0, 0, 0], 1, 230), ([99, -5, 1, 2], 0, 231)]
    data = spark.createDataFrame(rows, "x ARRAY<INT>, y INT, ord INT")
    t = TR.ScorerTrainer(vocab_size=30, seq_len=4, emb_dim=4, dense_units=4, shards=2, seed=1)
    sharded = t._sharded(data)
    packed = t._packed(sharded)
    assert packed.rdd.getNumPartitions() == 2
    for want, got in zip(sharded.rdd.glom().collect(), packed.rdd.glom().collect()):
        assert len(got) == -(-len(want) // 50)
        pairs = [TR.unpack_buffer(bytes(r["x"]), bytes(r["y"]), 4) for r in got]
        assert [len(y) for _, y in pairs[:-1]] == [50] * (len(got) - 1)
        assert np.array_equal(np.concatenate([x for x, _ in pairs]), np.clip([r["x"] for r in want], 0, 29))
        assert np.concatenate([y for _, y in pairs]).tolist() == [r["y"] for r in want]
    assert sorted(r["y"] for r in t._labels(packed).collect()) == sorted(r[1] for r in rows)
