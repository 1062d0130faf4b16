"""G5, synchronous: mini-batch Adam over shards that agree on every step.

``ScorerTrainer`` averages replicas once an epoch, which is Adam only with one shard. Here every step is
one step of plain Adam on one batch of the whole table, whatever the number of shards: the rows get a
place by the seeded hash of their keys (ranks by prefix sums over ranges, so no task sorts the table),
batch ``place div batch_size`` is divided over the shards by ``place mod shards``, and an epoch is one
barrier stage in which the shards, batch by batch, put their parts of the gradient together with
``allGather`` and each take the same step. Only the embedding rows that a batch touches are sent.

A shard reads its rows in order of place and holds one batch's part. Dropout masks are drawn for the whole batch from
(seed, epoch, batch), so they are the same for any number of shards; weights agree up to the order of
sums. A lost task fails the stage, and Spark runs the epoch again from the broadcast state: same result.
The cluster needs as many free slots as there are shards. Rows without keys are ranked by their own values;
an empty table raises.
"""

from __future__ import annotations

import base64
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gistlet import config as C
from gistlet.operators.flatten import ordinal_offsets
from gistlet.operators.scorer import ScorerWeights, share
from gistlet.operators.train import EPS, AdamState, TrainResult, class_weights, init_weights
from gistlet.session import new_work_path

KEYS = ("split", "article_id", "pos", "sent_index", "ord")


def placed(train: DataFrame, seed: int, shards: int) -> DataFrame:
    """(place, shard, x, y): the rows in a seeded order, ``shards`` of them side by side; written."""
    spark = train.sparkSession
    keys = [c for c in KEYS if c in train.columns] or ["x", "y"]
    rows = train.select("x", F.col("y").cast("int").alias("y"), *[c for c in keys if c not in ("x", "y")])
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), *keys)).withColumn("_one", F.lit(1).cast("bigint")).withColumn("_all", F.lit(0))
    ranked = ordinal_offsets(rows, "_one", "_all", ["_h", *keys], "place")
    path = new_work_path(spark, "placed")
    ranked.select("place", F.pmod("place", F.lit(shards)).cast("int").alias("shard"), "x", "y").write.parquet(path)
    return spark.read.parquet(path)


def batch_gradient(wt: ScorerWeights, x: np.ndarray, y: np.ndarray, sw: np.ndarray, keep: np.ndarray, batch: int) -> tuple:
    """Sum of the rows' losses, and their part of the gradient of the batch's mean loss: (touched ids, their rows, the rest)."""
    seq = x.shape[1]
    pooled = wt.emb[x].mean(axis=1)
    a1 = pooled @ wt.w1 + wt.b1
    hidden = np.maximum(a1, 0.0) * keep
    p = 1.0 / (1.0 + np.exp(-(hidden @ wt.w2 + wt.b2)))
    clipped = np.clip(p, EPS, 1 - EPS)
    loss = float(np.sum(sw * -(y * np.log(clipped) + (1 - y) * np.log(1 - clipped))))
    out = sw * (p - y) / batch
    inner = np.outer(out, wt.w2) * keep * (a1 > 0)
    ids, where = np.unique(x.ravel(), return_inverse=True)
    rows = np.zeros((len(ids), wt.emb.shape[1]))
    np.add.at(rows, where.ravel(), np.repeat(inner @ wt.w1.T / seq, seq, axis=0))
    return loss, ids, rows, np.concatenate([(pooled.T @ inner).ravel(), inner.sum(axis=0), hidden.T @ out, [out.sum()]])


def _packed(*arrays: np.ndarray) -> str:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return base64.b64encode(out.getvalue()).decode()


def _unpacked(text: str) -> list[np.ndarray]:
    held = np.load(io.BytesIO(base64.b64decode(text)))
    return [held[k] for k in held.files]


class SynchronousTrainer:
    """Adam on mini-batches of the whole table, computed by ``shards`` tasks; the same weights for any number of them."""

    def __init__(self, vocab_size: int, seq_len: int = C.SEQ_LEN, emb_dim: int = C.EMB_DIM, dense_units: int = C.DENSE_UNITS,
                 dropout: float = C.DROPOUT, batch_size: int = C.BATCH_SIZE, epochs: int = C.EPOCHS,
                 learning_rate: float = C.LEARNING_RATE, seed: int = 0, shards: int = 8):
        self.shape = (vocab_size, emb_dim, dense_units, seq_len)
        self.dropout, self.batch_size, self.epochs, self.lr = dropout, batch_size, epochs, learning_rate
        self.seed, self.shards = seed, shards

    def _epoch(self, data: DataFrame, n: int, state: AdamState, cw: dict | None, epoch: int, fault=None) -> tuple[AdamState, float]:
        spark, shape, lr, dropout = data.sparkSession, self.shape, self.lr, self.dropout
        size, shards, seed = self.batch_size, self.shards, self.seed
        sent = share(spark, state)
        vocab, dim, hidden, seq_len = shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            context = BarrierTaskContext.get()
            now = AdamState(*(np.array(a, np.float64) for a in (sent.value.params, sent.value.m, sent.value.v)), sent.value.t)
            held: list[pa.RecordBatch] = []
            source, loss = iter(batches), 0.0

            def rows_of(batch: int) -> tuple[np.ndarray, ...]:
                """Places, ids and labels of this shard's rows of a batch; what comes after it is held."""
                end, own = (batch + 1) * size, []
                while True:
                    b = held.pop() if held else next(source, None)
                    if b is None:
                        break
                    k = int(np.searchsorted(b.column(0).to_numpy(), end))
                    own.append(b.slice(0, k))
                    if k < b.num_rows:
                        held.append(b.slice(k))
                        break
                t = pa.Table.from_batches(own) if own else None
                if t is None or not t.num_rows:
                    return np.zeros(0, np.int64), np.zeros((0, seq_len), np.int64), np.zeros(0)
                x = np.array(t.column(1).to_pylist(), np.int64).reshape(t.num_rows, seq_len)
                return t.column(0).to_numpy(), np.clip(x, 0, vocab - 1), t.column(2).to_numpy().astype(np.float64)

            for step in range(-(-n // size)):
                place, x, y = rows_of(step)
                if fault:
                    fault(context, step)
                whole = min(size, n - step * size)
                keep = np.ones((whole, hidden))
                if dropout > 0:
                    keep = (np.random.default_rng([seed, epoch, step]).random((whole, hidden)) >= dropout) / (1.0 - dropout)
                sw = np.array([cw.get(int(c), 1.0) for c in y]) if cw else np.ones(len(y))
                wt = ScorerWeights.from_flat(now.params, vocab, dim, hidden, seq_len)
                part = batch_gradient(wt, x, y, sw, keep[place - step * size], whole)
                gradient = np.zeros(len(now.params))
                table = gradient[:vocab * dim].reshape(vocab, dim)
                for text in context.allGather(_packed(np.array([part[0]]), *part[1:])):     # in the order of the shards
                    lost, ids, rows, rest = _unpacked(text)
                    table[ids] += rows
                    gradient[vocab * dim:] += rest
                    loss += float(lost[0])
                now.step(gradient, lr)
            if context.partitionId() == 0:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a.tobytes()], pa.binary()) for a in (now.params, now.m, now.v)] + [pa.array([now.t]), pa.array([loss])],
                    names=["params", "m", "v", "t", "loss"])

        dealt = data.repartitionById(shards, "shard").sortWithinPartitions("place").select("place", "x", "y")
        done = dealt.mapInArrow(run, "params binary, m binary, v binary, t long, loss double", barrier=True)
        # one row, the state, of the model's size; it goes through an exchange, as only a stage before one can be run again
        r = done.repartition(1).collect()[0]
        sent.destroy()
        return AdamState(*(np.frombuffer(r[k], np.float64) for k in ("params", "m", "v")), r["t"]), r["loss"] / n

    def fit(self, train: DataFrame, class_weight: str | dict | None = "balanced", fault=None) -> TrainResult:
        """``fault(context, step)`` is called in every task before each step (tests)."""
        data = placed(train, self.seed, self.shards)
        n = data.count()
        if not n:
            raise ValueError("no training rows: the train split is required")
        cw = class_weight if isinstance(class_weight, dict) else None
        if class_weight == "balanced":
            cw = {int(r["label"]): float(r["weight"]) for r in class_weights(data, "y").collect()}   # one row per class
        vocab, dim, hidden, seq_len = self.shape
        start = init_weights(vocab, dim, hidden, self.seed, seq_len).flat()
        state, history = AdamState(start, np.zeros_like(start), np.zeros_like(start), 0), []
        for epoch in range(self.epochs):
            state, loss = self._epoch(data, n, state, cw, epoch, fault)
            history.append({"epoch": epoch + 1, "train_loss": loss})
        return TrainResult(ScorerWeights.from_flat(state.params, vocab, dim, hidden, seq_len), history, cw, self.epochs)
