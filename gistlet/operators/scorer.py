"""Sentence scorer (G4) and batch prediction.

Model: Embedding[V, D] -> mean over all seq_len positions (padding included)
-> Dense(H, relu) -> Dense(1, sigmoid).

``forward`` is the NumPy pass over a batch; ``score_udf`` runs it on Arrow batches with the
weights broadcast. The weights' size is a parameter of the model (vocabulary x dimension), not
of the data, and is checked against ``MAX_MODEL_BYTES`` before it is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gistlet import config as C

def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def relu(z: Column) -> Column:
    return F.greatest(z, F.lit(0.0))


# ------------------------------------------------------------------ trained model

MAX_MODEL_BYTES = 1 << 30


@dataclass
class ScorerWeights:
    """Weights of the sentence scorer."""

    emb: np.ndarray            # [V, D]
    w1: np.ndarray             # [D, H]
    b1: np.ndarray             # [H]
    w2: np.ndarray             # [H]
    b2: float
    seq_len: int = C.SEQ_LEN
    meta: dict = field(default_factory=dict)

    @property
    def vocab_size(self) -> int:
        return int(self.emb.shape[0])

    @property
    def nbytes(self) -> int:
        return sum(np.asarray(a).nbytes for a in (self.emb, self.w1, self.b1, self.w2))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.emb.ravel(), self.w1.ravel(), self.b1, self.w2,
                               np.array([self.b2])]).astype(np.float64)

    @classmethod
    def from_flat(cls, v: np.ndarray, vocab_size: int, dim: int, hidden: int,
                  seq_len: int = C.SEQ_LEN) -> "ScorerWeights":
        v = np.asarray(v, dtype=np.float64)
        i = 0
        emb = v[i:i + vocab_size * dim].reshape(vocab_size, dim); i += vocab_size * dim
        w1 = v[i:i + dim * hidden].reshape(dim, hidden); i += dim * hidden
        b1 = v[i:i + hidden]; i += hidden
        w2 = v[i:i + hidden]; i += hidden
        b2 = float(v[i])
        return cls(emb, w1, b1, w2, b2, seq_len)


#: Ids from 0 that are counted by row, and rows of a forward pass that are held at once.
HEAD, BLOCK = 64, 2048


def head_counts(x: np.ndarray, k: int) -> np.ndarray:
    """How often each row of ``x`` holds each of the ids below ``k``."""
    b = len(x)
    cells = np.minimum(x, k)
    cells += np.arange(0, b * (k + 1), k + 1)[:, None]
    return np.bincount(cells.ravel(), minlength=b * (k + 1)).reshape(b, k + 1)[:, :k].astype(np.float64)


def run_starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal neighbours begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1]))


def mean_rows(emb: np.ndarray, x: np.ndarray, block: int = 512) -> np.ndarray:
    """``emb[x].mean(axis=1)`` block by block: what is held is [block, seq_len, D] at most, not [N, seq_len, D].

    Ids go by frequency, so the first ``HEAD`` of them, padding among them, are most of all: these are counted by row, and only
    the others are gathered.
    """
    n, seq = x.shape
    out = np.zeros((n, emb.shape[1]), np.result_type(emb, np.float32))
    k = min(HEAD, len(emb)) if np.isfinite(emb[:HEAD]).all() else 0
    for i in range(0, n, block):
        ids, acc = x[i:i + block], out[i:i + block]
        if k:
            acc += head_counts(ids, k) @ emb[:k]
        at = np.flatnonzero(ids >= k)
        if len(at):
            row = at // seq
            first = run_starts(row)
            acc[row[first]] += np.add.reduceat(emb.take(ids.ravel()[at], axis=0), first, axis=0)
    return out / seq


def layers(wt: ScorerWeights, x: np.ndarray) -> dict[str, np.ndarray]:
    """NumPy activations of each layer on an [N, seq_len] id matrix."""
    x = np.clip(x, 0, wt.vocab_size - 1)
    pooled = mean_rows(wt.emb, x)
    hidden = np.maximum(pooled @ wt.w1 + wt.b1, 0.0)
    return {"pooled": pooled, "hidden": hidden, "logit": hidden @ wt.w2 + wt.b2}


def forward(wt: ScorerWeights, x: np.ndarray) -> np.ndarray:
    """NumPy forward pass on an [N, seq_len] id matrix -> [N] probabilities, block by block."""
    logit = [layers(wt, x[i:i + BLOCK])["logit"] for i in range(0, max(len(x), 1), BLOCK)]
    return 1.0 / (1.0 + np.exp(-np.concatenate(logit)))


def ids_matrix(series: pd.Series, seq_len: int) -> np.ndarray:
    """pandas Series of equal-length id arrays -> [N, seq_len] int matrix."""
    if len(series) == 0:
        return np.zeros((0, seq_len), dtype=np.int64)
    return np.stack(series.to_numpy()).astype(np.int64).reshape(len(series), seq_len)


def share(spark: SparkSession, wt):
    """Broadcast a model; the caller may release it with ``unpersist``."""
    if getattr(wt, "nbytes", 0) > MAX_MODEL_BYTES:
        raise ValueError(f"a model of {wt.nbytes} bytes is more than an executor is given ({MAX_MODEL_BYTES})")
    return spark.sparkContext.broadcast(wt)


def score_udf(spark: SparkSession, wt, nested: bool = False, shared=None):
    """Arrow UDF scoring id arrays (``nested``: arrays of id arrays) in whole batches.

    ``wt``: ScorerWeights or a QuantizedScorer (int8), broadcast once and reused by every
    task of the executor; ``shared``: a broadcast of it that the caller releases.
    """
    from gistlet.functions.arrow_kernels import by_slices, padded_matrix, rows_to_nested
    from gistlet.session import bound_batches

    bound_batches(spark)
    bc = shared if shared is not None else share(spark, wt)
    seq_len = wt.seq_len

    def _forward(mat):
        model = bc.value
        if hasattr(model, "forward_q"):          # int8 model: dequantized output
            return model.forward_q(mat)[1]
        return forward(model, mat)

    if not nested:
        @F.arrow_udf(T.DoubleType())
        def _score(x: pa.Array) -> pa.Array:
            return by_slices(lambda part: pa.array(_forward(padded_matrix(part, seq_len)), type=pa.float64()), x)
        return _score

    def _nested(xs: pa.ListArray) -> pa.ListArray:
        p = _forward(padded_matrix(xs.flatten(), seq_len))
        return rows_to_nested(xs, p.astype(np.float64))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def _score_nested(xs: pa.Array) -> pa.Array:
        return by_slices(_nested, xs)
    return _score_nested
