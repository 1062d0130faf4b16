"""Language identification by a byte convolutional network.

Filters of widths 2, 3 and 4 over the bytes of a window (A-Z lower-cased), each followed by
its maximum over the window, then softmax over the languages of the training rows. The
filters are trained in NumPy by Adam on windows of labelled texts. A prediction runs the
network over every window of the whole text and averages the windows' probabilities.

The training sample is bounded: at most ``per_language`` distinct texts of each language, those
with the smallest keyed hash, and ``windows`` windows of each. What is trained on depends on the
rows alone, not on their order. A text that is null or has no letter is ``und`` with score
0, as is every text when no row can be learned from. Only the text is an input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import LOWER, bound_batches, bounded_sample, row_slices, text_bytes

SIZE = 128                   # bytes of a window
WIDTHS = (2, 3, 4)
FILTERS = 10                 # of each width
PER_LANGUAGE, WINDOWS = 600, 4
UNKNOWN = "und"


# ------------------------------------------------------------------ network

class ByteNetwork:
    """weights[w]: (w, 256, FILTERS); ``out``: (filters, languages)."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.weights = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter in each window, and where it is."""
        top, at = [], []
        for weight, w in zip(self.weights, WIDTHS, strict=True):
            r = sum(weight[j][x[:, j:SIZE - w + 1 + j]] for j in range(w))
            where = r.argmax(axis=1)
            at.append(where)
            top.append(np.take_along_axis(r, where[:, None, :], 1)[:, 0])
        return np.concatenate(top, axis=1), at

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01,
            seed: int = 11) -> None:
        """Adam on the cross entropy; ``x``: (n, SIZE) bytes."""
        rng = np.random.default_rng(seed)
        params = [*self.weights, self.bias, self.out, self.offset]
        first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(order), batch):
                own = order[a:a + batch]
                xb, yb = x[own], y[own]
                top, at = self._pooled(xb)
                z = np.maximum(top + self.bias, 0)
                p = _softmax(z @ self.out + self.offset)
                p[np.arange(len(own)), yb] -= 1
                p /= len(own)
                dz = (p @ self.out.T) * (z > 0)
                grads = []
                for k, w in enumerate(WIDTHS):
                    g = np.zeros_like(self.weights[k])
                    d = dz[:, k * FILTERS:(k + 1) * FILTERS]
                    f = np.broadcast_to(np.arange(FILTERS), d.shape)
                    for j in range(w):
                        np.add.at(g[j], (np.take_along_axis(xb, at[k] + j, 1), f), d)
                    grads.append(g)
                grads += [dz.sum(0), z.T @ p, p.sum(0)]
                step += 1
                for q, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    q -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """The filters as sums of two look-ups by byte pairs: of bytes (0, 1) and of bytes (2, 3)."""
        a = np.zeros((256, 256, FILTERS * len(WIDTHS)), np.float32)
        b = np.zeros_like(a)
        for k, (weight, w) in enumerate(zip(self.weights, WIDTHS, strict=True)):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            a[:, :, own] = weight[0][:, None] + weight[1][None, :]
            if w > 2:
                b[:, :, own] = weight[2][:, None]
            if w > 3:
                b[:, :, own] += weight[3][None, :]
        return a.reshape(65536, -1), b.reshape(65536, -1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Predictor:
    """Probabilities of whole texts; made once in a worker from the network's arrays."""

    def __init__(self, net: ByteNetwork):
        self.net = net
        self.first, self.second = net.tables()

    def rows(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """(n, languages) mean probability over the windows of each row; a row without bytes is all zero.

        Rows are cut into SIZE-byte windows, the last one filled up with spaces.
        """
        sizes = np.diff(offs)
        parts = -(-sizes // SIZE)
        row = np.repeat(np.arange(len(sizes)), parts)
        start = offs[row] + (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * SIZE
        low = np.concatenate([LOWER[data], np.full(SIZE + 4, 32, np.uint8)])
        out = np.zeros((len(sizes), len(self.net.languages)))
        for a in range(0, len(row), 256):
            s, r = start[a:a + 256], row[a:a + 256]
            x = low[s[:, None] + np.arange(SIZE + 3)]
            x[np.arange(SIZE + 3) >= (offs[r + 1] - s)[:, None]] = 32
            pair = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
            top = np.empty((len(s), self.first.shape[1]), np.float32)
            for c in range(0, len(s), 16):       # small enough to stay in the cache
                resp = self.first[pair[c:c + 16, :SIZE]]
                resp += self.second[pair[c:c + 16, 2:SIZE + 2]]
                top[c:c + 16] = resp.max(axis=1)
            p = _softmax(np.maximum(top + self.net.bias, 0) @ self.net.out + self.net.offset)
            at = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
            out[r[at]] += np.add.reduceat(p, at, axis=0)
        return out / np.maximum(parts, 1)[:, None]


# ------------------------------------------------------------------ training rows

def _windows(text: bytes, n: int) -> list[bytes]:
    """Up to ``n`` windows spread over a text."""
    whole = max(1, -(-len(text) // SIZE))
    picks = sorted({round(i * (whole - 1) / max(1, n - 1)) for i in range(min(n, whole))})
    return [text[k * SIZE:(k + 1) * SIZE].ljust(SIZE + 3, b" ")[:SIZE] for k in picks]


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, windows: int = WINDOWS, text_col: str = "text",
           lang_col: str = "lang") -> DataFrame:
    """lang, window: a bounded sample of training windows, the same for the same rows in any order."""
    rows = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
            .where(F.col("lang").isNotNull() & F.col("t").rlike("\\p{L}")))
    rows = bounded_sample(rows, "lang", per_language, "t", distinct=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [(lang, w) for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                     for w in _windows(t.encode(), windows)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()),
                                              pa.array([p[1] for p in pairs], pa.binary())], names=["lang", "window"])

    return rows.mapInArrow(run, "lang string, window binary")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **bounds: int) -> ByteNetwork | None:
    """The network for the labelled rows of ``docs``; None if there are none."""
    bound_batches(docs.sparkSession)
    rows = sample(docs, text_col=text_col, lang_col=lang_col, **bounds).toPandas().sort_values(["lang", "window"])
    if rows.empty:
        return None
    languages = sorted(rows["lang"].unique())
    x = LOWER[np.frombuffer(b"".join(rows["window"]), np.uint8).reshape(-1, SIZE)]
    net = ByteNetwork(languages)
    net.fit(x, rows["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy())
    return net


def predicted(docs: DataFrame, net: ByteNetwork | None, text_col: str = "text") -> Column:
    """struct(lang, score) of a text column."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(net)
    held: dict = {}

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if shared.value is not None and "p" not in held:
            held["p"] = Predictor(shared.value)
        for texts in batches:
            n = len(texts)
            lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
            has = texts.map(lambda t: t is not None and any(map(str.isalpha, t)))
            if shared.value is not None and n:
                data, offs = text_bytes(pa.array(texts, pa.string()))
                for i, j in row_slices(offs):
                    p = held["p"].rows(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                    lang[i:j] = np.array(shared.value.languages, object)[p.argmax(axis=1)]
                    score[i:j] = np.minimum(p.max(axis=1), 1)
                lang[~has.to_numpy()] = UNKNOWN
                score[~has.to_numpy()] = 0
            yield pd.DataFrame({"lang": lang, "score": score})

    return run(F.col(text_col))


def learnable(id_col: str = "doc_id") -> Column:
    """True for the rows that may be learned from: CRC-32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) != 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from the rows that are not held out."""
    net = train(docs.where(learnable()))
    out = docs.select("doc_id", (~learnable()).alias("held_out"), predicted(docs, net).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def accepted(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The documents whose language is known with a score of at least ``least``, with all their columns."""
    net = train(docs.where(learnable()))
    p = predicted(docs, net)
    return docs.where((p["lang"] != UNKNOWN) & (p["score"] >= least))
