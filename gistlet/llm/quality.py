"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its whole text: shares of the byte
values, and how words and lines repeat, how long they are and how they are cased. It is learned
from preference pairs (a document of label 1 over one of label 0): the probability that the
first wins is the logistic function of the difference of strengths, so the loss is logistic
on differences of features. The threshold is the quantile, at the share of label 0, of the
strengths of all documents whose labels may be learned from, and ``score`` is the logistic
function of the distance from it.

The fit takes at most ``PER_LABEL`` labelled documents of each label, those with the smallest
keyed hash, and ``PAIRS`` pairs of them; the threshold leaves none out. With one label or none every score is 0.5.
Null and empty texts have all features zero. Repeated rows are scored each for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import (SPACES, bound_batches, bounded_sample, row_slices, span_hashes, text_bytes,
                               word_spans, written)

PER_LABEL, PAIRS, RIDGE = 3000, 30000, 1.0
EXTRA = 10
COUNT_BYTES = 1 << 20       # bytes of a batch counted at once
BINS = 4096         # counted in one pass of the search for a quantile


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct values in each row's range of ``hashes``."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))[:len(h)]
    return np.bincount(r[new], minlength=len(first) - 1)


def byte_counts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(n, 256) counts of byte values, by blocks: what is held besides does not grow with a text."""
    n = len(offs) - 1
    counts = np.zeros((n, 256), np.int64)
    for lo in range(0, len(data), COUNT_BYTES):
        hi = min(lo + COUNT_BYTES, len(data))
        # rows that have bytes in this block
        i, j = int(np.searchsorted(offs, lo, "right")) - 1, int(np.searchsorted(offs, hi, "left"))
        cut = np.clip(offs[i:j + 1], lo, hi)
        row = np.repeat(np.arange(j - i), np.diff(cut))
        counts[i:j] += np.bincount(row * 256 + data[lo:hi], minlength=(j - i) * 256).reshape(j - i, 256)
    return counts


def _breaks(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``COUNT_BYTES`` that end before a byte of which ``at`` is true, so that no span is cut."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + COUNT_BYTES, n)
        while hi < n:
            found = np.flatnonzero(at[data[hi:hi + COUNT_BYTES]])
            if len(found):
                hi += int(found[0])
                break
            hi = min(hi + COUNT_BYTES, n)
        yield lo, hi
        lo = hi


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans; those of more than ``COUNT_BYTES`` are read as a stream."""
    long = ends - starts > COUNT_BYTES
    out = np.empty(len(starts), np.uint64)
    out[~long] = span_hashes(data, starts[~long], ends[~long])
    for k in np.flatnonzero(long):
        digest = hashlib.blake2b(data[starts[k]:ends[k]], digest_size=8).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def span_counts(data: np.ndarray, offs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 7) whole numbers of the spans between bytes of which ``at`` is true: how many, their bytes and squared
    bytes, how many distinct, closing without a letter, opening without one, opening with a capital. Then their hashes."""
    n = len(offs) - 1
    starts, ends, first = word_spans(~at[data], offs)
    owner = np.repeat(np.arange(n), np.diff(first))
    lengths = ends - starts
    opening, closing = data[starts], data[ends - 1]

    def letter(b: np.ndarray) -> np.ndarray:
        return ((b | 32) >= 97) & ((b | 32) <= 122) | (b >= 128)

    def of(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner[mask], minlength=n)

    hashes = _hashes(data, starts, ends)
    out = np.stack([np.diff(first), np.bincount(owner, lengths, n), np.bincount(owner, lengths.astype(float) ** 2, n),
                    _distinct(hashes, first), of(~letter(closing)), of(~letter(opening)),
                    of((opening >= 65) & (opening <= 90))], axis=1)
    return out, hashes


def long_span_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``span_counts`` of one text, by blocks that add up; only the hashes of distinct spans are held meanwhile."""
    total, seen = np.zeros((1, 7)), np.zeros(0, np.uint64)
    for lo, hi in _breaks(data, at):
        counts, hashes = span_counts(data[lo:hi], np.array([0, hi - lo]), at)
        total += counts
        seen = np.union1d(seen, hashes)
    total[0, 3] = len(seen)
    return total


LINE_END = np.arange(256) == 10


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(n, 256 + EXTRA) features of byte rows; a text of more than ``COUNT_BYTES`` is alone, and counted by blocks."""
    n = len(offs) - 1
    size = np.diff(offs)
    if n == 1 and len(data) > COUNT_BYTES:
        words, lines = long_span_counts(data, SPACES), long_span_counts(data, LINE_END)
    else:
        words, lines = span_counts(data, offs, SPACES)[0], span_counts(data, offs, LINE_END)[0]
    per_byte, per_word, per_line = (1 / np.maximum(x, 1) for x in (size, words[:, 0], lines[:, 0]))
    out = np.zeros((n, 256 + EXTRA), np.float32)
    out[:, :256] = byte_counts(data, offs) * per_byte[:, None]
    extra = [np.log1p(size), np.log1p(words[:, 0]), words[:, 1] * per_word, words[:, 2] * per_word, words[:, 3] * per_word,
             lines[:, 3] * per_line, np.log1p(size * per_line), words[:, 4] * per_word, words[:, 5] * per_word,
             words[:, 6] * per_word]
    out[:, 256:] = np.stack(extra, axis=1) * (size > 0)[:, None]
    return out


class BradleyTerry:
    """strength(x) = ((x - mean) / std) @ weights; score = logistic((strength - threshold) / scale)."""

    def __init__(self, good: np.ndarray, bad: np.ndarray, share_bad: float, pairs: int = PAIRS, ridge: float = RIDGE,
                 seed: int = 5):
        both = np.concatenate([good, bad])
        self.mean, std = both.mean(0), both.std(0)
        self.std = np.where(std > 1e-7, std, np.inf)
        rng = np.random.default_rng(seed)
        a, b = ((x - self.mean) / self.std for x in (good, bad))
        # clipped as in scoring, so that one rare byte cannot decide a text
        a, b = np.clip(a, -5, 5), np.clip(b, -5, 5)
        d = (a[rng.integers(0, len(a), pairs)] - b[rng.integers(0, len(b), pairs)]).astype(np.float64)
        w = np.zeros(d.shape[1])
        for _ in range(12):      # Newton steps on sum(log(1 + exp(-d @ w))) + ridge |w|^2 / 2
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            grad = d.T @ p - ridge * w
            hess = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w
        s = np.concatenate([a @ w, b @ w])
        weight = np.concatenate([np.full(len(a), (1 - share_bad) / len(a)), np.full(len(b), share_bad / len(b))])
        order = np.argsort(s, kind="stable")
        below = np.cumsum(weight[order])
        k = min(int(np.searchsorted(below, share_bad - 1e-9)), len(s) - 2)
        self.threshold = float(s[order[k]] + s[order[k + 1]]) / 2
        self.scale = max(float(s.std()) / 4, 1e-9)

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -5, 5) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = self.strengths(x)
        return 1 / (1 + np.exp(-np.clip((s - self.threshold) / self.scale, -30, 30)))


def learnable(id_col: str = "doc_id") -> Column:
    """True for ids whose CRC-32 as text, modulo 3, is not 1: their labels may be learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) != 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> BradleyTerry | None:
    """The model for the labels that may be learned from; None without both labels."""
    bound_batches(docs.sparkSession)
    known = (labels.where(learnable(id_col) & F.col(label_col).isin(0, 1))
             .select(F.col(id_col).cast("long").alias("k"), F.col(label_col).cast("int").alias("y")).distinct())
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    chosen = F.broadcast(bounded_sample(known, "y", per_label, "k"))       # at most 2 * per_label rows
    rows = (docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
            .join(chosen, F.col("i") == F.col("k")).select("i", "y", "t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column(2))
            for i, j in row_slices(offs):
                x = features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array([v.tobytes() for v in x], pa.binary())], names=["i", "y", "x"])

    got = rows.mapInArrow(run, "i long, y int, x binary").toPandas().sort_values(["i", "x"])
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(-1, 256 + EXTRA)
    good, bad = x[(got["y"] == 1).to_numpy()], x[(got["y"] == 0).to_numpy()]
    if not len(good) or not len(bad):
        return None
    model = BradleyTerry(good, bad, counts[0] / (counts[0] + counts[1]))
    model.threshold = threshold(docs, known, model, id_col, text_col)
    return model


def ranked(values: DataFrame, rank: int) -> float:
    """The value of the column ``s`` at ``rank`` (from 0) in ascending order, exactly; the driver sees ``BINS`` counts a pass."""
    lo, hi = values.agg(F.min("s"), F.max("s")).first()
    while lo < hi:
        place = F.floor((F.col("s") - F.lit(lo)) / F.lit(hi - lo) * BINS)
        bins = (values.where(F.col("s").between(lo, hi)).groupBy(F.least(place, F.lit(BINS - 1)).alias("b"))
                .agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("b").collect())
        for r in bins:
            if rank < r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            rank -= r["n"]
    return lo


def threshold(docs: DataFrame, known: DataFrame, model: BradleyTerry, id_col: str = "doc_id", text_col: str = "text") -> float:
    """Between the strengths of all documents in ``known`` (k, y) where as many are below as have label 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            for i, j in row_slices(offs):
                s = shared.value.strengths(features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(s, pa.float64())], names=["i", "s"])

    rows = (docs.where(learnable(id_col)).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, "i long, s double"))
    # strengths, not texts, are dealt out for the join
    values = written(rows.join(known, F.col("i") == F.col("k")).select("y", "s"), "strengths")
    n, bad = values.agg(F.count("*"), F.count_if(F.col("y") == 0)).first()
    k = max(0, min(bad - 1, n - 2))
    return (ranked(values, k) + ranked(values, k + 1)) / 2


def scored(docs: DataFrame, model: BradleyTerry | None, text_col: str = "text") -> Column:
    """The score of a text column."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = np.full(len(texts), 0.5)
            if shared.value is not None and len(texts):
                data, offs = text_bytes(pa.array(texts, pa.string()))
                for i, j in row_slices(offs):
                    out[i:j] = shared.value.scores(features(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))
            yield pd.Series(out)

    return run(F.col(text_col))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = train(docs, labels)
    out = docs.select("doc_id", (~learnable()).alias("held_out"), scored(docs, model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
