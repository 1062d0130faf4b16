"""Exact deduplication by composable polynomial fingerprints.

A text, each run of white space made one space, is cut into chunks of ``CHUNK`` bytes. A
chunk's hash is sum(byte_i * B^i) modulo a prime, for two primes; all chunks of a batch
are hashed side by side, a block of bounded size at a time however long a document is, and
hashes of neighbouring chunks combine by hash(a + b) = hash(a) + B^len(a) * hash(b).
Documents with equal fingerprints (both hashes and the length) are then compared: their
chunks meet by (fingerprint, chunk number), and every chunk must have its smallest value
equal to its largest; partial aggregation leaves one smallest and one largest chunk per
task, however many copies there are. A fingerprint whose texts differ is divided by the
SHA-256 that each row carries.

Null counts as empty; empty texts are equal to each other. Rows that repeat a doc_id and
text are copies of each other, and ``kept`` is true for all of them or none, as ``doc_id = keep_id`` says;
``keep_first`` drops by row and not by id, and leaves one row of each set of equal texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import (SPACES, bitmap_bits, blocks, bound_batches, filter_bits, in_filter, mix, one_of_each,
                                row_key, row_slices, text_bytes, written)

CHUNK = 1 << 15
BLOCK = 64       # chunks hashed at once
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525013)

PRINTS = "doc_id long, len long, f1 long, f2 long, h long, sha string"
PRINT = ["len", "f1", "f2"]


def _power_table(base: int, prime: int) -> np.ndarray:
    out = np.empty(CHUNK, np.int64)
    x = 1
    for i in range(CHUNK):
        out[i] = x
        x = x * base % prime
    return out


def one_space(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with each run of white space as one space, and the new row offsets."""
    space = SPACES[data]
    n = len(data)
    keep = np.ones(n + 1, bool)
    keep[1:n] = ~(space[1:] & space[:-1])
    keep[offs] = True
    keep = keep[:n]
    dropped = np.flatnonzero(~keep)
    return np.where(space, np.uint8(32), data)[keep], offs - np.searchsorted(dropped, offs)


class Polynomial:
    """Fingerprints of byte rows under two primes; made in each task."""

    def __init__(self, primes: tuple[int, int] = PRIMES):
        self.primes = primes
        self.tables = [_power_table(b, p) for b, p in zip(BASES, primes, strict=True)]

    def chunks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(n, 2) hashes of chunks [start, end) of at most CHUNK bytes that stand end to end."""
        out = np.zeros((len(starts), 2), np.int64)
        full = np.flatnonzero(ends > starts)
        for i, j in blocks(starts[full], ends[full], BLOCK * CHUNK):
            own = full[i:j]
            lo, hi = starts[own[0]], ends[own[-1]]
            place = np.arange(lo, hi) - np.repeat(starts[own], ends[own] - starts[own])
            for k, (table, prime) in enumerate(zip(self.tables, self.primes, strict=True)):
                out[own, k] = np.add.reduceat(table[place] * data[lo:hi], starts[own] - lo) % prime
        return out

    def rows(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """(n, 2) fingerprints of rows, from those of their chunks."""
        sizes = np.diff(offs)
        parts = np.maximum(1, -(-sizes // CHUNK))
        row = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = offs[row] + number * CHUNK
        ends = np.minimum(starts + CHUNK, offs[row + 1])
        out = np.zeros((len(sizes), 2), np.int64)
        hashes = self.chunks(data, starts, ends)
        for k, prime in enumerate(self.primes):
            step = pow(BASES[k], CHUNK, prime)
            shift = np.ones(int(number.max(initial=0)) + 1, np.int64)
            for i in range(1, len(shift)):
                shift[i] = shift[i - 1] * step % prime
            np.add.at(out[:, k], row, hashes[:, k] * shift[number] % prime)
            out[:, k] %= prime
        return out


def _key(length: np.ndarray, f1: np.ndarray, f2: np.ndarray) -> np.ndarray:
    """One 64-bit number of a fingerprint, for the bitmap."""
    return mix(length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (f1.astype(np.uint64) << np.uint64(32))
               + f2.astype(np.uint64))


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), *more)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 primes: tuple[int, int] = PRIMES, key: Column | None = None) -> DataFrame:
    """doc_id, len, f1, f2, h (one number of the three), sha (SHA-256 of the normalised text) and key, if given, of every row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(primes)
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            for i, j in row_slices(offs):
                d, o = one_space(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                f = poly.rows(d, o)
                view = memoryview(np.ascontiguousarray(d))
                sha = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(o[:-1].tolist(), o[1:].tolist(), strict=True)]
                more = [batch.column(2).slice(i, j - i)] if batch.num_columns > 2 else []
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(o)),
                                                  pa.array(f[:, 0]), pa.array(f[:, 1]),
                                                  pa.array(_key(np.diff(o), f[:, 0], f[:, 1]).view(np.int64)),
                                                  pa.array(sha, pa.string()), *more],
                                                 names=["doc_id", *PRINT, "h", "sha", "key"][:6 + len(more)])

    if key is None:
        return _rows(docs, id_col, text_col).mapInArrow(run, PRINTS)
    return _rows(docs, id_col, text_col, key.alias("key")).mapInArrow(run, PRINTS + ", key binary")


def differing(docs: DataFrame, repeated: DataFrame, id_col: str, text_col: str, primes: tuple[int, int]) -> DataFrame:
    """Fingerprints of ``repeated`` (len, f1, f2, h) below which some chunk differs between documents."""
    spark = docs.sparkSession
    repeated = written(repeated.select("h"), "repeated")
    bits = bitmap_bits(repeated.count())
    words = spark.sparkContext.broadcast(filter_bits(repeated, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(primes)
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            for i, j in row_slices(offs):
                d, o = one_space(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                f, size = poly.rows(d, o), np.diff(o)
                text = d.tobytes()
                hit = np.flatnonzero(in_filter(words.value, _key(size, f[:, 0], f[:, 1]), bits))
                cuts = [(r, k, x) for r in hit.tolist() for k, x in
                        enumerate(range(int(o[r]), max(int(o[r + 1]), int(o[r]) + 1), CHUNK))]
                r = np.array([c[0] for c in cuts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(size[r]), pa.array(f[r, 0]), pa.array(f[r, 1]), pa.array([c[1] for c in cuts], pa.int32()),
                     pa.array([text[x:min(x + CHUNK, int(o[k + 1]))] for k, _, x in cuts], pa.binary())],
                    names=[*PRINT, "chunk", "body"])

    chunks = _rows(docs, id_col, text_col).mapInArrow(run, "len long, f1 long, f2 long, chunk int, body binary")
    return (chunks.groupBy(*PRINT, "chunk").agg(F.min("body").alias("lo"), F.max("body").alias("hi"))
            .where("lo <> hi").select(*PRINT).distinct())


def grouped(prints: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            primes: tuple[int, int] = PRIMES) -> DataFrame:
    """``prints`` with ``part``: rows of equal len, f1, f2 and part have equal texts."""
    repeated = prints.groupBy(*PRINT, "h").count().where("count > 1")
    mixed = written(differing(docs, repeated, id_col, text_col, primes), "differing")
    if mixed.isEmpty():
        return prints.withColumn("part", F.lit(""))
    # a collision: its texts are told apart by their SHA-256
    marked = prints.join(mixed.withColumn("collides", F.lit(True)), PRINT, "left")
    return marked.withColumn("part", F.when(F.col("collides"), F.col("sha")).otherwise("")).drop("collides")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     primes: tuple[int, int] = PRIMES) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = written(fingerprints(docs, id_col, text_col, primes), "fingerprints")
    marked = grouped(prints, docs, id_col, text_col, primes)
    key = [*PRINT, "part"]
    groups = written(marked.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                     .select(*[F.col(c).alias(f"g_{c}") for c in key], "keep_id", "group_size"), "groups")
    same = [marked[c] == groups[f"g_{c}"] for c in key]
    return marked.join(groups, same).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each set of equal texts, with all its columns: the one with the smallest doc_id, see ``one_of_each``."""
    key = row_key(docs, "doc_id", "text")
    prints = written(fingerprints(docs, key=key), "fingerprints")
    return one_of_each(docs, key, grouped(prints, docs), *PRINT, "part")
