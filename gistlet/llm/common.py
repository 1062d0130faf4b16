"""Helpers shared by the operators: bounded Arrow batches, byte views, span hashes."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from gistlet.session import new_work_path

#: Bytes of an Arrow batch sent to a Python worker, and of the rows worked on at once.
BATCH_BYTES = 8 << 20
SLICE_BYTES = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = new_work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Row keys that are sent to every task; more are joined.
KEYS = 200_000


def row_key(docs: DataFrame, *columns: str) -> Column:
    """32 bytes that are equal for rows equal in ``columns``; a null is not an empty string."""
    parts = [F.coalesce(F.concat(F.lit("="), docs[c].cast("string")), F.lit("-")) for c in columns]
    framed = [x for p in parts for x in (F.octet_length(p).cast("string"), F.lit(":"), p)]
    return F.unhex(F.sha2(F.concat(*framed), 256))


def _marked(keys: DataFrame, count: int, bits: int):
    """A column function: whether a long may be among the 64-bit hashes of ``keys``; none is missed."""
    words = keys.sparkSession.sparkContext.broadcast(filter_bits(keys.select(F.xxhash64("key").alias("h")), bits))

    @F.arrow_udf("boolean")
    def hit(h: pa.Array) -> pa.Array:
        return pa.array(in_filter(words.value, h.to_numpy(zero_copy_only=False).view(np.uint64), bits))

    return hit


def without(docs: DataFrame, key: Column, drop: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``key`` (see ``row_key``) is not in ``drop`` (key); all columns are kept.

    Up to ``KEYS`` keys are broadcast. Of more, a bitmap sized by their number lets rows through that are
    surely not among them, so that only the rows to drop, and few others, are shuffled for the join.
    """
    drop = written(drop.select("key"), "drop")
    n = drop.count()
    if not n:
        return docs
    name = f"_key_{uuid.uuid4().hex[:8]}"
    given = docs.withColumn(name, key)
    if n <= KEYS:
        return given.join(F.broadcast(drop), F.col(name) == drop["key"], "left_anti").drop(name)
    hit = _marked(drop, n, bitmap_bits(n))(F.xxhash64(name))
    doubt = given.where(hit).join(drop, F.col(name) == drop["key"], "left_anti")
    return given.where(~hit).unionByName(doubt).drop(name)


def one_of_each(docs: DataFrame, key: Column, rows: DataFrame, *group: str) -> DataFrame:
    """One row of ``docs`` for each ``group`` of ``rows`` (group, doc_id, key; a row for each of ``docs``).

    The row with the smallest doc_id stays (null last), of several the one with the smallest key, and of rows
    with that same key, which agree in the columns that it is made of, the one whose columns have the smallest hash.
    """
    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key")))
    first = rows.groupBy(*group).agg(least.alias("f"), F.count("*").alias("n")).where("n > 1")
    first = written(first.select(*[F.col(g).alias(f"of_{g}") for g in group], F.col("f.key").alias("first")), "first")
    shared = rows.join(first, [rows[g].eqNullSafe(first[f"of_{g}"]) for g in group])
    marked = written(shared.select("key", (F.col("key") == F.col("first")).alias("stays")), "marked")
    out = without(docs, key, marked.where("not stays").select("key").distinct())
    twice = written(marked.where("stays").groupBy("key").count().where("count > 1").select("key"), "twice")
    n = twice.count()
    if not n:
        return out
    name, keys = f"_key_{uuid.uuid4().hex[:8]}", F.broadcast(twice) if n <= KEYS else twice
    given = out.withColumn(name, key)
    hashed = F.xxhash64(F.to_json(F.struct(*[given[f"`{c}`"] for c in docs.columns]), {"ignoreNullFields": "false"}))
    copies = given.join(keys, F.col(name) == twice["key"], "left_semi")
    one = copies.groupBy(name).agg(F.min_by(F.struct(*[given[f"`{c}`"] for c in docs.columns]), hashed).alias("row")).select("row.*")
    return given.join(keys, F.col(name) == twice["key"], "left_anti").drop(name).unionByName(one)


# ------------------------------------------------------------------ byte views

def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the n + 1 offsets of its rows; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if not (pa.types.is_string(arr.type) or pa.types.is_binary(arr.type)):
        arr = arr.cast(pa.string())
    if arr.null_count:
        arr = pc.fill_null(arr, "" if pa.types.is_string(arr.type) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def row_slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes together; a longer row stands alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(int(np.searchsorted(offs, offs[i] + limit, "right")) - 1, i + 1)
        yield i, min(j, n)
        i = j


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of `[^\x20\x09-\x0D]+` words, and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` words after lower-casing.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def word_spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True in ``inside`` that do not cross a row; first word of each row, n + 1."""
    n = len(inside)
    edge = np.ones(n + 1, bool)
    edge[1:n] = inside[1:] != inside[:-1]
    edge[offs] = True
    at = np.flatnonzero(edge)
    at = at[at < n]
    ends = np.append(at[1:], n)
    keep = inside[at]
    starts, ends = at[keep], ends[keep]
    return starts, ends, np.searchsorted(starts, offs)


def blocks(starts: np.ndarray, ends: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Runs of ordered spans that cover at most ``limit`` bytes; a longer span stands alone."""
    i, n = 0, len(starts)
    while i < n:
        j = max(int(np.searchsorted(ends, starts[i] + limit, "right")), i + 1)
        yield i, j
        i = j


# ------------------------------------------------------------------ span hashes

_M = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inv = np.uint64(pow(int(_M), -1, 1 << 64))
    out = []
    for m in (_M, inv):
        p = np.full(size, m, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@functools.lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish of a 64-bit hash: every bit of the input moves every bit of the output."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: polynomial over keyed byte values, by prefix sums modulo 2^64."""
    out = np.empty(len(starts), np.uint64)
    values = _byte_values()
    for i, j in blocks(starts, ends):
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(max(1 << 20, 1 << int(hi - lo + 1).bit_length()))
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[data[lo:hi]] * up[:hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _M
    return mix(out)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc = acc * _M + h[j:n + j]
    return mix(acc)


# ------------------------------------------------------------------ fixed-size filters

FILTER_BITS = 26    # 2^26 bits: 8 MiB, whatever it is built from


def bitmap_bits(n: int) -> int:
    """Bits (as a power of two) of a bitmap for ``n`` hashes: 16 to 32 for each, up to 2^30 in all (128 MiB)."""
    return min(max(n.bit_length() + 4, 16), 30)


def filter_bits(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of 2^bits bits of the long column ``h``: set by Spark, so at most 2^(bits - 6) words reach the driver."""
    cell = F.shiftrightunsigned("h", 64 - bits)
    words = (hashes.select(cell.alias("cell"))
             .select(F.shiftright("cell", 6).alias("w"), F.expr("shiftleft(1L, cast(cell & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    table = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[table["w"].to_numpy()] = table["b"].to_numpy().view(np.uint64)
    return out


def in_filter(words: np.ndarray, h: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    cell = h >> np.uint64(64 - bits)
    return (words[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) != 0


# ------------------------------------------------------------------ bounded samples

def bounded_sample(rows: DataFrame, label: str, per_label: int, *key: str, distinct: bool = False) -> DataFrame:
    """At most ``per_label`` rows of each value of ``label``: those with the smallest hash of ``key``.

    A count by label gives the share of rows that the hash lets through, about twice what is
    needed, so that the ranking sees a bounded number of rows however many there are. With
    ``distinct``, rows that are equal in label and key count, and are taken, as one.
    """
    known = rows.where(F.col(label).isNotNull())
    if distinct:
        known = known.select(label, F.xxhash64(F.lit("sample"), *key).alias("_u")).distinct()
    counts = {r[0]: r[1] for r in known.groupBy(label).count().collect()}
    if not counts:
        return rows.where(F.lit(False))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, float(2 * per_label + 200) / n)])
    hashed = rows.where(F.col(label).isNotNull()).withColumn("_u", F.xxhash64(F.lit("sample"), *key))
    chosen = hashed.where(F.shiftrightunsigned("_u", 11) / F.lit(float(1 << 53)) < share[F.col(label)])
    if distinct:
        chosen = chosen.dropDuplicates([label, "_u", *key])
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_u", *key))
    return chosen.withColumn("_k", rank).where(F.col("_k") <= per_label).drop("_u", "_k")
