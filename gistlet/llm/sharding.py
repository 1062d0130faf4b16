"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 .. N - 1 by (bucket, doc_id, size, checksum), where a hash of the three
deals them into a fixed number of buckets: equal rows are first counted, so that copies of
one row are one entry, then each bucket numbers its own entries and starts after the rows of
the buckets before it. A keyed Feistel network permutes the numbers below the next power of
four; a result of N or more is permuted again until it is below N, which is a permutation of
0 .. N - 1. Row p of the shuffled order is in shard p mod S at slot p div S, so shard sizes
differ by at most one and any row's place can be computed from its number alone.

The documents themselves, with all their columns, are joined to their numbers and dealt out
in the order of shard and slot.

A null text has no bytes (checksum 0), a null doc_id is numbered first in its bucket, and
repeated rows take as many places as they are. An empty table has no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gistlet.llm.common import mix, written

BUCKETS = 4096
COPIES = 1 << 12        # of one row that are numbered at once
RUN = 1 << 9            # slots of a shard that lie in one partition, in order
ROUNDS = 8
KEY = 0x5DEECE66D1234567


def permute(rows: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The place of each row number (all below ``n``) in the keyed order."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(key | 1))
    out = rows.astype(np.uint64)
    open_ = np.arange(len(out))
    while len(open_):
        x = out[open_]
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & low)
        x = left << np.uint64(half) | right
        out[open_] = x
        open_ = open_[x >= n]
    return out.astype(np.int64)


def permuted(number: Column, n: int, key: int = KEY) -> Column:
    @F.pandas_udf("long")
    def run(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), n, key))

    return run(number)


def numbered(rows: DataFrame, *key: str, within: str) -> tuple[DataFrame, int]:
    """The distinct (``key``, ``within``) with their ``copies`` and the first of their numbers, ``at``; how many rows there are.

    The numbers of a key depend on the rows alone, and not on ``within``.
    """
    entries = rows.groupBy(*key, within).agg(F.count("*").alias("copies"))
    entries = entries.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int"))
    entries = written(entries, "entries")
    sizes = {r["bucket"]: r["n"] for r in entries.groupBy("bucket").agg(F.sum("copies").alias("n")).collect()}
    base, total = [], 0
    for b in range(BUCKETS):
        base.append((b, total))
        total += sizes.get(b, 0)
    starts = rows.sparkSession.createDataFrame(base, "bucket int, base long")       # BUCKETS rows
    before = Window.partitionBy("bucket").orderBy(*key, within).rowsBetween(Window.unboundedPreceding, -1)
    placed = entries.withColumn("before", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    placed = placed.join(F.broadcast(starts), "bucket")
    return placed.select(*key, within, "copies", (F.col("base") + F.col("before")).alias("at")), total


def each_copy(entries: DataFrame) -> DataFrame:
    """A row with its ``number`` for each of the ``copies`` from ``at``, in two steps, so that no array grows with them."""
    columns = [c for c in entries.columns if c not in ("at", "copies")]
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("block")
    out = entries.select(*columns, "copies", "at", block)
    last = F.least(F.col("copies"), F.col("block") + COPIES) - 1
    out = out.select(*columns, "at", F.explode(F.sequence("block", last)).alias("copy"))
    return out.select(*columns, (F.col("at") + F.col("copy")).alias("number"))


def _described(row: Column, id_col: str, text_col: str) -> list[Column]:
    """doc_id, size and text_crc32 of a document held as a struct."""
    text = F.coalesce(row[text_col].cast("string"), F.lit(""))
    return [row[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")]


def _row_hash() -> Column:
    """256-bit hash of all columns of ``row`` as JSON, in which every null, also one inside an array, has its place."""
    return F.unhex(F.sha2(F.to_json("row", {"ignoreNullFields": "false"}), 256))


def shuffled(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", key: int = KEY) -> DataFrame:
    """number, shard, slot and ``row``, the whole document as a struct, of every row.

    The rows are dealt out by shard and run of ``RUN`` slots, and a partition's rows are in the
    order of shard and slot. Rows equal in all columns are moved as one and copied at the end.
    """
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = docs.select("row", *_described(F.col("row"), id_col, text_col), _row_hash().alias("row_hash"))
    entries, n = numbered(rows.drop("row"), "doc_id", "size", "text_crc32", within="row_hash")
    # no null in the key of the join: the hash tells a null doc_id from 0
    entry = [F.coalesce("doc_id", F.lit(0)).alias("entry_id"), "size", "text_crc32", "row_hash"]
    names = ["entry_id", "size", "text_crc32", "row_hash"]
    whole = rows.select(*entry, "row").dropDuplicates(names)
    out = each_copy(whole.join(entries.select(*entry, "copies", "at"), names).select("row", "copies", "at"))
    out = out.withColumn("place", permuted(F.col("number"), n, key))
    out = out.select("number", F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
                     F.floor(F.col("place") / shards).cast("long").alias("slot"), "row")
    return out.repartition("shard", F.floor(F.col("slot") / RUN)).sortWithinPartitions("shard", "slot")


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", key: int = KEY) -> DataFrame:
    """doc_id, size, text_crc32, number, shard, slot of every document in ``shuffled``, from the text that it holds."""
    out = shuffled(docs, shards, id_col, text_col, key)
    return out.select(*_described(F.col("row"), id_col, text_col), "number", "shard", "slot")
