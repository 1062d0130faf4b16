"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (an item of fewer words is
one window). Both sides keep the smallest hash of every ``SPAN`` consecutive
``GRAM``-word hashes; ``GRAM + SPAN - 1 = WINDOW``, so two texts that share a window share
a kept hash inside it. Kept hashes of documents are looked up in a bitmap of fixed size of
the benchmark's, the few that pass are joined with the benchmark on the hash, and each hit
is extended word by word to both sides; runs of at least a window count. Items of n <
WINDOW words keep their one n-gram, and documents all n-grams of such a length n.

Rows of ``documents`` that share a doc_id count as one document (words add up per
distinct text, equal texts count once). Null, empty and wordless texts have no words;
such an item has no window. An empty benchmark gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import (ALNUM, LOWER, bound_batches, filter_bits, gram_hashes, in_filter, row_key,
                                row_slices, span_hashes, text_bytes, without, word_spans, written)

WINDOW, GRAM = 10, 8
SPAN = WINDOW - GRAM + 1

FINGERPRINTS = ("id long, body long, n_words long, kind int, h long, pos long, "
                "ahead array<string>, behind array<string>")


def _kept(h: np.ndarray) -> np.ndarray:
    """Positions that are the smallest of some SPAN neighbours."""
    n = len(h)
    if n < SPAN:
        return np.arange(n)
    low = h[:n - SPAN + 1].copy()
    for j in range(1, SPAN):
        np.minimum(low, h[j:n - SPAN + 1 + j], out=low)
    hit = np.zeros(n, bool)
    for j in range(SPAN):
        hit[j:n - SPAN + 1 + j] |= h[j:n - SPAN + 1 + j] == low
    return np.flatnonzero(hit)


def _batches(short: list[int], words: object, whole_items: bool):
    """A mapInArrow function from (id, text) to FINGERPRINTS.

    Documents: a row without a hash for each, and the kept hashes that the bitmap has.
    Items (``whole_items``): kept hashes of windows, or the one gram of a short item.
    """
    def rows(ids: pa.Array, data: np.ndarray, offs: np.ndarray) -> pa.RecordBatch:
        low = LOWER[data]
        starts, ends, first = word_spans(ALNUM[low], offs)
        counts = np.diff(first)
        doc = np.repeat(np.arange(len(counts)), counts)
        hashes = span_hashes(low, starts, ends)
        found = []
        for kind in [WINDOW, *short]:
            gram = GRAM if kind == WINDOW else kind
            h = gram_hashes(hashes, gram)
            whole = doc[:len(h)] == doc[gram - 1:]
            if kind == WINDOW:
                at = _kept(np.where(whole, h, np.uint64(2 ** 64 - 1)))
                at = at[whole[at]]
                if whole_items:
                    at = at[counts[doc[at]] >= WINDOW]
            else:
                at = np.flatnonzero(whole & (counts[doc[:len(h)]] == gram)) if whole_items else np.flatnonzero(whole)
            if words is not None:
                at = at[in_filter(words.value, h[at])]
            found.append((np.full(len(at), kind, np.int32), at, h[at]))
        kinds, at, h = (np.concatenate(x) for x in zip(*found, strict=True))
        text = low.tobytes()

        def piece(lo: int, hi: int, step: int = 1) -> list[str]:
            return [text[starts[w]:ends[w]].decode("utf-8", "replace") for w in range(lo, hi)[::step]]

        ahead, behind = [], []
        for g, w in zip(kinds.tolist(), at.tolist(), strict=True):
            if g == WINDOW:
                a, b = int(first[doc[w]]), int(first[doc[w] + 1])
                ahead.append(piece(w, min(w + WINDOW, b)))
                behind.append(piece(max(w - WINDOW + GRAM, a), w, -1))
            else:
                ahead.append(piece(w, w + g))
                behind.append([])
        n = 0 if whole_items else len(counts)
        every = np.arange(n)
        row = np.concatenate([every, doc[at]]).astype(np.int64)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * (np.arange(len(hashes), dtype=np.uint64) - np.repeat(first[:-1], counts).astype(np.uint64)
                            + np.uint64(1)), out=sums[1:])
        body = (sums[first[1:]] - sums[first[:-1]]).view(np.int64)
        none = np.zeros(n, np.int64)
        return pa.RecordBatch.from_arrays([
            ids.take(pa.array(row)), pa.array(body[row]), pa.array(counts[row].astype(np.int64)),
            pa.array(np.concatenate([none.astype(np.int32), kinds])),
            # no benchmark row has kind 0: the doc's own number only deals such rows out evenly
            pa.array(np.concatenate([body[:n], h.view(np.int64)])),
            pa.array(np.concatenate([none, at - first[doc[at]]]).astype(np.int64)),
            pa.array([[]] * n + ahead, pa.list_(pa.string())), pa.array([[]] * n + behind, pa.list_(pa.string()))],
            names=["id", "body", "n_words", "kind", "h", "pos", "ahead", "behind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            for i, j in row_slices(offs):
                yield rows(batch.column(0).slice(i, j - i), data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])

    return run


def _same(a: str, b: str):
    """How many leading elements of two arrays agree."""
    eq = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(eq, False)
    return F.when(at == 0, F.size(eq)).otherwise(at - 1).cast("long")


def fingerprints(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, list[int]]:
    """Kept hashes of the benchmark with the words around them and the items that have them; short lengths in use."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    prints = rows.mapInArrow(_batches(list(range(1, WINDOW)), None, True), FINGERPRINTS)
    prints = written(prints.groupBy("kind", "h", "ahead", "behind").agg(F.collect_set("id").alias("items")), "bench")
    short = prints.where(F.col("kind") < WINDOW).select("kind").distinct().collect()     # at most 9 rows
    return prints, sorted(r[0] for r in short)


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", key: Column | None = None) -> DataFrame:
    """A row for each document, and one for each hit: id, body, n_words, start, stop (words; null without hit), items.

    ``id`` is the document's id, or its ``key`` where one is given."""
    spark = docs.sparkSession
    bound_batches(spark)
    bench, short = fingerprints(items, item_col, item_text)
    bits = spark.sparkContext.broadcast(filter_bits(bench.select("h")))
    ident = F.col(id_col).cast("long") if key is None else key
    rows = docs.select(ident.alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = FINGERPRINTS if key is None else FINGERPRINTS.replace("id long", "id binary", 1)
    left = rows.mapInArrow(_batches(short, bits, False), kind)
    right = bench.select(F.col("kind").alias("k"), F.col("h").alias("gh"), F.col("ahead").alias("to"),
                         F.col("behind").alias("back"), "items")
    joined = left.join(right, (left.kind == right.k) & (left.h == right.gh), "left")
    after, before = _same("ahead", "to"), _same("behind", "back")
    run = joined.select("id", "body", "n_words", "kind", "pos", "items", after.alias("after"), before.alias("before"))
    full = (F.col("after") >= F.least(F.col("kind"), F.lit(GRAM))) & (F.col("after") + F.col("before") >= F.col("kind"))
    return run.select("id", "body", "n_words",
                      F.when(full, F.col("pos") - F.col("before")).alias("start"),
                      F.when(full, F.col("pos") + F.col("after")).alias("stop"),
                      F.when(full, F.col("items")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted ids, as strings), contaminated."""
    found = hits(docs, items, **columns)
    spans = F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "stop")))
    per_text = (found.groupBy("id", "body", "n_words")
                .agg(spans.alias("spans"), F.flatten(F.collect_set("items")).alias("items")))
    covered = F.size(F.array_distinct(F.flatten(
        F.transform("spans", lambda s: F.sequence(s["start"], s["stop"] - 1))))).cast("long")
    per_text = per_text.select("id", "n_words", covered.alias("n_hit"), "items")
    per_doc = per_text.groupBy("id").agg(F.sum("n_words").alias("n_words"), F.sum("n_hit").alias("n_hit"),
                                         F.flatten(F.collect_list("items")).alias("items"))
    ids = F.array_sort(F.transform(F.array_distinct("items"), lambda i: i.cast("string")))
    return per_doc.select(F.col("id").alias("doc_id"), "n_words", "n_hit", ids.alias("items"),
                          (F.col("n_hit") > 0).alias("contaminated"))


def digest(result: DataFrame) -> DataFrame:
    """The result with the item list as its length and SHA-256."""
    return result.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows whose text has no hit, with all their columns; rows of one doc_id are judged each by its own text."""
    key = row_key(docs, "text")
    bad = hits(docs, items, key=key).where(F.col("start").isNotNull()).select(F.col("id").alias("key")).distinct()
    return without(docs, key, bad)
