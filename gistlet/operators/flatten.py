"""Article to sentence operators.

B3  with_sentences       split + cap, drop articles without sentences
B6  aligned_label        labels padded with 0 / surplus ignored, as TINYINT
B8  flatten_sentences    posexplode: one row per sentence
B9  ordinal ids          position of the sentence in its split, as a string;
                         prefix sum of the sentence counts over range partitions
D9  regroup_articles     flat sentences -> articles (inverse of B8)
D5  flatten_stats        sentence counts per split, vocabulary size, sequence length
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gistlet import config as C
from gistlet.functions.rows import posexplode_rows
from gistlet.functions.text import has_sentence, split_sentences
from gistlet.session import new_work_path

def with_sentences(articles: DataFrame, max_sentences: int | None = None,
                   text_col: str = "article") -> DataFrame:
    """Add ``sentences`` (of an optional cap) and drop articles with none."""
    # tested on the text, so the split itself is not evaluated twice
    return (articles.where(has_sentence(text_col))
            .withColumn("sentences", split_sentences(F.col(text_col), max_sentences)))


def aligned_label(labels: Column, index: Column) -> Column:
    """Label at ``index`` (0-based), 0 past the end of the labels array."""
    return F.coalesce(F.get(labels, index), F.lit(0)).cast("tinyint")


def _running(part_at: int, count_at: int, names: list[str]):
    """Adds to rows that are in order the sum of the counts before them in their part and task, and the task's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, seen, begun = TaskContext.get().partitionId(), None, 0, False
        for b in batches:
            if not b.num_rows:
                continue
            part = np.array(b.column(part_at).to_pylist() + [None], dtype=object)[:-1]
            n = b.column(count_at).cast(pa.int64()).fill_null(0).to_numpy()
            before = np.cumsum(n) - n
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            own = before - np.repeat(before[first], np.diff(np.append(first, len(n))))
            if begun and part[0] == last:
                own[:first[1] if len(first) > 1 else len(n)] += seen
            last, seen, begun = part[-1], int(own[-1] + n[-1]), True
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own), pa.array(np.full(len(n), task, np.int32))], names=names)

    return run


#: Rows of the table of sums by part and range that are broadcast; more are joined.
STARTS = 100_000


def ordinal_offsets(rows: DataFrame, count_col: str, part_col: str, order_cols: list, out_col: str) -> DataFrame:
    """``rows`` with the exclusive prefix sum of ``count_col`` in the order of ``order_cols`` within ``part_col``.

    The rows are dealt out once, by ranges of (part, order), and written with the running sum of their own
    range and its number. Each range starts at the sum of the ranges before it in its part: one row per part
    and range, which meets the written rows where they lie, so that they are not moved again. A null
    part is a part; rows of one place follow each other in any order, fixed by the writing.
    """
    spark = rows.sparkSession
    path = new_work_path(spark, "ordinals")
    schema = T.StructType([*rows.schema.fields, T.StructField("_own", T.LongType()), T.StructField("_range", T.IntegerType())])
    dealt = rows.repartitionByRange(part_col, *order_cols).sortWithinPartitions(part_col, *order_cols)
    dealt.mapInArrow(_running(rows.columns.index(part_col), rows.columns.index(count_col), schema.names), schema).write.parquet(path)
    kept = spark.read.schema(schema).parquet(path)
    earlier = Window.partitionBy("_part").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = (kept.groupBy(F.col(part_col).alias("_part"), F.col("_range").alias("_of")).agg(F.sum(count_col).alias("_sum"))
              .withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum"))
    path = new_work_path(spark, "range-starts")
    starts.write.parquet(path)
    starts = spark.read.parquet(path)
    if starts.count() <= STARTS:
        starts = F.broadcast(starts)
    joined = kept.join(starts, kept[part_col].eqNullSafe(F.col("_part")) & (kept["_range"] == F.col("_of")))
    return (joined.withColumn(out_col, (F.col("_start") + F.col("_own")).cast("bigint"))
            .drop("_start", "_own", "_range", "_part", "_of"))


def order_columns(df: DataFrame) -> list:
    """Columns that give an article its place in its split: the file, where there is one, and the position."""
    return [c for c in ("file", "pos") if c in df.columns]


def add_ordinal_offset(articles: DataFrame, count_col: str, part_col: str = "split",
                       out_col: str = "_offset") -> DataFrame:
    """Exclusive prefix sum of ``count_col`` in source order within ``part_col``, on the articles."""
    return ordinal_offsets(articles, count_col, part_col, order_columns(articles), out_col)


def flatten_sentences(labeled: DataFrame, with_ordinal: bool = True,
                      id_col: str = "id") -> DataFrame:
    """Labeled articles (split, id, pos, sentences, labels) -> one row per sentence.

    Output: split, id (ordinal in split, string), sentence, label TINYINT,
    meta STRUCT<article_id, sent_index>, plus article_id and sent_index columns.
    """
    src = labeled
    if "labels" not in src.columns:
        src = src.withColumn("labels", F.array().cast("array<tinyint>"))
    if with_ordinal:
        src = add_ordinal_offset(src.withColumn("_n", F.size("sentences")), "_n").drop("_n")
    else:
        src = src.withColumn("_offset", F.lit(None).cast("bigint"))
    src = src.withColumnRenamed(id_col, "article_id")
    # each sentence with its own label, so that the array of labels is not copied onto every row
    labels, sents = F.col("labels"), F.col("sentences")
    zipped = F.transform(sents, lambda s, i: F.struct(s.alias("s"), aligned_label(labels, i).alias("l")))
    flat = posexplode_rows(src.withColumn("_z", zipped), ["split", "article_id", "_offset"], "_z", "sent_index", "_e")
    flat = flat.withColumn("sentence", F.col("_e.s")).withColumn("label", F.col("_e.l"))
    return flat.select(
        "split",
        (F.col("_offset") + F.col("sent_index")).cast("string").alias("id"),
        "sentence",
        "label",
        F.struct(F.col("article_id"), F.col("sent_index").cast("int").alias("sent_index")).alias("meta"),
        "article_id",
        F.col("sent_index").cast("int").alias("sent_index"),
    )


def regroup_articles(flat: DataFrame, article_col: str = "article_id") -> DataFrame:
    """Flat sentences back to one row per article (sentences and labels in index order).

    One exchange keyed by article; a group is one article's sentences."""
    g = flat.groupBy("split", article_col).agg(
        F.array_sort(F.collect_list(F.struct("sent_index", "sentence", "label"))).alias("_s"))
    return g.select("split", F.col(article_col).alias("id"),
                    F.transform("_s", lambda e: e["sentence"]).alias("sentences"),
                    F.transform("_s", lambda e: e["label"]).alias("labels"))


def flatten_stats(flat: DataFrame, vocab_size: int, seq_len: int = C.SEQ_LEN) -> DataFrame:
    """One row (train_sentences, validation_sentences, test_sentences, vocab_size, seq_len)."""
    aggs = [F.sum(F.when(F.col("split") == s, 1).otherwise(0)).cast("bigint").alias(f"{s}_sentences")
            for s in C.SPLITS]
    return flat.agg(*aggs).select(
        *[F.coalesce(F.col(f"{s}_sentences"), F.lit(0)).cast("bigint").alias(f"{s}_sentences")
          for s in C.SPLITS],
        F.lit(int(vocab_size)).cast("bigint").alias("vocab_size"),
        F.lit(int(seq_len)).cast("bigint").alias("seq_len"))
