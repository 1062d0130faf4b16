"""Vocabulary and encoded-array stores (parquet in place of .npy / .npz).

A7  save_vocab      (token, id, n) table
A8  load_vocab      -> Vocabulary (size-checked before it is broadcast)
A9  write_encoded   T5 rows partitioned by split; empty splits simply write nothing
A10 read_encoded    column-pruned parquet read, optional split filter (partition pruning)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gistlet import config as C
from gistlet.operators.vocab import Vocabulary, vocabulary_from_table


def save_vocab(vocab: Vocabulary, path: str) -> None:
    vocab.table.coalesce(1).write.mode("overwrite").parquet(path)


def load_vocab(spark: SparkSession, path: str, seq_len: int = C.SEQ_LEN) -> Vocabulary:
    return vocabulary_from_table(spark.read.parquet(path), seq_len)


def write_encoded(encoded: DataFrame, path: str) -> None:
    (encoded.select("split", "article_id", F.col("sent_index").cast("int").alias("sent_index"),
                    F.col("x").cast("array<int>").alias("x"), F.col("y").cast("tinyint").alias("y"))
     .write.mode("overwrite").partitionBy("split").parquet(path))


def read_encoded(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df
