"""C3  Alignment of separately stored tables by their key.

Sentences, ids, labels and scores of one corpus are stored as tables of their own, each written by another
job. ``store_aligned`` writes such a table bucketed and sorted by its key, ``aligned`` joins any number of
them: tables with the same key and buckets meet bucket by bucket, without an exchange. A table that was
stored otherwise is dealt out by the join like any other; the result is the same.

``how='outer'`` keeps every key of any table, with nulls and the names of the tables that lack it in
``missing``; ``inner`` keeps the keys that all have. A key that a table repeats cannot be aligned: its rows
are not multiplied but left out of the result, and ``repeated_keys`` gives them with their count. Rows with a null in
the key have no key and are reported there, too.
"""

from __future__ import annotations

import functools
import operator
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gistlet.session import new_work_path

KEY = ("split", "article_id", "sent_index")


def store_aligned(df: DataFrame, name: str | None = None, key: tuple = KEY, buckets: int | None = None) -> str:
    """Writes ``df`` bucketed by its key, a file to a bucket, and returns the table's name. Tables to be aligned take the same number.

    The number of buckets is that of the shuffle's partitions unless it is given: for a large corpus give
    one that makes a bucket of some hundred MB.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"aligned_{uuid.uuid4().hex[:12]}"
    # dealt out as the buckets are, so that each task writes one bucket as one sorted file
    dealt = df.repartition(buckets, *key)
    (dealt.write.bucketBy(buckets, *key).sortBy(*key).option("path", new_work_path(spark, name))
     .format("parquet").saveAsTable(name))
    return name


def _once(spark: SparkSession, table: str, key: tuple) -> DataFrame:
    """The rows of a table whose key is whole and stands once in it; its key groups stay in their buckets."""
    rows = spark.table(table)
    rows = rows.where(functools.reduce(operator.and_, [F.col(k).isNotNull() for k in key]))
    others = [c for c in rows.columns if c not in key]
    one = rows.groupBy(*key).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in others])
    return one.where("_n = 1").drop("_n")


def aligned(spark: SparkSession, tables: dict[str, str], key: tuple = KEY, how: str = "inner") -> DataFrame:
    """``tables`` (a label and the stored table's name) as one table: the key, each table's other columns, and ``missing``.

    ``missing`` lists the labels of the tables without the key, comma-joined in the order given ('' for ``inner``).
    """
    parts = [_once(spark, name, key).withColumn(f"_in_{label}", F.lit(True)) for label, name in tables.items()]
    joined = functools.reduce(lambda a, b: a.join(b, list(key), "full_outer" if how == "outer" else "inner"), parts)
    lacking = [F.when(F.col(f"_in_{label}").isNull(), F.lit(label)) for label in tables]
    return joined.withColumn("missing", F.concat_ws(",", *lacking)).drop(*[f"_in_{label}" for label in tables])


def repeated_keys(spark: SparkSession, tables: dict[str, str], key: tuple = KEY) -> DataFrame:
    """table, key, n: the keys that ``aligned`` leaves out, as they stand more than once in a table or hold a null."""
    whole = functools.reduce(operator.and_, [F.col(k).isNotNull() for k in key])
    found = [spark.table(name).groupBy(*key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | ~whole)
             .select(F.lit(label).alias("table"), *key, "n") for label, name in tables.items()]
    return functools.reduce(DataFrame.unionByName, found)
