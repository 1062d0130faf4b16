"""A training-corpus pipeline of five operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's
rows to the shared folder and reads them again for the next. All stages but the last keep the
columns of ``documents``; the last returns the packed pieces with their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gistlet.llm import decontaminate, exactdedup, langid, packing, simhash
from gistlet.llm.common import written
from gistlet.llm.queries import table, tokenizer_path
from gistlet.session import ship_package


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go."""
    ship_package(spark)
    return langid.accepted(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    ship_package(spark)
    return exactdedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    ship_package(spark)
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    ship_package(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their ids, packed into sequences."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("language ID", identify_language), ("exact dedup", drop_exact_copies), ("SimHash near-dedup", drop_near_copies),
          ("benchmark decontamination", drop_benchmark), ("packing", pack_sequences)]

#: The language model and the tokenizer are not SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
