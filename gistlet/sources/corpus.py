"""Input tables and the article view derived from them.

The given ``documents`` table carries no reference summaries, so articles are
derived by a fixed rule (also expressible in plain SQL):

* ``split``: ``doc_id % 10`` = 8 validation, 9 test, else train
* ``id``: ``split || '-' || doc_id``
* ``highlights``: text before the first newline, '' when there is none
* ``article``: text after the first newline, the whole text when there is none
* ``pos``: ``doc_id`` (the article's position in its source, for ordinals)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gistlet.functions.text import default_strip

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_of(doc_id) -> F.Column:
    m = F.pmod(doc_id, F.lit(10))
    return (F.when(m == 8, F.lit("validation"))
            .when(m == 9, F.lit("test"))
            .otherwise(F.lit("train")))


def documents_to_raw_articles(documents: DataFrame) -> DataFrame:
    """documents(doc_id, text, ...) -> raw articles (split, id, pos, article, highlights)."""
    nl = F.instr(F.col("text"), "\n")
    split = split_of(F.col("doc_id"))
    return documents.select(
        split.alias("split"),
        F.concat(split, F.lit("-"), F.col("doc_id").cast("string")).alias("id"),
        F.col("doc_id").cast("bigint").alias("pos"),
        F.when(nl > 0, F.expr("substring(text, instr(text, '\n') + 1)"))
         .otherwise(F.col("text")).alias("article"),
        F.when(nl > 0, F.expr("substring(text, 1, instr(text, '\n') - 1)"))
         .otherwise(F.lit("")).alias("highlights"),
    )


def normalize_articles(raw: DataFrame) -> DataFrame:
    """A2/B1/B2: default + strip both text fields, drop empty articles."""
    cols = [c for c in raw.columns if c not in ("article", "highlights")]
    out = raw.select(*cols,
                     default_strip("article").alias("article"),
                     default_strip("highlights").alias("highlights"))
    return out.where(F.length("article") > 0)


def load_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized articles of the ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return normalize_articles(documents_to_raw_articles(docs))
