"""Shared inputs of the operator tests: odd rows, and plain versions of the text rules."""

import re

from pyspark.sql import functions as F

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977} Étude{i % 31}" for i in range(30_000))

ODD_TEXTS = [
    None, "", " ", "\n\t", "...!!", "a", "A a", "one two", "One two three", "one two three four",
    "same text here for all of the rows that repeat it", "same text here for all of the rows that repeat it",
    "same  text here\tfor all of the rows that repeat it", " same text here for all of the rows that repeat it",
    "Été à la plage, l’été: œuvre naïve 123", "日本語のテキスト と English", "x" * 5000, LONG, "\x00\x01 nul", "don't <|endoftext|> it's",
]
EXTRA = ("h", "fp", "id", "body", "lang", "len", "items", "found", "change", "t", "k", "y", "p", "bucket", "node", "root",
         "score", "kept", "number", "copies", "start", "least", "url", "n")


def odd_docs(spark):
    """Odd texts, repeated rows, a null doc_id, and columns that share names with the operators' own."""
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "\n\t"), (10, ODD_TEXTS[10]), (None, "no id here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit("clash").alias(c) for c in EXTRA]).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def docs_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


class Sets:
    """Union-find."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
