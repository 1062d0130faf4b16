"""H1 from JSON lines: raw lines as they arrive -> articles -> summaries, each article once.

A line is known by its file and the byte at which it begins, so an article without an id gets the same one in any batch,
in any replay and on any cluster: '<file>-<byte place>'. No row number of Spark is used. Within a task the bytes of the
lines add up in the order of the file; what comes before an input split is the sum over the file's earlier splits, one row
for each of them. Lines end with a line feed (a carriage return before it is white space to the JSON parser). A byte
order mark is not counted.

Bad lines are dropped, or kept with file, place and reason by ``rejected``. Every micro-batch is written to the folder of
its own number, which a replay of that batch overwrites: a restart neither loses nor repeats an article.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gistlet import config as C
from gistlet.functions.text import default_strip
from gistlet.session import bound_batches
from gistlet.operators.scorer import ScorerWeights
from gistlet.operators.summarize import summarize_articles
from gistlet.operators.vocab import Vocabulary
from gistlet.sources.jsonl import RAW_SCHEMA, line_fault, parsed_line

_LINES = "_path string, _block bigint, _at bigint, _bytes bigint, value string"


def _raw(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
                        F.lit(0).cast("bigint").alias("_at"), (F.octet_length("value") + 1).cast("bigint").alias("_bytes"), "value")


def line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The raw lines of the files below ``path``, new files as they appear."""
    r = spark.readStream.format("text").option("lineSep", "\n").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return _raw(r.load(path))


def line_table(spark: SparkSession, path: str) -> DataFrame:
    """The same lines as a table."""
    return _raw(spark.read.format("text").option("lineSep", "\n").option("recursiveFileLookup", "true").load(path))


def _places_in_split(batches):
    """Adds up the bytes of the lines of each (file, input split), which a task reads one after another."""
    here, done = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column(3).to_numpy()
        key = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["p", "b"])
        code = np.asarray(key.field("p").dictionary_encode().indices, dtype=np.int64)
        block = np.asarray(key.field("b"), dtype=np.int64)
        new = np.append(True, (code[1:] != code[:-1]) | (block[1:] != block[:-1]))
        begins = np.flatnonzero(new)
        before = np.cumsum(size) - size
        first = before[begins].copy()
        if key[0].as_py() == here:          # goes on from the batch before
            first[0] -= done
        at = before - np.repeat(first, np.diff(np.append(begins, len(size))))
        here, done = key[len(key) - 1].as_py(), int(at[-1] + size[-1])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at), batch.column(3), batch.column(4)],
                                         ["_path", "_block", "_at", "_bytes", "value"])


def placed_lines(lines: DataFrame) -> DataFrame:
    """(file, split, place, value) of a table of lines, or of a micro-batch of their stream."""
    bound_batches(lines.sparkSession)
    splits = lines.groupBy("_path", "_block").agg(F.sum("_bytes").alias("_sum"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_path", "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    split = F.regexp_extract("_path", r"/split=([^/]+)/", 1)
    return lines.mapInArrow(_places_in_split, _LINES).join(splits, ["_path", "_block"]).select(
        F.regexp_extract("_path", r"([^/]+)$", 1).alias("file"), F.when(split != "", split).alias("split"),
        (F.col("_before") + F.col("_at")).alias("place"), "value")


def articles_of_lines(placed: DataFrame) -> DataFrame:
    """(split, id, file, place, article, highlights) of the good lines that hold a text. A missing id becomes
    '<file>-<place>'; one that is null stays null. Lines in no split's folder are training lines."""
    good = placed.withColumn("_j", parsed_line(RAW_SCHEMA)).where(line_fault().isNull())
    has_id = F.array_contains(F.json_object_keys("value"), "id")
    out = good.select(F.coalesce("split", F.lit("train")).alias("split"),
                      F.when(F.col("_j.id").isNull() & ~has_id, F.concat_ws("-", "file", F.col("place").cast("string")))
                      .otherwise(F.col("_j.id")).alias("id"),
                      "file", "place", default_strip("_j.article").alias("article"), default_strip("_j.highlights").alias("highlights"))
    return out.where(F.length("article") > 0)


def rejected(placed: DataFrame) -> DataFrame:
    """(file, split, place, reason, value) of the other lines."""
    return (placed.withColumn("_j", parsed_line(RAW_SCHEMA)).withColumn("reason", line_fault()).where(F.col("reason").isNotNull())
            .select("file", "split", "place", "reason", "value"))


def run_batches(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, available_now: bool = True):
    """``work`` on every micro-batch, written to ``out``/batch=<number>; with ``available_now`` what is there, then stop."""
    def one(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    w = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()
    if available_now:
        q.awaitTermination()
    return q


def summarize_lines(spark: SparkSession, path: str, vocab: Vocabulary, weights: ScorerWeights, out: str, checkpoint: str,
                    top_k: int = C.TOP_K, max_files_per_trigger: int | None = None, available_now: bool = True):
    """Summaries of the articles below ``path`` as a stream, with ``file`` and ``place`` of each article's line."""
    def work(batch: DataFrame) -> DataFrame:
        return summarize_articles(articles_of_lines(placed_lines(batch)), vocab, weights, top_k)

    return run_batches(line_stream(spark, path, max_files_per_trigger), work, out, checkpoint, available_now)
