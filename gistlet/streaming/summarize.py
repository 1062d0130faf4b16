"""H1: summarization of an article stream with Structured Streaming.

Every step of the summary is row-local (native array functions plus Arrow UDFs
with a broadcast vocabulary and weights), so the streaming query is stateless:
append mode, no watermark, no state store.  The file sink with its checkpoint
gives exactly-once output; the query survives restarts from the checkpoint.
The vocabulary (and trained weights, if any) are static inputs learned in batch,
as the model files are for the single-article tool.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gistlet import config as C
from gistlet.operators.scorer import ScorerWeights
from gistlet.operators.summarize import summarize_articles
from gistlet.operators.vocab import Vocabulary
from gistlet.sources.corpus import documents_to_raw_articles, normalize_articles

DOCUMENTS_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def document_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(DOCUMENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def summary_stream(docs: DataFrame, vocab: Vocabulary, weights: ScorerWeights,
                   top_k: int = C.TOP_K) -> DataFrame:
    """Streaming DataFrame of summaries (same function body as the batch form)."""
    arts = normalize_articles(documents_to_raw_articles(docs.select("doc_id", "text")))
    return summarize_articles(arts, vocab, weights, top_k)


def run_to_table(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Start the query into a parquet sink; with ``available_now`` process what is there and stop."""
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
