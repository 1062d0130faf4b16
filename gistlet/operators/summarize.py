"""Articles -> extractive summaries, one narrow stage per article row.

split + cap (native) -> tokens (native) -> ids (Arrow lookup, broadcast vocabulary)
-> pad (native) -> scores (Arrow UDF with the weights broadcast)
-> top-k in document order (native array sort) -> summary (native join).

Nothing here shuffles: every article is processed inside the task that read it. Arrow batches
are bounded in bytes, so long articles make smaller batches, and ``max_sentences`` is an
optional cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gistlet import config as C
from gistlet.operators.flatten import with_sentences
from gistlet.operators.scorer import ScorerWeights, score_udf
from gistlet.operators.topk import pick, summary_text, topk_indices
from gistlet.operators.vocab import Vocabulary, encode_articles


def sentence_scores(x_arrays: Column, weights: ScorerWeights) -> Column:
    """array<array<int>> -> array<double>."""
    from pyspark.sql import SparkSession
    return score_udf(SparkSession.getActiveSession(), weights, nested=True)(x_arrays)


def score_articles(articles: DataFrame, vocab: Vocabulary, weights: ScorerWeights,
                   max_sentences: int | None = None) -> DataFrame:
    """Articles with ``sentences``, ``x`` (ids per sentence) and ``scores`` arrays."""
    a = with_sentences(articles, max_sentences)
    return encode_articles(a, vocab).withColumn("scores", sentence_scores(F.col("x"), weights))


def summarize_articles(articles: DataFrame, vocab: Vocabulary, weights: ScorerWeights,
                       top_k: int = C.TOP_K, max_sentences: int | None = None) -> DataFrame:
    """T10 rows: one summary per article (all splits that are present)."""
    s = score_articles(articles, vocab, weights, max_sentences)
    sel = topk_indices(F.col("scores"), top_k)
    keep = [c for c in ("split", "id", "highlights") if c in s.columns]
    return s.select(
        *keep,
        F.size("sentences").alias("n_sentences"),
        sel.alias("selected_indices"),
        pick(F.col("sentences"), sel).alias("selected_sentences"),
        summary_text(F.col("sentences"), sel).alias("summary"),
        F.col("scores"),
    )
