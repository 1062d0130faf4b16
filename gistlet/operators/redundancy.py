"""Sentences that are good and unlike those already taken (greedy maximal marginal relevance).

In each of k rounds the sentence with the largest ``weight * score - (1 - weight) * similarity`` is taken, where the
similarity is the largest Jaccard similarity of its distinct tokens to those of a sentence taken before (0 in the first round).
Ties go to the later sentence, as in the plain top-k; with ``weight`` 1 the two agree.

Row-local and native. Of the matrix of similarities only the rows of the k sentences that are taken are ever computed, so
an article of n sentences costs k * n comparisons and holds n numbers.

Two sentences without tokens are alike (1), one without and one with are not (0). An article without sentences gives
an empty array, one with fewer than k all of them, null arrays give null; a null score ranks behind all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gistlet import config as C
from gistlet.functions.text import text_tokens
from gistlet.operators.summarize import score_articles
from gistlet.operators.topk import summary_text

WEIGHT = 0.75


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct tokens."""
    def ratio(both: Column) -> Column:
        either = F.size(a) + F.size(b) - both
        return F.when(either == 0, F.lit(1.0)).otherwise(both.cast("double") / either.cast("double"))

    return _bound(F.size(F.array_intersect(a, b)), ratio)


def sentence_sets(sentences: Column) -> Column:
    """Distinct tokens of each sentence."""
    return F.transform(sentences, lambda s: F.array_distinct(F.coalesce(text_tokens(s), F.array().cast("array<string>"))))


def mmr_indices(scores: Column, sets: Column, k: int = C.TOP_K, weight: float = WEIGHT) -> Column:
    """Indices (0-based) of k sentences in the order in which they are taken."""
    def chosen(z: Column) -> Column:
        def best(acc: Column) -> Column:
            worth = F.transform(z["scores"], lambda s, i: F.struct(
                (F.lit(weight) * s - F.lit(1 - weight) * F.get(acc["near"], i)).alias("worth"), i.alias("i")))
            return F.array_max(F.filter(worth, lambda e: ~F.array_contains(acc["taken"], e["i"])))["i"]

        def take(acc: Column, _: Column) -> Column:
            def state(i: Column) -> Column:
                near = F.zip_with(acc["near"], z["sets"], lambda m, s: F.greatest(m, jaccard(s, F.get(z["sets"], i))))
                return F.struct(F.concat(acc["taken"], F.array(i)).alias("taken"), near.alias("near"))

            return _bound(best(acc), state)

        n = F.least(F.size(z["scores"]), F.lit(k))
        start = F.struct(F.array().cast("array<int>").alias("taken"), F.transform(z["scores"], lambda s: F.lit(0.0)).alias("near"))
        rounds = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(rounds, start, take, lambda acc: acc["taken"])

    given = scores.isNotNull() & sets.isNotNull()
    return F.when(given, _bound(F.struct(scores.alias("scores"), sets.alias("sets")), chosen))


def summarize_unlike(articles: DataFrame, vocab, weights, top_k: int = C.TOP_K, weight: float = WEIGHT) -> DataFrame:
    """Articles' summaries of sentences that do not repeat each other, in document order."""
    s = score_articles(articles, vocab, weights)
    s = s.withColumn("picked_indices", mmr_indices(F.col("scores"), sentence_sets(F.col("sentences")), top_k, weight))
    sel = F.array_sort("picked_indices")
    keep = [c for c in ("split", "id", "highlights") if c in s.columns]
    return s.select(*keep, F.size("sentences").alias("n_sentences"), "picked_indices", sel.alias("selected_indices"),
                    summary_text(F.col("sentences"), sel).alias("summary"))
