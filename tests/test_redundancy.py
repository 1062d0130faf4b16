"""Greedy maximal marginal relevance against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from gistlet.operators import redundancy as R
from gistlet.operators.topk import ranked_indices


def greedy(scores, sets, k, weight):
    taken = []
    while len(taken) < min(k, len(scores)):
        def worth(i):
            near = 0.0
            for j in taken:
                either = len(set(sets[i]) | set(sets[j]))
                near = max(near, len(set(sets[i]) & set(sets[j])) / either if either else 1.0)
            return weight * scores[i] - (1 - weight) * near, i
        taken.append(max((i for i in range(len(scores)) if i not in taken), key=worth))
    return taken


def rows_of(seed, n_rows=60):
    rng = random.Random(seed)
    rows = []
    for k in range(n_rows):
        n = rng.choice([0, 1, 2, 3, 5, 12])
        # few distinct scores and sets, so that ties are common
        rows.append((k, [rng.choice([0.125, 0.5, 0.75, rng.random()]) for _ in range(n)],
                     [rng.sample("abcdef", rng.choice([0, 1, 3, 6])) for _ in range(n)]))
    return rows


@pytest.mark.parametrize("k,weight", [(3, 0.75), (1, 0.5), (7, 0.25), (3, 0.0)])
def test_greedy_rounds_equal_plain_python(spark, k, weight):
    rows = rows_of(k)
    df = spark.createDataFrame(rows, "k int, scores array<double>, sets array<array<string>>").repartition(3)
    got = dict(tuple(r) for r in df.select("k", R.mmr_indices(F.col("scores"), F.col("sets"), k, weight)).collect())
    assert got == {i: greedy(s, t, k, weight) for i, s, t in rows}


def test_weight_one_is_the_plain_top_k(spark):
    df = spark.createDataFrame(rows_of(9), "k int, scores array<double>, sets array<array<string>>")
    got = df.select(R.mmr_indices(F.col("scores"), F.col("sets"), 3, 1.0), ranked_indices("scores", 3)).collect()
    assert all(a == b for a, b in got)


def test_nulls_empty_and_repeated_sentences(spark):
    df = spark.createDataFrame([(0, None, None), (1, [], []), (2, [0.5, None, 0.4], ["A b.", "c", None]),
                                (3, [0.9, 0.9, 0.8], ["The cat sat.", "the CAT sat", "A dog ran."]), (4, [0.1, 0.2], ["...", ""])],
                               "k int, scores array<double>, s array<string>")
    got = dict(tuple(r) for r in df.select("k", R.mmr_indices(F.col("scores"), R.sentence_sets(F.col("s")), 2)).collect())
    assert got == {0: None, 1: [], 2: [0, 2], 3: [1, 2], 4: [1, 0]}


def test_a_long_article_is_not_quadratic(spark):
    n = 20000
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i % 97) / 100.0).alias("scores"),
                               F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.array(
                                   (i % 97).cast("string"), (i % 5).cast("string"), F.lit("x"))).alias("sets"))
    got = df.select(R.mmr_indices(F.col("scores"), F.col("sets"), 3)).first()[0]
    assert got == greedy([i % 97 / 100 for i in range(n)], [{str(i % 97), str(i % 5), "x"} for i in range(n)], 3, 0.75)


def test_no_exchange_and_no_python_in_the_choice(spark):
    df = spark.createDataFrame(rows_of(1), "k int, scores array<double>, sets array<array<string>>")
    plan = df.select(R.mmr_indices(F.col("scores"), F.col("sets")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
