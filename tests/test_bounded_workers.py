"""Workers hold slices of a batch, whatever the batch holds: kernels by slices, pooling by blocks, the oracle by hits."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gistlet.functions import lcs as LCS
from gistlet.functions import porter
from gistlet.functions.arrow_kernels import by_slices, padded_matrix, rows_to_nested
from gistlet.operators import oracle as OR
from gistlet.operators.scorer import ScorerWeights, forward, mean_rows
from gistlet.session import BATCH_BYTES


def test_slices_give_what_the_whole_gives():
    nested = pa.array([None, [], [[1, 2], [3]], [[4]], None, [[], [5, 6, 7]]] * 7, pa.list_(pa.list_(pa.int32())))

    def sums(x):
        return rows_to_nested(x, padded_matrix(x.flatten(), 2).sum(axis=1))

    sizes = []
    got = by_slices(lambda x: sizes.append(len(x)) or sums(x), nested, limit=40)
    assert got.to_pylist() == sums(nested).to_pylist()
    assert sum(sizes) == len(nested) and len(sizes) > 5
    assert by_slices(sums, nested.slice(0, 0), limit=40).to_pylist() == []


def test_pooling_holds_no_row_times_place_times_dimension():
    rng = np.random.default_rng(0)
    wt = ScorerWeights(rng.random((50, 16)), rng.random((16, 4)), rng.random(4), rng.random(4), 0.1)
    x = rng.integers(0, 50, (20_000, 32))
    assert np.allclose(mean_rows(wt.emb, x[:99]), wt.emb[x[:99]].mean(axis=1), rtol=0, atol=1e-15)
    tracemalloc.start()
    forward(wt, x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * x.nbytes         # with the product of the three it was 17 times


def test_oracle_of_hits_equals_the_search_over_all_tokens():
    rng = np.random.default_rng(1)
    words = np.array(["running", "runs", "cat", "cats", "of", "a", "hopes", "hoping"])
    st = [[list(rng.choice(words, rng.integers(0, 6))) for _ in range(rng.integers(0, 7))] for _ in range(60)] + [None]
    rt = [list(rng.choice(words[:5], rng.integers(0, 5))) for _ in range(60)] + [["cat"]]
    for stem in (False, True):
        got = OR._oracle_slice(pa.array(st, pa.list_(pa.list_(pa.string()))), pa.array(rt, pa.list_(pa.string())), 3, stem).to_pylist()
        for s, r, g in zip(st, rt, got):
            cut = (lambda t: porter.stem(t) if len(t) > 3 else t) if stem else (lambda t: t)
            s, r = [[cut(t) for t in x] for x in s or []], [cut(t) for t in r]
            chosen = LCS.greedy_oracle(s, r, 3)
            assert g == {"chosen": chosen, "labels": LCS.labels_from_chosen(len(s), chosen)}


def test_queries_bound_their_batches(spark):
    from gistlet.operators.rouge import rouge_token_col
    key, was = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.set(key, str(64 << 20))
    try:
        rouge_token_col(F.lit("a"))
        assert int(spark.conf.get(key)) == BATCH_BYTES
    finally:
        spark.conf.set(key, was)
