"""C2/G8 for embeddings that are too large to broadcast: pooled vectors by partial sums.

The embedding is a table (id, values). Vocabulary ids go by frequency, so the first ``HEAD`` of them (padding and
the unknown token among them) make up most of all positions: these rows, of a bounded size, are broadcast
and summed inside the row. The other positions become (row, id, count) and meet the embedding in a join on
the id, which has no hot key left; sums by row and dimension are partial before the exchange. Head
and tail sums meet by row, and the dense layers, which are small whatever the vocabulary, run on Arrow batches.
The result is that of ``scorer.forward`` up to the order of sums.

The rows get a number that is written before it is used; repeated rows are scored each for itself. Ids below 0 count
as 0, ids beyond the table as its last one, an id that the table lacks adds nothing. Null ids arrays score as all padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gistlet.functions.arrow_kernels import padded_matrix
from gistlet.functions.rows import explode_rows
from gistlet.operators.scorer import ScorerWeights, share
from gistlet.session import new_work_path

#: Embedding rows that are broadcast: 100,000 of 64 doubles are 51 MB.
HEAD = 100_000


def embedding_table(spark: SparkSession, wt: ScorerWeights) -> DataFrame:
    """A small model's embedding as the table (id, values) that a large one has."""
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(wt.emb)], "id INT, values ARRAY<DOUBLE>")


def _head(embedding: DataFrame, head: int, dim: int) -> np.ndarray:
    """The first ``head`` rows as a matrix; rows that the table lacks are zero."""
    out = np.zeros((head, dim))
    for r in embedding.where((F.col("id") >= 0) & (F.col("id") < head)).collect():      # at most ``head`` rows
        out[r["id"]] = r["values"]
    return out


def score_joined(encoded: DataFrame, embedding: DataFrame, dense: ScorerWeights, x_col: str = "x", out_col: str = "score",
                 head: int = HEAD) -> DataFrame:
    """``encoded`` with the scores of its id arrays; ``dense`` holds w1, b1, w2, b2 and seq_len (its ``emb`` is not read)."""
    spark, seq_len, dim = encoded.sparkSession, dense.seq_len, int(dense.w1.shape[0])
    top = embedding.agg(F.max("id")).first()[0]
    top = -1 if top is None else int(top)
    head = max(1, min(head, top + 1))        # padding is always summed in the row
    path = new_work_path(spark, "rows-to-score")
    encoded.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    kept = spark.read.schema(T.StructType([*encoded.schema.fields, T.StructField("_row", T.LongType())])).parquet(path)
    small = share(spark, ScorerWeights(_head(embedding, head, dim), dense.w1, dense.b1, dense.w2, dense.b2, seq_len))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def head_sum(x: pa.Array) -> pa.Array:
        ids = np.clip(padded_matrix(x, seq_len), 0, max(top, 0))
        table = np.concatenate([small.value.emb, np.zeros((1, dim))])           # ids of the tail add nothing here
        sums = table[np.minimum(ids, head)].sum(axis=1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * dim, pa.int32()), pa.array(sums.ravel()))

    @F.arrow_udf(T.DoubleType())
    def dense_layers(sums: pa.Array) -> pa.Array:
        if isinstance(sums, pa.ChunkedArray):
            sums = sums.combine_chunks()
        wt, pooled = small.value, sums.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) / seq_len
        hidden = np.maximum(pooled @ wt.w1 + wt.b1, 0.0)
        return pa.array(1.0 / (1.0 + np.exp(-(hidden @ wt.w2 + wt.b2))))

    ids = F.transform(F.slice(F.coalesce(x_col, F.array().cast("array<int>")), 1, seq_len), lambda i: F.greatest(F.least(i, F.lit(top)), F.lit(0)))
    tail = F.filter(ids, lambda i: i >= head)
    counted = F.transform(F.array_distinct(tail), lambda i: F.struct(i.alias("id"), F.size(F.filter(tail, lambda j: j == i)).alias("n")))
    rows = explode_rows(kept.select("_row", counted.alias("_t")), ["_row"], "_t", "_e").select("_row", "_e.id", "_e.n")
    vectors = embedding.where(F.col("id") >= head).select(F.col("id").alias("_id"), "values")
    sums = rows.join(vectors, F.col("id") == F.col("_id")).groupBy("_row").agg(
        *[F.sum(F.col("values")[d] * F.col("n")).alias(f"_s{d}") for d in range(dim)])
    sums = sums.select(F.col("_row").alias("_of"), F.array(*[f"_s{d}" for d in range(dim)]).alias("_tail"))
    both = kept.join(sums, F.col("_row") == F.col("_of"), "left").withColumn("_head", head_sum(F.coalesce(x_col, F.array().cast("array<int>"))))
    total = F.when(F.col("_tail").isNull(), F.col("_head")).otherwise(F.zip_with("_head", "_tail", lambda a, b: a + b))
    return both.withColumn("_sum", total).withColumn(out_col, dense_layers("_sum")).drop("_row", "_of", "_tail", "_head", "_sum")
