"""G1: greedy ROUGE-L oracle labels (and B7 multi-hot vector).

Per article: tokens of each sentence and of the reference summary are built
natively; the greedy search runs in an Arrow UDF with the resumable
bit-parallel LCS.  Everything is row-local (no shuffle); Arrow batches are bounded in
bytes, and an optional sentence cap is applied before labeling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gistlet import config as C
from gistlet.functions import lcs as LCS
from gistlet.functions.arrow_kernels import by_slices, list_starts
from gistlet.functions.text import rouge_tokens
from gistlet.operators.flatten import with_sentences
from gistlet.functions import porter
from gistlet.session import bound_batches

ORACLE_TYPE = T.StructType([T.StructField("chosen", T.ArrayType(T.IntegerType())),
                            T.StructField("labels", T.ArrayType(T.ByteType()))])


def _codes(tokens: pa.Array, stem: bool) -> np.ndarray:
    """A number for each token, equal for equal ones (with ``stem``: for equal stems)."""
    coded = tokens.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if not stem:
        return codes
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()      # faster than to_pylist()
    stems = pa.array([porter.stem(t) if len(t) > 3 else t for t in words], pa.string())
    return stems.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[codes]


def _oracle_slice(sent_tokens: pa.ListArray, ref_tokens: pa.ListArray, k: int, stem: bool) -> pa.StructArray:
    """Only the tokens that the row's reference holds go through the search: the others change no LCS, only a length."""
    rows, sentences = len(sent_tokens), sent_tokens.flatten()
    codes = _codes(pa.concat_arrays([sentences.flatten(), ref_tokens.flatten()]), stem)
    of_row, of_sentence, of_ref = list_starts(sent_tokens), list_starts(sentences), list_starts(ref_tokens)
    own, ref = codes[:of_sentence[-1]], codes[of_sentence[-1]:]
    width, row = int(codes.max(initial=0)) + 1, np.arange(rows)
    held = np.unique(np.repeat(row, np.diff(of_ref)) * width + ref)
    keys = np.repeat(row, np.diff(of_sentence[of_row])) * width + own
    if len(held):
        hits = np.flatnonzero(held[np.minimum(np.searchsorted(held, keys), len(held) - 1)] == keys)
    else:
        hits = np.zeros(0, np.int64)
    of_hit, found, sizes = np.searchsorted(hits, of_sentence), own[hits], np.diff(of_sentence)
    chosen_all, labels = [], np.zeros(len(sentences), np.int8)
    for i in range(rows):
        a, b = of_row[i], of_row[i + 1]
        r = ref[of_ref[i]:of_ref[i + 1]].tolist()
        st = [found[of_hit[s]:of_hit[s + 1]].tolist() for s in range(a, b)] if r else []
        chosen = LCS.greedy_oracle(st, r, k, sizes[a:b].tolist())
        labels[a + np.array(chosen, np.int64)] = 1
        chosen_all.append(chosen)
    return pa.StructArray.from_arrays(
        [pa.array(chosen_all, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array(of_row, pa.int32()), pa.array(labels))],
        names=["chosen", "labels"])


def _oracle_udf(k: int, stem: bool):
    # Stemming happens inside the same Python evaluation (each token of a slice once), so
    # the token lists cross the JVM/Python boundary once.
    @F.arrow_udf(ORACLE_TYPE)
    def _oracle(sent_tokens: pa.Array, ref_tokens: pa.Array) -> pa.Array:
        return by_slices(lambda st, rt: _oracle_slice(st, rt, k, stem), sent_tokens, ref_tokens)
    return _oracle


def oracle_labels(articles: DataFrame, k: int = C.ORACLE_K, stem: bool = True,
                  max_sentences: int | None = None, summary_col: str = "highlights") -> DataFrame:
    """T2 rows: split, id, pos, sentences, labels (TINYINT 0/1), summary, chosen (selection order).

    Articles must be normalized (B1/B2); sentences are split (and capped, M6) first,
    an empty reference leaves all labels 0 (M4).
    """
    bound_batches(articles.sparkSession)
    a = with_sentences(articles, max_sentences)
    st = F.transform("sentences", lambda s: rouge_tokens(s))
    rt = rouge_tokens(summary_col)
    a = a.withColumn("_oracle", _oracle_udf(k, stem)(st, rt))
    keep = [c for c in a.columns if c not in ("article", "sentences", summary_col, "_oracle")]
    return a.select(*keep, "sentences", F.col("_oracle.labels").alias("labels"),
                    F.col(summary_col).alias("summary"), F.col("_oracle.chosen").alias("chosen"))
