"""Vocabulary learning and token encoding.

D1  token_counts       explode + hash aggregate (partial aggregation map-side)
E6  top tokens         orderBy(n desc, token desc).limit(N) -> TakeOrderedAndProject,
                       then ids on those N rows only (never a global window)
G2  VocabularyBuilder  Estimator-style fit() -> Vocabulary model
C1  encode_by_join     token ids by a join, for vocabularies that are too large to broadcast
G3  encode_flat        token ids of each sentence row, padded or cut to seq_len (F4)
    encode_articles    the same for an array of sentences in each article row
D6  infer_vocab_size   max id + 1

Both encoders look tokens up in a broadcast list, without a shuffle, while the vocabulary has
at most ``BROADCAST_VOCAB_LIMIT`` entries, and by the join C1 beyond it; results are the same.

The join moves neither text nor lists of sentences by their content. The first ``HEAD`` entries, which are the
most frequent ones, are looked up in the row as before. What they lack becomes (row number, place, token), and of
these the hot tokens, each more than 1 of ``HOT`` of them all and so fewer than ``HOT``, get their ids from the driver.
The others have no hot key left: they meet the vocabulary in a join on the token, and ids go back
to their row by its number, which is written before it is used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gistlet import config as C
from gistlet.functions.arrow_kernels import by_slices, list_starts, lookup_token_ids, matrix_to_nested, padded_matrix, rebuild_list
from gistlet.functions.rows import explode_rows
from gistlet.functions.text import text_tokens
from gistlet.session import bound_batches, new_work_path

# Entries of a vocabulary that is broadcast (some tens of MB); larger ones are joined.
BROADCAST_VOCAB_LIMIT = 1_000_000

# Entries of a larger vocabulary that are looked up in the row.
HEAD = 100_000

# A token is hot in a join if it is more than 1 of this many.
HOT = 1000


def token_counts(sentences: DataFrame, text_col: str = "sentence", tokens_col: str | None = None) -> DataFrame:
    """(token, n) over all tokens of all sentences (full sentences, not truncated). ``tokens_col``: their tokens,
    where they are there already."""
    tokens = F.col(tokens_col) if tokens_col else text_tokens(text_col)
    return (explode_rows(sentences, [], tokens, "token")
            .groupBy("token")
            .agg(F.count(F.lit(1)).alias("n")))


def top_tokens(counts: DataFrame, max_tokens: int) -> DataFrame:
    """The ``max_tokens - 2`` most frequent tokens with ids from 2 (ties: token desc)."""
    keep = max(int(max_tokens) - 2, 0)
    top = counts.orderBy(F.desc("n"), F.desc("token")).limit(keep)
    # At most ``keep`` rows reach this window: a bounded, single-task step.
    rank = F.row_number().over(Window.orderBy(F.desc("n"), F.desc("token")))
    return top.select("token", (rank + 1).cast("int").alias("id"), F.col("n").cast("bigint").alias("n"))


class Vocabulary:
    """Fitted vocabulary: a table (token, id, n), its size with the two reserved entries, and seq_len."""

    def __init__(self, table: DataFrame, size: int, seq_len: int = C.SEQ_LEN):
        self.table, self.size, self.seq_len = table, size, seq_len
        self._tokens: list | None = None
        self._bc = None

    @property
    def fits(self) -> bool:
        return self.size <= BROADCAST_VOCAB_LIMIT

    @property
    def tokens(self) -> list:
        """Tokens by id; only of a vocabulary that may be broadcast."""
        if not self.fits:
            raise ValueError(f"{self.size} tokens are not brought to the driver")
        if self._tokens is None:
            self._tokens = [r["token"] for r in self.table.select("token", "id").orderBy("id").collect()]
        return self._tokens

    def broadcast_tokens(self, spark: SparkSession):
        if self._bc is None:
            self._bc = spark.sparkContext.broadcast(self.tokens[2:])
        return self._bc

    def lookup_table(self) -> DataFrame:
        """(token, id) for ids >= 2."""
        return self.table.where(F.col("id") >= 2).select("token", "id")


class VocabularyBuilder:
    """Estimator-style vocabulary learner."""

    def __init__(self, max_tokens: int = C.MAX_TOKENS, seq_len: int = C.SEQ_LEN,
                 text_col: str = "sentence"):
        self.max_tokens = max_tokens
        self.seq_len = seq_len
        self.text_col = text_col

    def fit(self, sentences: DataFrame) -> Vocabulary:
        return self.fit_counts(token_counts(sentences, self.text_col))

    def fit_counts(self, counts: DataFrame) -> Vocabulary:
        """The same from (token, n)."""
        spark = counts.sparkSession
        reserved = spark.createDataFrame([(C.PAD_TOKEN, C.PAD_ID, None), (C.UNK_TOKEN, C.UNK_ID, None)],
                                         "token STRING, id INT, n BIGINT")
        path = new_work_path(spark, "vocabulary")
        reserved.unionByName(top_tokens(counts, self.max_tokens)) \
            .write.parquet(path)
        return vocabulary_from_table(spark.read.parquet(path), self.seq_len)


def vocabulary_from_table(table: DataFrame, seq_len: int = C.SEQ_LEN) -> Vocabulary:
    """A stored (token, id[, n]) table as a Vocabulary."""
    if "n" not in table.columns:
        table = table.withColumn("n", F.lit(None).cast("bigint"))
    table = table.select("token", F.col("id").cast("int").alias("id"), F.col("n").cast("bigint").alias("n"))
    return Vocabulary(table, table.count(), seq_len)


def in_row_lookup(vocab: Vocabulary, token_lists: Column, nested: bool = True, seq_len: int | None = None) -> Column:
    """Arrow UDF: vectorized hash lookup (pyarrow index_in) against a broadcast vocabulary."""
    spark = SparkSession.getActiveSession()
    bound_batches(spark)
    bc = vocab.broadcast_tokens(spark)
    cache = {}

    def _vocab_array():
        a = cache.get("v")
        if a is None:
            a = pa.array(bc.value, type=pa.string())
            cache["v"] = a
        return a

    seq_len = seq_len or vocab.seq_len

    def _padded(tokens: pa.ListArray) -> pa.ListArray:
        # ids padded to seq_len in the same vectorized pass
        ids = lookup_token_ids(tokens.flatten(), _vocab_array(), 2, C.UNK_ID)
        return matrix_to_nested(tokens, padded_matrix(ids, seq_len, C.PAD_ID))

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def _lookup_nested(tokens: pa.Array) -> pa.Array:
        return by_slices(_padded, tokens)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _lookup_flat(tokens: pa.Array) -> pa.Array:
        return lookup_token_ids(tokens, _vocab_array(), 2, C.UNK_ID)

    return _lookup_nested(token_lists) if nested else _lookup_flat(token_lists)


def pad_ids(ids: Column, seq_len: int = C.SEQ_LEN) -> Column:
    """right-truncate / right-pad with 0 to ``seq_len``."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(C.PAD_ID), seq_len)), 1, seq_len)


def sentence_tokens(sentence: Column, seq_len: int = C.SEQ_LEN) -> Column:
    """Tokens of one sentence, truncated to ``seq_len`` before lookup."""
    return F.slice(text_tokens(sentence), 1, seq_len)


def _same_batch(*arrays):
    return [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]


def _head_lookup(known, seq_len: int, tokens: Column) -> Column:
    """Arrow UDF: padded ids of nested tokens by the broadcast entries ``known`` (tokens, ids), and the (place, token) of
    those that are not among them. A place counts through the row's sentences of ``seq_len`` places each."""
    cache = {}

    @F.arrow_udf("struct<x: array<array<int>>, rest: array<struct<place: bigint, token: string>>>")
    def _look_up(lists: pa.Array) -> pa.Array:
        if not cache:
            cache["tokens"], cache["ids"] = pa.array(known.value[0], pa.string()), pa.array(known.value[1], pa.int32())
        (lists,) = _same_batch(lists)
        sentences = lists.flatten()
        flat = sentences.flatten()
        at = pc.index_in(flat, value_set=cache["tokens"])
        ids = pc.fill_null(pc.take(cache["ids"], at), C.UNK_ID)
        of_row, of_sentence = list_starts(lists), list_starts(sentences)
        missing = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        sentence = np.searchsorted(of_sentence, missing, side="right") - 1
        row = np.searchsorted(of_row, sentence, side="right") - 1
        place = (sentence - of_row[row]) * seq_len + missing - of_sentence[sentence]
        entries = pa.StructArray.from_arrays([pa.array(place, pa.int64()), flat.take(pa.array(missing, pa.int64()))], ["place", "token"])
        rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(lists) + 1)), pa.int32()), entries)
        x = matrix_to_nested(lists, padded_matrix(rebuild_list(sentences, ids), seq_len, C.PAD_ID))
        return pa.StructArray.from_arrays([x, rest], ["x", "rest"])
    return _look_up(tokens)


def _put_ids(hot, seq_len: int, x: Column, rest: Column, found: Column) -> Column:
    """Arrow UDF: ``x`` with the ids of ``rest``'s hot tokens, and those of ``found`` (place, id), at their places."""
    @F.arrow_udf("array<array<int>>")
    def _put(x: pa.Array, rest: pa.Array, found: pa.Array) -> pa.Array:
        x, rest, found = _same_batch(x, rest, found)
        flat = np.array(x.flatten().flatten(), dtype=np.int64)
        start = list_starts(x) * seq_len

        def put(entries, ids):
            places = np.asarray(entries.flatten().field("place"), dtype=np.int64)
            known = np.asarray(pc.is_valid(ids))
            row = np.repeat(np.arange(len(entries)), np.diff(list_starts(entries)))
            flat[start[row[known]] + places[known]] = np.asarray(ids.drop_null(), dtype=np.int64)

        at = pc.index_in(rest.flatten().field("token"), value_set=pa.array(list(hot.value), pa.string()))
        put(rest, pc.take(pa.array(list(hot.value.values()), pa.int32()), at))
        put(found, found.flatten().field("id"))
        return matrix_to_nested(x, flat.reshape(-1, seq_len))
    return _put(x, rest, found)


def encode_by_join(rows: DataFrame, vocab: Vocabulary, tokens: Column, out_col: str, seq_len: int, head: int | None = None,
                   hot: int | None = None) -> DataFrame:
    """``rows`` with ``out_col``, the padded ids of ``tokens`` (an array of token arrays, each at most ``seq_len``
    long). A token that the vocabulary lacks is unknown; null tokens give null, an empty array an empty one. Repeated rows
    stay apart; all columns are kept."""
    bound_batches(rows.sparkSession)
    spark, head, hot = rows.sparkSession, HEAD if head is None else head, HOT if hot is None else hot
    table = vocab.lookup_table()
    first = table.where(F.col("id") < 2 + head).orderBy("id").collect()         # at most ``head`` entries
    known = spark.sparkContext.broadcast(([r["token"] for r in first], [r["id"] for r in first]))
    path = new_work_path(spark, "rows-to-encode")
    rows.select("*", _head_lookup(known, seq_len, tokens).alias("_looked"), F.monotonically_increasing_id().alias("_row")) \
        .write.parquet(path)
    kept = spark.read.parquet(path)
    rest = explode_rows(kept, ["_row"], "_looked.rest", "_e").select("_row", "_e.place", "_e.token")
    total = kept.agg(F.sum(F.size("_looked.rest"))).first()[0] or 0
    often = rest.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > total / hot)
    tail = table.where(F.col("id") >= 2 + head)
    hot_ids = {r["token"]: r["id"] for r in often.join(tail, "token", "left").collect()}     # fewer than ``hot``
    cold = rest.where(~F.col("token").isin(list(hot_ids))) if hot_ids else rest
    found = (cold.join(tail, "token").groupBy(F.col("_row").alias("_of"))
             .agg(F.collect_list(F.struct("place", "id")).alias("_found")))      # of one row
    none = F.array().cast("array<struct<place: bigint, id: int>>")
    x = _put_ids(spark.sparkContext.broadcast(hot_ids), seq_len, F.col("_looked.x"), F.col("_looked.rest"), F.coalesce("_found", none))
    return (kept.join(found, F.col("_row") == F.col("_of"), "left").withColumn(out_col, x)
            .drop("_looked", "_row", "_of", "_found"))


def encode_flat(sentences: DataFrame, vocab: Vocabulary, keys: list,
                text_col: str = "sentence", seq_len: int | None = None) -> DataFrame:
    """One row per sentence row with x ARRAY<INT> of length seq_len; repeated rows stay apart."""
    seq_len = seq_len or vocab.seq_len
    toks = F.array(sentence_tokens(F.col(text_col), seq_len))
    if vocab.fits:
        return sentences.select(*keys, in_row_lookup(vocab, toks, True, seq_len)[0].alias("x"))
    rows = sentences.select(*keys, toks.alias("_tokens"))
    return encode_by_join(rows, vocab, F.col("_tokens"), "_x", seq_len).select(*keys, F.col("_x")[0].alias("x"))


def encode_articles(articles: DataFrame, vocab: Vocabulary, sentences_col: str = "sentences",
                    out_col: str = "x") -> DataFrame:
    """Article rows with ``out_col``: the padded ids of each sentence, as array<array<int>>."""
    seq_len = vocab.seq_len
    toks = F.transform(sentences_col, lambda s: sentence_tokens(s, seq_len))
    if vocab.fits:
        return articles.withColumn(out_col, in_row_lookup(vocab, toks, True, seq_len))
    return encode_by_join(articles, vocab, toks, out_col, seq_len)


def infer_vocab_size(encoded: DataFrame, x_col: str = "x") -> DataFrame:
    """Max id + 1 over an encoded table."""
    return encoded.agg((F.max(F.array_max(x_col)) + 1).cast("bigint").alias("vocab_size"))
