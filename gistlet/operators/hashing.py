"""Token ids and features by hashing, without a pass over the corpus for a vocabulary.

A token's bucket is the first 8 hex digits of its MD5 modulo the number of buckets, its sign the next digit's parity, so the
same token has the same id in any job. Everything is row-local and native but ``collisions``, the one aggregate.

hash_ids       padded ids of a sentence: bucket + 2, so that 0 stays padding; any trained scorer takes them
hash_features  signed counts of a sentence's buckets, by bucket; where two tokens share one, their signs tend to cancel
collisions     tokens and occurrences per bucket, over a whole table
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gistlet.functions.text import text_tokens
from gistlet.operators.vocab import pad_ids, sentence_tokens, token_counts


def _hex(token: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(F.md5(token), start, digits), 16, 10).cast("bigint")


def bucket(token: Column, buckets: int) -> Column:
    return (_hex(token, 1, 8) % F.lit(buckets)).cast("int")


def sign(token: Column) -> Column:
    return F.when(_hex(token, 9, 1) % 2 == 0, 1).otherwise(-1)


def hash_ids(sentence: Column, buckets: int, seq_len: int) -> Column:
    """Ids from 2 to ``buckets`` + 1, cut and padded to ``seq_len``; a null sentence is all padding."""
    tokens = F.coalesce(sentence_tokens(sentence, seq_len), F.array().cast("array<string>"))
    return pad_ids(F.transform(tokens, lambda t: bucket(t, buckets) + 2), seq_len)


def hash_features(sentence: Column, buckets: int) -> Column:
    """Array of (bucket, value) of the whole sentence, in order of buckets; those that cancel have value 0."""
    tokens = F.coalesce(text_tokens(sentence), F.array().cast("array<string>"))
    signed = F.array_sort(F.transform(tokens, lambda t: F.struct(bucket(t, buckets).alias("bucket"), sign(t).alias("value"))))

    def add(done: Column, e: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        more = F.struct(e["bucket"].alias("bucket"), (last["value"] + e["value"]).alias("value"))
        return F.when(last["bucket"] == e["bucket"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(more))) \
            .otherwise(F.concat(done, F.array(e)))

    return F.aggregate(signed, F.array().cast("array<struct<bucket: int, value: int>>"), add)


def collisions(sentences: DataFrame, buckets: int, text_col: str = "sentence") -> DataFrame:
    """(bucket, n_tokens, n): distinct tokens and their occurrences, of the buckets that are in use."""
    return (token_counts(sentences, text_col).groupBy(bucket(F.col("token"), buckets).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n_tokens"), F.sum("n").alias("n")))
