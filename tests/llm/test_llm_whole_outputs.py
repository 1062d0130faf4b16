"""Operators return their data, not a digest of it."""

import struct
import zlib
from collections import Counter, defaultdict

from llm_cases import docs_of, odd_docs, plain
from pyspark.sql import functions as F

import corpus_pipeline
from gistlet.llm import packing, sharding
from gistlet.llm.queries import op3_first_fit_packing, tokenizer_path

SF = "/root/testdata/sf0.001"


def laid_out(rows):
    """The ids of each sequence, from its pieces in the order of their offsets."""
    out = defaultdict(list)
    for _, _, ids, seq, off in sorted(rows, key=lambda r: r[3:]):
        assert off == len(out[seq])
        out[seq] += ids
    return out


def test_packed_sequences_hold_the_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    for docs, length in ((docs_of(spark, SF), 4096), (docs_of(spark, SF), 64), (odd_docs(spark), 64)):
        rows = plain(packing.pack(docs, tokenizer_path(), length=length), "doc_id", "start", "ids", "sequence_id", "offset")
        ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in plain(docs, "doc_id", "text")]
        want = sorted(x[s:s + length] for x in ids for s in range(0, len(x), length))
        assert sorted(r[2] for r in rows) == want
        sequences = laid_out(rows)
        assert sum(map(len, sequences.values())) == sum(map(len, want)) and max(map(len, sequences.values())) <= length


def test_packing_query_digests_the_ids(spark):
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    got = op3_first_fit_packing(spark, SF)
    assert got.columns == cols
    assert sorted(plain(got, *cols)) == sorted(plain(packing.pack(docs_of(spark, SF), tokenizer_path()), *cols))
    packed = spark.createDataFrame([(1, 0, 2, [5, 2], 0, 2, 0, 0)], packing.PACKED)
    assert plain(packing.digest(packed), "ids_crc32") == [(zlib.crc32(struct.pack("<2I", 5, 2)),)]


def test_pipeline_ends_in_sequences_of_ids(spark):
    rows = plain(corpus_pipeline.run(spark, SF), "length", "start", "ids", "sequence_id", "offset")
    assert rows and all(len(r[2]) == r[0] for r in rows)
    assert all(len(x) <= packing.LENGTH for x in laid_out(rows).values())


def test_shards_hold_the_whole_documents_in_slot_order(spark):
    copies = spark.createDataFrame([(7, "same", i % 2) for i in range(6000)] + [(None, "same", 1), (0, "same", 1), (0, None, None)],
                                   "doc_id long, text string, number int").selectExpr("*", "map('k', number) AS tags")
    for docs in (docs_of(spark, SF), odd_docs(spark), copies):
        out = sharding.shuffled(docs, 5)
        assert out.schema["row"].dataType.fieldNames() == docs.columns
        rows = out.withColumn("part", F.spark_partition_id()).collect()
        assert Counter(repr(r["row"]) for r in rows) == Counter(repr(r) for r in docs.collect())
        assert sorted(r["number"] for r in rows) == list(range(len(rows)))
        by = defaultdict(list)
        for r in rows:
            by[r["part"]].append((r["shard"], r["slot"]))
        assert all(x == sorted(x) for x in by.values())
        assert sorted(x for p in by.values() for x in p) == sorted((i % 5, i // 5) for i in range(len(rows)))
