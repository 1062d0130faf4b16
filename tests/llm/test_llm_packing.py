"""Packing: ids against the tokenizer, every id in one piece, first-fit decreasing against the plain loop."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import docs_of, no_docs, odd_docs, plain

from gistlet.llm import packing
from gistlet.llm.common import text_bytes
from gistlet.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def check(docs, tokenizer, length, **more):
    got = packing.pack(docs, tokenizer_path(), length=length, **more)
    rows = plain(got, "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    want = defaultdict(int)
    for i, t in plain(docs, "doc_id", "text"):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        for s in range(0, len(ids), length):
            part = np.array(ids[s:s + length], "<u4").tobytes()
            want[i, s, len(part) // 4, zlib.crc32(part), len(ids)] += 1
    have = defaultdict(int)
    sequences = defaultdict(list)
    for *piece, seq, off in rows:
        have[tuple(piece)] += 1
        sequences[seq].append((off, piece[2]))
    assert have == want
    for parts in sequences.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= length
    return sequences


@pytest.mark.parametrize("length", [4096, 64])
def test_pieces_and_sequences(spark, tokenizer, length):
    check(docs_of(spark, SF), tokenizer, length)
    check(odd_docs(spark), tokenizer, length)


def test_groups_pack_with_little_padding(spark, tokenizer):
    docs = docs_of(spark, "/root/testdata/sf0.01")
    sequences = check(docs, tokenizer, 1024, group_tokens=1 << 18)
    assert len({s >> 24 for s in sequences}) > 2
    assert sum(n for parts in sequences.values() for _, n in parts) > 0.97 * 1024 * len(sequences)


def test_first_fit_decreasing_equals_plain_loop():
    rng = np.random.default_rng(2)
    for capacity in (10, 100, 4096):
        sizes = np.sort(rng.integers(1, capacity + 1, 500))[::-1]
        bins, offsets = packing.first_fit_decreasing(sizes, capacity)
        room = []
        for s, b, o in zip(sizes.tolist(), bins.tolist(), offsets.tolist(), strict=True):
            k = next((i for i, r in enumerate(room) if r >= s), len(room))
            if k == len(room):
                room.append(capacity)
            assert (b, o) == (k, capacity - room[k])
            room[k] -= s


def test_ids_equal_the_tokenizer_on_odd_characters(tokenizer):
    rng = random.Random(1)
    parts = ["a", "B", "É", "ß", "œ", "Œ", "’", "'s", "'", "don't", " ", "  ", "\n", "\x85", "\xa0", "1", "²", "½", "<|endoftext|>",
             "<|", "!", "--", "×", "µ", "日本", "e\u0301", "İ", "Σ", "ﬁ", "\x1c", "\x00", "THE", "I'LL", "ª"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    data, offs = text_bytes(pa.array(texts))
    memo = packing.WordTokenizer(tokenizer_path())
    for _ in range(2):      # the second time from memory
        ids, first = memo.encode_rows(data, offs)
        for i, t in enumerate(texts):
            assert ids[first[i]:first[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_ids_do_not_depend_on_the_size_of_the_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MEMO_TOKENS", 50)
    monkeypatch.setattr(packing, "TOKEN_BLOCK", 40)
    texts = [" ".join(f"w{i * j % 101}" for j in range(90)) for i in range(20)]
    data, offs = text_bytes(pa.array(texts))
    ids, first = packing.WordTokenizer(tokenizer_path()).encode_rows(data, offs)
    for i, t in enumerate(texts):
        assert ids[first[i]:first[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_result_does_not_depend_on_partitions(spark):
    docs = docs_of(spark, SF)
    cols = ["doc_id", "start", "sequence_id", "offset"]
    a, b = (sorted(plain(packing.pack(docs.repartition(n), tokenizer_path()), *cols)) for n in (1, 5))
    assert a == b


def test_empty_table(spark):
    assert packing.pack(no_docs(spark), tokenizer_path()).count() == 0
