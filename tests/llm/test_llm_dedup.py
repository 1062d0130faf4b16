"""Exact and near duplicates against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from llm_cases import ASCII_LOWER, Sets, docs_of, no_docs, odd_docs, plain

from gistlet.llm import exactdedup, simhash
from gistlet.llm.exactdedup import BASES, CHUNK, PRIMES, Polynomial, one_space

SF = "/root/testdata/sf0.001"


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out = []
    for i, t in rows:
        g = groups[normal(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("primes", [PRIMES, (3, 5)])     # (3, 5): nearly every fingerprint collides
def test_exact_duplicates_equal_brute_force(spark, primes):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    for docs in (odd_docs(spark), docs_of(spark, SF)):
        got = sorted(plain(exactdedup.exact_duplicates(docs, primes=primes), *cols), key=repr)
        assert got == brute_exact(plain(docs, "doc_id", "text"))


def test_equal_length_texts_that_collide_are_told_apart(spark):
    rows = [(i, f"{'ab'[i % 2]}{i % 7}{i % 3}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exactdedup.exact_duplicates(docs, primes=(3, 2))
    assert sorted(plain(got, *got.columns), key=repr) == brute_exact(rows)


def test_chunk_hashes_combine():
    rng = np.random.default_rng(1)
    sizes = [0, 1, CHUNK - 1, CHUNK, CHUNK + 1, 5 * CHUNK + 17, 0, 40]
    data = rng.integers(0, 256, sum(sizes), dtype=np.uint8)
    offs = np.append(0, np.cumsum(sizes))
    got = Polynomial().rows(data, offs)
    for r, (a, b) in enumerate(zip(offs[:-1], offs[1:], strict=True)):
        for k in range(2):
            whole = 0
            for x in reversed(data[a:b].tolist()):
                whole = (whole * BASES[k] + x) % PRIMES[k]
            assert got[r, k] == whole


def test_one_space():
    texts = [b"a \t\n b", b"  ", b"", b" x", b" ", b"y  ", b"z"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    d, o = one_space(data, np.append(0, np.cumsum([len(t) for t in texts])))
    assert [bytes(d[a:b]) for a, b in zip(o[:-1], o[1:], strict=True)] == [normal(t.decode()).encode() for t in texts]


def brute_simhash(text, shingle=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    sets, keys = Sets(), sorted({f for _, f in prints})
    for i, a in enumerate(keys):
        sets.find(a)
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 2:
                sets.join(a, b)
    least = {}
    for i, f in prints:
        r = sets.find(f)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, f"{f:016x}", least[sets.find(f)]) for i, f in prints), key=repr)


def test_near_duplicates_equal_brute_force(spark):
    for docs in (odd_docs(spark), docs_of(spark, SF)):
        rows = [(i, brute_simhash(t)) for i, t in plain(docs, "doc_id", "text")]
        got = simhash.hexed(simhash.near_duplicates(docs))
        assert sorted(plain(got, "doc_id", "fingerprint", "component_id"), key=repr) == brute_components(rows)


def near_prints(n, seed):
    """Random fingerprints, chains of one- and two-bit steps, and a dense ball."""
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 1 << 63, n, dtype=np.uint64)]
    for k in range(0, n, 7):
        x = out[k]
        for _ in range(5):
            x ^= 1 << int(rng.integers(64))
            x ^= 1 << int(rng.integers(64))
            out.append(x)
    out += [out[0] ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(0, 64, 9)]
    return sorted(set(out))


def test_trie_walk_equals_all_pairs():
    for seed in range(3):
        fp = near_prints(150, seed)
        root = simhash.trie_sets(np.array(fp, np.uint64), np.zeros(len(fp), np.int64))
        sets = Sets()
        for i, a in enumerate(fp):
            for j in range(i):
                if (a ^ fp[j]).bit_count() <= 2:
                    sets.join(i, j)
        assert root.tolist() == [sets.find(i) for i in range(len(fp))]


@pytest.mark.parametrize("split", [simhash.SPLIT, 8])     # 8: subtries are dealt out again, twice
def test_dealt_subtries_lose_no_link(spark, split):
    fp = near_prints(200, 9)
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fp)]
    distinct = spark.createDataFrame([(f,) for _, f in rows], "fp long")
    edges = plain(simhash.links(distinct, split=split), "a", "b")
    sets = Sets()
    for a, b in edges:
        sets.join(a % (1 << 64), b % (1 << 64))
    got = defaultdict(set)
    for f in fp:
        got[sets.find(f)].add(f)
    want = defaultdict(set)
    for i, _, c in brute_components(list(enumerate(fp))):
        want[c].add(fp[i])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 2000)], "a long, b long")
    got = dict(plain(simhash.components(edges), "node", "root"))
    assert got == {i: 0 for i in range(1, 301)} | {2000: 1000}


def test_dedup_of_empty_tables(spark):
    assert exactdedup.exact_duplicates(no_docs(spark)).count() == 0
    assert simhash.near_duplicates(no_docs(spark)).count() == 0
    assert exactdedup.keep_first(no_docs(spark)).columns == ["doc_id", "text", "lang"]
    assert simhash.keep_one(no_docs(spark)).count() == 0


def test_kept_documents_keep_their_columns(spark):
    docs = odd_docs(spark)
    kept = exactdedup.keep_first(docs)
    assert kept.columns == docs.columns
    texts = [normal(t) for _, t in plain(kept.dropDuplicates(["doc_id"]), "doc_id", "text")]
    assert len(texts) == len(set(texts))
    assert set(texts) == {normal(t) for _, t in plain(docs, "doc_id", "text")}
    near = simhash.keep_one(docs)
    assert near.columns == docs.columns
    assert len({brute_simhash(t) for _, t in plain(near.where("doc_id is not null"), "doc_id", "text")}) > 5
