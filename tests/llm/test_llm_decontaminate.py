"""Winnowing against all windows."""

import hashlib

import numpy as np
from llm_cases import docs_of, no_docs, odd_docs, plain, words

from gistlet.llm import decontaminate as dec

SF = "/root/testdata/sf0.001"


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    sizes = {len(k) for k in windows}
    texts = {}
    for i, t in docs:
        texts.setdefault(i, set()).add(tuple(words(t)))
    out = []
    for i, all_ in texts.items():
        n_words = n_hit = 0
        found = set()
        for w in all_:
            hit = set()
            for n in sizes:
                for k in range(len(w) - n + 1):
                    if w[k:k + n] in windows:
                        hit.update(range(k, k + n))
                        found |= windows[w[k:k + n]]
            n_words, n_hit = n_words + len(w), n_hit + len(hit)
        ids = ",".join(sorted(map(str, found)))
        out.append((i, n_words, n_hit, len(found), hashlib.sha256(ids.encode()).hexdigest(), n_hit > 0))
    return sorted(out, key=repr)


def check(docs, items):
    got = dec.digest(dec.contamination(docs, items))
    assert sorted(plain(got, *got.columns), key=repr) == brute(plain(docs, "doc_id", "text"), plain(items, "item_id", "text"))


def test_equals_all_windows_on_the_tables(spark):
    check(docs_of(spark, SF), spark.read.parquet(f"{SF}/benchmark.parquet"))


def test_equals_all_windows_on_random_words(spark):
    """Few different words: many windows, ties of hashes, items of 1 to 30 words, spans at both ends."""
    rng = np.random.default_rng(3)

    def text(n):
        return " ".join("abc"[k] for k in rng.integers(0, 3, n))

    items = [(i, text(n)) for i, n in enumerate([1, 2, 4, 7, 8, 9, 10, 11, 12, 30, 30, 0])] + [(50, None), (3, text(7))]
    items = [x for x in items if x[0] not in (0, 1, 2)]
    long = text(60)
    docs = [(i, text(int(n))) for i, n in enumerate(rng.integers(0, 60, 60))] + [(100, long), (101, "z " + long + " z"), (102, None)]
    items.append((60, long[10:60]))
    check(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
          spark.createDataFrame(items, "item_id long, text string"))


def test_every_long_shared_span_is_found(spark):
    rng = np.random.default_rng(4)
    item = [f"i{k}" for k in range(40)]
    docs = []
    for i in range(31):
        for n in (9, 10, 11):
            noise = [f"n{x}" for x in rng.integers(0, 50, 30)]
            docs.append((i * 10 + n, " ".join(noise[:15] + item[i:i + n] + noise[15:])))
    docs = [d for d in docs if len(item[d[0] // 10:d[0] // 10 + d[0] % 10]) or True]
    got = dec.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    for i, hit in plain(got, "doc_id", "n_hit"):
        text = dict(docs)[i].split()
        shared = sum(w.startswith("i") for w in text)
        assert hit == (shared if shared >= 10 else 0)


def test_odd_rows_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "text here for all of the rows"), (2, None), (3, ""), (4, "A")],
                                  "item_id long, text string").selectExpr("*", "'x' AS h", "'x' AS items")
    check(odd_docs(spark), items)
    check(odd_docs(spark), items.limit(0))
    assert dec.contamination(no_docs(spark), items).count() == 0
    kept = dec.clean(odd_docs(spark), items)
    assert kept.columns == odd_docs(spark).columns
    assert not any("text here for all" in (t or "") for t, in plain(kept, "text"))
    assert kept.where("doc_id is null").count() == 1
