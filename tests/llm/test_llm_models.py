"""Language, quality and URL models: held-out accuracy, odd rows, missing training rows."""

import tracemalloc
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from llm_cases import ODD_TEXTS, docs_of, no_docs, odd_docs, plain
from pyspark.sql import functions as F

from gistlet.llm import langid, quality, urlfilter
from gistlet.llm.common import span_hashes, word_spans

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def languages(spark):
    return langid.identify(docs_of(spark, SF)).toPandas().set_index("doc_id")


def test_language_of_held_out_documents(spark, languages):
    truth = docs_of(spark, SF).select("doc_id", "lang", "text").toPandas().set_index("doc_id")
    own = languages.join(truth)
    assert len(own) == 1000
    assert (own["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in own.index]).all()
    held = own[own["held_out"]]
    assert len(held) > 200 and (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert own["score"].between(0, 1).all()


def test_language_training_ignores_row_order(spark, languages):
    again = langid.identify(docs_of(spark, SF).repartition(7)).toPandas().set_index("doc_id").loc[languages.index]
    assert (again["lang_pred"] == languages["lang_pred"]).all()
    assert np.allclose(again["score"], languages["score"], atol=1e-5)


def test_convolution_tables_equal_the_filters():
    net = langid.ByteNetwork(["a", "b", "c"])
    rng = np.random.default_rng(0)
    data = rng.integers(97, 123, 1000, dtype=np.uint8)
    got = langid.Predictor(net).rows(data, np.array([0, 128, 128, 400, 1000]))
    x = np.full((1, langid.SIZE + 3), 32, np.uint8)
    x[0, :128] = data[:128]
    top = np.concatenate([np.stack([sum(w[j][x[:, j:langid.SIZE + j]] for j in range(k))], 0)[0].max(axis=1)
                          for w, k in zip(net.weights, langid.WIDTHS, strict=True)], axis=1)
    want = langid._softmax(np.maximum(top + net.bias, 0) @ net.out + net.offset)
    assert np.allclose(got[0], want[0], atol=1e-5)
    assert np.allclose(got.sum(1), [1, 0, 1, 1])


def test_language_of_odd_rows(spark):
    docs = odd_docs(spark).withColumn("lang", F.when(F.col("doc_id") > 4, "xx"))
    got = {i: (p, s) for i, p, s in plain(langid.identify(docs), "doc_id", "lang_pred", "score")}
    for i, t in enumerate(ODD_TEXTS):
        letter = any(c.isalpha() for c in t or "")
        assert (got[i][0] == "xx") == letter and 0 <= got[i][1] <= 1
    untaught = langid.identify(odd_docs(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r[0] for r in plain(untaught, "lang_pred")} == {"und"}
    assert langid.identify(no_docs(spark)).count() == 0
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 0


def test_clean_documents_stay(spark):
    docs = docs_of(spark, SF)
    assert langid.accepted(docs).count() > 0.99 * docs.count()


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"))
    n = label.sum()
    return (order[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def test_quality_of_held_out_documents(spark):
    docs, labels = docs_of(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.quality(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in held["doc_id"]]).all()
    assert auc(held["score"].to_numpy(), held["quality"].to_numpy()) > 0.95
    assert (held["predicted"] == held["quality"]).mean() > 0.93
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()


def test_bradley_terry_orders_by_the_preferred_direction():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (400, 5)), rng.normal(0, 1, (100, 5))
    good[:, 2] += 2
    m = quality.BradleyTerry(good.astype(np.float32), bad.astype(np.float32), 0.2)
    assert np.argmax(np.abs(m.weights)) == 2 and m.weights[2] > 0
    share = (m.scores(np.concatenate([good, bad])) < 0.5).mean()
    assert abs(share - 0.2) < 0.01         # the threshold is that quantile


def test_features_of_long_texts_add_up_over_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    words = b" ".join(b"%x" % i for i in range(3000))
    mixed = bytes(rng.choice(np.frombuffer(b"abcdEF  \n.\xc3\xa4", np.uint8), 20000))
    texts = [words, mixed, mixed + b"\n" + mixed, b"a " * 5000, b"x" * 5000, b"\n" * 5000, b" x" + b"y" * 3000 + b" " + b"y" * 3000]
    for text in texts:
        data, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        whole = quality.features(data, offs)
        for size in (64, 1000, 4999, 5000):
            with monkeypatch.context() as m:
                m.setattr(quality, "COUNT_BYTES", size)
                assert np.array_equal(quality.features(data, offs), whole)


def test_features_of_a_long_text_stay_small():
    for text in (b" ".join(b"%x" % i for i in range(1500000)), b"a " * 5_000_000, b"x" * 10_000_000):
        data, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        quality.features(data, offs)        # tables that are made once
        tracemalloc.start()
        quality.features(data, offs)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 8 * len(text)


def test_features_of_rows_do_not_touch_each_other():
    texts = [b"", b"One two two", b"a\nb\na", b"!!", "é1".encode()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = quality.features(data, np.append(0, np.cumsum([len(t) for t in texts])))
    for i, t in enumerate(texts):
        alone = quality.features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert np.allclose(got[i], alone[0])
    assert (got[0] == 0).all() and np.isclose(got[1, 256 + 4], 2 / 3) and np.isclose(got[2, 256 + 5], 2 / 3)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(5, None, 1), (None, 1, 1), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int").selectExpr("*", "'z' AS text", "'z' AS y")
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        got = plain(quality.quality(odd_docs(spark), known), "score", "predicted")
        assert len(got) == len(ODD_TEXTS) + 3 and all(0 <= s <= 1 and p == (s >= 0.5) for s, p in got)
    assert quality.quality(no_docs(spark), labels).count() == 0


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        k = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:k])
        path = rest[k:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for v, h, p in urlfilter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://ORG/", "http://a.Example.ORG/es/1", "https://example.org/en/1?x#y", "http://xorg/",
        "x://a.org", "http://a.com/fr/", "http://a.com/fr", "http://a.com/de/2#/fr/", "http://a.com?q=http://b.org/", "a://b://c.org/",
        "http://é.org/ü", "http://a.org:80/", "http://a.org/\n/x", "HTTP://M.example.org/es/"]


def test_url_rules_equal_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(10_000 + i, u) for i, u in enumerate(URLS)] + [(None, URLS[4]), (1, URLS[5])], "page_id long, url string")
    both = pages.unionByName(odd).selectExpr("*", "'r' AS r", "'o' AS ok", "1 AS ratio", "'h' AS host", "'h' AS html")
    urls = plain(both, "page_id", "url")
    got = sorted(plain(urlfilter.judge(both), "page_id", "host", "path", "rule", "verdict"), key=repr)
    want = sorted(((i, *brute_rule(u)) for i, u in urls), key=repr)
    assert len(got) == len(want)
    by = {}
    for i, h, p, (rule, verdict) in want:
        by.setdefault((i, h, p, rule), []).append(verdict)
    for i, h, p, rule, verdict in got:
        said = by[i, h, p, rule].pop()
        assert verdict == said if said else verdict in ("allow", "block")


def test_url_model_parts_known_styles(spark):
    rng = np.random.default_rng(2)
    words = ["river", "garden", "winter", "basket"]
    spam = ["xx9k", "qz77", "vv0x", "kq8z"]

    def url(kind, host):
        own = words if kind else spam
        return f"http://{'-'.join(rng.choice(own, 3))}.{host}/{'/'.join(rng.choice(own, 2))}"

    rules = (("allow", "good", "/"), ("block", "bad", "/"))
    rows = [(i, url(i % 2, "good" if i % 2 else "bad")) for i in range(300)] + [(1000 + i, url(i % 2, "net")) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = plain(urlfilter.judge(pages, rules).where("page_id >= 1000"), "page_id", "rule", "verdict")
    assert all(r is None for _, r, _ in got)
    assert np.mean([(v == "allow") == bool(i % 2) for i, _, v in got]) > 0.98


def brute_ratios(urls):
    """The mean log ratio of each (url, class or None, fold) by dictionaries of byte strings, and the threshold."""
    size = urlfilter.TUPLE

    def pieces(url):
        text = bytes(size) + bytes(b + 32 if 65 <= b <= 90 else b for b in url.encode())
        return [text[i - size + 1:i + 1] for i in range(size, len(text))]

    def model(texts):
        n = Counter(t[-k:] for text in texts for t in pieces(text) for k in range(1, size + 1))
        total, kinds = Counter(), Counter()
        for t, m in n.items():
            total[len(t), t[:-1]] += m
            kinds[len(t), t[:-1]] += 1

        def p(t):
            if not t:
                return 1 / 256
            key = len(t), t[:-1]
            return (n[t] + kinds[key] * p(t[1:])) / (total[key] + kinds[key]) if total[key] else p(t[1:])
        return p

    out = []
    for url, ok, fold in urls:
        good, bad = (model([u for u, y, f in urls if y is c and (ok is None or f != fold)]) for c in (True, False))
        if not url:
            out.append(0.0)
        else:
            out.append(np.mean([np.log(good(t)) - np.log(bad(t)) for t in pieces(url)]))
    return out


@pytest.mark.parametrize("head", [1, 40, 100_000])
def test_url_ratios_equal_brute_force(spark, head):
    hosts = ["a.good", "b.good", "x.bad", "y.bad", "n.net", "M.Net"]
    urls = [f"http://{h}/{w}/{i % 3}" for i, (h, w) in enumerate(product(hosts, ["river", "qz77", "ü?=&", ""]))]
    urls += [urls[0]] * 15 + [urls[9]] * 4 + [None, "", "no scheme", "n", "http://x.bad/" + "ab" * 200]
    rules = (("allow", "good", "/"), ("block", "bad", "/"))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    fold = dict(plain(pages.select("page_id", F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(urlfilter.FOLDS)).alias("f")), "page_id", "f"))
    got = {i: (rule, verdict, r) for i, rule, verdict, r in plain(urlfilter.judge(pages, rules, head=head), "page_id", "rule", "verdict", "ratio")}
    known = [(u, None if got[i][0] is None else got[i][0].startswith("good"), fold[i]) for i, u in enumerate(urls)]
    want = brute_ratios(known)
    assert np.allclose([got[i][2] for i in range(len(urls))], want, atol=1e-12)
    bins = np.clip(np.floor((np.array(want) + urlfilter.REACH) / (2 * urlfilter.REACH) * urlfilter.BINS), 0, urlfilter.BINS - 1).astype(int)
    counts = [np.bincount([b for b, k in zip(bins, known, strict=True) if k[1] is y], minlength=urlfilter.BINS) for y in (True, False)]
    cut = urlfilter.calibrate(*counts)
    # every decided row is in the histogram: no other threshold does better on them
    rate = lambda t: (np.mean([w >= t for w, k in zip(want, known, strict=True) if k[1] is True])
                      + np.mean([w < t for w, k in zip(want, known, strict=True) if k[1] is False]))
    assert rate(cut) >= max(map(rate, want)) - 1e-9
    for i, u in enumerate(urls):
        if known[i][1] is None:
            assert got[i][1] == ("allow" if not u or want[i] >= cut else "block")


def test_url_filter_without_training_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert {v for v, in plain(urlfilter.judge(pages), "verdict")} == {"allow"}
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_span_hashes_tell_words_apart():
    data = np.frombuffer(b"".join(b"%d " % i for i in range(100_000)), np.uint8)
    starts, ends, _ = word_spans(data != 32, np.array([0, len(data)]))
    h = span_hashes(data, starts, ends)
    assert len(np.unique(h)) == 100_000
    again = span_hashes(data[starts[500]:], starts[500:600] - starts[500], ends[500:600] - starts[500])
    assert (again == h[500:600]).all()
