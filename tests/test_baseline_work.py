"""What train_baseline does for each token: counted once, stemmed by the rules of its last letter, searched where it matches."""

import itertools

from gistlet.functions import lcs as LCS
from gistlet.functions import porter
from gistlet.functions.text import text_tokens
from gistlet.operators import train as TR
from gistlet.operators import vocab as VO


def test_count_vectors_by_counts_unless_ties_leave_a_choice(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizer
    asked = []
    monkeypatch.setattr(CountVectorizer, "fit", lambda self, df, fit=CountVectorizer.fit: asked.append(self) or fit(self, df))
    rows = [(list("aab"), 1), (list("aaczx"), 0), (list("dxyz"), 0), (list("bd"), 1), (["c"], 1), (["x"], 0)]
    df = spark.createDataFrame(rows, "tokens ARRAY<STRING>, y INT")        # a 4 times, x 3, b c d z twice, y once
    for n in (1, 3, 7):
        assert TR.train_baseline(df.repartition(n), vocab_size=4).stages[0].vocabulary == ["a", "x"]
    assert set(TR.train_baseline(df, vocab_size=8).stages[0].vocabulary) == set("axbcdz")
    assert set(TR.train_baseline(df, vocab_size=99).stages[0].vocabulary) == set("axbcdzy") and not asked
    assert TR.train_baseline(df, vocab_size=5).stages[0].vocabulary[:2] == ["a", "x"] and len(asked) == 1


def test_vocabulary_of_tokens_equals_that_of_their_text(spark):
    df = spark.createDataFrame([("A b, a-c!",), ("",), ("b B  c d",), (None,)], "sentence STRING")
    cut = df.select(text_tokens("sentence").alias("tokens"))
    b = VO.VocabularyBuilder(max_tokens=5)
    of_text, of_tokens = b.fit(df), b.fit_counts(VO.token_counts(cut, tokens_col="tokens"))
    assert of_tokens.tokens == of_text.tokens and of_tokens.size == of_text.size
    assert of_tokens.table.orderBy("id").collect() == of_text.table.orderBy("id").collect()


def test_baseline_counts_the_tokens_that_it_has_written(spark, monkeypatch):
    from gistlet.plans import queries as Q
    from gistlet.session import new_work_path
    d = new_work_path(spark, "baseline-input")
    texts = [f"Cats run {w}.\nThe cats run {w}. Dogs sleep late. {w} again!" for w in ("home", "far", "off", "up")]
    spark.createDataFrame([(i, texts[i % 4]) for i in range(20)], "doc_id BIGINT, text STRING").write.parquet(f"{d}/documents.parquet")

    def second_cut(*a, **kw):
        raise AssertionError("the text is split and cut into tokens again")

    monkeypatch.setattr(Q, "vocabulary", second_cut)
    got = {r["split"]: r["n"] for r in Q.q_train_baseline(spark, d).collect()}
    assert got == {"validation": 6, "test": 6}


def test_search_looks_only_at_sentences_with_a_match(monkeypatch):
    fed = []
    monkeypatch.setattr(LCS.LcsIndex, "feed", lambda self, v, tokens, feed=LCS.LcsIndex.feed: fed.append(tokens) or feed(self, v, tokens))
    assert LCS.greedy_oracle([[], ["a"], [], ["b"], []], ["a", "b"], 2, [3, 1, 0, 1, 9]) == [1, 3]
    assert [] not in fed


def test_measure_and_rules_of_the_stemmer_by_letters(monkeypatch):
    def cons(w, i):
        return w[i] not in "aeiou" and (w[i] != "y" or i == 0 or not cons(w, i - 1))

    for n in range(6):
        for w in map("".join, itertools.product("aybé", repeat=n)):
            kinds = "".join("c" if cons(w, i) else "v" for i in range(n))
            assert porter._kinds(w) == kinds and porter._measure(w) == kinds.count("vc")
    tried = []
    monkeypatch.setattr(porter, "_kinds", lambda w, kinds=porter._kinds: tried.append(w) or kinds(w))
    porter.stem.cache_clear()
    assert porter.stem("zebrawood") == "zebrawood" and porter.stem("hopefulness") == "hope"
    assert "zebrawood" not in tried and not any(w.startswith("z") for w in tried)
