"""B10/B11 sentence split, F1 strip, F2/F3 standardize, F5 ROUGE tokens, E4/E5/D7 golden top-k."""

from pyspark.sql import functions as F

import golden
from gistlet.functions.text import py_strip, rouge_tokens, split_sentences, text_tokens
from gistlet.operators.topk import pick, summary_text, topk_indices


def one(spark, expr, value, schema="s STRING"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_sample_article_splits_into_11_sentences(spark):
    sents = one(spark, split_sentences(F.col("s")), golden.ARTICLE.strip())
    assert len(sents) == 11
    for i, s in zip(golden.SELECTED, golden.SELECTED_SENTENCES):
        assert sents[i] == s


def test_golden_top3_in_document_order(spark):
    df = spark.createDataFrame([(golden.SCORES,)], "scores ARRAY<DOUBLE>")
    assert df.select(topk_indices("scores", 3).alias("o")).first()["o"] == golden.SELECTED


def test_golden_summary_text(spark):
    sents = one(spark, split_sentences(F.col("s")), golden.ARTICLE.strip())
    df = spark.createDataFrame([(sents, golden.SELECTED)], "s ARRAY<STRING>, i ARRAY<INT>")
    r = df.select(summary_text("s", "i").alias("t"), pick("s", "i").alias("p")).first()
    assert r["t"] == golden.SUMMARY
    assert r["p"] == golden.SELECTED_SENTENCES


def test_topk_ties_prefer_higher_index_and_short_articles(spark):
    df = spark.createDataFrame([([0.5, 0.5, 0.5, 0.5],), ([0.2],), ([],)], "scores ARRAY<DOUBLE>")
    got = [r["o"] for r in df.select(topk_indices("scores", 3).alias("o")).collect()]
    assert got == [[1, 2, 3], [0], []]


def test_strip_is_python_strip(spark):
    for v in ["  hello 　", "\n\t x \x1c", "", "   ", "a​b"]:
        assert one(spark, py_strip(F.col("s")), v) == v.strip()


def test_split_edge_cases(spark):
    assert one(spark, split_sentences(F.col("s")), "One sentence only") == ["One sentence only"]
    assert one(spark, split_sentences(F.col("s")), "Hi!  \"Yes.\" Done?") == ["Hi!", "\"Yes.\"", "Done?"]
    many = " ".join(f"S{i}." for i in range(60))
    got = one(spark, split_sentences(F.col("s"), 50), many)
    assert len(got) == 50 and got[0] == "S0." and got[-1] == "S49."
    assert len(one(spark, split_sentences(F.col("s")), many)) == 60      # no cap unless one is asked for
    assert one(spark, split_sentences(F.col("s")), "a\u0001b. c") == ["ab.", "c"]


def test_standardize_tokens(spark):
    got = one(spark, text_tokens(F.col("s")), "Long-lasting ÉCOLE, don't stop!  Grid-scale")
    # ASCII-only lower case; punctuation deleted, not spaced; NBSP is not a separator
    assert got == ["longlasting", "École", "dont stop", "gridscale"]
    assert one(spark, text_tokens(F.col("s")), "... !!! ") == []


def test_rouge_tokens(spark):
    assert one(spark, rouge_tokens(F.col("s")), "Héllo, World-42!") == ["h", "llo", "world", "42"]


def test_abbreviations_do_not_end_sentences(spark):
    cases = {
        "Dr. Smith met Mr. Jones at 5 p.m. in the U.S. office. They talked.":
            ["Dr. Smith met Mr. Jones at 5 p.m. in the U.S. office.", "They talked."],
        "We left the U.S. They stayed.": ["We left the U.S.", "They stayed."],
        "J. K. Smith, Jan. 5, e.g. here. Done": ["J. K. Smith, Jan. 5, e.g. here.", "Done"],
        "Apples, pears etc. were sold. Plums etc. Then more.": ["Apples, pears etc. were sold.", "Plums etc.", "Then more."],
        "the end. next starts small. ok": ["the end.", "next starts small.", "ok"],
        "Mr.": ["Mr."],
        "a\u0002b. c": ["ab.", "c"],
    }
    for text, want in cases.items():
        assert one(spark, split_sentences(F.col("s")), text) == want
