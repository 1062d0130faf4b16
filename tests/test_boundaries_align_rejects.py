"""Learned sentence boundaries, alignment of stored tables, the reject table, limits and labels of any kind."""

import re

import pytest
from pyspark.sql import functions as F

from golden import ARTICLE
from gistlet.functions.text import split_sentences
from gistlet.operators.align import aligned, repeated_keys, store_aligned
from gistlet.operators.boundaries import Boundaries, abbreviations, type_counts
from gistlet.operators.limits import limit_per_split
from gistlet.session import new_work_path
from gistlet.sources import jsonl


def corpus(spark):
    en = ["See Fig. %d for the shape of it. The figure is clear and the text is long. It goes on for a while in plain words." % i for i in range(40)]
    en += ["As Fig. %d shows in full, the line rises fast. Nobody doubts the long line any more. Words end here." % i for i in range(20)]
    de = ["Das gilt z. B. für alle Häuser der Stadt. Die Häuser sind alt und schön. Sie stehen z. B. am Fluss und am Markt." for _ in range(40)]
    de += ["Es gibt ein Haus am Markt, das B heißt. Es ist alt. Der Fluss ist nah und die Stadt ist groß." for _ in range(10)]
    rows = [(t, "en") for t in en] + [(t, "de") for t in de] + [(None, "en"), ("", None), ("Ein Satz ohne Sprache. Fig. 3 zeigt es.", None)]
    return spark.createDataFrame(rows, "text string, lang string").repartition(3)


def sentences(spark, column_of, text, lang="en"):
    df = spark.createDataFrame([(text, lang)], "text string, lang string")
    return df.select(column_of.alias("s")).first()["s"]


def test_types_are_counted_by_language(spark):
    got = {(r.lang, r.type): (r.n_with, r.n_without, r.n_lower) for r in type_counts(corpus(spark)).collect()}
    assert got["en", "fig"] == (60, 0, 60) and got["de", "z"] == (80, 0, 0) and got["de", "b"] == (80, 10, 80)
    assert got["en", "it"] == (40, 40, 0) and got["", "fig"] == (1, 0, 1)


def test_abbreviations_are_learned_and_applied_by_language(spark):
    learned = {(r.lang, r.type): r.never for r in abbreviations(type_counts(corpus(spark))).collect()}
    assert learned["en", "fig"] is True and ("de", "z") in learned and ("en", "while") not in learned
    b = Boundaries.fit(corpus(spark))
    assert ("z", "b") in b.pairs["de"]
    text, german = "See Fig. 3 here. Then Fig. Nine came. It was so.", "Das gilt z. B. hier. Es geht. Z. B. Berlin ist groß."
    assert sentences(spark, b.split("text", "lang"), text) == ["See Fig. 3 here.", "Then Fig. Nine came.", "It was so."]
    assert len(sentences(spark, split_sentences("text"), text)) == 5
    assert sentences(spark, b.split("text", "lang"), german, "de")[:2] == ["Das gilt z. B. hier.", "Es geht."]
    # not in another language, nor where nothing was learned
    assert sentences(spark, b.split("text", "lang"), text, "de") == sentences(spark, split_sentences("text"), text)
    assert sentences(spark, b.split("text", "lang"), text, None) == sentences(spark, split_sentences("text"), text)


def test_learned_boundaries_keep_the_sample_article(spark):
    b = Boundaries.fit(corpus(spark))
    got = sentences(spark, b.split("text", "lang"), ARTICLE)
    assert len(got) == 11 and got == sentences(spark, split_sentences("text"), ARTICLE)


def test_nothing_learned_from_nothing(spark):
    b = Boundaries.fit(corpus(spark).limit(0))
    assert not b.types and not b.never and not b.pairs
    odd = "One \x01 two.\x02 Three? a*b+c. (d) [e. f"
    assert sentences(spark, b.split("text", "lang"), odd) == sentences(spark, split_sentences("text"), odd)
    signs = Boundaries({"en": ["a+", r"\q", "x.y"]}, {}, {"en": [("c*", "(d)")]})
    assert sentences(spark, signs.split("text", "lang"), "It is a+. so. And c*. (d) too.") == ["It is a+. so.", "And c*. (d) too."]


# ------------------------------------------------------------------ alignment

def stored(spark):
    key = "split string, article_id string, sent_index int"
    left = spark.createDataFrame([("t", "a", 0, "s0"), ("t", "a", 1, "s1"), ("t", "b", 0, "s2"), ("t", "b", 0, "again"), (None, "c", 0, "s3")],
                                 key + ", sentence string")
    right = spark.createDataFrame([("t", "a", 0, 0.5), ("t", "b", 0, 0.1), ("t", "d", 0, 0.9)], key + ", score double")
    return {"sentences": store_aligned(left, buckets=4), "scores": store_aligned(right, buckets=4)}


def test_tables_are_aligned_by_key(spark):
    tables = stored(spark)
    inner = [tuple(r) for r in aligned(spark, tables).collect()]
    assert inner == [("t", "a", 0, "s0", 0.5, "")]
    outer = {tuple(r) for r in aligned(spark, tables, how="outer").collect()}
    assert outer == {("t", "a", 0, "s0", 0.5, ""), ("t", "a", 1, "s1", None, "scores"), ("t", "b", 0, None, 0.1, "sentences"),
                     ("t", "d", 0, None, 0.9, "sentences")}
    assert {tuple(r) for r in repeated_keys(spark, tables).collect()} == {("sentences", "t", "b", 0, 2), ("sentences", None, "c", 0, 1)}


@pytest.mark.parametrize("how", ["inner", "outer"])
def test_alignment_needs_no_exchange(spark, how):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = aligned(spark, stored(spark), how=how)
        df.collect()
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_table_stored_otherwise_gives_the_same(spark):
    tables = stored(spark)
    rows = spark.table(tables["scores"])
    other = store_aligned(rows, buckets=3)
    want = {tuple(r) for r in aligned(spark, tables, how="outer").collect()}
    assert {tuple(r) for r in aligned(spark, tables | {"scores": other}, how="outer").collect()} == want


# ------------------------------------------------------------------ rejected lines

LINES = ['{"id": "1", "article": "a"}', "", "{broken", "[1]", '"text"', "   ", '{"article": 5}', "{}", "null", '{"id": "2"} trailing {']


def test_every_line_is_accepted_or_rejected(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("\n".join(LINES) + "\n")
    out = new_work_path(spark, "rejects")
    counts = jsonl.read_with_rejects(spark, str(tmp_path / "x.jsonl"), out)
    good, bad = jsonl.accepted_lines(spark, out), jsonl.rejected_lines(spark, out)
    assert counts == {"accepted": good.count(), "rejected": bad.count()} and sum(counts.values()) == len(LINES)
    for cols in (["id"], ["article", "line"], ["file"]):       # whatever is asked for
        assert good.select(*cols).count() == counts["accepted"]
    why = {r.line: (r.reason, r.value) for r in bad.collect()}
    assert why[1] == ("blank", "") and why[5][0] == "blank" and why[2] == ("malformed", "{broken")
    assert {why[i][0] for i in (3, 4, 8)} == {"no object"}
    assert {r.file for r in bad.collect()} == {"x.jsonl"}
    kept = {r.line for r in jsonl.read_raw_articles(spark, str(tmp_path / "x.jsonl"), normalize=False)
            .withColumnRenamed("pos", "line").collect()}
    assert {r.line for r in good.collect()} == kept


def test_empty_file_gives_empty_tables(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("")
    out = new_work_path(spark, "rejects")
    counts = jsonl.read_with_rejects(spark, str(tmp_path / "x.jsonl"), out)
    assert counts == {"accepted": 0, "rejected": 0}


def test_labels_out_of_range_do_not_end_the_job(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "1", "sentences": ["a", "b", "c", "d"], "labels": [300, -129, 1e300, "x"]}\n')
    assert jsonl.read_labeled(spark, str(tmp_path / "x.jsonl")).first()["labels"] == [None] * 4


# ------------------------------------------------------------------ limits

@pytest.mark.parametrize("n", [10, 1001, None])
def test_limits_hold_every_split(spark, n):
    rows = [(s, i) for s in ("train", "extra", None) for i in range(1500 if s == "extra" else 30)]
    df = spark.createDataFrame(rows, "split string, pos long").repartition(5)
    got = limit_per_split(df, n).collect()
    want = {(s, i, i + 1) for s, i in rows if not n or i < n}
    assert {(r.split, r.pos, r.rank) for r in got} == want and len(got) == len(want)


def test_small_limits_cut_below_the_exchange(spark):
    df = spark.range(1000).select(F.col("id").alias("pos"), (F.col("id") % 3).cast("string").alias("split"))
    plan = limit_per_split(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("WindowGroupLimit", plan)) >= 2 and plan.count("Range") >= 1
