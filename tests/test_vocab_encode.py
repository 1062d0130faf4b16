"""G2 vocabulary, C1/G3 encoding (join form == in-row form), F4 padding, D6."""

import pytest
from pyspark.sql import functions as F

from gistlet.operators import vocab as VO


def sentences(spark):
    rows = [("a", 0, "The cat sat. The cat"), ("a", 1, "dog dog dog"), ("b", 0, "zebra!"),
            ("b", 1, "..."), ("c", 0, " ".join(["cat"] * 40))]
    return spark.createDataFrame(rows, "article_id STRING, sent_index INT, sentence STRING")


def test_vocab_order_and_reserved(spark):
    v = VO.VocabularyBuilder(max_tokens=5).fit(sentences(spark))
    # counts: cat 42, dog 3, the 2, sat 1, zebra 1 -> top 3 by (n desc, token desc)
    assert v.tokens == ["", "[UNK]", "cat", "dog", "the"]
    rows = {r["token"]: (r["id"], r["n"]) for r in v.table.collect()}
    assert rows["cat"] == (2, 42) and rows[""] == (0, None)


def test_encode_forms_agree_and_pad(spark):
    s = sentences(spark)
    v = VO.VocabularyBuilder(max_tokens=5).fit(s)
    flat = {(r["article_id"], r["sent_index"]): r["x"]
            for r in VO.encode_flat(s, v, ["article_id", "sent_index"]).collect()}
    arts = s.groupBy("article_id").agg(F.array_sort(F.collect_list(F.struct("sent_index", "sentence"))).alias("p"))
    arts = arts.select("article_id", F.transform("p", lambda e: e["sentence"]).alias("sentences"))
    inrow = VO.encode_articles(arts, v).collect()
    for r in inrow:
        for i, x in enumerate(r["x"]):
            assert x == flat[(r["article_id"], i)]
            assert len(x) == 32
    assert flat[("a", 0)][:6] == [4, 2, 1, 4, 2, 0]       # the cat sat the cat <pad>
    assert flat[("b", 1)] == [0] * 32                      # punctuation only: all padding
    assert flat[("c", 0)] == [2] * 32                      # truncated to 32
    assert VO.infer_vocab_size(VO.encode_flat(s, v, ["article_id", "sent_index"])).first()[0] == 5


def repeated(spark):
    """Sentences and articles of which some rows are the same in all, or in their keys only."""
    rows = [("a", 0, "cat dog"), ("a", 0, "cat dog"), ("a", 0, "dog dog dog"), ("b", 0, "..."), ("b", 1, "zebra cat")]
    return spark.createDataFrame(rows, "article_id STRING, sent_index INT, sentence STRING")


def test_both_ways_of_encoding_agree(spark, monkeypatch):
    s = repeated(spark).unionByName(sentences(spark))
    v = VO.VocabularyBuilder(max_tokens=5).fit(s)
    keys = ["article_id", "sent_index"]
    arts = spark.createDataFrame([("p", ["cat dog", "zebra"]), ("p", ["cat dog", "zebra"]), ("q", []), ("r", ["..."])],
                                 "id STRING, sentences ARRAY<STRING>")

    def both():
        return (sorted((r["article_id"], r["sent_index"], r["x"]) for r in VO.encode_flat(s, v, keys).collect()),
                sorted((r["id"], r["x"]) for r in VO.encode_articles(arts, v).collect()))

    small = both()
    assert len(small[0]) == s.count() and len(small[1]) == 4
    monkeypatch.setattr(VO, "BROADCAST_VOCAB_LIMIT", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not v.fits
        plan = VO.encode_flat(s, v, keys)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan
        assert both() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_encoding_in_the_row_does_not_shuffle(spark):
    s = sentences(spark)
    v = VO.VocabularyBuilder(max_tokens=5).fit(s)
    plan = VO.encode_flat(s, v, ["article_id", "sent_index"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_encode_keeps_sentences_with_repeated_keys_apart(spark):
    s = repeated(spark).where("article_id = 'a'")
    v = VO.VocabularyBuilder(max_tokens=10).fit(s)
    got = sorted(r["x"][:3] for r in VO.encode_flat(s, v, ["article_id", "sent_index"]).collect())
    assert got == [[2, 2, 2], [3, 2, 0], [3, 2, 0]]          # dog = 2, cat = 3


@pytest.mark.parametrize("head", [0, 1, 100])
@pytest.mark.parametrize("hot", [1, 4, 10**6])
def test_join_gives_each_row_the_ids_of_the_lookup(spark, head, hot):
    v = VO.VocabularyBuilder(max_tokens=6).fit(repeated(spark).unionByName(sentences(spark)))
    lists = [["cat dog", "zebra unheard of"], ["cat dog", "zebra unheard of"], [], None, [None, "", "dog"], ["..."],
             ["the " * 50] * 3, ["new new new cat"] * 40]
    rows = spark.createDataFrame([(i % 2, s) for i, s in enumerate(lists)], "id INT, sentences ARRAY<STRING>").repartition(3)
    toks = F.transform("sentences", lambda s: VO.sentence_tokens(s, v.seq_len))
    want = sorted(map(str, VO.encode_articles(rows, v).collect()))
    got = VO.encode_by_join(rows, v, toks, "x", v.seq_len, head=head, hot=hot)
    assert got.columns == ["id", "sentences", "x"]
    assert sorted(map(str, got.collect())) == want
    assert VO.encode_by_join(rows.limit(0), v, toks, "x", v.seq_len, head=head, hot=hot).collect() == []


def test_large_vocabularies_are_not_brought_to_the_driver_and_move_no_text(spark, monkeypatch):
    s = sentences(spark)
    v = VO.VocabularyBuilder(max_tokens=6).fit(s)
    want = sorted(map(str, VO.encode_flat(s, v, ["article_id", "sent_index"]).collect()))
    monkeypatch.setattr(VO, "BROADCAST_VOCAB_LIMIT", 1)
    monkeypatch.setattr(VO, "HEAD", 1)
    v._tokens = None
    out = VO.encode_flat(s, v, ["article_id", "sent_index"])
    assert sorted(map(str, out.collect())) == want and v._tokens is None
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sentence#" not in plan and "Join" in plan
