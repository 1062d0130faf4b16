"""Rows are dropped by row and not by id: nothing is lost, and of copies one stays."""

import os

import pytest
from llm_cases import no_docs, plain

from gistlet.llm import common, decontaminate, exactdedup, packing, sharding, simhash
from gistlet.llm.queries import tokenizer_path

A = "one text about the sea and the long coast of the north with its many small harbours"
B = "another text on the making of bread in old ovens of stone that keep their heat all night"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(params=[0, common.KEYS], ids=["joined", "sent"])
def either_way(request, monkeypatch):
    monkeypatch.setattr(common, "KEYS", request.param)


@pytest.mark.parametrize("stage", [exactdedup.keep_first, simhash.keep_one])
@pytest.mark.parametrize("rows, left", [
    ([(3, B), (5, A), (5, B)], [(3, B), (5, A)]),
    ([(9, A), (9, A)], [(9, A)]),
    ([(9, A), (9, A.replace(" ", "  ")), (9, B)], None),
    ([(None, A), (None, A), (4, A), (None, B), (None, B)], [(4, A), (None, B)]),
    ([(1, None), (2, ""), (0, "")], [(0, "")]),
    ([(5, None), (5, "")], None),
    ([(i, f"{A} {i * 7919} {B}" * 3) for i in range(3)], None),
])
def test_one_row_of_each_text_stays(spark, either_way, stage, rows, left):
    out = stage(docs(spark, [(*r, f"l{i}") for i, r in enumerate(rows)]))
    got = [(r.doc_id, r.text) for r in out.collect()]
    key = " ".join
    assert sorted({key((t or "").split()) for _, t in got}) == sorted({key((t or "").split()) for _, t in rows}) or stage is simhash.keep_one
    if left is not None:
        assert sorted(got, key=str) == sorted(left, key=str)
    if stage is exactdedup.keep_first:
        assert len(got) == len({key((t or "").split()) for _, t in rows})


def test_which_of_the_equal_rows_stays_does_not_depend_on_their_order(spark):
    rows = [(7, A, f"l{i}") for i in range(20)]
    kept = {plain(exactdedup.keep_first(docs(spark, order).repartition(n)), "lang")[0] for order, n in ((rows, 1), (rows[::-1], 4))}
    assert len(kept) == 1


def test_clean_judges_each_row_by_its_text(spark, either_way):
    items = spark.createDataFrame([(1, B)], "item_id long, text string")
    rows = [(5, A, "x"), (5, f"see: {B}!", "y"), (None, A, "z"), (None, B, "u"), (6, None, "v")]
    assert sorted(plain(decontaminate.clean(docs(spark, rows), items), "lang")) == [("v",), ("x",), ("z",)]


def test_stages_of_an_empty_table(spark):
    assert exactdedup.keep_first(no_docs(spark)).collect() == simhash.keep_one(no_docs(spark)).collect() == []


def test_shuffled_rows_are_equal_only_if_all_their_values_are(spark):
    tags = [[None, 1], [1, None], [1], [1, None, None], None, [], [None]]
    given = spark.createDataFrame([(1, "t", t) for t in tags + tags[:2]], "doc_id long, text string, tags array<int>")
    back = sharding.shuffled(given, 2).select("row.tags").collect()
    assert sorted((r.tags for r in back), key=str) == sorted(tags + tags[:2], key=str)


def test_many_equal_rows_are_packed_in_many_groups(spark):
    rows = docs(spark, [(7, "the same short text", "en")] * 3000 + [(i, f"text {i}", "en") for i in range(40)])
    got = packing.pack(rows, tokenizer_path(), group_tokens=1000)
    places = plain(got, "sequence_id", "offset", "length")
    assert len(places) == 3040 == len({p[:2] for p in places})
    assert len({s >> 24 for s, _, _ in places}) > 10


def test_bitmap_grows_with_what_it_holds(spark):
    assert [common.bitmap_bits(n) for n in (0, 1 << 10, 1 << 20, 1 << 40)] == [16, 16, 25, 30]
    h = spark.range(5000).selectExpr("xxhash64(id) AS h")
    words = common.filter_bits(h, common.bitmap_bits(5000))
    import numpy as np
    known = np.array([r.h for r in h.collect()]).view(np.uint64)
    other = np.array([r.h for r in spark.range(5000).selectExpr("xxhash64(-1 - id) AS h").collect()]).view(np.uint64)
    assert common.in_filter(words, known, 17).all() and common.in_filter(words, other, 17).mean() < 0.1


def test_row_numbers_are_written_before_they_are_used():
    """monotonically_increasing_id only where the next step writes it."""
    top = os.path.dirname(common.__file__)
    found = {f: open(os.path.join(top, f)).read().count("monotonically_increasing_id()") for f in os.listdir(top) if f.endswith(".py")}
    assert {f: n for f, n in found.items() if n} == {"packing.py": 1, "urlfilter.py": 1}
    assert 'F.monotonically_increasing_id()), "urls")' in open(os.path.join(top, "urlfilter.py")).read()
    code = open(os.path.join(top, "packing.py")).read()
    assert code.index('written(cut, "pieces")') - code.index("monotonically_increasing_id()") < 120
