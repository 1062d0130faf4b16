"""The pipeline against its stages in plain Python, and the registered queries against their SQL."""

import re
from collections import Counter

import duckdb
import pytest
from llm_cases import docs_of, no_docs, odd_docs, plain
from test_llm_decontaminate import brute as brute_windows
from test_llm_dedup import brute_components, brute_exact, brute_simhash

import __spark_entry__ as E
import corpus_pipeline
from gistlet.llm import langid
from gistlet.llm.queries import ORACLES, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", k)) for k in names) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLES) <= set(E.oracle_sql())


def test_pipeline_equals_plain_stages(spark):
    from tokenizers import Tokenizer

    docs = docs_of(spark, SF)
    rows = dict(plain(docs, "doc_id", "text"))
    said = langid.identify(docs).where("lang_pred <> 'und' AND score >= 0.4")
    left = {i: rows[i] for i, in plain(said, "doc_id")}
    left = {i: left[i] for i, *_, kept, _ in brute_exact(list(left.items())) if kept}
    near = brute_components([(i, brute_simhash(t)) for i, t in left.items()])
    left = {i: left[i] for i, _, c in near if i == c}
    items = plain(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text")
    left = {i: left[i] for i, *_, bad in brute_windows(list(left.items()), items) if not bad}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}
    got = plain(corpus_pipeline.run(spark, SF), "doc_id", "length", "doc_tokens")
    total = Counter()
    for i, n, _ in got:
        total[i] += n
    assert dict(total) == want and all(want[i] == n for i, _, n in got)
    assert 0 < len(want) < len(rows)


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = odd_docs(spark).withColumnRenamed("lang", "other").selectExpr("*", "'en' AS lang")
    for given in (docs, no_docs(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, SF)
            assert out.columns == given.columns
            given = corpus_pipeline.written(out, "test")
        corpus_pipeline.STAGES[-1][1](spark, given, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    cols = [d[0] for d in want.description]
    rows = Counter(want.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert Counter(plain(got, *cols)) == rows
