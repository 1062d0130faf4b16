"""Driver contract, stream = batch, and the flagship query on the smallest table."""

from conftest import SF_SMALL
import __spark_entry__ as E


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["split", "id", "n_sentences", "selected_indices", "summary"]


def test_stream_equals_batch(spark):
    from gistlet.plans.queries import q_summarize_articles, q_summarize_stream
    b = sorted(tuple(r) for r in q_summarize_articles(spark, SF_SMALL).collect())
    s = sorted(tuple(r) for r in q_summarize_stream(spark, SF_SMALL).collect())
    assert b == s


def test_stream_restart_is_exactly_once(spark):
    from gistlet.plans.queries import vocabulary, weights
    from gistlet.session import new_work_path
    from gistlet.streaming.summarize import document_stream, run_to_table, summary_stream
    base = new_work_path(spark, "stream-restart")
    v = vocabulary(spark, SF_SMALL)
    for _ in range(2):   # second run restarts from the checkpoint and finds nothing new
        docs = document_stream(spark, f"{SF_SMALL}/documents*.parquet")
        run_to_table(summary_stream(docs, v, weights(spark, SF_SMALL)), f"{base}/out", f"{base}/ck")
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == out.select("id").distinct().count() == 200


def test_stream_over_several_micro_batches(spark):
    from pyspark.sql import functions as F

    from gistlet.operators.summarize import summarize_articles
    from gistlet.plans.queries import articles, vocabulary, weights
    from gistlet.session import new_work_path
    from gistlet.streaming.summarize import document_stream, run_to_table, summary_stream
    base = new_work_path(spark, "stream-multi")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.repartition(4, "doc_id").write.parquet(f"{base}/in")
    v = vocabulary(spark, SF_SMALL)
    q = run_to_table(summary_stream(document_stream(spark, f"{base}/in", max_files_per_trigger=1), v, weights(spark, SF_SMALL)),
                     f"{base}/out", f"{base}/ck")
    assert len(q.recentProgress) >= 4                       # one micro-batch per file
    cols = ["id", "selected_indices", "summary"]
    got = spark.read.parquet(f"{base}/out").select(*cols)
    exp = summarize_articles(articles(spark, SF_SMALL), v, weights(spark, SF_SMALL)).select(*cols)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert got.count() == 200
