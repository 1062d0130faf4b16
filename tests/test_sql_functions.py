"""Section 2.9: SQL functions equal the column API on the documents table."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from gistlet.functions import text as TX
from gistlet.functions.sql import register_functions


def test_sql_functions_match_column_api(spark):
    register_functions(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.createOrReplaceTempView("docs_sql_test")
    a = spark.sql("""SELECT doc_id, strip_text(text) AS st, split_sentences(text) AS ss, split_sentences(text, 50) AS s50,
                            text_tokens(text) AS tt, rouge_tokens(text) AS rt, standardize_text(text) AS sd
                     FROM docs_sql_test""")
    b = docs.select("doc_id", TX.py_strip("text").alias("st"), TX.split_sentences("text").alias("ss"), TX.split_sentences("text", 50).alias("s50"),
                    TX.text_tokens("text").alias("tt"), TX.rouge_tokens("text").alias("rt"),
                    TX.standardize("text").alias("sd"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sql_quantize_and_python_udfs(spark):
    register_functions(spark)
    r = spark.sql("""SELECT quantize_int8(2.5, 1.0, 0) AS q, dequantize(36, 1.0D / 256, -128) AS d,
                            porter_stem(array('running', 'cats', 'is')) AS ps,
                            rouge_l(array('a','b','c'), array('a','c')).fmeasure AS f""").first()
    assert r["q"] == 2 and r["d"] == 0.640625 and r["ps"] == ["run", "cat", "is"]
    assert abs(r["f"] - 0.8) < 1e-12
