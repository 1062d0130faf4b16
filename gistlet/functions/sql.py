"""SQL surface: the text and quantization rules as SQL functions (section 2.9).

Native rules become temporary SQL functions (``CREATE TEMPORARY FUNCTION ...
RETURN expr``), so they run as JVM expressions in SQL too; the two Python
helpers (Porter stemming, ROUGE-L) are registered as Arrow UDFs.

    register_functions(spark)
    spark.sql("SELECT split_sentences(text) FROM documents")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from gistlet import config as C
from gistlet.functions.text import DOTTED, HIDDEN


def sql_lit(s: str) -> str:
    """A Spark SQL string literal; non-printable and non-ASCII characters as \\uXXXX or \\UXXXXXXXX."""
    out = []
    for ch in s:
        if ch == "\\":
            out.append("\\\\")
        elif ch == "'":
            out.append("\\'")
        elif 32 <= ord(ch) < 127:
            out.append(ch)
        else:
            out.append(("\\u%04x" if ord(ch) < 0x10000 else "\\U%08x") % ord(ch))
    return "'" + "".join(out) + "'"


def _definitions() -> dict:
    ws = sql_lit(C.PY_WHITESPACE)
    sent_re = sql_lit(C.SENTENCE_END + C.WS_CLASS + "+")
    guarded = (f"regexp_replace(regexp_replace(trim(BOTH {ws} FROM translate(s, concat(chr(1), chr(2)), '')), "
               f"{sql_lit(DOTTED)}, concat('$1', chr(2))), {sql_lit(HIDDEN)}, chr(2))")
    std = f"translate(s, {sql_lit(C.UPPER_ASCII + C.PUNCT_CHARS)}, {sql_lit(C.LOWER_ASCII)})"
    tokens = (f"array_remove(split(translate({std}, {sql_lit(C.ASCII_WS_CHARS)}, "
              f"{sql_lit(' ' * len(C.ASCII_WS_CHARS))}), ' '), '')")
    return {
        "strip_text": ("s STRING", "STRING", f"trim(BOTH {ws} FROM s)"),
        "split_sentences": ("s STRING, max_sentences INT DEFAULT CAST(NULL AS INT)", "ARRAY<STRING>",
                            f"slice(array_remove(split(translate(regexp_replace({guarded}, {sent_re}, concat('$1', chr(1))), "
                            f"chr(2), '.'), chr(1)), ''), 1, coalesce(max_sentences, 2147483647))"),
        "standardize_text": ("s STRING", "STRING", std),
        "text_tokens": ("s STRING", "ARRAY<STRING>", tokens),
        "rouge_tokens": ("s STRING", "ARRAY<STRING>",
                         f"array_remove(split(regexp_replace(lower(s), {sql_lit(C.ROUGE_NON_ALNUM)}, ' '), ' '), '')"),
        "quantize_int8": ("x DOUBLE, scale DOUBLE, zero_point INT", "TINYINT",
                          "CAST(greatest(least(bround(x / (CASE WHEN scale <> 0 THEN scale ELSE "
                          "CAST(raise_error('quantized tensor with scale == 0') AS DOUBLE) END) "
                          "+ zero_point, 0), 127), -128) AS TINYINT)"),
        "dequantize": ("q INT, scale DOUBLE, zero_point INT", "DOUBLE", "(q - zero_point) * scale"),
    }


def register_functions(spark: SparkSession) -> list:
    names = []
    for name, (args, ret, body) in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
        names.append(name)
    from gistlet.operators.rouge import rouge_l_udf, stem_tokens
    spark.udf.register("porter_stem", stem_tokens)
    spark.udf.register("rouge_l", rouge_l_udf)
    return names + ["porter_stem", "rouge_l"]
