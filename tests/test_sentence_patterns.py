"""The patterns that hide periods begin at what is rare in a text, and hide the periods that the rule read from its front hides."""

import random

from pyspark.sql import functions as F

from gistlet import config as C
from gistlet.functions.sql import register_functions
from gistlet.functions.text import DOTTED, HIDDEN, sentence_text, split_sentences

BEFORE = r"(^|[^\p{L}\p{N}.])"
CONTINUES = BEFORE + r"((?:\p{L}\.)+\p{L}|" + "|".join(C.ABBREVIATIONS) + r")\.(?=" + C.WS_CLASS + r"+[\p{Ll}\p{N}])"
NEVER_ENDS = BEFORE + "(" + "|".join(C.TITLES) + r"|\p{Lu})\."

PIECES = ["Mr", "Dr", "vs", "etc", "Inc", "No", "al", "p.m", "U.S.A", "a", "B", "É", "é", "\U0001d400", "\U0001d51f", "İ", "1", "9.5", "cat", "Dog",
          ".", ".", ".", ".", ". ", ". ", ".  ", "! ", "? ", ".\xa0", " ", " ", "\x1c", "\n", '"', ")", "(", ",", "-", "\u0001", "\u0002", "̀",
          "A.B.C.D.E.F.G.H.I.J.K.L"]


def from_the_front(text):
    out = F.regexp_replace(F.regexp_replace(sentence_text(text), CONTINUES, "$1$2\u0002"), NEVER_ENDS, "$1$2\u0002")
    marked = F.regexp_replace(out, C.SENTENCE_END + C.WS_CLASS + "+", "$1\u0001")
    return F.array_remove(F.split(F.replace(marked, F.lit("\u0002"), F.lit(".")), "\u0001"), "")


def test_no_place_but_a_period_is_tried():
    assert HIDDEN.startswith(r"\.") and DOTTED.startswith(r"(\p{L}\.")


def test_periods_hidden_as_from_the_front(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(20_000)] + [None, ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    found = rows.select("t", split_sentences("t").alias("got"), from_the_front("t").alias("want"))
    assert [tuple(r) for r in found.where(~F.col("got").eqNullSafe(F.col("want"))).take(3)] == []
    register_functions(spark)
    found = rows.select("t", F.expr("split_sentences(t)").alias("got"), from_the_front("t").alias("want"))
    assert [tuple(r) for r in found.where(~F.col("got").eqNullSafe(F.col("want"))).take(3)] == []
