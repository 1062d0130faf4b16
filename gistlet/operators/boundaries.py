"""B10 learned from the corpus: which periods end no sentence, by language.

A type (a lower-cased word) that nearly always has a period behind it is an abbreviation. Spark counts,
per language, each type with and without a final period and how often the next word begins with a
lower-case letter or digit (``type_counts``: one explode, one hash aggregate with partial sums). From the
counts comes the log-likelihood ratio of "the period belongs to the type" against "it came by chance",
scaled as in Kiss and Strunk (2006): short types, types with inner periods and types never seen without
their period score higher (``abbreviations``). A second pass counts the words after the learned types; pairs that stand together
far more often than chance ("z. B.") never have a sentence end between them (``collocations``).

What is learned is small by construction (at most ``MOST`` types and pairs a language) and is turned into
one guard per language, which hides such periods before the sentence rule of ``functions.text`` looks at the
text: native, row-local, without a join. A learned period still ends a sentence where an upper-case
word follows, unless the type is seldom followed by one.

Null or unknown languages share the language ''. Empty texts have no types; ties of score go by type.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gistlet import config as C
from gistlet.functions.rows import explode_rows
from gistlet.functions.text import _DOT, _col, sentence_text, split_sentences
from gistlet.session import new_work_path

#: Score from which a type is an abbreviation, and types of a language that are kept, best first.
LEAST, MOST = 0.3, 400
#: Share of lower-case (or digit) followers from which a type's period never ends a sentence, and how often it must be seen.
NEVER, SEEN = 0.9, 5
#: Times a type must be seen with its period.
RARE = 3
#: Ratio from which a pair is a collocation (0.5 % of chance pairs reach it).
PAIR = 7.88

#: Signs around a word that are no part of it.
_AROUND = "\"'()[]{},;:!?“”‘’«»"


def _language(lang) -> Column:
    return F.coalesce(_col(lang), F.lit(""))


def _raw_words(texts: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """lang, raw: white-space words as they stand in the text, with the signs around them."""
    return texts.select(_language(lang_col).alias("lang"), F.array_remove(F.split(sentence_text(text_col), C.WS_CLASS + "+"), "").alias("raw"))


def _bare(word) -> Column:
    return F.trim(_col(word), F.lit(_AROUND))


def type_counts(texts: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, type (lower case, no final period), n_with, n_without, n_lower (with a period, next word lower-case or digit)."""
    def entry(w: Column, i: Column) -> Column:
        # the next word is only looked at behind a period
        before_lower = F.coalesce(_bare(F.get("raw", i + 1)).rlike(r"^[\p{Ll}\p{N}]"), F.lit(False))
        return F.struct(w.alias("w"), F.when(w.contains("."), before_lower).otherwise(F.lit(False)).alias("lower"))

    rows = explode_rows(_raw_words(texts, text_col, lang_col), ["lang"], F.transform("raw", entry), "e")
    # counted as they stand, so that signs and case are taken off once for each distinct word
    seen = rows.groupBy("lang", F.col("e.w").alias("w"), F.col("e.lower").alias("lower")).agg(F.count("*").alias("n"))
    bare = seen.select("lang", _bare("w").alias("w"), "lower", "n")
    dotted = F.col("w").endswith(".")
    counted = bare.select("lang", F.lower(F.rtrim("w", F.lit("."))).alias("type"), "n", F.when(dotted, F.col("n")).otherwise(0).alias("with"),
                          F.when(dotted & F.col("lower"), F.col("n")).otherwise(0).alias("low"))
    return (counted.where("type <> ''").groupBy("lang", "type")
            .agg(F.sum("with").alias("n_with"), (F.sum("n") - F.sum("with")).alias("n_without"), F.sum("low").alias("n_lower")))


def _log(x: Column) -> Column:
    return F.log(F.greatest(x, F.lit(1e-12)))


def likelihood_ratio(n_type, n_dots, n_both, n_all) -> Column:
    """Twice the log ratio of "99 % of the type's words have a period" to "as many as of all words" (binomial)."""
    a, b, ab, n = (_col(c).cast("double") for c in (n_type, n_dots, n_both, n_all))
    p = b / n
    chance = ab * _log(p) + (a - ab) * _log(1 - p)
    return 2 * (ab * F.lit(math.log(0.99)) + (a - ab) * F.lit(math.log(0.01)) - chance)


def pair_counts(texts: DataFrame, learned: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, type, next, n_pair: how often each learned type with its period stands before each word (lower case, no period)."""
    def entry(w: Column, i: Column) -> Column:
        return F.when(w.contains("."), F.struct(w.alias("w"), F.get("raw", i + 1).alias("next")))

    both = F.filter(F.transform("raw", entry), lambda e: e.isNotNull())
    rows = explode_rows(_raw_words(texts, text_col, lang_col), ["lang"], both, "e")
    rows = rows.select("lang", _bare("e.w").alias("w"), _bare("e.next").alias("next")).where(F.col("w").endswith(".") & (F.col("next") != ""))
    rows = rows.select("lang", F.lower(F.rtrim("w", F.lit("."))).alias("type"), F.lower(F.rtrim("next", F.lit("."))).alias("next"))
    # at most MOST types a language
    known = rows.join(F.broadcast(learned.select("lang", "type")), ["lang", "type"], "left_semi")
    return known.where("next <> ''").groupBy("lang", "type", "next").agg(F.count("*").alias("n_pair"))


def collocations(pairs: DataFrame, counts: DataFrame, least: float = PAIR, most: int = MOST) -> DataFrame:
    """lang, type, next, ratio: pairs that stand together far more often than chance, at most ``most`` a language.

    The ratio is that of one binomial for the next word against two, after the type and elsewhere (Dunning 1993).
    """
    each = counts.select("lang", "type", (F.col("n_with") + F.col("n_without")).alias("n"))
    words = counts.groupBy("lang").agg(F.sum(F.col("n_with") + F.col("n_without")).alias("all"))
    rows = (pairs.where(F.col("n_pair") >= 2).join(each.withColumnRenamed("n", "n_type"), ["lang", "type"])
            .join(each.select("lang", F.col("type").alias("next"), F.col("n").alias("n_next")), ["lang", "next"]).join(words, "lang"))
    a, b, ab, n = (F.col(c).cast("double") for c in ("n_type", "n_next", "n_pair", "all"))

    def fit(k: Column, m: Column, p: Column) -> Column:
        return k * _log(p) + (m - k) * _log(1 - p)

    ratio = 2 * (fit(ab, a, ab / a) + fit(b - ab, n - a, (b - ab) / (n - a)) - fit(ab, a, b / n) - fit(b - ab, n - a, b / n))
    best = Window.partitionBy("lang").orderBy(F.desc("ratio"), "type", "next")
    found = rows.withColumn("ratio", ratio).where((F.col("ratio") >= least) & (ab / a > b / n))
    return found.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= most).select("lang", "type", "next", "ratio")


def abbreviations(counts: DataFrame, least: float = LEAST, most: int = MOST) -> DataFrame:
    """lang, type, score, n_with, n_lower, never: the learned abbreviations, at most ``most`` a language.

    ``never``: the period ends no sentence even before an upper-case word, as that is hardly ever what follows.
    """
    totals = counts.groupBy("lang").agg(F.sum("n_with").alias("dots"), F.sum(F.col("n_with") + F.col("n_without")).alias("words"))
    # a row for each language; the counts meet it in a broadcast when the planner sees that it is small
    rows = counts.where((F.col("n_with") >= RARE) & F.col("type").rlike(r"\p{L}")).join(totals, "lang")
    ratio = likelihood_ratio(F.col("n_with") + F.col("n_without"), "dots", "n_with", "words")
    inner = F.length("type") - F.length(F.replace(F.col("type"), F.lit("."), F.lit("")))
    letters = (F.length("type") - inner).cast("double")
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -F.col("n_without").cast("double"))
    scored = rows.withColumn("score", score).where(F.col("score") >= least)
    never = (F.col("n_with") >= SEEN) & (F.col("n_lower") >= NEVER * F.col("n_with"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), "type")
    kept = scored.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= most)
    return kept.select("lang", "type", "score", "n_with", "n_lower", never.alias("never"))


class Boundaries:
    """Guards of the sentence rule by language: types, types whose period never ends a sentence, and (type, next) pairs."""

    def __init__(self, types: dict[str, list[str]], never: dict[str, list[str]], pairs: dict[str, list[tuple[str, str]]]):
        self.types, self.never, self.pairs = types, never, pairs

    @classmethod
    def fit(cls, texts: DataFrame, text_col: str = "text", lang_col: str = "lang", least: float = LEAST, most: int = MOST) -> Boundaries:
        """Two passes over the texts: counts of types, and of the pairs of the types that were learned."""
        spark, path = texts.sparkSession, new_work_path(texts.sparkSession, "types")
        type_counts(texts, text_col, lang_col).write.parquet(path)
        counts = spark.read.parquet(path)
        path = new_work_path(spark, "abbreviations")
        abbreviations(counts, least, most).write.parquet(path)
        learned = spark.read.parquet(path)
        return cls.from_tables(learned, collocations(pair_counts(texts, learned, text_col, lang_col), counts, most=most))

    @classmethod
    def from_tables(cls, learned: DataFrame, pairs: DataFrame) -> Boundaries:
        types: dict[str, list[str]] = {}
        never: dict[str, list[str]] = {}
        both: dict[str, list[tuple[str, str]]] = {}
        for r in learned.orderBy("lang", "type").collect():             # at most MOST rows for each language
            (never if r["never"] else types).setdefault(r["lang"], []).append(r["type"])
        for r in pairs.orderBy("lang", "type", "next").collect():       # and as many
            both.setdefault(r["lang"], []).append((r["type"], r["next"]))
        return cls(types, never, both)

    def patterns(self, lang: str) -> list[str]:
        """Regular expressions of the periods that end no sentence in ``lang``."""
        space = C.WS_CLASS + "+"

        def dots(types: list[str], ahead: str) -> str:
            # looked at from the period, so that the list is only tried where a period stands
            return r"\.(?<=(?:^|[^\p{L}\p{N}.])(?iu:" + "|".join(map(_quoted, types)) + r")\.)(?=" + ahead + ")"

        out = []
        if lang in self.types:
            out.append(dots(self.types[lang], space + r"[\p{Ll}\p{N}]"))
        if lang in self.never:
            out.append(dots(self.never[lang], space))
        after: dict[str, list[str]] = {}
        for a, b in self.pairs.get(lang, []):
            after.setdefault(a, []).append(b)
        for a, words in sorted(after.items()):
            out.append(dots([a], space + "(?iu:" + "|".join(map(_quoted, words)) + r")(?![\p{L}\p{N}])"))
        return out

    def guarded(self, text: Column, lang) -> Column:
        """The text with the learned periods hidden as the sentence rule hides those of its own list."""
        out = text
        for name in sorted({*self.types, *self.never, *self.pairs}):
            own = F.regexp_replace(text, "|".join(self.patterns(name)), _DOT)
            out = F.when(_language(lang) == name, own).otherwise(out)
        return out

    def split(self, text, lang, max_sentences: int | None = None) -> Column:
        """Sentences of a text by the frozen rule and what was learned for its language."""
        return split_sentences(_col(text), max_sentences, guard=lambda t: self.guarded(t, lang))


def _quoted(word: str) -> str:
    return r"\Q" + word.replace(r"\E", "") + r"\E"
