"""Text rules as native Spark column expressions (no Python in the hot path).

F1  py_strip            Unicode strip as Python's str.strip()
B10 split_sentences     rule-based sentence split
B11 (max_sentences)     optional cap on sentences per article
F2  standardize         ASCII lower-case, punctuation deleted
F3  text_tokens         whitespace split of the standardized text
F5  rouge_tokens        ROUGE tokenizer (without stemming)
F9  join_text           ' '.join
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gistlet import config as C

_SEP, _DOT = "\u0001", "\u0002"
# U+10000, a letter itself, makes Java look behind by code points and not by UTF-16 units.
_IN_WORD = "[\\p{L}\\p{N}.\U00010000]"
_GOES_ON = "(?=" + C.WS_CLASS + r"+[\p{Ll}\p{N}])"
# Both are tried at few places of a text: where a letter has a period behind it, and where a period stands.
DOTTED = r"(\p{L}\.(?<!" + _IN_WORD + r"\p{L}\.)(?:\p{L}\.)*\p{L})\." + _GOES_ON
HIDDEN = (r"\.(?:(?<=(?<!" + _IN_WORD + ")(?:" + "|".join(C.TITLES) + r"|\p{Lu})\.)|"
          + _GOES_ON + "(?<=(?<!" + _IN_WORD + ")(?:" + "|".join(C.ABBREVIATIONS) + r")\.))")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Remove leading and trailing Unicode whitespace (M1), as str.strip()."""
    return F.trim(_col(c), F.lit(C.PY_WHITESPACE))


def default_strip(c) -> Column:
    """Missing value becomes '' and is then stripped (B1)."""
    return py_strip(F.coalesce(_col(c), F.lit("")))


def sentence_text(c) -> Column:
    """Text that the split works on: stripped, without the two marker characters."""
    # replace() searches for one character; translate() would look up every one
    return py_strip(F.replace(F.replace(_col(c), F.lit(_SEP), F.lit("")), F.lit(_DOT), F.lit("")))


def has_sentence(c) -> Column:
    """Whether any character is left besides white space and the markers; looks at the ends only."""
    return F.length(F.trim(_col(c), F.lit(C.PY_WHITESPACE + _SEP + _DOT))) > 0


def split_sentences(c, max_sentences: int | None = None, guard: Callable[[Column], Column] | None = None) -> Column:
    """Split text after a terminal punctuation run followed by whitespace.

    Periods of abbreviations and initials are hidden behind char(2) while the separator
    char(1) is set; both are removed from the text first so they cannot collide. Blank
    pieces are dropped; ``max_sentences`` is an optional cap. ``guard`` may hide further periods
    of the text in the same way.
    """
    # On stripped text every piece starts and ends with a non-space character (a
    # boundary swallows the whole whitespace run), so only an empty text yields a
    # blank piece: array_remove replaces a per-piece lambda.
    text = sentence_text(c)
    guarded = F.regexp_replace(guard(text) if guard else text, DOTTED, "$1" + _DOT)
    guarded = F.regexp_replace(guarded, HIDDEN, _DOT)
    marked = F.regexp_replace(guarded, C.SENTENCE_END + C.WS_CLASS + "+", "$1" + _SEP)
    parts = F.array_remove(F.split(F.replace(marked, F.lit(_DOT), F.lit(".")), _SEP), "")
    if max_sentences:
        parts = F.slice(parts, 1, int(max_sentences))
    return parts


def standardize(c) -> Column:
    """ASCII lower-case and delete punctuation (M8) in one translate() pass:
    characters of the 'from' set without a counterpart are removed."""
    return F.translate(_col(c), C.UPPER_ASCII + C.PUNCT_CHARS, C.LOWER_ASCII)


def text_tokens(c) -> Column:
    """Standardize and split on ASCII whitespace, dropping empty tokens."""
    # standardize() and white space to spaces in one pass
    spaced = F.translate(_col(c), C.UPPER_ASCII + C.ASCII_WS_CHARS + C.PUNCT_CHARS,
                         C.LOWER_ASCII + " " * len(C.ASCII_WS_CHARS))
    return F.array_remove(F.split(spaced, " "), "")


def rouge_tokens(c) -> Column:
    """ROUGE tokens without stemming: lower-case, [^a-z0-9]+ separates."""
    spaced = F.regexp_replace(F.lower(_col(c)), C.ROUGE_NON_ALNUM, " ")
    return F.array_remove(F.split(spaced, " "), "")


def join_text(arr, sep: str = " ") -> Column:
    return F.array_join(_col(arr), sep)
