"""The stemmer as DuckDB SQL: one CTE per step over the distinct words.

Vowels and consonants of a word are found on a copy in which a y that counts as a consonant
is written Y; the measure of a stem is then the number of its vowel-consonant borders. The
suffixes and endings are written out here once more, apart from the operator's.
"""

from __future__ import annotations

# Irregular forms and their stems.
IRREGULAR = [("sky", "sky"), ("skies", "sky"), ("dying", "die"), ("lying", "lie"), ("tying", "tie"), ("news", "news"),
             ("innings", "inning"), ("inning", "inning"), ("outings", "outing"), ("outing", "outing"),
             ("cannings", "canning"), ("canning", "canning"), ("howe", "howe"), ("proceed", "proceed"),
             ("exceed", "exceed"), ("succeed", "succeed")]

# Suffixes of steps 2, 3 and 4 with what takes their place.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
         ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
         ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
         ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
         "ous", "ive", "ize"]


def marked(w: str) -> str:
    """``w`` with each y that is a consonant as Y: at the start, after a vowel, and every second y of a run."""
    after = f"regexp_replace(regexp_replace({w}, '^y', 'Y'), '([aeiou])y', '\\1Y', 'g')"
    return f"replace({after}, 'yy', 'yY')"


def measure(w: str) -> str:
    return f"len(regexp_extract_all({marked(w)}, '[aeiouy][^aeiouy]'))"


def has_vowel(w: str) -> str:
    return f"regexp_matches({marked(w)}, '[aeiouy]')"


def short_end(w: str) -> str:
    """Ends consonant, vowel, consonant (not w, x, y), or is a vowel and a consonant."""
    m = marked(w)
    return f"(regexp_matches({m}, '[^aeiouy][aeiouy][^aeiouywxY]$') OR regexp_matches({m}, '^[aeiouy][^aeiouy]$'))"


def cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def suffixes(rules: list[tuple[str, str]], more_than: int) -> str:
    """CASE branches: the first suffix that fits decides; without the measure the word stays."""
    return " ".join(f"WHEN ends_with(w, '{s}') THEN CASE WHEN {measure(cut(len(s)))} > {more_than} "
                    f"THEN {cut(len(s))} || '{r}' ELSE w END" for s, r in rules)


def step4() -> str:
    out = []
    for s in STEP4:
        also = f" AND right({cut(3)}, 1) IN ('s', 't')" if s == "ion" else ""
        out.append(f"WHEN ends_with(w, '{s}') THEN CASE WHEN {measure(cut(len(s)))} > 1{also} THEN {cut(len(s))} ELSE w END")
    return " ".join(out)


def stem_ctes(words: str) -> str:
    """CTEs that end in ``stems`` (token, stem): ``words`` gives the distinct tokens of over three characters."""
    irregular = " ".join(f"WHEN '{form}' THEN '{s}'" for form, s in IRREGULAR)
    steps = [
        # 1a
        f"""CASE WHEN length(w) = 4 AND ends_with(w, 'ies') THEN {cut(1)} WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {cut(2)}
  WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {cut(1)} ELSE w END""",
        # 1b: `~` marks a word that lost its ending
        f"""CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN {cut(1)} ELSE {cut(2)} END
  WHEN ends_with(w, 'eed') THEN CASE WHEN {measure(cut(3))} > 0 THEN {cut(1)} ELSE w END
  WHEN ends_with(w, 'ed') AND {has_vowel(cut(2))} THEN {cut(2)} || '~'
  WHEN ends_with(w, 'ing') AND {has_vowel(cut(3))} THEN {cut(3)} || '~' ELSE w END""",
        f"""CASE WHEN NOT ends_with(w, '~') THEN w
  WHEN regexp_matches(w, '(at|bl|iz)~$') THEN {cut(1)} || 'e'
  WHEN length(w) > 2 AND w[-2] = w[-3] AND regexp_matches({marked(cut(1))}, '[^aeiouy]$')
    THEN CASE WHEN w[-2] IN ('l', 's', 'z') THEN {cut(1)} ELSE {cut(2)} END
  WHEN {measure(cut(1))} = 1 AND {short_end(cut(1))} THEN {cut(1)} || 'e' ELSE {cut(1)} END""",
        # 1c
        f"CASE WHEN length(w) > 2 AND ends_with(w, 'y') AND regexp_matches({marked(cut(1))}, '[^aeiouy]$') THEN {cut(1)} || 'i' ELSE w END",
        # 2: alli first, and again what that leaves
        f"CASE WHEN ends_with(w, 'alli') AND {measure(cut(4))} > 0 THEN {cut(2)} ELSE w END",
        f"""CASE {suffixes(STEP2, 0)} WHEN ends_with(w, 'logi') AND {measure(cut(3))} > 0 THEN {cut(1)} ELSE w END""",
        f"CASE {suffixes(STEP3, 0)} ELSE w END",
        f"CASE {step4()} ELSE w END",
        # 5
        f"""CASE WHEN ends_with(w, 'e') AND ({measure(cut(1))} > 1 OR ({measure(cut(1))} = 1 AND NOT {short_end(cut(1))})) THEN {cut(1)}
  ELSE w END""",
        f"CASE WHEN ends_with(w, 'll') AND {measure(cut(1))} > 1 THEN {cut(1)} ELSE w END",
    ]
    ctes = [f"st0 AS MATERIALIZED (SELECT token, token AS w FROM ({words}))"]
    ctes += [f"st{k} AS MATERIALIZED (SELECT token, {e} AS w FROM st{k - 1})" for k, e in enumerate(steps, 1)]
    ctes.append(f"stems AS MATERIALIZED (SELECT token, CASE token {irregular} ELSE w END AS stem FROM st{len(steps)})")
    return ",\n".join(ctes)
