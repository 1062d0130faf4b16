"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each twin is written from the same rules as the Spark operators, over the raw
given tables (documents, labels, embeddings, ...), so the check covers the
whole path from the source table to the result.  The rules' constants are written
out here once more, and nothing of the operators is imported, so that a wrong
constant on one side does not agree with itself.
"""

from __future__ import annotations

from gistlet.plans.stem_twin import stem_ctes

VOCAB_TOKENS = 2000       # vocabulary size used by the registered queries
SEQ = 32                  # token ids per sentence
CAP = 50                  # of the optional cap on sentences
K = 3                     # sentences of a summary, and of the oracle

# The 29 white-space characters that are stripped from texts.
SPACES = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004,
                           0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WS = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


SENT_RE = q(r"""([.!?]+["')\]]*)""" + WS + "+")
# Words after whose period a sentence goes on.
CONTINUES_RE = q(r"(^|[^\p{L}\p{N}.])((?:\p{L}\.)+\p{L}|etc|Inc|Corp|Co|Ltd|Jr|Sr|approx|dept|est|al|No|Jan|Feb|Mar|Apr|Jun|Jul"
                 r"|Aug|Sep|Sept|Oct|Nov|Dec)\.(" + WS + r"+[\p{Ll}\p{N}])")
NEVER_RE = q(r"(^|[^\p{L}\p{N}.])(Mr|Mrs|Ms|Dr|Prof|Gen|Col|Capt|Lt|Sgt|Rev|Hon|Sen|Rep|Gov|St|Mt|vs|\p{Lu})\.")
PUNCT_RE = q(r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~']""")
AWS_RE = q(r"[ \t\n\x0B\f\r]+")
ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def strip(e: str) -> str:
    return f"trim({e}, {q(SPACES)})"


def tokens(e: str) -> str:
    # Independent regex form of the same rule (the Spark side uses translate()).
    std = f"regexp_replace(translate({e}, {ALPHABET}), {PUNCT_RE}, '', 'g')"
    return f"list_filter(regexp_split_to_array({std}, {AWS_RE}), lambda t: t <> '')"


def rouge_tokens(e: str) -> str:
    spaced = f"regexp_replace(lower({e}), '[^a-z0-9]+', ' ', 'g')"
    return f"list_filter(string_split({spaced}, ' '), lambda t: t <> '')"


def stripped(e: str) -> str:
    return strip(f"replace(replace({e}, chr(1), ''), chr(2), '')")


def sentences(e: str, raw: bool = True) -> str:
    hidden = stripped(e) if raw else e
    for _ in range(2):      # a match takes the letter after it along, which may begin the next one
        hidden = f"regexp_replace({hidden}, {CONTINUES_RE}, '\\1\\2' || chr(2) || '\\3', 'g')"
    hidden = f"regexp_replace({hidden}, {NEVER_RE}, '\\1\\2' || chr(2), 'g')"
    marked = f"replace(regexp_replace({hidden}, {SENT_RE}, '\\1' || chr(1), 'g'), chr(2), '.')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: {strip('s')} <> '')"


def scorer_layers(x: str) -> tuple[list, list, str]:
    """The fixture weights' layers as whole numbers: pooled times 64 * 32, hidden times 64 * 32 * 16, and the logit
    without its bias times 64 * 32 * 16 * 4."""
    pooled = [f"list_sum(list_transform({x}, lambda i: ((i * 31 + {d * 17}) % 97) - 48))::BIGINT" for d in range(8)]
    hidden = []
    for h in range(8):
        first = [f"({pooled[d]}) * ({(d * 13 + h * 7) % 11 - 5})" for d in range(8)]
        hidden.append(f"greatest({' + '.join(first)} + ({(h % 3 - 1) * 64 * SEQ * 2}), 0)")
    return pooled, hidden, " + ".join(f"{u} * ({(h * 5) % 7 - 3})" for h, u in enumerate(hidden))


def logit(x: str) -> str:
    return f"((({scorer_layers(x)[2]})::DOUBLE) / {64 * SEQ * 16 * 4}.0 + 0.125)"


def score(x: str) -> str:
    """The forward pass for the fixture weights, divided once at the end."""
    return f"(1.0 / (1.0 + exp(-{logit(x)})))"


# ---------------------------------------------------------------- CTE building blocks

ARTICLES = f"""
raw AS (
  SELECT CASE WHEN doc_id % 10 = 8 THEN 'validation' WHEN doc_id % 10 = 9 THEN 'test' ELSE 'train' END AS split,
         doc_id, text
  FROM documents),
raw2 AS (
  SELECT split, split || '-' || CAST(doc_id AS VARCHAR) AS id, CAST(doc_id AS BIGINT) AS pos,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE text END AS article,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE '' END AS highlights
  FROM raw),
articles AS (
  SELECT split, id, pos, {strip("coalesce(article, '')")} AS article, {strip("coalesce(highlights, '')")} AS highlights
  FROM raw2
  WHERE length({strip("coalesce(article, '')")}) > 0),
sents AS (
  SELECT split, id, pos, article, highlights, {sentences('article')} AS sentences FROM articles),
sents2 AS (SELECT * FROM sents WHERE len(sentences) > 0),
flat AS (
  SELECT split, id AS article_id, pos, unnest(sentences) AS sentence,
         unnest(range(len(sentences))) AS sent_index
  FROM sents2)"""

VOCAB = f"""
train_toks AS (SELECT unnest({tokens('sentence')}) AS token FROM flat WHERE split = 'train'),
counts AS (SELECT token, count(*) AS n FROM train_toks GROUP BY token),
top AS (
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token DESC) + 1 AS BIGINT) AS id, CAST(n AS BIGINT) AS n
  FROM counts ORDER BY n DESC, token DESC LIMIT {VOCAB_TOKENS - 2}),
vocab AS (
  SELECT '' AS token, CAST(0 AS BIGINT) AS id, CAST(NULL AS BIGINT) AS n
  UNION ALL SELECT '[UNK]', CAST(1 AS BIGINT), CAST(NULL AS BIGINT)
  UNION ALL SELECT token, id, n FROM top)"""

ENCODE = f"""
stoks AS (SELECT split, article_id, sent_index, {tokens('sentence')}[1:{SEQ}] AS t FROM flat),
ex AS (SELECT split, article_id, sent_index, unnest(t) AS token, unnest(range(len(t))) AS p FROM stoks),
ids AS (
  SELECT ex.split, ex.article_id, ex.sent_index, list(coalesce(v.id, 1) ORDER BY ex.p) AS ids
  FROM ex LEFT JOIN top v ON ex.token = v.token
  GROUP BY ex.split, ex.article_id, ex.sent_index),
enc AS (
  SELECT s.split, s.article_id, s.sent_index, list_resize(coalesce(i.ids, []::BIGINT[]), {SEQ}, 0) AS x
  FROM stoks s LEFT JOIN ids i
    ON s.split = i.split AND s.article_id = i.article_id AND s.sent_index = i.sent_index)"""

SCORED = f"""
scored AS (
  SELECT e.split, e.article_id, e.sent_index, f.sentence, {score('e.x')} AS score
  FROM enc e JOIN flat f ON e.article_id = f.article_id AND e.sent_index = f.sent_index),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY score DESC, sent_index DESC) AS rk
  FROM scored)"""


SUMM = f"""
summ AS (
  SELECT r.split, r.article_id AS id, any_value(s.highlights) AS highlights,
         CAST(any_value(len(s.sentences)) AS BIGINT) AS n_sentences,
         string_agg(CAST(r.sent_index AS VARCHAR), ',' ORDER BY r.sent_index) AS selected_indices,
         string_agg(r.sentence, ' ' ORDER BY r.sent_index) AS summary
  FROM ranked r JOIN sents2 s ON r.article_id = s.id
  WHERE r.rk <= {K}
  GROUP BY r.split, r.article_id)"""


def _alike(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    either = f"(len({a}) + len({b}) - {both})"
    return f"CASE WHEN {either} = 0 THEN 1.0::DOUBLE ELSE {both}::DOUBLE / {either}::DOUBLE END"


def unlike_ctes() -> str:
    """Three rounds of greedy maximal marginal relevance at weight 0.75, one after the other."""
    ctes = [f"""
near1 AS (
  SELECT split, article_id, sent_index, sentence, score, list_distinct({tokens('sentence')}) AS t, 0.0::DOUBLE AS m FROM scored)"""]
    for r in range(1, K + 1):
        ctes.append(f"""
took{r} AS (
  SELECT article_id, sent_index, sentence, t, {r} AS round FROM near{r}
  QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY 0.75::DOUBLE * score - 0.25::DOUBLE * m DESC, sent_index DESC) = 1)""")
        if r < K:
            ctes.append(f"""
near{r + 1} AS (
  SELECT n.split, n.article_id, n.sent_index, n.sentence, n.score, n.t, greatest(n.m, {_alike('n.t', 'p.t')}) AS m
  FROM near{r} n JOIN took{r} p ON n.article_id = p.article_id AND n.sent_index <> p.sent_index)""")
    every = " UNION ALL ".join(f"SELECT article_id, sent_index, sentence, round FROM took{r}" for r in range(1, K + 1))
    return ",".join(ctes) + f""",
took AS ({every})"""


# Learned sentence boundaries: counts by type, their scores, pairs, and the texts with the learned periods hidden.
BOUNDARIES = f"""
doc_words AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS lang, list_transform(list_filter(regexp_split_to_array({stripped('text')}, {q(WS + '+')}),
         lambda w: w <> ''), lambda w: trim(w, {q(chr(34) + "'()[]{},;:!?“”‘’«»")})) AS w
  FROM documents WHERE text IS NOT NULL),
each_word AS MATERIALIZED (
  SELECT lang, w[i] AS w, coalesce(w[i + 1], '') AS next FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words)),
types AS MATERIALIZED (
  SELECT lang, lower(rtrim(w, '.')) AS type, count(*) FILTER (WHERE w LIKE '%.') AS n_with,
         count(*) FILTER (WHERE w NOT LIKE '%.') AS n_without,
         count(*) FILTER (WHERE w LIKE '%.' AND regexp_matches(next, '^[\\p{{Ll}}\\p{{N}}]')) AS n_lower
  FROM each_word WHERE rtrim(w, '.') <> '' GROUP BY ALL),
totals AS (SELECT lang, sum(n_with)::DOUBLE AS dots, sum(n_with + n_without)::DOUBLE AS words FROM types GROUP BY lang),
rated AS (
  SELECT t.*, 2 * (n_with * ln(0.99) + n_without * ln(0.01) - n_with * ln(greatest(dots / words, 1e-12))
                   - n_without * ln(greatest(1 - dots / words, 1e-12)))
         * exp(-(length(replace(type, '.', '')))) * (length(type) - length(replace(type, '.', '')) + 1)
         * power(length(replace(type, '.', ''))::DOUBLE, -n_without) AS score
  FROM types t JOIN totals USING (lang) WHERE n_with >= 3 AND regexp_matches(type, '\\p{{L}}')),
learned AS MATERIALIZED (
  SELECT lang, type, score, n_with, n_lower, n_with >= 5 AND n_lower >= 0.9 * n_with AS never
  FROM rated WHERE score >= 0.3 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, type) <= 400)"""

BOUNDARY_PAIRS = f"""
pairs AS (
  SELECT lang, lower(rtrim(w, '.')) AS type, lower(rtrim(next, '.')) AS next, count(*)::DOUBLE AS k FROM each_word
  WHERE w LIKE '%.' AND rtrim(next, '.') <> '' GROUP BY ALL HAVING count(*) >= 2),
known AS (
  SELECT p.*, (a.n_with + a.n_without)::DOUBLE AS a, (b.n_with + b.n_without)::DOUBLE AS b, words AS n
  FROM pairs p JOIN learned USING (lang, type) JOIN types a ON a.lang = p.lang AND a.type = p.type
  JOIN types b ON b.lang = p.lang AND b.type = p.next JOIN totals t ON t.lang = p.lang),
together AS (
  SELECT lang, type, next, 2 * (
      k * ln(greatest(k / a, 1e-12)) + (a - k) * ln(greatest(1 - k / a, 1e-12))
      + (b - k) * ln(greatest((b - k) / (n - a), 1e-12)) + (n - a - b + k) * ln(greatest(1 - (b - k) / (n - a), 1e-12))
      - k * ln(b / n) - (a - k) * ln(1 - b / n) - (b - k) * ln(b / n) - (n - a - b + k) * ln(1 - b / n)) AS ratio
  FROM known WHERE k / a > b / n),
ends_nothing AS (
  SELECT lang, regexp_escape(type) AS t, CASE WHEN never THEN '' ELSE '[\\p{{Ll}}\\p{{N}}]' END AS ahead FROM learned
  UNION ALL SELECT lang, regexp_escape(type), '(?i:' || regexp_escape(next) || ')(?:$|[^\\p{{L}}\\p{{N}}])' FROM (
    SELECT * FROM together WHERE ratio >= 7.88 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY ratio DESC, type, next) <= 400)),
rules AS (
  SELECT lang, list('(^|[^\\p{{L}}\\p{{N}}.])((?i:' || t || '))\\.(' || {q(WS + '+')} || ahead || ')') AS rule FROM ends_nothing GROUP BY lang),
guarded AS MATERIALIZED (
  SELECT doc_id, list_reduce(list_concat([{stripped('text')}], list_concat(coalesce(rule, []), coalesce(rule, []))),
         lambda acc, p: regexp_replace(acc, p, '\\1\\2' || chr(2) || '\\3', 'g')) AS hidden
  FROM documents d LEFT JOIN rules r ON r.lang = coalesce(d.lang, ''))"""


def f_measure(p: str, r: str) -> str:
    return f"CASE WHEN {p} + {r} > 0 THEN 2.0 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"


def pairs_of(name: str) -> str:
    return f"""
{name} AS MATERIALIZED (SELECT split, id, {rouge_tokens('highlights')} AS rt, {rouge_tokens('summary')} AS ct FROM summ)"""


PAIRS = pairs_of("pairs")


def rouge_n_ctes(n: int) -> str:
    def grams(t):
        return f"list_transform(range(0, len({t}) - {n - 1}), lambda i: array_to_string({t}[i + 1:i + {n}], ' '))"
    return f"""
g{n} AS (SELECT id, {grams('rt')} AS rg, {grams('ct')} AS cg FROM pairs),
gx{n} AS (
  SELECT id, unnest(rg) AS gram, 1 AS r, 0 AS c FROM g{n}
  UNION ALL SELECT id, unnest(cg) AS gram, 0 AS r, 1 AS c FROM g{n}
  UNION ALL SELECT id, NULL AS gram, 0 AS r, 0 AS c FROM g{n}),
per_gram{n} AS (SELECT id, gram, sum(r) AS r, sum(c) AS c FROM gx{n} GROUP BY id, gram),
per_pair{n} AS (
  SELECT id, CAST(sum(least(r, c)) AS BIGINT) AS ov, CAST(sum(r) AS BIGINT) AS nr, CAST(sum(c) AS BIGINT) AS nc
  FROM per_gram{n} GROUP BY id),
rouge{n} AS (SELECT id, ov::DOUBLE / greatest(nc, 1) AS p, ov::DOUBLE / greatest(nr, 1) AS r FROM per_pair{n})"""


def last_places(r: str) -> str:
    """Map of each token of the list ``r`` to the list whose j-th entry is the token's last place up to j (0: none)."""
    return (f"map_from_entries(list_transform(list_distinct({r}), lambda t: struct_pack(k := t, v := "
            f"list_transform(range(1, len({r}) + 1), lambda j: coalesce(list_max(list_filter(range(1, j + 1), "
            f"lambda k: {r}[k] = t)), 0)))))")


def lcs_row(row: str, places: str) -> str:
    """The row of the LCS table after the tokens of ``places`` (their last places): a token at place k of the
    reference continues what the row holds before k."""
    return (f"list_reduce({places}, lambda prev, x: list_transform(range(1, len(prev) + 1), lambda j: greatest(prev[j], "
            f"CASE WHEN x[j] = 0 THEN 0 WHEN x[j] = 1 THEN 1 ELSE prev[x[j] - 1] + 1 END)), {row})")


def token_places(t: str, m: str) -> str:
    return f"list_transform(list_filter({t}, lambda t: map_contains({m}, t)), lambda t: {m}[t])"


ROUGE_L = f"""
places AS MATERIALIZED (SELECT *, {last_places('rt')} AS l FROM pairs),
lcs AS (
  SELECT id, len(rt) AS nr, len(ct) AS nc,
         coalesce({lcs_row("list_transform(range(0, len(rt)), lambda i: 0::BIGINT)", token_places('ct', 'l'))}[len(rt)], 0) AS ov
  FROM places),
rougel AS (SELECT id, CASE WHEN nc > 0 THEN ov::DOUBLE / nc ELSE 0.0 END AS p,
                  CASE WHEN nr > 0 THEN ov::DOUBLE / nr ELSE 0.0 END AS r FROM lcs)"""


def rouge_sql(name: str, blocks: str) -> str:
    return with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, SUMM, PAIRS, blocks, body=f"""
SELECT id, round(p, 6) AS precision, round(r, 6) AS recall, round({f_measure('p', 'r')}, 6) AS fmeasure FROM {name}""")


def _oracle_round(k: int) -> str:
    """State of each article after round k, from that after round k - 1."""
    f = f_measure("p", "r")
    row = lcs_row("s.row", "c.xs")
    return f"""
try{k} AS MATERIALIZED (
  SELECT *, CASE WHEN n > 0 AND m > 0 THEN coalesce(row[m], 0)::DOUBLE / n ELSE 0.0 END AS p,
         CASE WHEN n > 0 AND m > 0 THEN coalesce(row[m], 0)::DOUBLE / m ELSE 0.0 END AS r
  FROM (SELECT c.id, c.sent_index, s.m, s.n + c.n AS n, {row} AS row, s.f AS before, s.chosen
        FROM cand c JOIN state{k - 1} s ON c.id = s.id WHERE NOT list_contains(s.chosen, c.sent_index))),
best{k} AS (
  SELECT * FROM (SELECT *, {f} AS f, row_number() OVER (PARTITION BY id ORDER BY {f} DESC, sent_index) AS place FROM try{k})
  WHERE place = 1 AND f > before),
state{k} AS MATERIALIZED (
  SELECT s.id, s.m, coalesce(b.row, s.row) AS row, coalesce(b.n, s.n) AS n, coalesce(b.f, s.f) AS f,
         CASE WHEN b.id IS NULL THEN s.chosen ELSE list_append(s.chosen, b.sent_index) END AS chosen
  FROM state{k - 1} s LEFT JOIN best{k} b ON s.id = b.id)"""


def stemmed(name: str, source: str, keys: str, col: str) -> str:
    """``source`` with the tokens of its list ``col`` stemmed (``stems`` holds those of over three characters)."""
    return f"""
{name}_x AS (SELECT {keys}, unnest({col}) AS token, unnest(range(len({col}))) AS p FROM {source}),
{name}_s AS (
  SELECT {keys}, list(coalesce(stem, x.token) ORDER BY p) AS stemmed FROM {name}_x x LEFT JOIN stems s ON x.token = s.token
  GROUP BY {keys}),
{name} AS MATERIALIZED (
  SELECT o.* EXCLUDE ({col}), coalesce(stemmed, []::VARCHAR[]) AS {col} FROM {source} o LEFT JOIN {name}_s USING ({keys}))"""


def stems_of(*lists: tuple[str, str]) -> str:
    """``stems`` for the tokens of the list columns given as (table, column)."""
    every = " UNION ALL ".join(f"SELECT unnest({col}) AS token FROM {t}" for t, col in lists)
    return stem_ctes(f"SELECT DISTINCT token FROM ({every}) WHERE length(token) > 3")


def oracle_tokens(end: str = "") -> str:
    return f"""
refs{end} AS (SELECT id, {rouge_tokens('highlights')} AS r FROM sents2),
ctoks{end} AS (SELECT article_id AS id, sent_index, {rouge_tokens('sentence')} AS t FROM flat)"""


ORACLE_ROUNDS = f"""
places AS MATERIALIZED (SELECT id, r, {last_places('r')} AS l FROM refs),
cand AS MATERIALIZED (
  SELECT c.id, c.sent_index, len(c.t) AS n, {token_places('c.t', 'l')} AS xs FROM ctoks c JOIN places p ON c.id = p.id),
state0 AS (
  SELECT id, len(r) AS m, list_transform(range(0, len(r)), lambda i: 0::BIGINT) AS row, 0::BIGINT AS n, 0.0::DOUBLE AS f,
         []::BIGINT[] AS chosen
  FROM places),""" + ",".join(_oracle_round(k) for k in range(1, K + 1)) + f""",
labeled AS (
  SELECT s.split, s.id, s.pos, s.sentences, s.highlights, o.chosen,
         list_transform(range(len(s.sentences)), lambda i: CASE WHEN list_contains(o.chosen, i) THEN 1 ELSE 0 END) AS labels
  FROM sents2 s JOIN state{K} o ON s.id = o.id)"""
ORACLE = oracle_tokens() + "," + ORACLE_ROUNDS
ORACLE_STEMMED = ",".join([
    oracle_tokens("0"), stems_of(("refs0", "r"), ("ctoks0", "t")), stemmed("refs", "refs0", "id", "r"),
    stemmed("ctoks", "ctoks0", "id, sent_index", "t"), ORACLE_ROUNDS])

LEAD = """
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
labeled AS (
  SELECT s.split, s.id, s.pos, s.sentences,
         list_transform(range(len(s.sentences)), lambda i: CASE WHEN g.doc_id IS NOT NULL AND i < 3 THEN 1 ELSE 0 END) AS labels
  FROM sents2 s LEFT JOIN good g ON s.pos = g.doc_id)"""

FLATTENED = """
offs AS (
  SELECT id, coalesce(sum(len(sentences)) OVER (PARTITION BY split ORDER BY pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM labeled),
flattened AS (
  SELECT l.split, CAST(o.off + i AS VARCHAR) AS id, l.sentences[i + 1] AS sentence, CAST(l.labels[i + 1] AS BIGINT) AS label,
         l.id AS article_id, CAST(i AS BIGINT) AS sent_index
  FROM (SELECT *, unnest(range(len(sentences))) AS i FROM labeled) l JOIN offs o ON l.id = o.id)"""


def with_ctes(*blocks: str, body: str) -> str:
    return "WITH " + ",".join(b.strip("\n") for b in blocks) + "\n" + body


def twins() -> dict:
    t = {}
    t["normalize_articles"] = with_ctes(ARTICLES, body="""
SELECT split, id, pos, article, highlights FROM articles""")

    t["split_sentences"] = with_ctes(ARTICLES, body="""
SELECT split, article_id, CAST(sent_index AS BIGINT) AS sent_index, sentence FROM flat""")

    t["standardize_text"] = with_ctes(ARTICLES, body=f"""
SELECT split, article_id, CAST(sent_index AS BIGINT) AS sent_index,
       array_to_string({tokens('sentence')}, ' ') AS tokens,
       CAST(len({tokens('sentence')}) AS BIGINT) AS n_tokens
FROM flat""")

    t["token_counts"] = with_ctes(ARTICLES, VOCAB, body="""
SELECT token, CAST(n AS BIGINT) AS n FROM counts""")

    t["build_vocab"] = with_ctes(ARTICLES, VOCAB, body="""
SELECT token, id, CAST(coalesce(n, 0) AS BIGINT) AS n FROM vocab""")

    t["encode_tokens"] = with_ctes(ARTICLES, VOCAB, ENCODE, body="""
SELECT split, article_id, CAST(sent_index AS BIGINT) AS sent_index, array_to_string(x, ',') AS x FROM enc""")

    t["encode_tokens_joined"] = t["encode_tokens"]
    bucket = "(CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 1000)"
    t["hash_tokens"] = with_ctes(ARTICLES, f"""
ht AS (SELECT split, article_id, sent_index, unnest(t) AS token, unnest(range(len(t))) AS p
       FROM (SELECT *, {tokens('sentence')} AS t FROM flat)),
coded AS (SELECT *, {bucket} AS b, CASE WHEN CAST('0x' || substr(md5(token), 9, 1) AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END AS v FROM ht),
ids AS (SELECT split, article_id, sent_index, list(b + 2 ORDER BY p) FILTER (WHERE p < {SEQ}) AS x FROM coded GROUP BY ALL),
sums AS (SELECT split, article_id, sent_index, b, sum(v) AS v FROM coded GROUP BY ALL),
feats AS (SELECT split, article_id, sent_index, string_agg(b || ':' || v, ',' ORDER BY b) AS features FROM sums GROUP BY ALL)""", body=f"""
SELECT f.split, f.article_id, CAST(f.sent_index AS BIGINT) AS sent_index,
       array_to_string(list_resize(coalesce(x, []::BIGINT[]), {SEQ}, 0), ',') AS x, coalesce(features, '') AS features
FROM flat f LEFT JOIN ids USING (split, article_id, sent_index) LEFT JOIN feats USING (split, article_id, sent_index)""")
    t["hash_collisions"] = with_ctes(ARTICLES, body=f"""
SELECT {bucket} AS bucket, count(DISTINCT token) AS n_tokens, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest({tokens('sentence')}) AS token FROM flat) GROUP BY 1""")
    t["infer_vocab_size"] = with_ctes(ARTICLES, VOCAB, ENCODE, body="""
SELECT CAST(max(list_max(x)) + 1 AS BIGINT) AS vocab_size FROM enc WHERE split = 'train'""")

    t["flatten_stats"] = with_ctes(ARTICLES, VOCAB, body=f"""
SELECT CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS train_sentences,
       CAST(sum(CASE WHEN split = 'validation' THEN 1 ELSE 0 END) AS BIGINT) AS validation_sentences,
       CAST(sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS test_sentences,
       (SELECT CAST(count(*) AS BIGINT) FROM vocab) AS vocab_size,
       CAST({SEQ} AS BIGINT) AS seq_len
FROM flat""")

    t["score_sentences"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, body="""
SELECT split, article_id, CAST(sent_index AS BIGINT) AS sent_index, round(score, 6) AS score FROM scored""")

    t["score_sentences_joined"] = t["score_sentences"]
    t["ml_pipeline"] = t["score_sentences"]

    t["topk_sentences"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, body=f"""
SELECT split, article_id, CAST(sent_index AS BIGINT) AS sent_index, CAST(rk AS BIGINT) AS rank
FROM ranked WHERE rk <= {K}""")

    t["summarize_articles"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, SUMM, body="""
SELECT split, id, n_sentences, selected_indices, summary FROM summ""")

    t["summarize_unlike"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, unlike_ctes(), body="""
SELECT s.split, s.id, CAST(any_value(len(s.sentences)) AS BIGINT) AS n_sentences,
       string_agg(CAST(k.sent_index AS VARCHAR), ',' ORDER BY k.round) AS picked_indices,
       string_agg(CAST(k.sent_index AS VARCHAR), ',' ORDER BY k.sent_index) AS selected_indices,
       string_agg(k.sentence, ' ' ORDER BY k.sent_index) AS summary
FROM took k JOIN sents2 s ON k.article_id = s.id GROUP BY s.split, s.id""")

    t["rouge_tokens"] = with_ctes(ARTICLES, body=f"""
SELECT split, id, array_to_string({rouge_tokens('article')}, ' ') AS tokens,
       CAST(len({rouge_tokens('article')}) AS BIGINT) AS n_tokens
FROM articles""")

    t["rouge1"] = rouge_sql("rouge1", rouge_n_ctes(1))
    t["rouge2"] = rouge_sql("rouge2", rouge_n_ctes(2))
    t["rougeL"] = rouge_sql("rougel", ROUGE_L)
    means = " UNION ALL ".join(
        f"SELECT '{name}' AS metric, count(*) AS n_scored, round(avg({f_measure('x.p', 'x.r')}), 6) AS mean_f "
        f"FROM {cte} x JOIN pairs USING (id) WHERE split = 'test'"
        for name, cte in (("rouge1", "rouge1"), ("rouge2", "rouge2"), ("rougeL", "rougel")))
    t["evaluate_rouge"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, SUMM, PAIRS, rouge_n_ctes(1), rouge_n_ctes(2), ROUGE_L,
                                    body=means)

    stemmed_pairs = ",".join([pairs_of("pairs0"), stems_of(("pairs0", "rt"), ("pairs0", "ct")),
                              stemmed("pairs1", "pairs0", "id", "rt"), stemmed("pairs", "pairs1", "id", "ct")])
    t["evaluate_rouge_stemmed"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, SUMM, stemmed_pairs, rouge_n_ctes(1),
                                            rouge_n_ctes(2), ROUGE_L, body=means)
    t["porter_stem"] = with_ctes(ARTICLES, f"""
said0 AS (SELECT split, id, {rouge_tokens('article')} AS t FROM articles)""", stems_of(("said0", "t")),
                                 stemmed("said", "said0", "id", "t"), body="""
SELECT split, id, array_to_string(t, ' ') AS stems, CAST(len(t) AS BIGINT) AS n_tokens FROM said""")

    listed = "array_to_string({}, ',')"
    for key, block in (("oracle_labels", ORACLE), ("oracle_labels_stemmed", ORACLE_STEMMED)):
        t[key] = with_ctes(ARTICLES, block, body=f"""
SELECT split, id, CAST(len(sentences) AS BIGINT) AS n_sentences, {listed.format('labels')} AS labels,
       {listed.format('chosen')} AS chosen FROM labeled""")
    everything = "SELECT split, id, sentence, label, article_id, sent_index FROM flattened"
    t["flatten_sentences"] = with_ctes(ARTICLES, ORACLE, FLATTENED, body=everything)
    t["labeled_roundtrip"] = t["flatten_sentences"]
    t["read_labeled_strict"] = with_ctes(ARTICLES, LEAD, FLATTENED, body=everything)
    t["flat_roundtrip"] = t["read_labeled_strict"]
    t["read_sentences"] = with_ctes(ARTICLES, body="SELECT sentence, count(*) AS n FROM flat GROUP BY sentence")
    t["regroup_articles"] = with_ctes(ARTICLES, LEAD, body=f"""
SELECT split, id, CAST(len(sentences) AS BIGINT) AS n_sentences, array_to_string(sentences, '|') AS sentences,
       {listed.format('labels')} AS labels FROM labeled""")
    t["vocab_store"] = with_ctes(ARTICLES, VOCAB, ENCODE, body="""
SELECT split, article_id, CAST(sent_index AS BIGINT) AS sent_index, array_to_string(x, ',') AS x FROM enc""")
    t["encoded_store"] = with_ctes(ARTICLES, VOCAB, ENCODE, LEAD, body="""
SELECT e.split, e.article_id, CAST(e.sent_index AS BIGINT) AS sent_index, array_to_string(e.x, ',') AS x,
       CAST(l.labels[e.sent_index + 1] AS BIGINT) AS y
FROM enc e JOIN labeled l ON e.article_id = l.id WHERE e.split = 'validation'""")
    t["cap_sentences"] = with_ctes(ARTICLES, body=f"""
SELECT split, article_id, CAST(sent_index AS BIGINT) AS sent_index, sentence FROM flat WHERE sent_index < {CAP}""")
    t["first_train_sentences"] = with_ctes(ARTICLES, body="""
SELECT article_id, CAST(sent_index AS BIGINT) AS sent_index, sentence FROM flat WHERE split = 'train'
ORDER BY pos, sent_index LIMIT 500""")
    quality = """
y AS (SELECT doc_id, max(quality) AS y FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
scored_y AS (
  SELECT s.split, s.score, y.y FROM scored s JOIN sents2 a ON s.article_id = a.id JOIN y ON a.pos = y.doc_id)"""
    clipped = "least(greatest(score, 1e-7), 1 - 1e-7)"
    t["bce_loss"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, quality, body=f"""
SELECT split, count(*) AS n, round(avg(-(y * ln({clipped}) + (1 - y) * ln(1 - {clipped}))), 6) AS bce
FROM scored_y GROUP BY split""")
    t["accuracy"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, quality, body="""
SELECT split, count(*) AS n, round(avg(CASE WHEN (score > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM scored_y GROUP BY split""")
    t["read_dirty_articles"] = with_ctes(ARTICLES, body="""
SELECT split, CASE pos % 8 WHEN 1 THEN 'fallback' WHEN 2 THEN NULL ELSE id END AS id, article, highlights
FROM articles WHERE pos % 8 NOT IN (0, 3, 4)""")
    t["read_dirty_labeled"] = with_ctes(ARTICLES, body="""
SELECT CASE pos % 4 WHEN 1 THEN article_id WHEN 2 THEN '' ELSE NULL END AS article_id, CAST(sent_index AS BIGINT) AS sent_index, sentence,
       CAST(CASE WHEN pos % 4 = 1 THEN CASE sent_index WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 5 THEN -1 ELSE 0 END
                 WHEN pos % 4 = 2 AND sent_index = 1 THEN 1 ELSE 0 END AS BIGINT) AS label
FROM flat WHERE pos % 4 <> 0""")
    t["reject_table"] = with_ctes(ARTICLES, body="""
SELECT split, CASE pos % 8 WHEN 0 THEN 'malformed' WHEN 3 THEN 'no object' WHEN 4 THEN 'blank' ELSE 'accepted' END AS reason,
       CASE pos % 8 WHEN 0 THEN '{broken ' || id WHEN 3 THEN '[1, 2]' WHEN 4 THEN '  ' ELSE article END AS value,
       count(*) OVER (PARTITION BY pos % 8 IN (0, 3, 4)) AS n
FROM raw2""")
    t["read_whole_text_articles"] = with_ctes(ARTICLES, body="SELECT id, article FROM articles")
    t["aligned_stores"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, LEAD, body="""
SELECT f.split, f.article_id, CAST(f.sent_index AS BIGINT) AS sent_index, f.sentence, array_to_string(e.x, ',') AS x,
       CAST(l.labels[f.sent_index + 1] AS BIGINT) AS label,
       CASE WHEN f.split <> 'validation' THEN round(s.score, 6) END AS score,
       CASE WHEN f.split = 'validation' THEN 'scores' ELSE '' END AS missing
FROM flat f JOIN enc e ON f.article_id = e.article_id AND f.sent_index = e.sent_index
JOIN scored s ON f.article_id = s.article_id AND f.sent_index = s.sent_index JOIN labeled l ON f.article_id = l.id""")
    t["model_roundtrip"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, body="""
SELECT f.article_id, CAST(f.sent_index AS BIGINT) AS sent_index, round(score, 6) AS p_before, round(score, 6) AS p_after, true AS equal
FROM scored s JOIN flat f ON s.article_id = f.article_id AND s.sent_index = f.sent_index
WHERE f.split = 'train' ORDER BY pos, f.sent_index LIMIT 5""")
    t["limit_four_splits"] = """
SELECT split, pos, rank FROM (SELECT source AS split, doc_id AS pos, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank
                              FROM documents) WHERE rank <= 10"""
    t["boundary_type_counts"] = with_ctes(BOUNDARIES, body="SELECT lang, type, n_with, n_without, n_lower FROM types")
    t["learned_abbreviations"] = with_ctes(BOUNDARIES, body="""
SELECT lang, type, round(score, 6) AS score, n_with, n_lower, never FROM learned""")
    t["split_sentences_learned"] = with_ctes(BOUNDARIES, BOUNDARY_PAIRS, body=f"""
SELECT doc_id, sent_index, sentence FROM (
  SELECT doc_id, unnest(s) AS sentence, CAST(unnest(range(len(s))) AS BIGINT) AS sent_index
  FROM (SELECT doc_id, {sentences('hidden', raw=False)} AS s FROM guarded))""")

    t["flatten_ordinals"] = with_ctes(ARTICLES, """
offs AS (
  SELECT id, coalesce(sum(len(sentences)) OVER (PARTITION BY split ORDER BY pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM sents2)""", body="""
SELECT f.split, CAST(o.off + f.sent_index AS VARCHAR) AS id, f.article_id, CAST(f.sent_index AS BIGINT) AS sent_index,
       f.sentence, CAST(0 AS BIGINT) AS label
FROM flat f JOIN offs o ON f.article_id = o.id""")

    t["class_weights"] = """
WITH y AS (SELECT quality AS y FROM labels WHERE doc_id % 10 NOT IN (8, 9)),
c AS (SELECT y AS label, count(*) AS n FROM y GROUP BY y)
SELECT CAST(label AS BIGINT) AS label, CAST(n AS BIGINT) AS n,
       round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 6) AS weight
FROM c"""

    emb = """
ev AS (SELECT vec_id, CAST(unnest(range(len(embedding))) AS BIGINT) AS dim,
              CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
mm AS (SELECT least(min(x), 0.0) AS mn, greatest(max(x), 0.0) AS mx FROM ev),
cal AS (SELECT mn, mx, CASE WHEN mx - mn > 0 THEN (mx - mn) / 255.0 ELSE 1.0 END AS scale FROM mm),
cal2 AS (SELECT mn, mx, scale,
                CAST(greatest(least(round_even(-128.0 - mn / scale, 0), 127.0), -128.0) AS INTEGER) AS zp FROM cal),
qv AS (SELECT vec_id, dim, x,
              CAST(greatest(least(round_even(x / scale + zp, 0), 127.0), -128.0) AS BIGINT) AS q, scale, zp
       FROM ev, cal2),
dq AS (SELECT vec_id, dim, x, q, (q - zp) * scale AS xd FROM qv)"""
    t["calibrate_activations"] = with_ctes(emb, body="""
SELECT 'embedding' AS tensor, round(mn, 6) AS min, round(mx, 6) AS max, round(scale, 9) AS scale,
       CAST(zp AS BIGINT) AS zero_point FROM cal2""")
    pooled, hidden, _ = scorer_layers("x")
    t["calibrate_model"] = with_ctes(ARTICLES, VOCAB, ENCODE, f"""
sample AS MATERIALIZED (
  SELECT x FROM enc WHERE split = 'train'
  ORDER BY md5(concat_ws('-', '0', article_id, CAST(sent_index AS VARCHAR))), article_id, sent_index LIMIT 500),
act AS (
  SELECT 'pooled' AS tensor, unnest([{', '.join(pooled)}]) / {64 * SEQ}.0::DOUBLE AS v FROM sample
  UNION ALL SELECT 'hidden', unnest([{', '.join(hidden)}]) / {64 * SEQ * 16}.0::DOUBLE FROM sample
  UNION ALL SELECT 'logit', {logit('x')} FROM sample),
layer AS (SELECT tensor, least(min(v), 0.0) AS mn, greatest(max(v), 0.0) AS mx FROM act GROUP BY tensor),
grid AS (SELECT *, CASE WHEN mx > mn THEN (mx - mn) / 255.0 ELSE 1.0 END AS scale FROM layer)""", body="""
SELECT tensor, round(mn, 6) AS min, round(mx, 6) AS max, round(scale, 9) AS scale,
       CAST(greatest(least(round_even(-128.0 - mn / scale, 0), 127.0), -128.0) AS BIGINT) AS zero_point FROM grid""")
    t["quantize"] = with_ctes(emb, body="SELECT vec_id, dim, q FROM dq")
    t["dequantize"] = with_ctes(emb, body="SELECT vec_id, dim, round(xd, 6) AS value FROM dq")
    t["quantize_weights"] = """
WITH ev AS (SELECT vec_id, CAST(unnest(range(len(embedding))) AS BIGINT) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
top AS (SELECT dim, max(abs(x)) AS top FROM ev GROUP BY dim),
sc AS (SELECT dim, CASE WHEN top > 0 THEN top / 127.0 ELSE 1.0 END AS scale FROM top)
SELECT vec_id, ev.dim, round(scale, 9) AS scale, CAST(greatest(least(round_even(x / scale, 0), 127.0), -128.0) AS BIGINT) AS q
FROM ev JOIN sc ON ev.dim = sc.dim"""
    t["quantize_weights_model"] = t["quantize_weights"]
    t["quantization_drift"] = with_ctes(emb, body="""
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(power(x - xd, 2)), 9) AS mse, round(corr(x, xd), 6) AS pearson,
       round(max(abs(x - xd)), 6) AS max_abs_err FROM dq""")

    t["calibration_sample"] = with_ctes(ARTICLES, body="""
SELECT article_id, CAST(sent_index AS BIGINT) AS sent_index, sentence FROM flat
WHERE split = 'train'
ORDER BY md5(concat_ws('-', '0', article_id, CAST(sent_index AS VARCHAR))), article_id, sent_index
LIMIT 500""")

    t["read_articles"] = with_ctes(ARTICLES, body="SELECT split, id, article, highlights FROM articles")
    t["read_text_articles"] = with_ctes(ARTICLES, body="SELECT id, article FROM articles")

    t["summarize_stream"] = t["summarize_articles"]
    t["summarize_line_stream"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, SUMM, body="""
SELECT a.split, CASE pos % 8 WHEN 1 THEN 'fallback' WHEN 2 THEN NULL ELSE a.id END AS id, n_sentences, selected_indices, summary
FROM summ JOIN articles a ON a.id = summ.id WHERE pos % 8 NOT IN (0, 3, 4)""")
    t["summarize_text_files"] = with_ctes(ARTICLES, VOCAB, ENCODE, SCORED, SUMM, body="""
SELECT id, n_sentences, selected_indices, summary, true AS timed FROM summ""")

    ranked = """
SELECT split, id, pos, rank FROM (
  SELECT split, id, pos, CAST(row_number() OVER (PARTITION BY split ORDER BY pos) AS BIGINT) AS rank
  FROM articles)"""
    t["limit_per_split"] = with_ctes(ARTICLES, body=f"{ranked} WHERE rank <= 20")
    t["limit_per_split_2000"] = with_ctes(ARTICLES, body=f"{ranked} WHERE rank <= 2000")
    t["limit_per_split_none"] = with_ctes(ARTICLES, body=ranked)
    return t
