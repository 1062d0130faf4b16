"""Registered queries of the operators, over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gistlet.llm import (decontaminate, exactdedup, hosttext, langid, licenses, packing, pii, prefixtrie, quality, sharding,
                         simhash, urlfilter, vectorcodes)

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), pii.session_key(spark))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"),
                                                            table(spark, sf_dir, "benchmark")))


def op3_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op4_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "number")


def op6_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.hexed(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op9_polynomial_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licensed(licenses.scan(table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_host_suffix_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosttext.main_text(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_feistel_pseudonyms, op2_winnowing, op3_first_fit_packing, op4_byte_network, op5_feistel_shards, op6_bradley_terry,
    op7_url_ratio, op8_simhash_trie, op9_polynomial_dedup, op10_patience_licenses, op11_prefix_trie,
    op12_dual_tree_codes, op13_host_suffix_text, pipeline)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: CRC-32 of an ASCII string, bit by bit.
_CRC32 = ("xor(list_reduce(list_concat([4294967295], list_transform(string_split({}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))), "
          "lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], "
          "lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)")



def _codes_twin() -> str:
    """Four rounds of plain nearest entries over (vector, part, position) rows."""
    near = """a{i} AS MATERIALIZED (SELECT r, k, min(g) AS g FROM
    (SELECT x.r, x.k, b.e, sum((x.x - b.b) * (x.x - b.b))::BIGINT * 256 + b.e AS g
     FROM x JOIN b{i} b ON x.k = b.k AND x.p = b.p GROUP BY x.r, x.k, b.e) GROUP BY r, k)"""
    move = """b{j} AS MATERIALIZED (SELECT b.k, b.e, b.p, coalesce(m.b, b.b) AS b FROM b{i} b LEFT JOIN
    (SELECT x.k, a.g % 256 AS e, x.p, floor(sum(x.x)::DOUBLE / count(*))::BIGINT AS b
     FROM x JOIN a{i} a ON x.r = a.r AND x.k = a.k GROUP BY 1, 2, 3) m ON b.k = m.k AND b.e = m.e AND b.p = m.p)"""
    steps = ",\n".join(near.format(i=i) + ",\n" + move.format(i=i, j=i + 1) for i in range(4)) + ",\n" + near.format(i=4)
    return f"""
WITH v AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r,
                  list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS l
           FROM embeddings WHERE len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
                             AND len(embedding) > 0),
x AS MATERIALIZED (SELECT r, p // w AS k, p % w AS p, l[p + 1] AS x
                   FROM (SELECT r, l, len(l) // 4 AS w, unnest(range(0, len(l))) AS p FROM v)),
b0 AS (SELECT k, r AS e, p, x AS b FROM x WHERE r < 256),
{steps},
sha AS (SELECT sha256(string_agg(b::VARCHAR, ',' ORDER BY k, e, p)) AS s FROM b4),
coded AS (SELECT r, string_agg(printf('%02x', g % 256), '' ORDER BY k) AS code, sum(g // 256)::BIGINT AS error FROM a4 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256
FROM v JOIN coded USING (r), sha"""


ORACLES: dict[str, str] = {
    "op2_winnowing": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n, i, w[i:i + n - 1] AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, grams.n, i FROM grams JOIN win ON grams.g = win.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op9_polynomial_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d""",
    "op11_prefix_trie": f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS l FROM t GROUP BY c),
crc AS (SELECT c, l, {_CRC32.format("CAST(c AS VARCHAR)")} % 6 AS h FROM own),
reb AS (SELECT a.c, list_concat(coalesce(b.l[1:h], []), a.l[h + 1:]) AS l FROM crc a LEFT JOIN own b ON b.c = a.c - a.c % 100),
pre AS (SELECT c, l, d, l[1:d] AS k FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM reb)),
node AS (SELECT k, d, min(c) AS v, count(*) AS n,
                coalesce(sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(l) = d)), sha256('')) AS e
         FROM pre GROUP BY k, d),
kid AS (SELECT k[1:d - 1] AS k, count(*) AS m FROM node WHERE d > 0 GROUP BY 1),
own_values AS (SELECT node.k, d, CASE WHEN m IS NULL THEN 1 ELSE 0 END AS leaf,
                      CASE WHEN d = 0 THEN 0 ELSE (n - 1) * length(node.k[d].x) END AS saved
               FROM node LEFT JOIN kid ON kid.k = node.k),
up AS (SELECT k[1:i] AS k, sum(leaf) AS leaves, sum(saved) AS saved
       FROM (SELECT k, leaf, saved, unnest(range(0, d + 1)) AS i FROM own_values) GROUP BY 1)
SELECT node.v AS conv_id, node.d AS depth, p.v AS parent_conv_id, node.n AS n_convs, coalesce(m, 0) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, node.e AS ends_sha256
FROM node JOIN up ON up.k = node.k LEFT JOIN kid ON kid.k = node.k
LEFT JOIN node p ON node.d > 0 AND p.d = node.d - 1 AND p.k = node.k[1:node.d - 1]""",
    "op12_dual_tree_codes": _codes_twin(),
}
