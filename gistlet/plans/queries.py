"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator of the inventory.

Each query reads the given tables (mostly ``documents``) and runs the whole
path from the source table.  Output columns are aliased to the names of the
SQL twins in :mod:`gistlet.plans.sql_twins`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gistlet import config as C
from gistlet.functions.rows import posexplode_rows
from gistlet.functions.text import text_tokens
from gistlet.operators import flatten as FL
from gistlet.operators import summarize as SU
from gistlet.operators import topk as TK
from gistlet.operators import vocab as VO
from gistlet.plans.fixture_model import fixture_weights
from gistlet.plans.sql_twins import VOCAB_TOKENS
from gistlet.sources import corpus

_MADE: dict = {}


def made_once(kind: str, spark: SparkSession, sf_dir: str, make):
    """What ``make()`` gives, made once per application and state of the input files.

    The key holds the files' paths, sizes and times, so changed files are learned from anew.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/documents.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [fs.getFileStatus(path), *fs.listStatus(path)]
    state = tuple((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in files)
    key = (kind, spark.sparkContext.applicationId, sf_dir, state)
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.load_articles(spark, sf_dir)


def sentence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, article_id, pos, sent_index, sentence) for every kept sentence."""
    a = FL.with_sentences(articles(spark, sf_dir)).withColumnRenamed("id", "article_id")
    return posexplode_rows(a, ["split", "article_id", "pos"], "sentences", "sent_index", "sentence")


def vocabulary(spark: SparkSession, sf_dir: str, max_tokens: int = VOCAB_TOKENS) -> VO.Vocabulary:
    """Vocabulary learned from the train split."""
    def fit():
        train = sentence_rows(spark, sf_dir).where(F.col("split") == "train")
        return VO.VocabularyBuilder(max_tokens=max_tokens).fit(train)

    return made_once(f"vocabulary-{max_tokens}", spark, sf_dir, fit)


def weights(spark: SparkSession, sf_dir: str):
    return fixture_weights(vocabulary(spark, sf_dir).size)


def scored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SU.score_articles(articles(spark, sf_dir), vocabulary(spark, sf_dir), weights(spark, sf_dir))


# ------------------------------------------------------------------ queries

def q_normalize_articles(spark, sf_dir):
    return articles(spark, sf_dir).select("split", "id", "pos", "article", "highlights")


def q_split_sentences(spark, sf_dir):
    return sentence_rows(spark, sf_dir).select(
        "split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"), "sentence")


def q_standardize_text(spark, sf_dir):
    s = sentence_rows(spark, sf_dir).withColumn("_t", text_tokens("sentence"))
    return s.select("split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
                    F.array_join("_t", " ").alias("tokens"),
                    F.size("_t").cast("bigint").alias("n_tokens"))


def q_token_counts(spark, sf_dir):
    train = sentence_rows(spark, sf_dir).where(F.col("split") == "train")
    return VO.token_counts(train).select("token", F.col("n").cast("bigint").alias("n"))


def q_build_vocab(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    # Reserved rows carry no count: reported as 0.
    return v.table.select("token", F.col("id").cast("bigint").alias("id"),
                          F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def encoded_flat(spark, sf_dir):
    keys = ["split", "article_id", "sent_index"]
    return VO.encode_flat(sentence_rows(spark, sf_dir), vocabulary(spark, sf_dir), keys)


def q_encode_tokens(spark, sf_dir):
    return encoded_flat(spark, sf_dir).select(
        "split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
        F.array_join("x", ",").alias("x"))


def q_encode_tokens_joined(spark, sf_dir):
    """The same through the join, of which only the first 64 entries are looked up in the row."""
    keys = ["split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index")]
    v = vocabulary(spark, sf_dir)
    rows = sentence_rows(spark, sf_dir).select(*keys, F.array(VO.sentence_tokens(F.col("sentence"), v.seq_len)).alias("tokens"))
    enc = VO.encode_by_join(rows, v, F.col("tokens"), "x", v.seq_len, head=64)
    return enc.select("split", "article_id", "sent_index", F.array_join(F.col("x")[0], ",").alias("x"))


def q_hash_tokens(spark, sf_dir):
    """Hashed ids and signed features of every sentence, in 1000 buckets."""
    from gistlet.operators.hashing import hash_features, hash_ids
    f = F.transform(hash_features(F.col("sentence"), 1000), lambda e: F.concat_ws(":", e["bucket"].cast("string"), e["value"].cast("string")))
    return sentence_rows(spark, sf_dir).select(
        "split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
        F.array_join(hash_ids(F.col("sentence"), 1000, C.SEQ_LEN), ",").alias("x"), F.array_join(f, ",").alias("features"))


def q_hash_collisions(spark, sf_dir):
    """Tokens per bucket, over all sentences."""
    from gistlet.operators.hashing import collisions
    return collisions(sentence_rows(spark, sf_dir), 1000).withColumn("bucket", F.col("bucket").cast("bigint"))


def q_infer_vocab_size(spark, sf_dir):
    return VO.infer_vocab_size(encoded_flat(spark, sf_dir).where(F.col("split") == "train"))


def q_flatten_stats(spark, sf_dir):
    v = vocabulary(spark, sf_dir)
    flat = sentence_rows(spark, sf_dir)
    return FL.flatten_stats(flat, v.size, v.seq_len)


def q_cap_sentences(spark, sf_dir):
    """The optional cap on sentences per article."""
    a = FL.with_sentences(articles(spark, sf_dir), C.SENTENCE_CAP).withColumnRenamed("id", "article_id")
    rows = posexplode_rows(a, ["split", "article_id"], "sentences", "sent_index", "sentence")
    return rows.select("split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"), "sentence")


def q_score_sentences(spark, sf_dir):
    s = scored_articles(spark, sf_dir).withColumnRenamed("id", "article_id")
    return posexplode_rows(s, ["split", "article_id"], "scores", "sent_index", "score").select(
        "split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
        F.round("score", 6).alias("score"))


def q_score_sentences_joined(spark, sf_dir):
    """Scores through a joined embedding, of which only the first 64 rows are broadcast."""
    from gistlet.operators.scorer_join import embedding_table, score_joined
    wt = weights(spark, sf_dir)
    scored = score_joined(encoded_flat(spark, sf_dir), embedding_table(spark, wt), wt, head=64)
    return scored.select("split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
                         F.round("score", 6).alias("score"))


def q_topk_sentences(spark, sf_dir):
    # ranked within each article row, which holds all its scores
    s = scored_articles(spark, sf_dir).withColumnRenamed("id", "article_id")
    s = s.withColumn("top", TK.ranked_indices("scores", C.TOP_K))
    return posexplode_rows(s, ["split", "article_id"], "top", "rank", "sent_index").select(
        "split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
        (F.col("rank") + 1).cast("bigint").alias("rank"))


def summaries(spark, sf_dir):
    return SU.summarize_articles(articles(spark, sf_dir), vocabulary(spark, sf_dir), weights(spark, sf_dir))


def q_summarize_articles(spark, sf_dir):
    s = summaries(spark, sf_dir)
    return s.select("split", "id", F.col("n_sentences").cast("bigint").alias("n_sentences"),
                    _ids_string("selected_indices").alias("selected_indices"), "summary")


def q_summarize_unlike(spark, sf_dir):
    """Summaries by score and unlikeness, of whole articles."""
    from gistlet.operators.redundancy import summarize_unlike
    s = summarize_unlike(articles(spark, sf_dir), vocabulary(spark, sf_dir), weights(spark, sf_dir))
    return s.select("split", "id", F.col("n_sentences").cast("bigint").alias("n_sentences"),
                    _ids_string("picked_indices").alias("picked_indices"),
                    _ids_string("selected_indices").alias("selected_indices"), "summary")


def _limited(spark, sf_dir, n):
    from gistlet.operators.limits import limit_per_split
    a = articles(spark, sf_dir).select("split", "id", "pos")
    return limit_per_split(a, n).select("split", "id", "pos", F.col("rank").cast("bigint").alias("rank"))


def q_limit_per_split(spark, sf_dir):
    return _limited(spark, sf_dir, 20)


def q_limit_four_splits(spark, sf_dir):
    """E1 on splits that are not the usual three: the documents' sources, and none."""
    from gistlet.operators.limits import limit_per_split
    docs = corpus.read_table(spark, sf_dir, "documents").select(F.col("source").alias("split"), F.col("doc_id").alias("pos"))
    return limit_per_split(docs, 10).select("split", "pos", F.col("rank").cast("bigint").alias("rank"))


def q_limit_per_split_2000(spark, sf_dir):
    return _limited(spark, sf_dir, 2000)


def q_limit_per_split_none(spark, sf_dir):
    return _limited(spark, sf_dir, None)


def q_first_train_sentences(spark, sf_dir):
    """The first 500 training sentences in source order."""
    from gistlet.operators.limits import first_n
    train = sentence_rows(spark, sf_dir).where(F.col("split") == "train")
    return first_n(train, 500, ["pos", "sent_index"]).select(
        "article_id", F.col("sent_index").cast("bigint").alias("sent_index"), "sentence")


# ------------------------------------------------------------------ ROUGE

def _ids_string(c):
    return F.array_join(F.transform(c, lambda i: i.cast("string")), ",")


def q_rouge_tokens(spark, sf_dir):
    from gistlet.operators.rouge import rouge_token_col
    a = articles(spark, sf_dir).withColumn("_t", rouge_token_col("article", stem=False))
    return a.select("split", "id", F.array_join("_t", " ").alias("tokens"),
                    F.size("_t").cast("bigint").alias("n_tokens"))


def q_porter_stem(spark, sf_dir):
    from gistlet.operators.rouge import rouge_token_col
    a = articles(spark, sf_dir).withColumn("_t", rouge_token_col("article", stem=True))
    return a.select("split", "id", F.array_join("_t", " ").alias("stems"),
                    F.size("_t").cast("bigint").alias("n_tokens"))


def _rouge_n_query(spark, sf_dir, n):
    from gistlet.operators.rouge import rouge_n, tokenized_pairs
    pairs = tokenized_pairs(summaries(spark, sf_dir), "id", "highlights", "summary", stem=False)
    r = rouge_n(pairs, "id", "ref_tokens", "cand_tokens", n)
    return r.select("id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "fmeasure")])


def q_rouge1(spark, sf_dir):
    return _rouge_n_query(spark, sf_dir, 1)


def q_rouge2(spark, sf_dir):
    return _rouge_n_query(spark, sf_dir, 2)


def q_rougeL(spark, sf_dir):
    from gistlet.operators.rouge import rouge_l_col, tokenized_pairs
    pairs = tokenized_pairs(summaries(spark, sf_dir), "id", "highlights", "summary", stem=False)
    r = pairs.select("id", rouge_l_col("ref_tokens", "cand_tokens").alias("_r"))
    return r.select("id", *[F.round(F.col("_r")[c], 6).alias(c) for c in ("precision", "recall", "fmeasure")])


def labeled_articles(spark, sf_dir, stem: bool = False):
    from gistlet.operators.oracle import oracle_labels
    return oracle_labels(articles(spark, sf_dir), C.ORACLE_K, stem=stem)


def _oracle_query(spark, sf_dir, stem):
    lab = labeled_articles(spark, sf_dir, stem)
    return lab.select("split", "id", F.size("sentences").cast("bigint").alias("n_sentences"),
                      _ids_string("labels").alias("labels"), _ids_string("chosen").alias("chosen"))


def q_oracle_labels(spark, sf_dir):
    return _oracle_query(spark, sf_dir, stem=False)


def q_oracle_labels_stemmed(spark, sf_dir):
    return _oracle_query(spark, sf_dir, stem=True)


def _evaluate_query(spark, sf_dir, stem):
    from gistlet.operators.rouge import mean_f
    test = summaries(spark, sf_dir).where(F.col("split") == "test")
    return mean_f(test, "id", "highlights", "summary", stem=stem).select(
        "metric", "n_scored", F.round("mean_f", 6).alias("mean_f"))


def q_evaluate_rouge(spark, sf_dir):
    return _evaluate_query(spark, sf_dir, stem=False)


def q_evaluate_rouge_stemmed(spark, sf_dir):
    return _evaluate_query(spark, sf_dir, stem=True)


# ------------------------------------------------------------------ flatten, class weights, losses

def _flat_columns(flat):
    return flat.select("split", "id", "sentence", F.col("label").cast("bigint").alias("label"),
                       "article_id", F.col("sent_index").cast("bigint").alias("sent_index"))


def q_flatten_sentences(spark, sf_dir):
    return _flat_columns(FL.flatten_sentences(labeled_articles(spark, sf_dir)))


def q_flatten_ordinals(spark, sf_dir):
    """B8/B9 on unlabeled articles: ordinal ids from the prefix sum over range partitions."""
    return _flat_columns(FL.flatten_sentences(FL.with_sentences(articles(spark, sf_dir))))


def lead_labeled(spark, sf_dir):
    """Articles labeled by a rule on the given tables: the first three sentences of documents of quality 1.
    The list of labels ends there (the flattening fills it up), and is empty for other documents."""
    good = (corpus.read_table(spark, sf_dir, "labels").where("quality = 1")
            .select(F.col("doc_id").alias("_good")).distinct())
    a = FL.with_sentences(articles(spark, sf_dir))
    a = a.join(good, a["pos"] == good["_good"], "left")
    ones = F.transform(F.slice("sentences", 1, 3), lambda s: F.lit(1).cast("tinyint"))
    return a.select("split", "id", "pos", "sentences", F.col("highlights").alias("summary"),
                    F.when(F.col("_good").isNotNull(), ones).otherwise(F.array().cast("array<tinyint>")).alias("labels"))


def q_regroup_articles(spark, sf_dir):
    """Flat sentences back to articles."""
    back = FL.regroup_articles(FL.flatten_sentences(lead_labeled(spark, sf_dir), with_ordinal=False))
    return back.select("split", "id", F.size("sentences").cast("bigint").alias("n_sentences"),
                       F.array_join("sentences", "|").alias("sentences"), _ids_string("labels").alias("labels"))


def q_class_weights(spark, sf_dir):
    from gistlet.operators.train import class_weights
    from gistlet.sources.corpus import read_table, split_of
    lab = read_table(spark, sf_dir, "labels")
    train = lab.where(split_of(F.col("doc_id")) == "train").select(F.col("quality").alias("y"))
    return class_weights(train, "y").select(F.col("label").cast("bigint").alias("label"),
                                            F.col("n").cast("bigint").alias("n"),
                                            F.round("weight", 6).alias("weight"))


def sentence_scores_with_labels(spark, sf_dir):
    """(split, article_id, sent_index, score, y): scores, and the quality label of the sentence's document."""
    lab = corpus.read_table(spark, sf_dir, "labels").where("quality is not null").groupBy("doc_id") \
        .agg(F.max("quality").alias("y"))
    s = scored_articles(spark, sf_dir).select("split", F.col("id").alias("article_id"), "pos", "scores")
    rows = s.join(lab, s["pos"] == lab["doc_id"])
    return posexplode_rows(rows, ["split", "article_id", "y"], "scores", "sent_index", "score")


def q_bce_loss(spark, sf_dir):
    from gistlet.operators.train import bce_loss
    return bce_loss(sentence_scores_with_labels(spark, sf_dir), "score", "y", by="split")


def q_accuracy(spark, sf_dir):
    from gistlet.operators.train import accuracy
    return accuracy(sentence_scores_with_labels(spark, sf_dir), "score", "y", by="split")


# ------------------------------------------------------------------ quantization (embeddings table)

def embedding_values(spark, sf_dir):
    from gistlet.sources.corpus import read_table
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return posexplode_rows(e, ["vec_id"], "embedding", "dim", "x").select(
        "vec_id", F.col("dim").cast("bigint").alias("dim"), F.col("x").cast("double").alias("x"))


def embedding_calibration(spark, sf_dir):
    from gistlet.operators.quantize import calibrate
    return calibrate(embedding_values(spark, sf_dir), "x", "embedding")


def _calib_params(spark, sf_dir):
    # one row, bounded: the two numbers of the affine map
    r = embedding_calibration(spark, sf_dir).first()
    return float(r["scale"]), int(r["zero_point"])


def q_calibrate_activations(spark, sf_dir):
    c = embedding_calibration(spark, sf_dir)
    return c.select("tensor", F.round("min", 6).alias("min"), F.round("max", 6).alias("max"),
                    F.round("scale", 9).alias("scale"), F.col("zero_point").cast("bigint").alias("zero_point"))


def quantized_embeddings(spark, sf_dir):
    from gistlet.operators.quantize import dequantize, quantize
    scale, zp = _calib_params(spark, sf_dir)
    v = embedding_values(spark, sf_dir).withColumn("q", quantize("x", scale, zp))
    return v.withColumn("xd", dequantize("q", scale, zp))


def q_quantize(spark, sf_dir):
    return quantized_embeddings(spark, sf_dir).select("vec_id", "dim", F.col("q").cast("bigint").alias("q"))


def q_dequantize(spark, sf_dir):
    return quantized_embeddings(spark, sf_dir).select("vec_id", "dim", F.round("xd", 6).alias("value"))


def q_quantization_drift(spark, sf_dir):
    from gistlet.operators.quantize import drift
    d = drift(quantized_embeddings(spark, sf_dir), "x", "xd")
    return d.select("n", F.round("mse", 9).alias("mse"), F.round("pearson", 6).alias("pearson"),
                    F.round("max_abs_err", 6).alias("max_abs_err"))


def q_calibration_sample(spark, sf_dir):
    from gistlet.operators.quantize import calibration_sample
    train = sentence_rows(spark, sf_dir).where(F.col("split") == "train")
    s = calibration_sample(train.select("article_id", "sent_index", "sentence"),
                           ["article_id", "sent_index"], C.CALIBRATION_SAMPLES, seed=0)
    return s.select("article_id", F.col("sent_index").cast("bigint").alias("sent_index"), "sentence")


# ------------------------------------------------------------------ sources (round trips)

def q_read_articles(spark, sf_dir):
    from gistlet.session import new_work_path
    from gistlet.sources import jsonl
    raw = corpus.documents_to_raw_articles(
        corpus.read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    path = new_work_path(spark, "raw-articles")
    jsonl.write_raw_articles(raw, path)
    back = jsonl.read_raw_articles(spark, path)
    return back.select("split", "id", "article", "highlights")


def q_read_text_articles(spark, sf_dir):
    from gistlet.session import new_work_path
    from gistlet.sources import jsonl
    path = new_work_path(spark, "text-articles")
    jsonl.write_packed_articles(articles(spark, sf_dir), path)
    return jsonl.read_packed_articles(spark, path).select("id", "article")


def q_read_whole_text_articles(spark, sf_dir):
    """One file for each article."""
    from gistlet.session import new_work_path
    from gistlet.sources import jsonl
    path = new_work_path(spark, "whole-text")
    jsonl.write_text_articles(articles(spark, sf_dir), path)
    return jsonl.read_text_articles(spark, path).select("id", "article")


def q_summarize_text_files(spark, sf_dir):
    """Text articles -> summaries -> summary JSON (T10) -> read back."""
    from gistlet.session import new_work_path
    from gistlet.sources import jsonl
    base = new_work_path(spark, "text-summaries")
    jsonl.write_packed_articles(articles(spark, sf_dir), f"{base}/articles")
    arts = jsonl.read_packed_articles(spark, f"{base}/articles").withColumn("highlights", F.lit(""))
    jsonl.write_summaries(SU.summarize_articles(arts, vocabulary(spark, sf_dir), weights(spark, sf_dir)), f"{base}/summaries")
    back = spark.read.schema(jsonl.SUMMARY_SCHEMA).json(f"{base}/summaries")
    return back.select("id", F.size("scores").cast("bigint").alias("n_sentences"),
                       _ids_string("selected_indices").alias("selected_indices"), "summary",
                       (F.col("inference_elapsed_seconds") > 0).alias("timed"))


def _number_in_id():
    return F.regexp_extract("id", r"-(\d+)$", 1).cast("bigint")


def _through_labeled_files(spark, labeled, read):
    from gistlet.session import new_work_path
    from gistlet.sources import jsonl
    path = new_work_path(spark, "labeled")
    jsonl.write_labeled(labeled, path)
    return _flat_columns(FL.flatten_sentences(read(spark, path).withColumn("pos", _number_in_id())))


def q_labeled_roundtrip(spark, sf_dir):
    from gistlet.sources import jsonl
    return _through_labeled_files(spark, labeled_articles(spark, sf_dir), jsonl.read_labeled)


def q_read_labeled_strict(spark, sf_dir):
    from gistlet.sources import jsonl
    return _through_labeled_files(spark, lead_labeled(spark, sf_dir), jsonl.read_labeled_strict)


def _flat_files(spark, sf_dir):
    from gistlet.session import new_work_path
    from gistlet.sources import jsonl
    path = new_work_path(spark, "flat")
    jsonl.write_flat(FL.flatten_sentences(lead_labeled(spark, sf_dir)), path)
    return path


def q_flat_roundtrip(spark, sf_dir):
    """Flat sentences as JSON and back."""
    from gistlet.sources import jsonl
    back = jsonl.read_flat(spark, _flat_files(spark, sf_dir))
    return _flat_columns(back.withColumn("article_id", F.col("meta.article_id"))
                         .withColumn("sent_index", F.col("meta.sent_index")))


def q_read_sentences(spark, sf_dir):
    """How often each sentence occurs in the flat files."""
    from gistlet.sources import jsonl
    return jsonl.read_sentences(spark, _flat_files(spark, sf_dir)).groupBy("sentence").agg(F.count("*").alias("n"))


def _dirty_files(spark, sf_dir):
    """Raw lines of which some are broken, blank, no object, or without an id or with a null one."""
    from gistlet.session import new_work_path
    raw = corpus.documents_to_raw_articles(corpus.read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kind = F.pmod("pos", F.lit(8))
    body = F.to_json(F.struct("article", "highlights"), {"ignoreNullFields": "false"})
    line = (F.when(kind == 0, F.concat(F.lit("{broken "), F.col("id"))).when(kind == 1, body)
            .when(kind == 2, F.concat(F.lit('{"id": null, '), F.substring(body, F.lit(2), F.length(body))))
            .when(kind == 3, "[1, 2]").when(kind == 4, "  ")
            .otherwise(F.to_json(F.struct("id", "article", "highlights"), {"ignoreNullFields": "false"})))
    path = new_work_path(spark, "dirty")
    raw.select("split", line.alias("value")).write.partitionBy("split").text(path)
    return path


def q_read_dirty_articles(spark, sf_dir):
    """Dirty raw lines, read tolerant."""
    from gistlet.sources import jsonl
    back = jsonl.read_raw_articles(spark, _dirty_files(spark, sf_dir))
    # the fallback holds the file's name, which Spark chooses
    ident = F.when(F.col("id") == F.concat("file", F.lit("-"), F.col("pos")), "fallback").otherwise(F.col("id"))
    return back.select("split", ident.alias("id"), "article", "highlights")


def q_reject_table(spark, sf_dir):
    """Every dirty line, from the table that it went into, with the observed size of that table."""
    from gistlet.session import new_work_path
    from gistlet.sources import jsonl
    out = new_work_path(spark, "sorted-out")
    counts = jsonl.read_with_rejects(spark, _dirty_files(spark, sf_dir), out)
    good = jsonl.accepted_lines(spark, out).select("split", F.lit("accepted").alias("reason"), F.col("article").alias("value"),
                                                   F.lit(counts["accepted"]).cast("bigint").alias("n"))
    bad = jsonl.rejected_lines(spark, out).select("split", "reason", "value", F.lit(counts["rejected"]).cast("bigint").alias("n"))
    return good.unionByName(bad)


def q_read_dirty_labeled(spark, sf_dir):
    """A4: sentences of whole texts with labels as any JSON values, missing ids, null labels and broken lines."""
    from gistlet.session import new_work_path
    from gistlet.sources import jsonl
    a = FL.with_sentences(articles(spark, sf_dir))
    kind = F.pmod("pos", F.lit(4))
    sentences = F.concat(F.lit('"sentences": '), F.to_json("sentences"), F.lit(', "labels": '))
    line = (F.when(kind == 0, F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", "labels": [')))
            .when(kind == 1, F.concat(F.lit('{"id": "'), F.col("id"), F.lit('", '), sentences, F.lit('[1.0, true, 0, 300, "x", -1]}')))
            .when(kind == 2, F.concat(F.lit("{"), sentences, F.lit("[0, 1]}")))
            .otherwise(F.concat(F.lit('{"id": null, '), sentences, F.lit('null, "summary": "s"}'))))
    path = new_work_path(spark, "dirty-labeled")
    a.select(line.alias("value")).write.text(path)
    flat = FL.flatten_sentences(jsonl.read_labeled(spark, path).withColumn("split", F.lit("train")), with_ordinal=False)
    return flat.select("article_id", F.col("sent_index").cast("bigint").alias("sent_index"), "sentence",
                       F.col("label").cast("bigint").alias("label"))


def q_aligned_stores(spark, sf_dir):
    """Sentences, ids, labels and scores, each stored as a table of its own, put together by their key; no scores of
    the validation split are stored."""
    from gistlet.operators.align import aligned, store_aligned
    keys = ["split", "article_id", "sent_index"]
    lab = lead_labeled(spark, sf_dir).withColumnRenamed("id", "article_id")
    labels = F.transform("sentences", lambda s, i: FL.aligned_label(F.col("labels"), i))
    scores = scored_articles(spark, sf_dir).where("split <> 'validation'").withColumnRenamed("id", "article_id")
    tables = {"sentences": sentence_rows(spark, sf_dir).select(*keys, "sentence"),
              "ids": encoded_flat(spark, sf_dir).select(*keys, "x"),
              "labels": posexplode_rows(lab.withColumn("_l", labels), ["split", "article_id"], "_l", "sent_index", "label"),
              "scores": posexplode_rows(scores, ["split", "article_id"], "scores", "sent_index", "score")}
    out = aligned(spark, {label: store_aligned(df) for label, df in tables.items()}, how="outer")
    return out.select("split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"), "sentence",
                      F.array_join("x", ",").alias("x"), F.col("label").cast("bigint").alias("label"),
                      F.round("score", 6).alias("score"), "missing")


# ------------------------------------------------------------------ learned sentence boundaries

def learned_boundaries(spark, sf_dir):
    from gistlet.operators.boundaries import Boundaries
    return made_once("boundaries", spark, sf_dir, lambda: Boundaries.fit(corpus.read_table(spark, sf_dir, "documents")))


def q_boundary_type_counts(spark, sf_dir):
    """Types with and without a period, by language."""
    from gistlet.operators.boundaries import type_counts
    return type_counts(corpus.read_table(spark, sf_dir, "documents"))


def q_learned_abbreviations(spark, sf_dir):
    from gistlet.operators.boundaries import abbreviations, type_counts
    found = abbreviations(type_counts(corpus.read_table(spark, sf_dir, "documents")))
    return found.select("lang", "type", F.round("score", 6).alias("score"), "n_with", "n_lower", "never")


def q_split_sentences_learned(spark, sf_dir):
    """Sentences of whole texts by the rule and what was learned for their language."""
    docs = corpus.read_table(spark, sf_dir, "documents").select(
        "doc_id", learned_boundaries(spark, sf_dir).split("text", "lang").alias("_s"))
    rows = posexplode_rows(docs, ["doc_id"], "_s", "sent_index", "sentence")
    return rows.select("doc_id", F.col("sent_index").cast("bigint").alias("sent_index"), "sentence")


def q_vocab_store(spark, sf_dir):
    """A vocabulary saved, loaded, and used to encode."""
    from gistlet.session import new_work_path
    from gistlet.sources import store
    path = new_work_path(spark, "vocab")
    store.save_vocab(vocabulary(spark, sf_dir), path)
    rows = VO.encode_flat(sentence_rows(spark, sf_dir), store.load_vocab(spark, path), ["split", "article_id", "sent_index"])
    return rows.select("split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
                       F.array_join("x", ",").alias("x"))


def q_encoded_store(spark, sf_dir):
    """Encoded sentences with labels written by split, and one split read back."""
    from gistlet.session import new_work_path
    from gistlet.sources import store
    lab = lead_labeled(spark, sf_dir)
    enc = VO.encode_articles(lab, vocabulary(spark, sf_dir)).withColumnRenamed("id", "article_id")
    labels = F.col("labels")
    z = F.transform("x", lambda x, i: F.struct(x.alias("x"), FL.aligned_label(labels, i).alias("y")))
    rows = posexplode_rows(enc.withColumn("_z", z), ["split", "article_id"], "_z", "sent_index", "_e")
    path = new_work_path(spark, "encoded")
    store.write_encoded(rows.select("split", "article_id", "sent_index", F.col("_e.x").alias("x"), F.col("_e.y").alias("y")), path)
    back = store.read_encoded(spark, path, "validation")
    return back.select("split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
                       F.array_join("x", ",").alias("x"), F.col("y").cast("bigint").alias("y"))


# ------------------------------------------------------------------ training, model, quantized model

def encoded_rows(spark, sf_dir):
    """(split, article_id, pos, sent_index, x): every sentence encoded."""
    a = VO.encode_articles(FL.with_sentences(articles(spark, sf_dir)), vocabulary(spark, sf_dir))
    return posexplode_rows(a.withColumnRenamed("id", "article_id").withColumnRenamed("x", "xs"),
                           ["split", "article_id", "pos"], "xs", "sent_index", "x")


def encoded_labeled(spark, sf_dir):
    """(split, article_id, pos, sent_index, x, y): every sentence encoded, with its oracle label."""
    lab = VO.encode_articles(labeled_articles(spark, sf_dir, stem=True), vocabulary(spark, sf_dir))
    z = lab.select("split", F.col("id").alias("article_id"), "pos",
                   F.arrays_zip(F.col("x").alias("x"), F.col("labels").alias("y")).alias("_z"))
    rows = posexplode_rows(z, ["split", "article_id", "pos"], "_z", "sent_index", "_e")
    return rows.select("split", "article_id", "pos", "sent_index", F.col("_e.x").alias("x"),
                       F.col("_e.y").cast("int").alias("y"))


def trained_model(spark, sf_dir):
    from gistlet.operators.train import ScorerTrainer
    from gistlet.session import new_work_path

    def fit():
        v = vocabulary(spark, sf_dir)
        # labeled once, and read again for the training and the validation rows
        path = new_work_path(spark, "encoded-labeled")
        encoded_labeled(spark, sf_dir).where(F.col("split") != "test").write.partitionBy("split").parquet(path)
        enc = spark.read.parquet(path)
        return ScorerTrainer(vocab_size=v.size, seq_len=v.seq_len, seed=0).fit(
            enc.where(F.col("split") == "train"), enc.where(F.col("split") == "validation"),
            checkpoint_dir=new_work_path(spark, "train-state"))

    return made_once("model", spark, sf_dir, fit)


def q_train_scorer(spark, sf_dir):
    res = trained_model(spark, sf_dir)
    rows = [(int(h["epoch"]), float(h["train_loss"]), h.get("val_loss"), h.get("val_accuracy"),
             bool(h["epoch"] == res.best_epoch)) for h in res.history]
    return spark.createDataFrame(
        rows, "epoch BIGINT, train_loss DOUBLE, val_loss DOUBLE, val_accuracy DOUBLE, best BOOLEAN")


def q_model_roundtrip(spark, sf_dir):
    """Save and load a model, and predict the first 5 train sentences before and after (smoke test)."""
    from gistlet.operators.limits import first_n
    from gistlet.operators.scorer import score_udf
    from gistlet.operators.train import load_weights, save_weights
    from gistlet.session import new_work_path
    wt = weights(spark, sf_dir)
    path = new_work_path(spark, "model")
    save_weights(spark, wt, path)
    wt2 = load_weights(spark, path)
    head = first_n(encoded_rows(spark, sf_dir).where(F.col("split") == "train"), 5, ["pos", "sent_index"])
    out = head.select("article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
                      score_udf(spark, wt)(F.col("x")).alias("before"), score_udf(spark, wt2)(F.col("x")).alias("after"))
    return out.select("article_id", "sent_index", F.round("before", 6).alias("p_before"), F.round("after", 6).alias("p_after"),
                      (F.col("before") == F.col("after")).alias("equal"))


def q_train_baseline(spark, sf_dir):
    from gistlet.operators.train import baseline_probability, losses, train_baseline
    from gistlet.session import new_work_path
    lab = labeled_articles(spark, sf_dir, stem=True).withColumnRenamed("id", "article_id")
    z = F.arrays_zip(F.col("sentences").alias("s"), F.col("labels").alias("y"))
    flat = posexplode_rows(lab.withColumn("_z", z), ["split", "article_id"], "_z", "sent_index", "_e")
    path = new_work_path(spark, "baseline")     # labeled and cut into tokens once: class weights, counts and model read it again
    flat.select("split", "article_id", "sent_index", text_tokens(F.col("_e.s")).alias("tokens"),
                F.col("_e.y").cast("int").alias("y")).write.parquet(path)
    rows = spark.read.parquet(path)
    train = rows.where(F.col("split") == "train")
    path = new_work_path(spark, "baseline-counts")
    VO.token_counts(train, tokens_col="tokens").write.parquet(path)
    counts = spark.read.parquet(path)
    model = train_baseline(train, VO.VocabularyBuilder(max_tokens=VOCAB_TOKENS).fit_counts(counts).size, counts=counts)
    return losses(baseline_probability(model, rows.where(F.col("split") != "train")), "p", "y", by="split")


def sampled_ranges(spark, sf_dir, wt):
    """D8 of a model, on E7's sample of training sentences, of which only those that are chosen are encoded."""
    from gistlet.operators.quantize import activation_ranges, calibration_sample
    from gistlet.session import new_work_path
    keys = ["article_id", "sent_index"]
    train = sentence_rows(spark, sf_dir).where(F.col("split") == "train").select(*keys, "sentence")
    # written, as the planner would move the encoding below the limit and sort all that is encoded
    path = new_work_path(spark, "calibration")
    calibration_sample(train, keys, C.CALIBRATION_SAMPLES, seed=0).write.parquet(path)
    return activation_ranges(VO.encode_flat(spark.read.parquet(path), vocabulary(spark, sf_dir), keys), wt)


def q_calibrate_model(spark, sf_dir):
    """Ranges of a model's own activations, layer by layer."""
    r = sampled_ranges(spark, sf_dir, weights(spark, sf_dir))
    return r.select("tensor", F.round("min", 6).alias("min"), F.round("max", 6).alias("max"), F.round("scale", 9).alias("scale"),
                    F.col("zero_point").cast("bigint").alias("zero_point"))


def quantized_model(spark, sf_dir):
    from gistlet.operators.quantize import QuantizedScorer, layer_grids

    def calibrated():
        wt = trained_model(spark, sf_dir).weights
        return QuantizedScorer(wt, layer_grids(sampled_ranges(spark, sf_dir, wt)))

    return made_once("quantized", spark, sf_dir, calibrated)


def q_quantize_weights(spark, sf_dir):
    """G11 as a table transform: int8 values per column, here of the embeddings as a weight matrix."""
    from gistlet.operators.quantize import quantize_columns
    q = quantize_columns(embedding_values(spark, sf_dir), ["dim"], "x")
    return q.select("vec_id", "dim", F.round("scale", 9).alias("scale"), F.col("q").cast("bigint").alias("q"))


def q_quantize_weights_model(spark, sf_dir):
    """G11 as an ML stage: fitted, saved, loaded, and applied."""
    from gistlet.operators.ml import ColumnQuantizer, ColumnQuantizerModel
    from gistlet.session import new_work_path
    path = new_work_path(spark, "quantizer")
    values = embedding_values(spark, sf_dir)
    ColumnQuantizer(inputCols=["dim"], inputCol="x", outputCol="q").fit(values).save(path)
    q = ColumnQuantizerModel.load(path).transform(values)
    return q.select("vec_id", "dim", F.round("scale", 9).alias("scale"), F.col("q").cast("bigint").alias("q"))


def q_ml_pipeline(spark, sf_dir):
    """G2, G3, G8, A15 as ML stages: a vocabulary fitted and a scorer put behind it, saved, loaded, and every sentence scored."""
    from pyspark.ml import PipelineModel
    from gistlet.operators.ml import SentenceScorerModel, SentenceVocabulary
    from gistlet.session import new_work_path
    rows = sentence_rows(spark, sf_dir)
    encoder = SentenceVocabulary(maxTokens=VOCAB_TOKENS).fit(rows.where(F.col("split") == "train"))
    path = new_work_path(spark, "ml-pipeline")
    PipelineModel([encoder, SentenceScorerModel(fixture_weights(encoder.vocabulary.size))]).save(path)
    scored = PipelineModel.load(path).transform(rows)
    return scored.select("split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
                         F.round("score", 6).alias("score"))


def q_score_quantized(spark, sf_dir):
    from gistlet.operators.quantize import quantized_score_udf
    from gistlet.operators.scorer import score_udf
    wt = trained_model(spark, sf_dir).weights
    qs = quantized_model(spark, sf_dir)
    # scored by article: the ids of a sentence do not become a row of their own
    a = VO.encode_articles(FL.with_sentences(articles(spark, sf_dir)), vocabulary(spark, sf_dir))
    a = a.select("split", F.col("id").alias("article_id"), score_udf(spark, wt, nested=True)(F.col("x")).alias("float"),
                 quantized_score_udf(spark, qs, nested=True)(F.col("x")).alias("quant"))
    rows = posexplode_rows(a, ["split", "article_id"], F.arrays_zip("float", "quant"), "sent_index", "_e")
    return rows.select("split", "article_id", F.col("sent_index").cast("bigint").alias("sent_index"),
                       F.col("_e.float").alias("score_float"), F.col("_e.quant").alias("score_quant"))


def q_model_drift(spark, sf_dir):
    """MSE and Pearson of float vs int8 scores over every sentence, and the mean
    ROUGE F of the summaries each model selects on the test split (the evaluation set)."""
    from gistlet.operators.quantize import drift
    from gistlet.operators.rouge import mean_f
    wt = trained_model(spark, sf_dir).weights
    qs = quantized_model(spark, sf_dir)
    scores = q_score_quantized(spark, sf_dir)
    d = drift(scores, "score_float", "score_quant").first()
    test = articles(spark, sf_dir).where(F.col("split") == "test")
    v = vocabulary(spark, sf_dir)
    rows = [("n_sentences", float(d["n"])), ("mse", d["mse"]), ("pearson", d["pearson"]),
            ("max_abs_err", d["max_abs_err"])]
    for name, model in (("float", wt), ("int8", qs)):
        summ = SU.summarize_articles(test, v, model)
        for r in mean_f(summ, "id", "highlights", "summary", stem=True).collect():
            rows.append((f"{r['metric']}_f_{name}", r["mean_f"]))
    return spark.createDataFrame(rows, "measure STRING, value DOUBLE")


# ------------------------------------------------------------------ streaming

def q_summarize_stream(spark, sf_dir):
    """The documents file replayed as a stream, summarized, sunk to parquet and read back."""
    from gistlet.session import new_work_path
    from gistlet.streaming.summarize import document_stream, run_to_table, summary_stream
    base = new_work_path(spark, "stream")
    docs = document_stream(spark, f"{sf_dir.rstrip('/')}/documents*.parquet")
    run_to_table(summary_stream(docs, vocabulary(spark, sf_dir), weights(spark, sf_dir)), f"{base}/out", f"{base}/checkpoint")
    s = spark.read.parquet(f"{base}/out")
    return s.select("split", "id", F.col("n_sentences").cast("bigint").alias("n_sentences"),
                    _ids_string("selected_indices").alias("selected_indices"), "summary")


def q_summarize_line_stream(spark, sf_dir):
    """H1 on dirty JSON lines: a file for each micro-batch, bad lines dropped, ids from file and byte place."""
    from gistlet.session import new_work_path
    from gistlet.streaming.articles import summarize_lines
    base = new_work_path(spark, "line-stream")
    summarize_lines(spark, _dirty_files(spark, sf_dir), vocabulary(spark, sf_dir), weights(spark, sf_dir), f"{base}/out",
                    f"{base}/checkpoint", max_files_per_trigger=1)
    s = spark.read.parquet(f"{base}/out")
    ident = F.when(F.col("id").rlike(r"\.txt-\d+$"), "fallback").otherwise(F.col("id"))     # the file's name is Spark's choice
    return s.select("split", ident.alias("id"), F.col("n_sentences").cast("bigint").alias("n_sentences"),
                    _ids_string("selected_indices").alias("selected_indices"), "summary")


QUERIES = {
    "summarize_articles": q_summarize_articles,
    "summarize_unlike": q_summarize_unlike,
    "normalize_articles": q_normalize_articles,
    "split_sentences": q_split_sentences,
    "standardize_text": q_standardize_text,
    "token_counts": q_token_counts,
    "build_vocab": q_build_vocab,
    "encode_tokens": q_encode_tokens,
    "encode_tokens_joined": q_encode_tokens_joined,
    "hash_tokens": q_hash_tokens,
    "hash_collisions": q_hash_collisions,
    "infer_vocab_size": q_infer_vocab_size,
    "flatten_stats": q_flatten_stats,
    "score_sentences": q_score_sentences,
    "score_sentences_joined": q_score_sentences_joined,
    "topk_sentences": q_topk_sentences,
    "cap_sentences": q_cap_sentences,
    "limit_per_split": q_limit_per_split,
    "limit_per_split_2000": q_limit_per_split_2000,
    "limit_per_split_none": q_limit_per_split_none,
    "first_train_sentences": q_first_train_sentences,
    "rouge_tokens": q_rouge_tokens,
    "porter_stem": q_porter_stem,
    "rouge1": q_rouge1,
    "rouge2": q_rouge2,
    "rougeL": q_rougeL,
    "oracle_labels": q_oracle_labels,
    "evaluate_rouge": q_evaluate_rouge,
    "oracle_labels_stemmed": q_oracle_labels_stemmed,
    "evaluate_rouge_stemmed": q_evaluate_rouge_stemmed,
    "flatten_sentences": q_flatten_sentences,
    "flatten_ordinals": q_flatten_ordinals,
    "regroup_articles": q_regroup_articles,
    "class_weights": q_class_weights,
    "bce_loss": q_bce_loss,
    "accuracy": q_accuracy,
    "calibrate_activations": q_calibrate_activations,
    "quantize": q_quantize,
    "dequantize": q_dequantize,
    "quantization_drift": q_quantization_drift,
    "calibrate_model": q_calibrate_model,
    "calibration_sample": q_calibration_sample,
    "read_articles": q_read_articles,
    "read_text_articles": q_read_text_articles,
    "summarize_text_files": q_summarize_text_files,
    "labeled_roundtrip": q_labeled_roundtrip,
    "read_labeled_strict": q_read_labeled_strict,
    "flat_roundtrip": q_flat_roundtrip,
    "read_sentences": q_read_sentences,
    "read_dirty_articles": q_read_dirty_articles,
    "read_dirty_labeled": q_read_dirty_labeled,
    "vocab_store": q_vocab_store,
    "encoded_store": q_encoded_store,
    "train_scorer": q_train_scorer,
    "model_roundtrip": q_model_roundtrip,
    "train_baseline": q_train_baseline,
    "quantize_weights": q_quantize_weights,
    "score_quantized": q_score_quantized,
    "summarize_stream": q_summarize_stream,
    "limit_four_splits": q_limit_four_splits,
    "read_whole_text_articles": q_read_whole_text_articles,
    "reject_table": q_reject_table,
    "aligned_stores": q_aligned_stores,
    "boundary_type_counts": q_boundary_type_counts,
    "learned_abbreviations": q_learned_abbreviations,
    "split_sentences_learned": q_split_sentences_learned,
    "model_drift": q_model_drift,
    "quantize_weights_model": q_quantize_weights_model,
    "ml_pipeline": q_ml_pipeline,
    "summarize_line_stream": q_summarize_line_stream,
}
