"""JSON-lines, text and summary readers/writers.

A1  read_raw_articles      tolerant line JSON (malformed, blank, array and scalar lines
                           dropped); id falls back to '<file basename>-<0-based line>'
                           with the line count including skipped lines
A2  write_raw_articles     one JSONL set per split (partitionBy split)
A3  write_labeled          labeled articles, nulls kept (ignoreNullFields=false)
A4  read_labeled           tolerant (DROPMALFORMED)
B4  read_with_rejects      one pass into accepted and rejected lines, with counts
A5  read_labeled_strict    strict (FAILFAST): a bad line fails the job
A6  write_flat             flat sentences with nested meta
A11 write_stats            the one-row stats table as JSON
A12 read_text_articles     one article per file (wholetext), stripped; empty files dropped
A13 write_summaries        T10 rows as JSON
A14 read_sentences         ``sentence`` field only, '' when missing, tolerant
"""

from __future__ import annotations

import os
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gistlet.functions.text import default_strip, py_strip
from gistlet.session import new_work_path
from gistlet.sources import textfiles

RAW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("article", T.StringType()),
    T.StructField("highlights", T.StringType()),
])

LABELED_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("sentences", T.ArrayType(T.StringType())),
    T.StructField("labels", T.ArrayType(T.ByteType())),
    T.StructField("summary", T.StringType()),
])

FLAT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("sentence", T.StringType()),
    T.StructField("label", T.ByteType()),
    T.StructField("meta", T.StructType([T.StructField("article_id", T.StringType()),
                                        T.StructField("sent_index", T.IntegerType())])),
])

def _with_type(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f.name, kind if f.name == name else f.dataType) for f in schema.fields])


# As the tolerant readers parse them: any JSON value is a label's text, made a number afterwards.
LABELED_TEXT_SCHEMA = _with_type(LABELED_SCHEMA, "labels", T.ArrayType(T.StringType()))
FLAT_TEXT_SCHEMA = _with_type(FLAT_SCHEMA, "label", T.StringType())

SUMMARY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("selected_indices", T.ArrayType(T.IntegerType())),
    T.StructField("selected_sentences", T.ArrayType(T.StringType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
    T.StructField("inference_elapsed_seconds", T.DoubleType()),
    T.StructField("generated_at", T.StringType()),
])

_CORRUPT = "_corrupt_record"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line, value): every line of every file with its 0-based line number.

    One DataFrame job, any number of files: within a scan split rows keep file order and
    ``monotonically_increasing_id`` is contiguous, so a line's number is the lines of the
    file's earlier splits plus its offset inside its split.  Spark plans the join with the
    per-split table (one row per input split) by its measured size.
    """
    from pyspark.sql import Window

    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"), "value")
    blocks = raw.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    small = blocks.select("_path", "_block", "_first", "_before")
    lines = raw.join(small, ["_path", "_block"])
    split = F.regexp_extract("_path", r"/split=([^/]+)/", 1)
    return lines.select(
        F.regexp_extract("_path", r"([^/]+)$", 1).alias("file"),
        F.when(split != "", split).alias("split"),
        (F.col("_before") + F.col("_mid") - F.col("_first")).cast("bigint").alias("line"),
        "value")


def parsed_line(schema: T.StructType) -> Column:
    """The column ``value`` as a struct of ``schema`` and the corrupt-record field."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    return F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def line_fault() -> Column:
    """Why a line with ``value`` and ``_j`` (its ``parsed_line``) is rejected; null for a good one."""
    return (F.when(F.trim("value") == "", "blank").when(~F.ltrim("value").startswith("{"), "no object")
            .when(F.col("_j").isNull() | F.col(f"_j.{_CORRUPT}").isNotNull(), "malformed"))


def parse_json_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse the ``value`` column; malformed, blank and non-object lines are dropped."""
    # the corrupt-record field is only filled in where it is asked for, whatever else is selected
    ok = (F.col("_j").isNotNull() & F.col(f"_j.{_CORRUPT}").isNull()
          & F.ltrim(F.col("value")).startswith("{"))
    return lines.withColumn("_j", parsed_line(schema)).where(ok)


def read_with_rejects(spark: SparkSession, path: str, out: str, schema: T.StructType = RAW_SCHEMA) -> dict[str, int]:
    """One pass over JSON lines into two tables below ``out``; returns how many lines went into each.

    ``accepted_lines`` reads the parsed lines, ``rejected_lines`` the others with file, line, reason and the line itself.
    The counts are those of the written rows, so whatever columns are asked for later, accepted and rejected
    lines are all lines. (An ``Observation`` would count in the same pass, but a session that has used one can
    no longer send Spark ML's closures to its tasks.)
    """
    lines = numbered_lines(spark, path).withColumn("_j", parsed_line(schema))
    rows = lines.withColumn("reason", line_fault()).withColumn("accepted", F.col("reason").isNull())
    rows = rows.select("file", "split", "line", *[F.when(F.col("accepted"), F.col(f"_j.{f.name}")).alias(f"json_{f.name}") for f in schema.fields],
                       "reason", F.when(~F.col("accepted"), F.col("value")).alias("value"),
                       F.when(F.col("accepted"), "accepted").otherwise("rejected").alias("went"))
    rows.write.partitionBy("went").parquet(out)
    # the folder's name alone: the files' footers know how many rows they hold
    counts = spark.read.parquet(out).groupBy("went").count().collect() if not rows.isEmpty() else []
    return {"accepted": 0, "rejected": 0} | {r["went"]: int(r["count"]) for r in counts}


def accepted_lines(spark: SparkSession, out: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """file, split, line and the fields of the lines that were accepted."""
    rows = spark.read.parquet(out).where("went = 'accepted'")
    return rows.select("file", "split", "line", *[F.col(f"json_{f.name}").alias(f.name) for f in schema.fields])


def rejected_lines(spark: SparkSession, out: str) -> DataFrame:
    """file, split, line, reason (blank, no object, malformed) and text of the lines that were not."""
    return spark.read.parquet(out).where("went = 'rejected'").select("file", "split", "line", "reason", "value")


def _has_key(name: str) -> Column:
    """Whether the line's JSON object has a top-level key, null or not."""
    return F.array_contains(F.json_object_keys("value"), name)


def read_raw_articles(spark: SparkSession, path: str, normalize: bool = True) -> DataFrame:
    """A1 + B1/B2/B5: (split, id, file, pos, article, highlights) from JSONL files.

    ``pos`` is the line in its file, so (file, pos) is an article's place. A missing id becomes
    '<file>-<line>'; one that is null stays null.
    """
    lines = numbered_lines(spark, path)
    p = parse_json_lines(lines, RAW_SCHEMA)
    fallback = F.concat(F.col("file"), F.lit("-"), F.col("line").cast("string"))
    out = p.select(
        F.coalesce(F.col("split"), F.lit("train")).alias("split"),
        F.when(F.col("_j.id").isNull() & ~_has_key("id"), fallback).otherwise(F.col("_j.id")).alias("id"),
        "file",
        F.col("line").alias("pos"),
        F.col("_j.article").alias("article"),
        F.col("_j.highlights").alias("highlights"))
    if not normalize:
        return out
    out = out.select("split", "id", "file", "pos", default_strip("article").alias("article"),
                     default_strip("highlights").alias("highlights"))
    return out.where(F.length("article") > 0)


def write_raw_articles(articles: DataFrame, path: str) -> None:
    """A2: JSONL per split (split=<name>/part-*.json)."""
    (articles.select("split", "id", "article", "highlights")
     .write.mode("overwrite").option("ignoreNullFields", "false")
     .partitionBy("split").json(path))


def write_labeled(labeled: DataFrame, path: str) -> None:
    """A3: T2 rows as JSONL per split; UTF-8, nulls written."""
    (labeled.select("split", "id", "sentences", "labels", "summary")
     .write.mode("overwrite").option("ignoreNullFields", "false")
     .partitionBy("split").json(path))


def _whole(label: Column) -> Column:
    """A JSON label as an integer: numbers are cut to whole ones, true is 1 and false 0; null where it is no number of a byte."""
    return (F.when(label == "true", 1).when(label == "false", 0)
            .otherwise(label.try_cast("double").try_cast("int")).try_cast("tinyint"))


def read_labeled(spark: SparkSession, path: str) -> DataFrame:
    """A4: tolerant read of labeled articles: each line is parsed once, lines that are no JSON object are
    dropped whatever columns are asked for, a missing id is '' and labels may be any JSON number."""
    lines = spark.read.text(path)
    p = parse_json_lines(lines, LABELED_TEXT_SCHEMA)
    labels = F.transform("_j.labels", _whole)
    split = ["split"] if "split" in lines.columns else []
    return p.select(F.when(F.col("_j.id").isNull() & ~_has_key("id"), "").otherwise(F.col("_j.id")).alias("id"),
                    F.col("_j.sentences").alias("sentences"), labels.alias("labels"),
                    F.col("_j.summary").alias("summary"), *split)


def read_labeled_strict(spark: SparkSession, path: str) -> DataFrame:
    """A5: strict read; a malformed line raises when the job runs."""
    return spark.read.schema(LABELED_SCHEMA).option("mode", "FAILFAST").json(path)


def write_flat(flat: DataFrame, path: str) -> None:
    """Flat sentences (id, sentence, label, meta) per split."""
    (flat.select("split", "id", "sentence", "label", "meta")
     .write.mode("overwrite").option("ignoreNullFields", "false")
     .partitionBy("split").json(path))


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    p = parse_json_lines(lines, FLAT_TEXT_SCHEMA)
    split = ["split"] if "split" in lines.columns else []
    return p.select(F.col("_j.id").alias("id"), F.col("_j.sentence").alias("sentence"),
                    _whole(F.col("_j.label")).alias("label"), F.col("_j.meta").alias("meta"), *split)


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """The ``sentence`` field of flat JSONL ('' when missing), bad lines skipped."""
    p = parse_json_lines(spark.read.text(path), T.StructType([T.StructField("sentence", T.StringType())]))
    return p.select(F.coalesce("_j.sentence", F.lit("")).alias("sentence"))


def write_stats(stats: DataFrame, path: str) -> None:
    """One JSON object."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def write_summaries(summaries: DataFrame, path: str) -> None:
    """T10 rows (summary, selected_indices, selected_sentences, scores,
    inference_elapsed_seconds, generated_at) plus the article id.

    ``inference_elapsed_seconds`` is the time that the batch took to compute, measured while it is
    written to the work folder, divided by its articles.
    """
    spark = summaries.sparkSession
    kept = new_work_path(spark, "summaries")
    began = time.monotonic()
    summaries.select("id", "summary", F.col("selected_indices").cast("array<int>").alias("selected_indices"),
                     "selected_sentences", F.col("scores").cast("array<double>").alias("scores")).write.parquet(kept)
    elapsed = time.monotonic() - began
    rows = spark.read.parquet(kept)
    out = rows.select(
        "*", F.lit(elapsed / max(rows.count(), 1)).alias("inference_elapsed_seconds"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"))
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_text_articles(articles: DataFrame, path: str) -> None:
    """One text file per article, named by its id (the whole-text reader's input layout).

    The time goes into making files, not into text: the articles are dealt out to all cores however few input splits
    there are. On a local file system the tasks make the files themselves (``textfiles``); elsewhere Spark does, under
    id=<id>/, and each task moves its own files into place (the committer's algorithm 2) instead of the driver all of them.
    """
    spark = articles.sparkSession
    tasks = 4 * spark.sparkContext.defaultParallelism
    rows = articles.select("id", F.col("article").alias("value")).repartition(tasks, "id")
    folder = textfiles.local_folder(spark, path)
    if folder is not None:
        textfiles.write_files(rows, folder)
        return
    rows.write.mode("overwrite") \
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("id").text(path)


def read_text_articles(spark: SparkSession, path: str) -> DataFrame:
    """(id, article) from one-article-per-file text.  Stripped; empty files dropped.

    The id is the text of the id=<..> folder or that of the article's file, else the file path; it is taken from the path,
    since the folder's value as a partition column would be read as a number where it looks like one. The tasks look a
    local folder's articles up themselves (``textfiles``).
    """
    folder = textfiles.local_folder(spark, path)
    found = textfiles.article_folders(folder) if folder is not None and os.path.isdir(folder) else None
    if found is not None:
        files = textfiles.read_files(spark, found)
    else:
        file = F.col("_metadata.file_path")
        named = F.regexp_extract(file, r"/id=([^/]*)/[^/]*$", 1)
        named = F.when(named != "", named).otherwise(F.regexp_extract(file, r"/part-\d{5,}\.id=([^/]*)\.txt$", 1))
        # the folder's name is escaped, and the path that holds it once more; "+" stands for itself
        plus = F.lit("%2B")
        once = F.url_decode(F.replace(named, F.lit("+"), plus))
        ident = F.when(named != "", F.url_decode(F.replace(once, F.lit("+"), plus))).otherwise(file)
        # looked up without partition columns, which the driver would infer from every folder
        files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(ident.alias("id"), "value")
    out = files.select("id", py_strip("value").alias("article"))
    return out.where(F.length("article") > 0)


# Packed text: records end in RS, id and article are parted by US; ESC and a letter stand for the three.
_RS, _US, _ESC = "\u001e", "\u001f", "\u001b"
_ESCAPES = ((_ESC, "e"), (_RS, "r"), (_US, "u"))


def _escaped(c: Column) -> Column:
    for sign, letter in _ESCAPES:
        c = F.replace(c, F.lit(sign), F.lit(_ESC + letter))
    return c


def _plain(c: Column) -> Column:
    for sign, letter in reversed(_ESCAPES):
        c = F.replace(c, F.lit(_ESC + letter), F.lit(sign))
    return c


def write_packed_articles(articles: DataFrame, path: str) -> None:
    """Many whole-text articles per file, for corpora in which a file each would be too many files."""
    articles.select(F.concat(_escaped(F.col("id")), F.lit(_US), _escaped(F.col("article"))).alias("value")) \
        .write.mode("overwrite").option("lineSep", _RS).text(path)


def read_packed_articles(spark: SparkSession, path: str) -> DataFrame:
    """A12 from packed files: (id, article).  Stripped; empty articles dropped."""
    part = F.split("value", _US, 2)
    rows = spark.read.option("lineSep", _RS).text(path)
    out = rows.select(_plain(part[0]).alias("id"), py_strip(_plain(part[1])).alias("article"))
    return out.where(F.length("article") > 0)
