"""tolerant/strict readers with hand-written edge rows, write/read round trips."""

import os

import pytest
from pyspark.sql import functions as F

from gistlet.session import new_work_path
from gistlet.sources import jsonl

EDGE_LINES = [
    '{"id": "a1", "article": "  First one. Second one!  ", "highlights": "First."}',
    'this is not json',
    '',
    '{"article": "No id here.", "highlights": "x"}',
    '{"id": "a3", "article": "Missing highlights."}',
    '{"id": "a4", "article": null, "highlights": "h"}',
    '[1, 2]',
    '5',
    '{"id": "a5", "article": " \\t\\u00a0 ", "highlights": "h"}',
    '{"id": "a6", "article": "\\u00a0Accented \\u00c9cole.\\u00a0", "highlights": "\\u3000h\\u3000"}',
]


def write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_tolerant_reader_edge_rows(spark):
    base = new_work_path(spark, "edge").replace("file:", "")
    write_lines(f"{base}/split=train", "train.jsonl", EDGE_LINES)
    rows = {r["id"]: r for r in jsonl.read_raw_articles(spark, base).collect()}
    assert set(rows) == {"a1", "train.jsonl-3", "a3", "a6"}
    assert rows["a1"]["article"] == "First one. Second one!"
    assert rows["a1"]["split"] == "train" and rows["a1"]["pos"] == 0
    assert rows["a3"]["highlights"] == ""
    assert rows["a6"]["article"] == "Accented École." and rows["a6"]["highlights"] == "h"
    assert rows["a1"]["file"] == "train.jsonl"


def test_strict_reader_fails_and_tolerant_skips(spark):
    base = new_work_path(spark, "labeled").replace("file:", "")
    good = '{"id": "x", "sentences": ["A.", "B."], "labels": [1], "summary": "A."}'
    write_lines(base, "test_labeled.jsonl", [good, "{broken"])
    assert jsonl.read_labeled(spark, base).count() == 1
    with pytest.raises(Exception):
        jsonl.read_labeled_strict(spark, base).collect()


def test_text_articles_roundtrip(spark):
    names = ["007", "d 2", "a/b:c%41+", "é=1"]
    arts = spark.createDataFrame([(n, f"Line one of {n}.\nLine two.") for n in names], "id STRING, article STRING")
    path = new_work_path(spark, "text")
    jsonl.write_text_articles(arts, path)
    back = {r["id"]: r["article"] for r in jsonl.read_text_articles(spark, path).collect()}
    assert back == {n: f"Line one of {n}.\nLine two." for n in names}


def test_summary_writer_keeps_nulls(spark):
    df = spark.createDataFrame([("i", "S.", [0], ["S."], [0.5])],
                               "id STRING, summary STRING, selected_indices ARRAY<INT>, "
                               "selected_sentences ARRAY<STRING>, scores ARRAY<DOUBLE>")
    path = new_work_path(spark, "summ")
    jsonl.write_summaries(df.withColumn("scores", F.lit(None).cast("array<double>")), path)
    r = spark.read.schema(jsonl.SUMMARY_SCHEMA).json(path).first()
    assert "\"scores\":null" in spark.read.text(path).first()["value"]
    assert 0 < r["inference_elapsed_seconds"] < 600 and len(r["generated_at"]) == 19


def test_vocab_and_encoded_store(spark):
    from gistlet.operators.vocab import VocabularyBuilder
    from gistlet.sources import store
    s = spark.createDataFrame([("a b b c",), ("b c",)], "sentence STRING")
    v = VocabularyBuilder(max_tokens=10).fit(s)
    path = new_work_path(spark, "vocab")
    store.save_vocab(v, path)
    assert store.load_vocab(spark, path).tokens == v.tokens == ["", "[UNK]", "b", "c", "a"]
    enc = spark.createDataFrame([("train", "t-1", 0, [2, 3] + [0] * 30, 1), ("test", "s-1", 0, [0] * 32, 0)],
                                "split STRING, article_id STRING, sent_index INT, x ARRAY<INT>, y INT")
    epath = new_work_path(spark, "enc")
    store.write_encoded(enc, epath)
    got = store.read_encoded(spark, epath, "train").collect()
    assert len(got) == 1 and got[0]["x"][:3] == [2, 3, 0] and got[0]["y"] == 1
    assert store.read_encoded(spark, epath, "validation").count() == 0      # missing split is fine


def test_flat_writer_roundtrip(spark):
    from gistlet.operators.flatten import flatten_sentences
    lab = spark.createDataFrame([("train", "t-0", 0, ["A.", "B."], [1])],
                                "split STRING, id STRING, pos BIGINT, sentences ARRAY<STRING>, labels ARRAY<TINYINT>")
    path = new_work_path(spark, "flat")
    jsonl.write_flat(flatten_sentences(lab), path)
    back = sorted((r["id"], r["sentence"], r["label"], r["meta"]["sent_index"]) for r in jsonl.read_flat(spark, path).collect())
    assert back == [("0", "A.", 1, 0), ("1", "B.", 0, 1)]
    assert sorted(r["sentence"] for r in jsonl.read_sentences(spark, path).collect()) == ["A.", "B."]


def test_line_numbers_span_input_splits(spark):
    """Line numbers stay file positions when one file is read as several splits."""
    base = new_work_path(spark, "lines").replace("file:", "")
    lines = [f'{{"id": "r{i}", "article": "Text {i}.", "highlights": ""}}' if i % 7 else "bad line" for i in range(3000)]
    write_lines(f"{base}/split=test", "big.jsonl", lines)
    write_lines(f"{base}/split=train", "small.jsonl", ['{"article": "A."}', "", '{"article": "B."}'])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = {(r["file"], r["line"]): r["value"] for r in jsonl.numbered_lines(spark, base).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(got[("big.jsonl", i)] == lines[i] for i in range(3000))
    rows = {r["id"]: r for r in jsonl.read_raw_articles(spark, base).collect()}
    assert rows["small.jsonl-0"]["article"] == "A." and rows["small.jsonl-2"]["article"] == "B."
    assert rows["r1"]["pos"] == 1 and "r7" not in rows and rows["r1"]["split"] == "test"


def test_packed_articles_keep_any_text(spark):
    texts = ["a\nb", "rs \x1e us \x1f esc \x1b end", "\x1be \x1br \x1bu", "\\x", "é日本", "x" * 5000]
    arts = spark.createDataFrame([(f"00{i}", t) for i, t in enumerate(texts)] + [("empty", " \n ")], "id STRING, article STRING")
    path = new_work_path(spark, "packed")
    jsonl.write_packed_articles(arts.repartition(2), path)
    back = {r["id"]: r["article"] for r in jsonl.read_packed_articles(spark, path).collect()}
    assert back == {f"00{i}": t for i, t in enumerate(texts)}


def test_null_id_stays_null_and_missing_id_is_made_up(spark):
    base = new_work_path(spark, "ids").replace("file:", "")
    write_lines(f"{base}/split=train", "t.jsonl", ['{"id": null, "article": "A."}', '{"article": "B."}', '{"id": "x", "article": "C."}'])
    got = {r["article"]: r["id"] for r in jsonl.read_raw_articles(spark, base).collect()}
    assert got == {"A.": None, "B.": "t.jsonl-1", "C.": "x"}


def test_labels_of_any_number_are_read_whole(spark):
    base = new_work_path(spark, "any-labels").replace("file:", "")
    write_lines(base, "l.jsonl", ['{"id": "a", "sentences": ["A.", "B."], "labels": [1.0, 0]}',
                                  '{"id": "b", "sentences": ["A."], "labels": [true]}', "{broken", "", "[1]",
                                  '{"sentences": ["A."], "labels": [1]}', '{"id": null, "sentences": [], "labels": null}'])
    df = jsonl.read_labeled(spark, base)
    got = sorted((str(r["id"]), r["labels"]) for r in df.collect())
    assert got == [("", [1]), ("None", None), ("a", [1, 0]), ("b", [1])]
    assert df.select("id").count() == df.count() == df.select("labels").count() == 4
    write_lines(f"{base}/flat", "f.jsonl", ['{"id": "0", "sentence": "A.", "label": 1.0, "meta": {"article_id": "a", "sent_index": 0}}',
                                            '{"id": "1", "label": false}', "nothing"])
    flat = jsonl.read_flat(spark, f"{base}/flat")
    assert sorted((r["id"], r["label"]) for r in flat.collect()) == [("0", 1), ("1", 0)] and flat.select("id").count() == 2
    assert sorted(r[0] for r in jsonl.read_sentences(spark, f"{base}/flat").collect()) == ["", "A."]


def test_sizes_with_units_are_no_matter(spark):
    base = new_work_path(spark, "units").replace("file:", "")
    write_lines(f"{base}/split=train", "t.jsonl", ['{"id": "x", "article": "C."}'])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("64m", "64MB", "128mb", "1048576"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert jsonl.read_raw_articles(spark, base).count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


class Master:
    """What work_dir asks of a session."""

    def __init__(self, master, named=None):
        self.sparkContext = self
        self.master, self.named, self.applicationId = master, named, f"test-{master}"
        self.conf = self

    def getCheckpointDir(self):
        return self.named

    def get(self, key, default):
        return default


def test_cluster_without_a_shared_folder_is_an_error():
    from gistlet.session import work_dir
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(ValueError):
            work_dir(Master(master))
        assert work_dir(Master(master, "hdfs://shared/x")) == "hdfs://shared/x"
    for master in ("local", "local[4]", "local[*]"):
        assert os.path.isdir(work_dir(Master(master)))


def test_no_shuffle_key_comes_from_a_row_number():
    """monotonically_increasing_id only where its value is written before it is used, or inside one scan."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = []
    for d, parts, files in os.walk(os.path.join(top, "gistlet")):
        parts[:] = [x for x in parts if x != "llm"]         # has its own test
        found += [f for f in files if f.endswith(".py") and "monotonically_increasing_id()" in open(os.path.join(d, f)).read()]
    assert sorted(found) == ["jsonl.py", "scorer_join.py", "vocab.py"]
