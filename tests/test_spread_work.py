"""Files made by many tasks, words counted before they are trimmed, training steps that gather no padding."""

import gzip
import os
import re
import tracemalloc

import numpy as np

from gistlet.operators import train as TR
from gistlet.operators.boundaries import pair_counts, type_counts
from gistlet.session import new_work_path
from gistlet.sources import jsonl, textfiles


def test_text_files_of_one_input_split_are_made_by_many_tasks(spark):
    rows = [(f"train-{i}", f"text {i}\nmore") for i in range(40)]
    path = new_work_path(spark, "whole-text")
    jsonl.write_text_articles(spark.createDataFrame(rows, "id STRING, article STRING").coalesce(1), path)
    files = spark.read.text(path).inputFiles()
    assert len(files) == 40 and len({re.search(r"/part-(\d+)", f)[1] for f in files}) > 4
    assert sorted(map(tuple, jsonl.read_text_articles(spark, path).collect())) == sorted(rows)


def test_types_and_pairs_by_hand(spark):
    docs = spark.createDataFrame([("See (Fig. 3) and \"FIG. \" a fig. Next. 'x", "en"), ("Fig.", "en"), ("—. \" .", None), (None, "en")],
                                 "text STRING, lang STRING")
    got = {(r["lang"], r["type"]): (r["n_with"], r["n_without"], r["n_lower"]) for r in type_counts(docs).collect()}
    # the word behind a period may be signs alone: then nothing follows in lower case
    assert got[("en", "fig")] == (4, 0, 1) and got[("en", "next")] == (1, 0, 1) and got[("en", "see")] == (0, 1, 0)
    assert got[("", "—")] == (1, 0, 0) and ("", "") not in got
    learned = spark.createDataFrame([("en", "fig")], "lang STRING, type STRING")
    pairs = {(r["type"], r["next"]): r["n_pair"] for r in pair_counts(docs, learned).collect()}
    assert pairs == {("fig", "3"): 1, ("fig", "next"): 1}


def test_a_step_holds_what_its_tokens_need():
    rng = np.random.default_rng(0)
    wt = TR.init_weights(40, 16, 4, 1, 512)
    x = np.zeros((256, 512), np.int64)
    x[:, :3] = rng.integers(1, 40, (256, 3))
    x[0] = 0
    y, sw = rng.integers(0, 2, 256).astype(float), np.ones(256)
    tracemalloc.start()
    _, grad = TR.loss_and_grads(wt, x, y, sw, 0.0, rng)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * x.nbytes              # with padding gathered it was over 16 times
    p = wt.flat()
    for i in (0, 15, 16 * 7 + 3):
        e = np.zeros_like(p)
        e[i] = 1e-6
        up, down = (TR.loss_and_grads(TR.ScorerWeights.from_flat(p + s * e, 40, 16, 4, 512), x, y, sw, 0.0, rng)[0] for s in (1, -1))
        assert abs((up - down) / 2e-6 - grad[i]) < 1e-6


def test_article_files_of_a_local_folder_are_made_and_read_by_the_tasks(spark, monkeypatch):
    ids = ["007", "d 2", "a/b:c%41+", "é=1", "x.gz", "n" * 250, "", None]
    rows = [(i, f" text {k}\nmore ") for k, i in enumerate(ids)] + [("twice", "one"), ("twice", "one"), ("none", None), ("blank", " ")]
    arts = spark.createDataFrame(rows, "id STRING, article STRING").coalesce(1)
    path = new_work_path(spark, "local-text")
    for _ in range(2):      # the second takes the place of the first
        jsonl.write_text_articles(arts, path)
    # no checksum beside an article's file: those, and their rights, are what a process each was started for
    folder = textfiles.local_folder(spark, path)
    names = [n for _, _, names in os.walk(folder) for n in names]
    assert len(names) == 12 and not [n for n in names if n.endswith(".crc")]
    assert not [n for n in os.listdir(folder) if n != "_SUCCESS" and not re.fullmatch(r"task=\d{5}", n)]
    want = sorted([(i or "__HIVE_DEFAULT_PARTITION__", f"text {k}\nmore") for k, i in enumerate(ids)] + [("twice", "one\none")])
    monkeypatch.setattr(textfiles, "FILES", 1)
    got = jsonl.read_text_articles(spark, path)
    assert sorted(map(tuple, got.collect())) == want and "FileScan" not in got._jdf.queryExecution().toString()
    # as Spark writes and reads it where the files are not local ones, but for names that a codec goes by
    monkeypatch.setattr(textfiles, "local_folder", lambda spark, path: None)
    plain = [r for r in want if r[0] != "x.gz"]
    os.remove(next(os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".id=x.gz.txt")))
    assert sorted(map(tuple, jsonl.read_text_articles(spark, path).collect())) == plain
    jsonl.write_text_articles(arts.where("id is null or id <> 'x.gz'"), path)
    monkeypatch.undo()
    assert sorted(map(tuple, jsonl.read_text_articles(spark, path).collect())) == plain


def test_files_that_no_article_id_names_are_left_to_spark(spark, tmp_path):
    (tmp_path / "id=a").mkdir()
    (tmp_path / "id=a" / "part-0.txt").write_text("text a")
    assert textfiles.article_folders(str(tmp_path)) == [(str(tmp_path / "id=a"), 1)]
    with gzip.open(tmp_path / "id=a" / "b.txt.gz", "wt") as f:
        f.write("text b")
    (tmp_path / "other.txt").write_text("text c")
    assert textfiles.article_folders(str(tmp_path)) is None
    got = sorted(map(tuple, jsonl.read_text_articles(spark, str(tmp_path)).collect()))
    assert got[:2] == [("a", "text a"), ("a", "text b")] and got[2][0].endswith("/other.txt") and got[2][1] == "text c"
