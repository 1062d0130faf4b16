"""H1 from JSON lines: byte places, bad lines, stream = batch over several micro-batches, replays and a restart."""

import json
import os
import shutil

import pytest

from gistlet.operators.summarize import summarize_articles
from gistlet.operators.vocab import vocabulary_from_table
from gistlet.plans.fixture_model import fixture_weights
from gistlet.streaming import articles as A

TEXT = "The cat sat down. A dog ran off. Nobody saw it. The end came soon."


def dirty(n, ident=True):
    lines = []
    for i in range(n):
        row = {"id": f"a{i}", "article": f"{TEXT} Número {i} ü.", "highlights": "h"}
        if i % 3 == 1:
            row.pop("id")
        if i % 7 == 2:
            row["id"] = None
        lines.append([json.dumps(row, ensure_ascii=False), "", "  ", "{broken", "[1]", json.dumps(row) + "\r", '{"id": "empty"}'][i % 5 if i % 4 == 0 else 0])
    return lines


def write(path, lines, end="\n"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write("\n".join(lines).encode() + end.encode())


def places(lines):
    """Byte at which each line begins."""
    out, at = [], 0
    for line in lines:
        out.append(at)
        at += len(line.encode()) + 1
    return out


def vocab(spark):
    return vocabulary_from_table(spark.createDataFrame([("", 0), ("[UNK]", 1), ("the", 2), ("cat", 3), ("dog", 4)], "token string, id int"))


@pytest.mark.parametrize("split_bytes", [64, 1000, 1 << 27])
def test_places_are_bytes_whatever_the_input_splits(spark, tmp_path, split_bytes):
    files = {"split=test/x.json": dirty(60), "split=train/x.json": dirty(3), "y.json": ["", "", "{}"], "z.json": []}
    for name, lines in files.items():
        write(str(tmp_path / "in" / name), lines, end="" if name in ("y.json", "z.json") else "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = A.placed_lines(A.line_table(spark, str(tmp_path / "in"))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for name, lines in files.items():
        split = "test" if "test" in name else "train" if "train" in name else None
        want += [(os.path.basename(name), split, at, line) for at, line in zip(places(lines), lines)]
    key = str
    assert sorted(((r.file, r.split, r.place, r.value) for r in got), key=key) == sorted(want, key=key)


def test_lines_are_articles_or_rejected(spark, tmp_path):
    lines = dirty(80)
    write(str(tmp_path / "in" / "split=test" / "x.json"), lines)
    placed = A.placed_lines(A.line_table(spark, str(tmp_path / "in")))
    good = {r.place: r for r in A.articles_of_lines(placed).collect()}
    bad = {r.place: r.reason for r in A.rejected(placed).collect()}
    for at, line in zip(places(lines), lines):
        try:
            row = json.loads(line)
            reason = None if isinstance(row, dict) else "no object"
        except ValueError:
            row, reason = None, "blank" if not line.strip() else "malformed"
        assert bad.get(at) == reason
        if reason is None and row.get("article"):
            assert good[at].id == row.get("id", f"x.json-{at}") and good[at].article == row["article"]
        else:
            assert at not in good


def rows_of(df):
    return sorted(((r.split, r.id or "", r.summary) for r in df.select("split", "id", "summary").collect()))


def test_stream_equals_batch_over_batches_and_a_restart(spark, tmp_path):
    v, wt = vocab(spark), fixture_weights(5)
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for i in range(3):
        write(f"{src}/split=train/f{i}.json", dirty(20 + i))
    A.summarize_lines(spark, src, v, wt, out, ck, max_files_per_trigger=1)
    assert sorted(d for d in os.listdir(out) if d.startswith("batch=")) == ["batch=0", "batch=1", "batch=2"]
    for i in range(3, 5):
        write(f"{src}/split=test/f{i}.json", dirty(25))
    A.summarize_lines(spark, src, v, wt, out, ck, max_files_per_trigger=1)      # goes on where it stopped
    want = rows_of(summarize_articles(A.articles_of_lines(A.placed_lines(A.line_table(spark, src))), v, wt))
    assert len(want) > 60 and rows_of(spark.read.parquet(out)) == want
    # the driver ended after the last batch was written and before it was noted down: the batch runs again
    last = max(int(n) for n in os.listdir(f"{ck}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{ck}/commits/{name}"):
            shutil.move(f"{ck}/commits/{name}", tmp_path / f"taken-{name}")
    A.summarize_lines(spark, src, v, wt, out, ck, max_files_per_trigger=1)
    assert rows_of(spark.read.parquet(out)) == want


def test_a_stream_of_bad_lines_only(spark, tmp_path):
    write(str(tmp_path / "in" / "x.json"), ["{", "", "[]", '{"article": null}'])
    out = str(tmp_path / "out")
    A.summarize_lines(spark, str(tmp_path / "in"), vocab(spark), fixture_weights(5), out, str(tmp_path / "ck"))
    assert spark.read.parquet(out).count() == 0
