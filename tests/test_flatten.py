"""B6 label alignment, B8 flatten, B9 ordinal ids, D5 stats, E1 limit per split."""

from pyspark.sql import functions as F

from gistlet.operators import flatten as FL
from gistlet.operators.limits import first_n, limit_per_split


def labeled(spark):
    rows = [
        ("train", "t-1", 1, ["a", "b", "c"], [1, 0]),         # labels shorter: pad 0
        ("train", "t-0", 0, ["x"], [0, 1, 1]),                 # labels longer: ignored
        ("train", "t-9", 9, ["p", "q"], None),
        ("test", "s-5", 5, ["m"], [1]),
    ]
    return spark.createDataFrame(rows, "split STRING, id STRING, pos BIGINT, sentences ARRAY<STRING>, labels ARRAY<TINYINT>")


def test_flatten_alignment_and_ordinals(spark):
    flat = {(r["article_id"], r["sent_index"]): r for r in FL.flatten_sentences(labeled(spark)).collect()}
    assert [flat[("t-1", i)]["label"] for i in range(3)] == [1, 0, 0]
    assert flat[("t-0", 0)]["label"] == 0
    assert flat[("t-9", 1)]["label"] == 0
    # ordinal = position in the split in article order (pos): t-0, t-1, t-9
    assert flat[("t-0", 0)]["id"] == "0"
    assert [flat[("t-1", i)]["id"] for i in range(3)] == ["1", "2", "3"]
    assert [flat[("t-9", i)]["id"] for i in range(2)] == ["4", "5"]
    assert flat[("s-5", 0)]["id"] == "0"
    assert flat[("t-1", 2)]["meta"]["sent_index"] == 2


def test_stats(spark):
    flat = FL.flatten_sentences(labeled(spark))
    r = FL.flatten_stats(flat, 2000, 32).first()
    assert (r["train_sentences"], r["validation_sentences"], r["test_sentences"]) == (6, 0, 1)
    assert (r["vocab_size"], r["seq_len"]) == (2000, 32)


def test_limits(spark):
    df = spark.createDataFrame([("train", i) for i in range(10)] + [("test", i) for i in range(3)],
                               "split STRING, pos BIGINT")
    got = limit_per_split(df, 2).orderBy("split", "pos").collect()
    assert [(r["split"], r["pos"]) for r in got] == [("test", 0), ("test", 1), ("train", 0), ("train", 1)]
    assert limit_per_split(df, 0).count() == 13                 # 0 means no limit
    assert [r["pos"] for r in first_n(df.where("split = 'train'"), 3).collect()] == [0, 1, 2]


def test_regroup_is_inverse_of_flatten(spark):
    lab = labeled(spark)
    back = FL.regroup_articles(FL.flatten_sentences(lab))
    got = {r["id"]: (r["sentences"], r["labels"]) for r in back.collect()}
    assert got["t-1"] == (["a", "b", "c"], [1, 0, 0])
    assert got["t-0"] == (["x"], [0])
    assert len(got) == 4


def test_training_requires_train_rows(spark):
    import pytest
    from gistlet.operators.train import ScorerTrainer
    empty = spark.createDataFrame([], "x ARRAY<INT>, y INT")
    with pytest.raises(ValueError):
        ScorerTrainer(vocab_size=5, epochs=1).fit(empty)


def test_stats_written_as_one_json_object(spark):
    from gistlet.session import new_work_path
    from gistlet.sources.jsonl import write_stats
    path = new_work_path(spark, "stats")
    write_stats(FL.flatten_stats(FL.flatten_sentences(labeled(spark)), 2000, 32), path)
    rows = spark.read.json(path).collect()
    assert len(rows) == 1
    assert rows[0].asDict() == {"train_sentences": 6, "validation_sentences": 0, "test_sentences": 1,
                                "vocab_size": 2000, "seq_len": 32}


def expected_ordinals(rows, place):
    """Ordinals of (id, index) when the articles of a split stand in order of ``place``."""
    out, after = {}, {}
    for r in sorted(rows, key=place):
        for i in range(len(r[3])):
            out[r[1], i] = after.get(r[0], 0)
            after[r[0]] = out[r[1], i] + 1
    return out


def ordinals(df):
    return {(r["article_id"], r["sent_index"]): int(r["id"]) for r in FL.flatten_sentences(df).collect()}


SCHEMA = "split STRING, id STRING, pos BIGINT, sentences ARRAY<STRING>, file STRING"


def test_ordinals_of_sparse_positions(spark):
    """Positions anywhere in 64 bits, one split far larger than the other."""
    rows = [("train" if p % 9 else "test", f"a{p}", (p * 7919 % 61) * 10 ** 16 - 3 * 10 ** 17, ["s"] * (p % 4 + 1), "f") for p in range(60)]
    got = ordinals(spark.createDataFrame(rows, SCHEMA).repartition(5).drop("file"))
    assert got == expected_ordinals(rows, lambda r: r[2])


def test_ordinals_over_files_whose_line_numbers_repeat(spark):
    rows = [("train", f"f{f}-{p}", p, ["s"] * ((f + p) % 3 + 1), f"file{f:02}") for f in range(20) for p in range(12)]
    got = ordinals(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got == expected_ordinals(rows, lambda r: (r[4], r[2]))


def test_ordinals_of_articles_at_one_place_do_not_meet(spark):
    rows = [("train", f"a{i % 3}", 5, ["s", "t"], "f") for i in range(9)]
    flat = FL.flatten_sentences(spark.createDataFrame(rows, SCHEMA))
    assert sorted(int(r["id"]) for r in flat.collect()) == list(range(18))


def test_ordinals_scan_the_articles_once(spark):
    df = spark.createDataFrame([("train", "a", 1, ["s"], "f")], SCHEMA)
    plan = FL.add_ordinal_offset(df.withColumn("_n", F.size("sentences")), "_n")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert sum("sentences" in s for s in scans) == 1


def test_limit_without_end_ranks_all(spark):
    df = spark.createDataFrame([("train", i * 3) for i in range(50)] + [("test", 5)], "split STRING, pos BIGINT").repartition(4)
    got = sorted((r["split"], r["pos"], r["rank"]) for r in limit_per_split(df, None).collect())
    assert got == [("test", 5, 1)] + [("train", i * 3, i + 1) for i in range(50)]
