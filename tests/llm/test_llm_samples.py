"""Samples and thresholds of the models do not leave rows out."""

import numpy as np
import pyarrow as pa
from llm_cases import docs_of, plain

from gistlet.llm import langid, quality
from gistlet.llm.common import text_bytes

SF = "/root/testdata/sf0.01"


def test_language_of_many_copies_of_few_texts_is_learned(spark):
    few = spark.range(40_000).selectExpr("'aa' AS lang", "concat('texte numero ', cast(id % 12 AS string)) AS text")
    many = spark.range(900).selectExpr("'bb' AS lang", "concat('other text ', cast(id AS string)) AS text")
    got = plain(langid.sample(few.unionByName(many)), "lang", "window")
    windows = [bytes(w).strip() for lang, w in got if lang == "aa"]
    assert sorted(windows) == sorted(b"texte numero %d" % i for i in range(12))
    assert sum(lang == "bb" for lang, _ in got) == 600


def test_values_at_a_rank(spark):
    rng = np.random.default_rng(3)
    for values in (rng.normal(0, 1, 500), np.repeat(rng.normal(0, 1, 7), 60), np.append(np.full(50, 1e300), 1e-300), np.zeros(3)):
        df = spark.createDataFrame([(float(v),) for v in values], "s double")
        for k in (0, len(values) // 3, len(values) - 1):
            assert quality.ranked(df, k) == np.sort(values)[k]


def test_quality_threshold_is_the_quantile_of_all_learnable_rows(spark):
    docs, labels = docs_of(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels, per_label=15)
    known = plain(docs.where(quality.learnable()).join(labels.select("doc_id", "quality"), "doc_id"), "text", "quality")
    strengths = model.strengths(quality.features(*text_bytes(pa.array([t for t, _ in known]))))
    assert len(known) > 200 and (strengths < model.threshold).sum() == sum(y == 0 for _, y in known)
