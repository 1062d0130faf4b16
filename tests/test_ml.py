"""Stages of Spark ML: the operators behind them, Pipeline, CrossValidator, save and load."""

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import functions as F

from gistlet.operators import ml as M
from gistlet.operators import quantize as Q
from gistlet.operators import vocab as VO


def rows(spark, n=240):
    data = [(i, f"good news {i % 7} again" if i % 3 else f"bad weather {i % 5}, again!", int(i % 3 > 0)) for i in range(n)]
    return spark.createDataFrame(data, "pos INT, sentence STRING, y INT")


def scorer(**kw):
    return M.SentenceScorer(embDim=4, denseUnits=4, maxIter=2, batchSize=16, dropout=0.0, learningRate=0.05, shards=2, seed=1, **kw)


def test_encoder_is_the_operator_and_keeps_rows(spark, tmp_path, monkeypatch):
    df = rows(spark).unionByName(rows(spark, 5)).withColumn("tokens", F.lit(1)).unionByName(
        spark.createDataFrame([(0, None, 1, 1)], "pos INT, sentence STRING, y INT, tokens INT"))
    model = M.SentenceVocabulary(maxTokens=8, seqLen=6, outputCol="ids").fit(df)
    want = sorted(map(str, VO.encode_flat(df, model.vocabulary, ["pos", "y"]).collect()))
    model.save(str(tmp_path / "m"))
    back = M.SentenceEncoder.load(str(tmp_path / "m"))
    assert (back.uid, back.getOutputCol(), back.vocabulary.seq_len) == (model.uid, "ids", 6)
    for limit in (VO.BROADCAST_VOCAB_LIMIT, 1):
        monkeypatch.setattr(VO, "BROADCAST_VOCAB_LIMIT", limit)
        got = back.transform(df)
        assert got.columns == [*df.columns, "ids"]
        assert sorted(map(str, got.select("pos", "y", F.col("ids").alias("x")).collect())) == want


def test_pipeline_fits_saves_loads_and_scores_alike(spark, tmp_path):
    df = rows(spark)
    pipeline = Pipeline(stages=[M.SentenceVocabulary(maxTokens=20, seqLen=8), scorer(seqLen=8)])
    pipeline.save(str(tmp_path / "p"))
    again = Pipeline.load(str(tmp_path / "p"))
    assert again.getStages()[1].getOrDefault("learningRate") == 0.05
    model = again.fit(df)
    assert len(model.stages[1].history) == 2
    model.save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    a, b = ([r.score for r in m.transform(df).orderBy("pos").collect()] for m in (model, back))
    assert a == b and len(a) == 240
    assert BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y").evaluate(back.transform(df)) > 0.9


def test_cross_validation_over_a_stage_parameter(spark, tmp_path):
    s = scorer(seqLen=8)
    pipeline = Pipeline(stages=[M.SentenceVocabulary(maxTokens=20, seqLen=8), s])
    grid = ParamGridBuilder().addGrid(s.learningRate, [1e-6, 0.05]).build()
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, numFolds=2, seed=3,
                        evaluator=BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y"))
    model = cv.fit(rows(spark))
    assert model.avgMetrics[1] > 0.9
    assert model.bestModel.transform(rows(spark)).where("score is null").count() == 0
    model.save(str(tmp_path / "cv"))
    assert np.allclose(CrossValidatorModel.load(str(tmp_path / "cv")).avgMetrics, model.avgMetrics)


def test_baseline_round_trip_with_clashing_columns(spark, tmp_path):
    df = rows(spark).withColumn("words", F.split("sentence", " ")).withColumn("features", F.lit(1)).withColumn("tokens", F.lit("t"))
    model = M.BaselineClassifier(inputCol="words", vocabSize=50).fit(df)
    model.save(str(tmp_path / "b"))
    a, b = (m.transform(df) for m in (model, M.BaselineModel.load(str(tmp_path / "b"))))
    assert a.columns == [*df.columns, "score"]
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y").evaluate(a) == 1.0


def test_quantizer_equals_the_operator_and_leaves_unknown_columns_null(spark, tmp_path):
    values = spark.createDataFrame([(r, c, float((r * 7 + c * 3) % 11 - 5) * (c != 2)) for r in range(6) for c in range(3)],
                                   "row INT, col INT, w DOUBLE")
    model = M.ColumnQuantizer().fit(values)
    model.save(str(tmp_path / "q"))
    back = M.ColumnQuantizerModel.load(str(tmp_path / "q"))
    pick = lambda df: sorted((r.row, r.col, r.scale, r.q) for r in df.collect())
    assert pick(back.transform(values)) == pick(Q.quantize_columns(values, ["col"], "w"))
    new = back.transform(spark.createDataFrame([(0, 9, 1.0)], "row INT, col INT, w DOUBLE")).first()
    assert new.q is None and new.scale is None
