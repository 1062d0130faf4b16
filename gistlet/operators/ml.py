"""The learned operators as stages of ``pyspark.ml``: Params, Pipeline, CrossValidator, save and load.

G2, G3  SentenceVocabulary -> SentenceEncoder       sentences to padded ids
G5, G8  SentenceScorer -> SentenceScorerModel       ids to scores
G6      BaselineClassifier -> BaselineModel         token counts and class-weighted logistic regression
G11     ColumnQuantizer -> ColumnQuantizerModel     int8 weights per column

The stages hold parameters and call the operators of ``vocab``, ``train``, ``scorer`` and ``quantize``; nothing is
computed here. A saved model is the parameters as Spark ML keeps them and one table (or folder) beside them:
the vocabulary, the weights, the scales. All of them add columns and keep every row, repeated ones too.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol, HasMaxIter, HasOutputCol, HasSeed
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
                             MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gistlet import config as C
from gistlet.operators import quantize as Q
from gistlet.operators import train as TR
from gistlet.operators import vocab as VO
from gistlet.operators.scorer import ScorerWeights, score_udf
from gistlet.sources import store


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class _StoredWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage._save_data(self.sparkSession, f"{path}/data")


class _StoredReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage._load_data(self.sparkSession, f"{path}/data")
        return stage


class _StoredModel(Model, MLWritable, MLReadable):
    """A model with data beside its parameters."""

    def write(self) -> MLWriter:
        return _StoredWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StoredReader(cls)


# ------------------------------------------------------------------ vocabulary

class _VocabularyParams(HasInputCol, HasOutputCol):
    maxTokens = _param("maxTokens", "entries of the vocabulary, the two reserved ones among them", TypeConverters.toInt)
    seqLen = _param("seqLen", "ids of a sentence", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(inputCol="sentence", outputCol="x", maxTokens=C.MAX_TOKENS, seqLen=C.SEQ_LEN)


class SentenceVocabulary(Estimator, _VocabularyParams, DefaultParamsWritable, DefaultParamsReadable):
    @keyword_only
    def __init__(self, *, inputCol="sentence", outputCol="x", maxTokens=C.MAX_TOKENS, seqLen=C.SEQ_LEN):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "SentenceEncoder":
        v = VO.VocabularyBuilder(self.getOrDefault("maxTokens"), self.getOrDefault("seqLen"), self.getInputCol()).fit(dataset)
        return self._copyValues(SentenceEncoder(v))


class SentenceEncoder(_StoredModel, _VocabularyParams):
    def __init__(self, vocabulary: VO.Vocabulary | None = None):
        super().__init__()
        self.vocabulary = vocabulary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        v, out = self.vocabulary, self.getOutputCol()
        tokens = F.array(VO.sentence_tokens(F.col(self.getInputCol()), v.seq_len))
        if v.fits:
            return dataset.withColumn(out, VO.in_row_lookup(v, tokens)[0])
        return VO.encode_by_join(dataset, v, tokens, out, v.seq_len).withColumn(out, F.col(out)[0])

    def _save_data(self, spark, path):
        store.save_vocab(self.vocabulary, path)

    def _load_data(self, spark, path):
        self.vocabulary = store.load_vocab(spark, path, self.getOrDefault("seqLen"))


# ------------------------------------------------------------------ scorer

class _ScorerParams(HasInputCol, HasOutputCol):
    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(inputCol="x", outputCol="score")


class SentenceScorer(Estimator, _ScorerParams, HasLabelCol, HasMaxIter, HasSeed, DefaultParamsWritable, DefaultParamsReadable):
    """``maxIter`` epochs of the trainer on the rows whose label is known; ids are those of the encoder's column."""
    vocabSize = _param("vocabSize", "entries of the vocabulary; unset: the largest id plus one", TypeConverters.toInt)
    seqLen = _param("seqLen", "ids of a sentence", TypeConverters.toInt)
    embDim = _param("embDim", "dimensions of the embedding", TypeConverters.toInt)
    denseUnits = _param("denseUnits", "hidden units", TypeConverters.toInt)
    batchSize = _param("batchSize", "rows of a step", TypeConverters.toInt)
    learningRate = _param("learningRate", "step size of Adam", TypeConverters.toFloat)
    dropout = _param("dropout", "share of hidden units left out in a step", TypeConverters.toFloat)
    shards = _param("shards", "replicas that train side by side", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="x", outputCol="score", labelCol="y", maxIter=C.EPOCHS, seed=0, vocabSize=None, seqLen=C.SEQ_LEN,
                 embDim=C.EMB_DIM, denseUnits=C.DENSE_UNITS, batchSize=C.BATCH_SIZE, learningRate=C.LEARNING_RATE, dropout=C.DROPOUT,
                 shards=8):
        super().__init__()
        self._setDefault(labelCol="y", maxIter=C.EPOCHS, seed=0, seqLen=C.SEQ_LEN, embDim=C.EMB_DIM, denseUnits=C.DENSE_UNITS,
                         batchSize=C.BATCH_SIZE, learningRate=C.LEARNING_RATE, dropout=C.DROPOUT, shards=8)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "SentenceScorerModel":
        get = self.getOrDefault
        y = F.col(self.getLabelCol()).cast("int")
        rows = dataset.where(y.isNotNull()).withColumn("x", F.col(self.getInputCol())).withColumn("y", y)
        size = get("vocabSize") if self.isDefined("vocabSize") else int(VO.infer_vocab_size(rows).first()[0] or 1)
        trainer = TR.ScorerTrainer(vocab_size=size, seq_len=get("seqLen"), emb_dim=get("embDim"), dense_units=get("denseUnits"),
                                   dropout=get("dropout"), batch_size=get("batchSize"), epochs=get("maxIter"),
                                   learning_rate=get("learningRate"), seed=get("seed"), shards=get("shards"))
        result = trainer.fit(rows)
        model = self._copyValues(SentenceScorerModel(result.weights))
        model.history = result.history
        return model


class SentenceScorerModel(_StoredModel, _ScorerParams):
    def __init__(self, weights: ScorerWeights | None = None):
        super().__init__()
        self.weights, self.history = weights, []

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), score_udf(dataset.sparkSession, self.weights)(F.col(self.getInputCol())))

    def _save_data(self, spark, path):
        TR.save_weights(spark, self.weights, path)

    def _load_data(self, spark, path):
        self.weights = TR.load_weights(spark, path)


# ------------------------------------------------------------------ baseline

class _BaselineParams(HasInputCol, HasOutputCol):
    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(inputCol="tokens", outputCol="score")


class BaselineClassifier(Estimator, _BaselineParams, HasLabelCol, HasMaxIter, HasSeed, DefaultParamsWritable, DefaultParamsReadable):
    vocabSize = _param("vocabSize", "entries of the vocabulary, the two reserved ones among them", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="tokens", outputCol="score", labelCol="y", maxIter=50, seed=0, vocabSize=C.MAX_TOKENS):
        super().__init__()
        self._setDefault(labelCol="y", maxIter=50, seed=0, vocabSize=C.MAX_TOKENS)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "BaselineModel":
        get = self.getOrDefault
        y = F.col(self.getLabelCol()).cast("int")
        rows = dataset.where(y.isNotNull()).select(F.col(self.getInputCol()).alias("tokens"), y.alias("y"))
        return self._copyValues(BaselineModel(TR.train_baseline(rows, get("vocabSize"), get("maxIter"), get("seed"))))


class BaselineModel(_StoredModel, _BaselineParams):
    def __init__(self, pipeline: PipelineModel | None = None):
        super().__init__()
        self.pipeline = pipeline

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        whole = F.struct("*").alias("_row")         # so that the inner columns meet none of the dataset's
        out = self.pipeline.transform(dataset.select(whole, F.col(self.getInputCol()).alias("tokens")))
        return out.select("_row.*", vector_to_array("probability")[1].alias(self.getOutputCol()))

    def _save_data(self, spark, path):
        self.pipeline.write().save(path)

    def _load_data(self, spark, path):
        self.pipeline = PipelineModel.load(path)


# ------------------------------------------------------------------ int8 weights

class _QuantizerParams(HasInputCols, HasInputCol, HasOutputCol):
    """``inputCols`` name the column of a weight matrix, ``inputCol`` holds its values; ``outputCol`` gets int8 values."""

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(inputCol="w", outputCol="q", inputCols=["col"])


class ColumnQuantizer(Estimator, _QuantizerParams, DefaultParamsWritable, DefaultParamsReadable):
    @keyword_only
    def __init__(self, *, inputCols=None, inputCol="w", outputCol="q"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "ColumnQuantizerModel":
        return self._copyValues(ColumnQuantizerModel(Q.column_scales(dataset, self.getInputCols(), self.getInputCol())))


class ColumnQuantizerModel(_StoredModel, _QuantizerParams):
    """``scales``: a table of the columns and their ``scale``. A value of a column that it lacks gets nulls."""

    def __init__(self, scales: DataFrame | None = None):
        super().__init__()
        self.scales = scales

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.join(self.scales, self.getInputCols(), "left").withColumn(
            self.getOutputCol(), F.when(F.col("scale").isNotNull(), Q.quantize(self.getInputCol(), F.coalesce("scale", F.lit(1.0)), 0)))

    def _save_data(self, spark, path):
        self.scales.write.parquet(path)

    def _load_data(self, spark, path):
        self.scales = spark.read.parquet(path)
