"""Pipeline stages of our own, saved and loaded with the model: training codes of text (M1, X1), the encoder (P3-P9), the scaler.

With them a saved ``PipelineModel`` takes raw encounter records, so serving can't use other codes, maps or statistics than
training did. All of them are DataFrame expressions and joins; nothing runs in Python at scoring time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.functions.encode import encode_features, in_pieces
from carepulse.operators.clean import code_columns, text_code_dictionary
from carepulse.schemas import FEATURE_COLUMNS, UNMAPPED_TEXT_COLUMNS, quote


# --- M5, X2: the scaler ------------------------------------------------------
class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits mean and population deviation of each input column in one aggregation."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: list(v) for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        names = self.getInputCols()
        numbers = dataset.select(*[F.col(quote(c)).cast("double").alias(f"_n{i}") for i, c in enumerate(names)])
        vectors = VectorAssembler(inputCols=numbers.columns, outputCol="_numbers", handleInvalid="keep").transform(numbers)
        row = vectors.groupBy(F.lit(0).alias("all")).agg(Summarizer.metrics("count", "mean", "variance").summary(F.col("_numbers")).alias("s")).first()  # none without rows
        n = row["s"]["count"] if row else 0
        means = [float(x) for x in row["s"]["mean"]] if row else [0.0] * len(names)
        deviations = [math.sqrt(float(x) * (n - 1) / n) for x in row["s"]["variance"]] if row else [0.0] * len(names)
        holed = [i for i in range(len(names)) if not math.isfinite(means[i] + deviations[i])]  # with missing values (NaN in a vector): few columns by themselves
        if holed:
            exact = numbers.agg(*[F.avg(f"_n{i}").alias(f"m{i}") for i in holed], *[F.stddev_pop(f"_n{i}").alias(f"s{i}") for i in holed]).first()
            for i in holed:
                means[i], deviations[i] = float(exact[f"m{i}"] or 0.0), float(exact[f"s{i}"] or 0.0)
        model = PopulationScalerModel()
        model._set(inputCols=names, outputCols=self.getOutputCols(), means=means, deviations=deviations)
        return model


class PopulationScalerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / deviation into the output columns; a column without deviation becomes 0. Its statistics are parameters."""

    means = Param(Params._dummy(), "means", "mean of each column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviation of each column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names, outs = self.getInputCols(), self.getOutputCols()
        own = [F.col(quote(c)).cast("double") for c in names]
        scaled = [F.when(x.isNotNull(), 0.0) if d == 0 else (x - m) / d for x, m, d in zip(own, self.getOrDefault(self.means), self.getOrDefault(self.deviations))]
        return dataset.select("*", *[x.alias(out) for out, x in zip(outs, in_pieces(scaled))])


# --- M1, X1: training codes --------------------------------------------------
class TextCoder(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a dictionary (name, v, code) of the text columns: dense alphabetical codes of the training rows."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(inputCols=list(inputCols if inputCols is not None else UNMAPPED_TEXT_COLUMNS))

    def _fit(self, dataset: DataFrame) -> TextCoderModel:
        model = TextCoderModel(text_code_dictionary(dataset, self.getInputCols()))
        model._set(inputCols=self.getInputCols())
        return model


class TextCoderModel(Model, HasInputCols, MLWritable, MLReadable):
    """Text -> its training code; `?` is missing (NULL), text that training didn't hold is one past the last code."""

    def __init__(self, dictionary: DataFrame | None = None):
        super().__init__()
        self.dictionary = dictionary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return code_columns(dataset, self.getInputCols(), self.dictionary)

    def write(self) -> MLWriter:
        return _TextCoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TextCoderReader(cls)


class _TextCoderWriter(MLWriter):
    def __init__(self, instance: TextCoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, SparkSession.active())
        self.instance.dictionary.write.parquet(f"{path}/dictionary")


class _TextCoderReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TextCoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        model = self.cls(SparkSession.active().read.parquet(f"{path}/dictionary"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


# --- P3-P9: the encoder ------------------------------------------------------
class EncounterEncoder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``encode_features`` as a stage: the features become numbers, all other columns stay."""

    numeric = Param(Params._dummy(), "numeric", "double or int", TypeConverters.toString)
    insulin = Param(Params._dummy(), "insulin", "whether insulin has its map", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, numeric: str = "double", insulin: bool = True):
        super().__init__()
        self._setDefault(numeric="double", insulin=True)
        self._set(numeric=numeric, insulin=insulin)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        others = [c for c in dataset.columns if c not in FEATURE_COLUMNS]
        return encode_features(dataset, FEATURE_COLUMNS, insulin=self.getOrDefault(self.insulin), numeric=self.getOrDefault(self.numeric), keep=others)
