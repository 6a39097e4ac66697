"""Random-forest training and scoring as one Spark ML pipeline.

One ``PipelineModel`` holds the label order, the assembler, the scaler and
the forest, so training and serving cannot drift apart (X1-X3), and saving it
is one directory (K8). Scoring is ``transform`` on any batch or streaming
frame; Spark broadcasts the trees to the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.operators.stages import EncounterEncoder, PopulationScaler, TextCoder
from carepulse.schemas import FEATURE_COLUMNS, HIGH_RISK_CLASS, ID_COLUMNS, PROBABILITY_COLUMN, UNMAPPED_TEXT_COLUMNS, quote

LABEL_INDEX = "label_idx"


def model_features(include_ids: bool = False, features: Sequence[str] = FEATURE_COLUMNS) -> list[str]:
    """Record and patient ids are not features unless parity asks for them."""
    return [c for c in features if include_ids or c not in ID_COLUMNS]


def _plain(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop ML attribute metadata so encoded text enters as a plain number (no maxBins limit)."""
    return df.select(*[F.col(quote(c)).alias(c, metadata={}) if c in cols else F.col(quote(c))
                       for c in df.columns])


def build_pipeline(features: Sequence[str], *, num_trees: int = 100, max_depth: int = 30,
                   seed: int = 42, scale: bool = False, max_bins: int = 32, before: Sequence[Estimator | Transformer] = ()) -> Pipeline:
    """`before`, then optional scaler, assembler and M3 forest over an already indexed label column.

    Trees split on per-feature quantile bins, which a per-feature affine
    scaling does not change, so the scaler (M5, the reference's X2 step: mean
    and population deviation) is off by default and available with
    ``scale=True``; when on, it is fitted on the training split inside the same
    pipeline, and saved with it.
    """
    names, stages = list(features), list(before)
    if scale:
        scaled = [f"scaled_{i}" for i in range(len(names))]
        stages.append(PopulationScaler(inputCols=names, outputCols=scaled))
        names = scaled
    # Column names may contain '-': VectorAssembler takes them verbatim.
    stages.append(VectorAssembler(inputCols=names, outputCol="raw_features", handleInvalid="keep"))
    stages.append(RandomForestClassifier(
        featuresCol="raw_features", labelCol=LABEL_INDEX, numTrees=num_trees, maxDepth=max_depth, seed=seed,
        featureSubsetStrategy="sqrt", maxBins=max_bins))
    return Pipeline(stages=stages)


def fit_forest(train: DataFrame, features: Sequence[str], label: str, *, before: Sequence[Estimator | Transformer] = (), **kw) -> PipelineModel:
    """M1 + M3: label order (alphabetical), the stages `before` and the forest, fitted on the training split only.

    The returned model's first stage is the label indexer; serving skips it,
    so rows without a label (or with an unseen one) are still scored.
    """
    from pyspark import StorageLevel
    # The indexer and the stages before re-read their input, the scaler and every
    # tree level the numbers made of it: both stay materialised (memory, spilling
    # to disk) for the duration of the fit, so a row is encoded once.
    held = []

    def hold(df: DataFrame) -> DataFrame:
        held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        train = hold(train) if before else train
        indexer = StringIndexer(inputCol=label, outputCol=LABEL_INDEX, stringOrderType="alphabetAsc",
                                handleInvalid="skip").fit(train)
        labelled = indexer.transform(_plain(train, features))
        first = Pipeline(stages=list(before)).fit(labelled)
        numbers = hold(first.transform(labelled).select(*[F.col(quote(c)) for c in features], LABEL_INDEX))
        body = build_pipeline(features, **kw).fit(numbers)
    finally:
        for df in held:
            df.unpersist()
    return PipelineModel(stages=[indexer, *first.stages, *body.stages])


def fit_record_forest(train: DataFrame, features: Sequence[str], label: str, *, numeric: str = "double", insulin: bool = True, **kw) -> PipelineModel:
    """The whole serving path as one saved pipeline over raw encounter records: training codes of the text columns without a
    value map, the encoder, the scaler and the forest (X1, X2). `kw` as in `build_pipeline`."""
    before = [TextCoder(inputCols=[c for c in UNMAPPED_TEXT_COLUMNS if c in train.columns]), EncounterEncoder(numeric=numeric, insulin=insulin)]
    return fit_forest(train, features, label, before=before, scale=True, **kw)


def save_model(model: PipelineModel, path: str) -> None:
    """K8: model, scaler and label order saved together."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """M9: load once before scoring; a failure raises."""
    return PipelineModel.load(path)


def class_labels(model: PipelineModel) -> list[str]:
    """The label text of each class index, as stored in the model."""
    return list(model.stages[0].labelsArray[0])


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
          positive_index: int = HIGH_RISK_CLASS, none_label: str | None = "NO") -> DataFrame:
    """M4 + P14 (+ X6): class, P(class `positive_index`) x 100, all class probabilities, p_any.

    p_any = 1 - P(`none_label`) when that label exists in the model (the
    probability of any readmission), else NULL.
    """
    labels = class_labels(model)
    scored = PipelineModel(stages=model.stages[1:]).transform(_plain(df, features))
    probs = vector_to_array("probability")
    none_idx = labels.index(none_label) if none_label in labels else None
    p_any = (F.lit(1.0) - probs[none_idx]) if none_idx is not None else F.lit(None).cast("double")
    return scored.select(
        *[F.col(quote(k)) for k in keep],
        F.col("prediction").cast("int").alias("readmission_prediction"),
        (F.try_element_at(probs, F.lit(positive_index + 1)) * 100.0).alias(PROBABILITY_COLUMN),
        probs.alias("class_probabilities"),
        p_any.alias("p_any"),
    )


def feature_importance(spark, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M6: (feature, importance): tree importances; else |coefficient| of class 0 (linear models); else 0.

    One value per feature (a bounded list built on the driver from the model).
    """
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        imp = last.featureImportances.toArray().tolist()
    elif hasattr(last, "coefficientMatrix"):
        imp = [abs(float(x)) for x in last.coefficientMatrix.toArray()[0].tolist()]
    elif hasattr(last, "coefficients"):
        imp = [abs(float(x)) for x in last.coefficients.toArray().tolist()]
    else:
        imp = [0.0] * len(features)
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)],
                                 "feature string, importance double")
