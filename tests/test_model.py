"""Forest invariants (no SQL oracle for tree fitting)."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from carepulse.operators.forest import class_labels, feature_importance, fit_forest, load_model, save_model, score
from carepulse.plans.q_model import FEATURES, encoded_encounters, trained_model
from conftest import SF_SMALL


def test_probabilities_and_argmax(spark):
    model = trained_model(spark, SF_SMALL)
    s = score(model, encoded_encounters(spark, SF_SMALL), FEATURES, keep=["record_key"]).collect()
    assert len(s) > 0
    for r in s:
        p = r.class_probabilities
        assert abs(sum(p) - 1.0) < 1e-9
        assert r.readmission_prediction == max(range(len(p)), key=lambda i: (p[i], -i))
        assert abs(r.readmission_probability_pct - 100 * p[1]) < 1e-9


def test_label_order_is_alphabetical(spark):
    assert class_labels(trained_model(spark, SF_SMALL)) == ["<30", ">30", "NO"]


def test_same_seed_same_model_and_save_load(spark, scratch):
    data = encoded_encounters(spark, SF_SMALL).where(F.col("split") == "train")
    m1 = fit_forest(data, FEATURES, "readmitted", num_trees=5, max_depth=3, seed=11)
    m2 = fit_forest(data, FEATURES, "readmitted", num_trees=5, max_depth=3, seed=11)
    path = scratch("model")
    save_model(m1, path)
    m3 = load_model(path)
    test = encoded_encounters(spark, SF_SMALL)
    a, b, c = (sorted((r.record_key, r.readmission_prediction) for r in
                      score(m, test, FEATURES, keep=["record_key"]).collect()) for m in (m1, m2, m3))
    assert a == b == c


def test_serving_does_not_need_a_label(spark):
    model = trained_model(spark, SF_SMALL)
    unlabelled = encoded_encounters(spark, SF_SMALL).drop("readmitted").limit(20)
    assert score(model, unlabelled, FEATURES).count() == 20


def test_importance_covers_features(spark):
    imp = feature_importance(spark, trained_model(spark, SF_SMALL), FEATURES).collect()
    assert len(imp) == len(FEATURES)
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-6


def test_importance_of_a_linear_model(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(float(i % 7), float(i % 3), float(i % 2)) for i in range(60)], "a double, b double, y double")
    m = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="f"),
                         LogisticRegression(featuresCol="f", labelCol="y", maxIter=5)]).fit(df)
    rows = {r.feature: r.importance for r in feature_importance(spark, m, ["a", "b"]).collect()}
    coef = m.stages[-1].coefficientMatrix.toArray()[0]
    assert rows == {"a": abs(coef[0]), "b": abs(coef[1])}
