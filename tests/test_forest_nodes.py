"""The node relation, the saved stages of our own, atomic snapshots and the folded result store."""

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Row
from pyspark.sql import functions as F

from carepulse.operators import clean
from carepulse.operators.forest import feature_importance, fit_forest, fit_record_forest, load_model, model_features, save_model, score
from carepulse.operators.forest_nodes import node_importance, node_table, score_nodes
from carepulse.operators.stages import PopulationScaler, PopulationScalerModel, TextCoder, TextCoderModel
from carepulse.schemas import ENCOUNTER_COLUMNS, FEATURE_COLUMNS, PROBABILITY_COLUMN
from carepulse.sources import snapshots
from carepulse.streaming import store


def numbers(spark, n=400):
    rows = [(i, float(i % 17), float(i * i % 23), float(i % 5), "abc"[(i % 17 > 8) + (i * i % 23 > 15)]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x double, y double, `z-1` double, label string")


# ---- the forest as a relation

@pytest.fixture(scope="module")
def forest(spark):
    from carepulse.session import new_scratch
    path = new_scratch(spark, "small-forest")
    save_model(fit_forest(numbers(spark), ["x", "y", "z-1"], "label", num_trees=12, max_depth=6, seed=3), path)
    stored = new_scratch(spark, "small-nodes")
    node_table(spark, path).write.parquet(stored)
    return load_model(path), spark.read.parquet(stored)


def test_node_table_is_whole_trees(forest):
    model, nodes = forest
    assert nodes.count() == model.stages[-1].totalNumNodes
    by = {(r.tree, r.node): r for r in nodes.collect()}
    for r in by.values():
        if r.feature >= 0:
            assert by[r.tree, r.left_node].depth == by[r.tree, r.right_node].depth == r.depth + 1
        else:
            assert math.isclose(sum(r.class_probabilities), 1.0)
    assert [max(r.depth for k, r in by.items() if k[0] == t) for t in range(12)] == [t.depth for t in model.stages[-1].trees]


def test_walking_the_nodes_equals_the_ml_runtime(spark, forest):
    model, nodes = forest
    odd = [(1000, float("nan"), 1.0, 0.0, "a"), (1001, None, None, None, None), (1002, 1e300, -1e300, float("inf"), "b")]
    rows = numbers(spark).union(spark.createDataFrame(odd, numbers(spark).schema))
    want = {r.id: r for r in score(model, rows, ["x", "y", "z-1"], keep=["id"]).collect()}
    got = score_nodes(nodes, rows, ["x", "y", "z-1"], key=["id"]).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.class_probabilities == pytest.approx(want[r.id].class_probabilities, abs=1e-12)
        assert r[PROBABILITY_COLUMN] == pytest.approx(want[r.id][PROBABILITY_COLUMN], abs=1e-9)
        p = sorted(r.class_probabilities)
        assert r.readmission_prediction == want[r.id].readmission_prediction or p[-1] - p[-2] < 1e-12
    assert score_nodes(nodes, rows.limit(0), ["x", "y", "z-1"], key=["id"]).collect() == []
    with pytest.raises(ValueError):
        score_nodes(nodes.limit(0), rows, ["x", "y", "z-1"], key=["id"])


def test_importance_of_the_nodes(spark, forest):
    model, nodes = forest
    names = ["x", "y", "z-1"]
    want = {r.feature: r.importance for r in feature_importance(spark, model, names).collect()}
    assert {r.feature: r.importance for r in node_importance(nodes, names).collect()} == pytest.approx(want)


# ---- stages that are saved with the model

def test_scaler_uses_the_population_deviation_and_is_saved(spark, scratch):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (6.0, 5.0)], "`a-b` double, c double")
    path = scratch("scaler")
    PopulationScaler(inputCols=["a-b", "c"], outputCols=["p", "q"]).fit(df).save(path)
    got = [(r.p, r.q) for r in PopulationScalerModel.load(path).transform(df).collect()]
    mean, deviation = 3.0, math.sqrt(14 / 3)
    assert got == [pytest.approx(((1 - mean) / deviation, 0.0)), pytest.approx(((2 - mean) / deviation, 0.0)), (None, 0.0), pytest.approx(((6 - mean) / deviation, 0.0))]
    assert PopulationScaler(inputCols=["c"], outputCols=["q"]).fit(df.limit(0)).transform(df).select("q").distinct().collect() == [Row(q=0.0)]


@pytest.mark.parametrize("entries", [200_000, 0])
def test_text_codes_in_one_pass(spark, scratch, monkeypatch, entries):
    """Small dictionaries as one value, larger ones by one join for all columns: equal results."""
    monkeypatch.setattr(clean, "MAP_ENTRIES", entries)
    train = spark.createDataFrame([("b", "x"), ("a", "?"), ("c", "x"), ("a", None)], "metformin string, `A1Cresult` string")
    path = scratch("coder")
    TextCoder(inputCols=["metformin", "A1Cresult"]).fit(train).save(path)
    coder = TextCoderModel.load(path)
    rows = [("a", "x", 1), ("zz", "y", 2), (None, "?", 3), ("c", None, 4), ("a", "x", 1)]
    got = coder.transform(spark.createDataFrame(rows, "metformin string, A1Cresult string, other int")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(0, 0, 1), (3, 1, 2), (None, None, 3), (2, None, 4), (0, 0, 1)], key=str)
    none = coder.transform(spark.createDataFrame([("q",)], "other string"))
    assert none.collect() == [Row(other="q")]


def test_one_exchange_at_most_codes_all_columns(spark):
    cols = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([tuple("ab"[(i >> k) & 1] for k in range(6)) for i in range(64)], cols)
    dictionary = spark.createDataFrame([(c, v, k) for c in cols for k, v in enumerate("ab")], "name string, v string, code int")
    plan = clean.code_columns(df, cols, dictionary)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert all(set(r) <= {0, 1} for r in clean.code_columns(df, cols, dictionary).collect())


def test_raw_records_through_the_saved_pipeline(spark, scratch):
    rows = []
    for i in range(300):
        r = dict.fromkeys(ENCOUNTER_COLUMNS, "?")
        r |= {"encounter_id": str(i), "patient_nbr": str(i % 7), "gender": "Male" if i % 2 else "Female", "metformin": ["No", "Up", "Steady"][i % 3],
              "age": "[70-80)", "time_in_hospital": str(i % 14), "diag_1": "250.83", "readmitted": ["<30", ">30", "NO"][i % 3]}
        rows.append(tuple(r[c] for c in ENCOUNTER_COLUMNS))
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in ENCOUNTER_COLUMNS))
    path = scratch("record-model")
    save_model(fit_record_forest(raw, model_features(), "readmitted", numeric="int", num_trees=15, max_depth=5, seed=1), path)
    model = load_model(path)
    assert isinstance(model, PipelineModel) and [type(s).__name__ for s in model.stages[1:4]] == ["TextCoderModel", "EncounterEncoder", "PopulationScalerModel"]
    unseen = raw.limit(1).withColumn("metformin", F.lit("Never seen")).withColumn("encounter_id", F.lit("999")).drop("readmitted")
    got = score(model, raw.drop("readmitted").union(unseen), model_features(), keep=FEATURE_COLUMNS).collect()
    assert len(got) == 301
    codes = {r.encounter_id: r.metformin for r in got}
    assert codes[999] == 3 and {codes[i] for i in range(300)} == {0, 1, 2}  # a drug column is no constant 0
    assert all(r.diag_1 == 250 and r.weight == 0 for r in got)
    assert sum(r.readmission_prediction == r.encounter_id % 3 for r in got if r.encounter_id < 300) > 200
    streamed = model.stages[1].transform(raw)  # the same plan serves batches and streams: nothing but expressions
    assert "Join" not in streamed._jdf.queryExecution().optimizedPlan().toString()


# ---- atomic snapshots

def test_publish_replaces_as_a_whole(spark, scratch):
    path = scratch("published")
    with pytest.raises(FileNotFoundError):
        snapshots.read_current(spark, path)
    first = snapshots.publish(spark.range(10), path)
    before = snapshots.read_current(spark, path)
    second = snapshots.publish(spark.range(5), path, run="b")
    assert first != second and snapshots.current(spark, path)["run"] == "b"
    assert snapshots.read_current(spark, path).count() == 5 and before.count() == 10  # a reader of the old one can finish
    with pytest.raises(Exception):  # a failing job leaves the pointer
        snapshots.publish(spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("id")), path)
    assert snapshots.current(spark, path)["folder"] == second
    gone = snapshots.expire(spark, path)
    assert first in gone and second not in gone and snapshots.read_current(spark, path).count() == 5


# ---- the folded store

SCHEMA = "id long, batch_id long"


def test_store_folds_committed_batches(spark, scratch):
    from pyspark.sql.types import _parse_datatype_string
    schema, path = _parse_datatype_string(SCHEMA), scratch("store")
    assert store.read_store(spark, path, schema).collect() == []
    most = 0
    for b in range(24):
        assert store.store_batch(spark.range(b * 10, b * 10 + 10).repartition(3), path, b)
        if b % 3 == 2:
            state = store.compact(spark, path, schema, b - 1)  # the last one isn't committed yet
            assert state["upto"] == b - 1
            store.expire(spark, path)
            most = max(most, len(state["folders"]))
            files = store.read_store(spark, path, schema).inputFiles()
            assert len(files) <= len(state["folders"]) + 3 * 2
    assert most <= 5
    rows = store.read_store(spark, path, schema).collect()
    assert sorted(r.id for r in rows) == list(range(240)) and all(r.batch_id == r.id // 10 for r in rows)
    assert not store.store_batch(spark.range(99), path, 4)  # folded: a replay is a no-op
    assert store.store_batch(spark.range(230, 240), path, 23)  # not folded: it replaces itself
    store.compact(spark, path, schema, 23)
    store.compact(spark, path, schema, 23)
    assert sorted(r.id for r in store.read_store(spark, path, schema).collect()) == list(range(240))


def test_store_knows_what_the_checkpoint_committed(spark, scratch):
    landing, ckpt, path = scratch("in"), scratch("ckpt"), scratch("store")
    assert store.committed_upto(spark, ckpt) == -1
    spark.range(8).selectExpr("cast(id as string) value").repartition(4).write.text(landing)
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(landing).selectExpr("cast(value as long) id")
    q = stream.writeStream.foreachBatch(lambda df, b: store.store_batch(df, path, b) and None).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    last = store.committed_upto(spark, ckpt)
    assert last == 3
    from pyspark.sql.types import _parse_datatype_string
    store.compact(spark, path, _parse_datatype_string(SCHEMA), last)
    assert sorted(r.id for r in store.read_store(spark, path, _parse_datatype_string(SCHEMA)).collect()) == list(range(8))


# ---- many nodes and rows

def test_walks_of_a_large_forest_are_not_exchanged(spark, forest, monkeypatch):
    """Trees beyond the broadcast limit are walked in groups, rows dealt by their number; equal scores."""
    model, nodes = forest
    from carepulse.operators import forest_nodes
    rows = numbers(spark)
    rows = rows.union(rows.limit(3)).union(rows.limit(1).withColumn("id", F.lit(None).cast("long")))  # keys may repeat or be missing
    features, key = ["x", "y", "z-1"], ["id", "label"]
    plain = sorted(map(tuple, score_nodes(nodes, rows, features, key=key).collect()), key=str)
    assert len(plain) == 401
    monkeypatch.setattr(forest_nodes, "BROADCAST_NODES", 150)
    monkeypatch.setattr(forest_nodes, "WALKED_ROWS", 20, raising=False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = score_nodes(nodes, rows, features, key=key)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, out.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plan and ", 21), REPARTITION_BY_NUM" in plan
    for a, b in zip(got, plain, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-9) and a[4] == pytest.approx(b[4], abs=1e-12)
