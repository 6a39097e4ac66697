"""Forest queries (M3-M9, P13, P14): train on the hash split of the encounter stand-in, save, load, score.

Tree fitting has no SQL twin, what the trees say has: the saved nodes are a
relation (`operators.forest_nodes`), and the oracles walk it in SQL over the
same encoded rows. pytest adds the invariants of fitting (same seed -> same
model).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from carepulse.functions.encode import align_features, encode_features
from carepulse.functions.records import predict_label
from carepulse.operators.clean import train_test_split
from carepulse.operators.evaluate import auc_ovr, classification_report
from carepulse.operators.forest import (
    feature_importance, fit_forest, load_model, model_features, save_model, score,
)
from carepulse.operators.forest_nodes import node_table, score_nodes
from carepulse.operators.results import top_k
from carepulse.operators.spread import spread
from carepulse.plans.catalog import register
from carepulse.plans.q_encode import encoded_columns_sql
from carepulse.plans.standins import ENCOUNTERS_SQL, encounters, table
from carepulse.schemas import FEATURE_COLUMNS, PROFILE_COLUMNS, PROBABILITY_COLUMN
from carepulse.session import new_scratch

FEATURES = model_features(include_ids=False)
QUERY_TREES, QUERY_DEPTH = 100, 30  # the deepest that Spark's trees go

_MODELS: dict = {}
_EXPORTED: dict = {}


def encoded_encounters(spark, sf):
    """Training / serving frame: record key, target text, split and the 49 encoded features."""
    raw = spread(encounters(spark, sf)).withColumn("record_key", F.col("encounter_id").cast("long"))
    enc = encode_features(raw, keep=["record_key", "readmitted"])
    return train_test_split(enc, "record_key")


def served(spark, sf, kind: str, fit):
    """Fit once per (application, data dir), save to the shared folder, serve the loaded copy; (model, path)."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _MODELS:
        path = new_scratch(spark, kind)
        save_model(fit(), path)
        _MODELS[key] = (load_model(path), path)
    if _EXPORTED.get(kind) != key and spark.sparkContext.master.startswith("local"):
        export_nodes(node_table(spark, _MODELS[key][1]), kind)
        _EXPORTED[kind] = key
    return _MODELS[key]


def trained_model(spark, sf):
    def fit():
        data = encoded_encounters(spark, sf)
        return fit_forest(data.where(F.col("split") == "train"), FEATURES, "readmitted", num_trees=QUERY_TREES, max_depth=QUERY_DEPTH, seed=42)
    return served(spark, sf, "forest", fit)[0]


# --- the oracles' side: the saved nodes, and a walk over them ----------------------------------
def nodes_file(kind: str) -> str:
    return os.path.join(tempfile.gettempdir(), f"carepulse-oracle-{os.getuid()}", f"{kind}.parquet")


def export_nodes(nodes, kind: str) -> None:
    """The nodes of the model last served, as one file for the oracles (a local session only: its engine sees this host's files)."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    path = nodes_file(kind)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.Table.from_batches(nodes.toArrow().to_batches()), f"{path}.new")
    os.replace(f"{path}.new", path)


def walk_sql(kind: str, rows: str, features: list[str], keep: list[str]) -> str:
    """CTEs after ``rows`` (key, `keep`, features): scored (key, `keep`, p = class probabilities, c = class from 0)."""
    x = ", ".join(f'CAST("{f}" AS DOUBLE)' for f in features)
    kept = "".join(f", {k}" for k in keep)
    return f"""
nodes AS (SELECT * FROM read_parquet('{nodes_file(kind)}')),
vectors AS (SELECT key{kept}, [{x}] AS x FROM {rows}),
walk AS (
  SELECT v.key, n.tree, n.feature, n.threshold, n.left_node, n.right_node, n.class_probabilities AS q
  FROM vectors v, nodes n WHERE n.node = 0
  UNION ALL
  SELECT w.key, n.tree, n.feature, n.threshold, n.left_node, n.right_node, n.class_probabilities
  FROM walk w JOIN vectors v ON v.key = w.key
  JOIN nodes n ON n.tree = w.tree AND n.node = CASE WHEN v.x[w.feature + 1] <= w.threshold THEN w.left_node ELSE w.right_node END
  WHERE w.feature >= 0),
votes AS (SELECT key, avg(q[1]) AS p0, avg(q[2]) AS p1, avg(q[3]) AS p2 FROM walk WHERE feature = -1 GROUP BY key),
scored AS (
  SELECT v.key{kept}, [p0, p1, p2] AS p, CAST(CASE WHEN p0 >= greatest(p1, p2) THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS INTEGER) AS c
  FROM votes t JOIN vectors v ON v.key = t.key)
"""


SPLIT_SQL = "CASE WHEN ('0x' || substr(md5(CAST(key AS VARCHAR)), 1, 8))::BIGINT % 10 < 7 THEN 'train' ELSE 'test' END"
_ENCODED_SQL = f"""
WITH RECURSIVE e AS ({ENCOUNTERS_SQL}),
enc AS (SELECT CAST(encounter_id AS BIGINT) AS key, readmitted, {", ".join(encoded_columns_sql(True, "double"))} FROM e),
encoded AS (SELECT *, {SPLIT_SQL} AS split FROM enc),"""
_FOREST_SQL = _ENCODED_SQL + walk_sql("forest", "encoded", FEATURES, ["split", "readmitted"])
_PCT_SQL = f"round(p[2] * 100, 6) AS {PROBABILITY_COLUMN}"
_SCORE_SQL = _FOREST_SQL + f"SELECT key AS encounter_id, split, c AS readmission_prediction, {_PCT_SQL} FROM scored"


@register("rf_train_score", _SCORE_SQL)
def q_rf_train_score(spark, sf):
    model = trained_model(spark, sf)
    s = score(model, encoded_encounters(spark, sf), FEATURES, keep=["record_key", "split"])
    return s.select(F.col("record_key").alias("encounter_id"), "split", "readmission_prediction",
                    F.round(PROBABILITY_COLUMN, 6).alias(PROBABILITY_COLUMN))


@register("score_nodes", _SCORE_SQL)
def q_score_nodes(spark, sf):
    """M4 + P14 over the node relation, level by level: the same scores without the ML runtime."""
    trained_model(spark, sf)
    nodes = node_table(spark, served(spark, sf, "forest", None)[1])
    path = new_scratch(spark, "forest-nodes")
    nodes.write.parquet(path)
    s = score_nodes(spark.read.parquet(path), encoded_encounters(spark, sf), FEATURES, key=["record_key", "split"])
    return s.select(F.col("record_key").alias("encounter_id"), "split", "readmission_prediction", F.round(PROBABILITY_COLUMN, 6).alias(PROBABILITY_COLUMN))


@register("score_proba", _FOREST_SQL + f"""
SELECT key AS encounter_id, c AS readmission_prediction, {_PCT_SQL}, round(1 - p[3], 6) AS p_any,
       CASE WHEN c = 1 THEN 'Readmitted' ELSE 'Not Readmitted' END AS label
FROM scored
""")
def q_score_proba(spark, sf):
    model = trained_model(spark, sf)
    s = score(model, encoded_encounters(spark, sf), FEATURES, keep=["record_key"])
    return s.select(F.col("record_key").alias("encounter_id"), "readmission_prediction",
                    F.round(PROBABILITY_COLUMN, 6).alias(PROBABILITY_COLUMN),
                    F.round("p_any", 6).alias("p_any"),
                    predict_label(F.col("readmission_prediction")).alias("label"))


def numeric_profiles(spark, sf):
    """F7 profile rows: numeric age, coded gender, ids as numbers (no text maps needed)."""
    o = table(spark, sf, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("record_key"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("gender"),
        (c % 100).cast("int").alias("age"),
        ((k % 8) + 1).cast("int").alias("admission_type_id"),
        ((k % 29) + 1).cast("int").alias("discharge_disposition_id"),
        ((k % 14) + 1).cast("int").alias("time_in_hospital"),
        (k % 150).cast("int").alias("num_lab_procedures"),
        (k % 20).cast("int").alias("num_procedures"),
        (c % 100).cast("int").alias("num_medications"),
        (c % 20).cast("int").alias("number_outpatient"),
        (k % 10).cast("int").alias("number_emergency"),
        (c % 10).cast("int").alias("number_inpatient"),
    )


_PROFILE_SQL = """
WITH RECURSIVE prof AS (
  SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS gender, o_custkey % 100 AS age, o_orderkey % 8 + 1 AS admission_type_id,
         o_orderkey % 29 + 1 AS discharge_disposition_id, o_orderkey % 14 + 1 AS time_in_hospital, o_orderkey % 150 AS num_lab_procedures,
         o_orderkey % 20 AS num_procedures, o_custkey % 100 AS num_medications, o_custkey % 20 AS number_outpatient,
         o_orderkey % 10 AS number_emergency, o_custkey % 10 AS number_inpatient
  FROM orders),
aligned AS (SELECT key, """ + ", ".join(f'"{c}"' if c in PROFILE_COLUMNS else f'0 AS "{c}"' for c in FEATURES) + " FROM prof)," + walk_sql("forest", "aligned", FEATURES, []) + f"""
SELECT key AS encounter_id, c AS readmission_prediction, {_PCT_SQL} FROM scored
"""


@register("score_numeric_profile", _PROFILE_SQL)
def q_score_numeric_profile(spark, sf):
    """M7: score profile rows with the same model: align to the feature list, no text maps."""
    model = trained_model(spark, sf)
    prof = spread(numeric_profiles(spark, sf))
    aligned = align_features(prof.select("record_key", *[F.col(x).cast("double").alias(x) for x in PROFILE_COLUMNS]),
                             FEATURE_COLUMNS, keep=["record_key"])
    s = score(model, aligned, FEATURES, keep=["record_key"])
    return s.select(F.col("record_key").alias("encounter_id"), "readmission_prediction",
                    F.round(PROBABILITY_COLUMN, 6).alias(PROBABILITY_COLUMN))


@register("feature_importance", f"""
WITH nodes AS (SELECT * FROM read_parquet('{nodes_file("forest")}')),
gains AS (SELECT tree, feature, sum(gain * rows) AS g FROM nodes WHERE feature >= 0 GROUP BY 1, 2),
shares AS (SELECT feature, sum(g / t) AS s FROM gains JOIN (SELECT tree, sum(g) AS t FROM gains GROUP BY 1) USING (tree) WHERE t > 0 GROUP BY 1),
named AS (SELECT unnest({FEATURES!r}) AS name, generate_subscripts({FEATURES!r}, 1) - 1 AS feature)
SELECT name AS feature, round(coalesce(s / (SELECT sum(s) FROM shares), 0), 6) AS importance
FROM named LEFT JOIN shares USING (feature) ORDER BY round(coalesce(s / (SELECT sum(s) FROM shares), 0), 12) DESC, name LIMIT 15
""")
def q_feature_importance(spark, sf):
    """M6 + W5: the 15 most important features."""
    imp = feature_importance(spark, trained_model(spark, sf), FEATURES)
    return top_k(imp, 15, "importance", ["feature"]).select("feature", F.round("importance", 6).alias("importance"))


def _report(spark, sf, split: str | None):
    model = trained_model(spark, sf)
    labels = model.stages[0].labelsArray[0]
    data = encoded_encounters(spark, sf)
    if split is not None:
        data = data.where(F.col("split") == split)
    s = score(model, data, FEATURES, keep=["readmitted"])
    name = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("readmission_prediction") + 1)
    rep = classification_report(s.withColumn("predicted", name), "readmitted", "predicted")
    return rep.select(F.lit(split or "all").alias("split"), "label",
                      *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


_REPORT_TAIL = """,
cm AS (SELECT x.l AS actual, y.l AS predicted, count(t.key) AS n
       FROM (SELECT unnest(['<30', '>30', 'NO']) AS l) x CROSS JOIN (SELECT unnest(['<30', '>30', 'NO']) AS l) y
       LEFT JOIN picked t ON t.readmitted = x.l AND t.predicted = y.l GROUP BY 1, 2),
seen AS (SELECT actual AS l FROM cm GROUP BY 1 HAVING sum(n) > 0 UNION SELECT predicted FROM cm GROUP BY 1 HAVING sum(n) > 0),
per AS (SELECT l AS label, (SELECT sum(n) FROM cm WHERE actual = l) AS support, (SELECT sum(n) FROM cm WHERE predicted = l) AS named,
               (SELECT sum(n) FROM cm WHERE actual = l AND predicted = l) AS hit FROM seen),
pr AS (SELECT *, CASE WHEN named = 0 THEN 0.0 ELSE hit * 1.0 / named END AS precision, CASE WHEN support = 0 THEN 0.0 ELSE hit * 1.0 / support END AS recall FROM per),
prf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr)
SELECT '{split}' AS split, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM prf
UNION ALL SELECT '{split}', 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM prf
UNION ALL SELECT '{split}', 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM prf
"""


def _report_sql(split: str) -> str:
    where = "" if split == "all" else f"WHERE split = '{split}'"
    return _FOREST_SQL + f", picked AS (SELECT key, readmitted, ['<30', '>30', 'NO'][c + 1] AS predicted FROM scored {where})" + _REPORT_TAIL.replace("{split}", split)


@register("holdout_report", _report_sql("test"))
def q_holdout_report(spark, sf):
    """M8: classification report of the forest on the hold-out split (labels as text)."""
    return _report(spark, sf, "test")


@register("full_data_report", _report_sql("all"))
def q_full_data_report(spark, sf):
    """The same report on every row, training rows included, labelled split=all."""
    return _report(spark, sf, None)


@register("holdout_auc", _FOREST_SQL + """,
st AS (SELECT readmitted AS a, unnest(['<30', '>30', 'NO']) AS class, unnest(p) AS score FROM scored WHERE split = 'test'),
sc AS (SELECT class, round(score, 12) AS score, sum(CASE WHEN a = class THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN a <> class THEN 1 ELSE 0 END) AS neg FROM st GROUP BY 1, 2),
c2 AS (SELECT class, score, pos, neg, sum(neg) OVER (PARTITION BY class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_le FROM sc),
per AS (SELECT class, sum(pos * (neg_le - neg + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM c2 GROUP BY class)
SELECT class, round(auc, 6) AS auc FROM per UNION ALL SELECT 'macro', round(avg(auc), 6) FROM per
""")
def q_holdout_auc(spark, sf):
    """M8: one-vs-rest AUC of the forest on the hold-out split, one probability column per class."""
    model = trained_model(spark, sf)
    labels = model.stages[0].labelsArray[0]
    s = score(model, encoded_encounters(spark, sf).where(F.col("split") == "test"), FEATURES,
              keep=["readmitted"])
    # equal votes are equal scores: sums of the same leaves in another order differ in the last bits
    probs = s.select("readmitted", *[F.round(F.col("class_probabilities")[i], 12).alias(f"p{i}") for i in range(len(labels))])
    auc = auc_ovr(probs, "readmitted", {lab: f"p{i}" for i, lab in enumerate(labels)})
    return auc.select("class", F.round("auc", 6).alias("auc"))
