"""The landing-file batch job end to end (K3, D9, M5, X1, X2): raw 50-column files -> training codes, integer encoder, scaler, forest -> 51 columns.

The raw records are derived from `orders` by expressions that both engines
read, so the oracles start from the same text. The model is one saved
pipeline; its nodes are walked in SQL as in `q_model`.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from carepulse.functions.encode import in_pieces
from carepulse.operators.clean import train_test_split
from carepulse.operators.forest import fit_record_forest, model_features, score
from carepulse.operators.spread import spread
from carepulse.plans.catalog import register
from carepulse.plans.q_encode import encoded_columns_sql
from carepulse.plans.q_model import FEATURES, QUERY_DEPTH, QUERY_TREES, SPLIT_SQL, served, walk_sql
from carepulse.plans.standins import table
from carepulse.schemas import (
    ENCOUNTER_COLUMNS, FEATURE_COLUMNS, NULL_MARKERS, PROBABILITY_COLUMN, PROBABILITY_CSV_NAME, UNMAPPED_TEXT_COLUMNS, quote,
)
from carepulse.session import new_scratch
from carepulse.sources.files import read_headerless_csv
from carepulse.sources.snapshots import publish, read_current

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"


def _pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {index} {whens} ELSE '{values[-1]}' END"


def _raw_expressions() -> dict[str, str]:
    """The 50 raw columns over `orders`; drugs follow the status but for every few records, so that trees have something to learn."""
    text = {
        "encounter_id": "CAST(o_orderkey AS STRING)", "patient_nbr": "CAST(o_custkey AS STRING)",
        "race": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Caucasian' WHEN '2-HIGH' THEN 'AfricanAmerican' WHEN '3-MEDIUM' THEN 'Asian' WHEN '4-NOT SPECIFIED' THEN '?' ELSE 'Martian' END",
        "gender": _pick("o_orderkey % 3", ["Male", "Female", "Unknown/Invalid"]),
        "age": "CASE WHEN o_custkey % 11 = 0 THEN '?' WHEN o_custkey % 11 = 1 THEN '60' ELSE '[' || CAST(o_custkey % 10 * 10 AS STRING) || '-' || CAST(o_custkey % 10 * 10 + 10 AS STRING) || ')' END",
        "weight": _pick("o_orderkey % 6", ["[75-100)", "[50-75)", "?"]),
        "payer_code": _pick("o_custkey % 4", ["MC", "HM", "SP", "?"]),
        # some specialties are so rare that serving meets unseen ones
        "medical_specialty": "CASE WHEN o_orderkey % 97 = 0 THEN 'Rare, no. ' || CAST(o_orderkey AS STRING) ELSE " + _pick("o_custkey % 3", ["Cardiology", "Surgery", "?"]) + " END",
        "diag_1": "CAST(o_totalprice AS STRING)", "diag_2": "CASE WHEN o_orderkey % 7 = 0 THEN 'V57' WHEN o_orderkey % 7 = 1 THEN '?' ELSE '250.83' END",
        "diag_3": "CAST(o_orderkey % 900 + 100 AS STRING) || '.5'",
        "max_glu_serum": _pick("o_orderkey % 4", ["None", ">200", "Norm", ">300"]), "A1Cresult": _pick("o_custkey % 4", ["None", ">7", "Norm", ">8"]),
        "change": _pick("o_orderkey % 2", ["Ch", "No"]), "diabetesMed": _pick("o_custkey % 3", ["No", "Yes"]),
        "readmitted": "CASE o_orderstatus WHEN 'F' THEN '<30' WHEN 'O' THEN '>30' ELSE 'NO' END",
    }
    drugs = ENCOUNTER_COLUMNS[ENCOUNTER_COLUMNS.index("metformin"):ENCOUNTER_COLUMNS.index("change")]
    for i, c in enumerate(drugs):
        text[c] = _pick(f"({_STATUS} + CASE WHEN o_orderkey % {i + 3} = 0 THEN 1 ELSE 0 END) % 4", ["No", "Steady", "Up", "Down"])
    for i, c in enumerate(c for c in ENCOUNTER_COLUMNS if c not in text):  # the plain counts
        text[c] = f"CASE WHEN o_orderkey % {i + 31} = 0 THEN '?' ELSE CAST({'o_custkey' if i % 2 else 'o_orderkey'} % {7 + 3 * i} + 1 AS STRING) END"
    return {c: text[c] for c in ENCOUNTER_COLUMNS}


RAW = _raw_expressions()
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]  # what they read
RAW_SQL = "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in RAW.items()) + " FROM orders"


def raw_records(spark, sf):
    orders = spread(table(spark, sf, "orders").select(*ORDERS))
    return orders.select(*[x.alias(c) for c, x in zip(RAW, in_pieces(F.expr(e) for e in RAW.values()))])


def record_model(spark, sf):
    """Fitted on the training split of the raw records; saved, loaded."""
    def fit():
        split = train_test_split(raw_records(spark, sf), "encounter_id")
        train = split.where(F.col("split") == "train").drop("split")
        return fit_record_forest(train, FEATURES, "readmitted", numeric="int", num_trees=QUERY_TREES, max_depth=QUERY_DEPTH, seed=42)
    return served(spark, sf, "record-forest", fit)[0]


# --- the oracles: dictionaries and statistics of the training split, then the same walk -------------
def _marked(c: str) -> str:
    out = f'"{c}"'
    for m in NULL_MARKERS:
        out = f"NULLIF({out}, '{m}')"
    return out


_CODED = {c: f"CASE WHEN {_marked(c)} IS NOT NULL THEN coalesce(nullif(list_position(l{i}, {_marked(c)}), 0) - 1, len(l{i})) END" for i, c in enumerate(UNMAPPED_TEXT_COLUMNS)}
_RECORD_SQL = (f"""
WITH RECURSIVE raw AS (SELECT *, CAST(encounter_id AS BIGINT) AS key FROM ({RAW_SQL})),
parted AS (SELECT *, {SPLIT_SQL} AS split FROM raw),
lists AS (SELECT """ + ", ".join(f"list_sort(list(DISTINCT {_marked(c)}) FILTER ({_marked(c)} IS NOT NULL)) AS l{i}" for i, c in enumerate(UNMAPPED_TEXT_COLUMNS))
    + " FROM parted WHERE split = 'train'),\nenc AS (SELECT key, split, readmitted, " + ", ".join(encoded_columns_sql(True, "int", ENCOUNTER_COLUMNS, _CODED))
    + " FROM parted, lists),\nstats AS (SELECT " + ", ".join(f'avg("{c}") AS m{i}, stddev_pop("{c}") AS s{i}' for i, c in enumerate(FEATURES))
    + " FROM enc WHERE split = 'train'),\nscaled AS (SELECT key, split, " + ", ".join(f'CASE WHEN s{i} = 0 THEN 0 ELSE ("{c}" - m{i}) / s{i} END AS "{c}"' for i, c in enumerate(FEATURES))
    + " FROM enc, stats)," + walk_sql("record-forest", "scaled", FEATURES, ["split"]))


@register("batch_score_wide", _RECORD_SQL + "SELECT " + ", ".join(f'e."{c}"' for c in FEATURE_COLUMNS)
          + f""", s.c AS readmission_prediction, round(s.p[2] * 100, 6) AS "{PROBABILITY_CSV_NAME}" FROM enc e JOIN scored s ON s.key = e.key""")
def q_batch_score_wide(spark, sf):
    """Headerless landing files -> the saved pipeline -> the 51-column record, replaced as a whole by a pointer switch."""
    landing, out = new_scratch(spark, "landing-wide"), new_scratch(spark, "scored-wide")
    raw_records(spark, sf).write.csv(landing)
    records = read_headerless_csv(spark, landing)
    scored = wide_scores(record_model(spark, sf), records).persist(StorageLevel.MEMORY_AND_DISK)  # two writes, one scoring
    try:
        publish(scored.where(F.col("readmission_prediction") < 0), out)  # an earlier run's result, which is replaced
        publish(scored, out)
    finally:
        scored.unpersist()
    return read_current(spark, out).withColumn(PROBABILITY_CSV_NAME, F.round(F.col(quote(PROBABILITY_CSV_NAME)), 6))


def wide_scores(model, records):
    """The 49 integer features, class and percent of raw records."""
    s = score(model, records, model_features(), keep=FEATURE_COLUMNS)
    return s.select(*[F.col(quote(c)) for c in FEATURE_COLUMNS], "readmission_prediction", F.col(PROBABILITY_COLUMN).alias(PROBABILITY_CSV_NAME))


_SHOWN = ["age", "time_in_hospital", "metformin", "medical_specialty"]


@register("score_scaled", _RECORD_SQL + "SELECT s.key AS encounter_id, s.split, " + ", ".join(f"round(x.{c}, 6) AS scaled_{c}" for c in _SHOWN)
          + f", s.c AS readmission_prediction, round(s.p[2] * 100, 6) AS {PROBABILITY_COLUMN} FROM scored s JOIN scaled x ON x.key = s.key")
def q_score_scaled(spark, sf):
    """M5 in the served pipeline: scaled features (population deviation of the training split) and the scores made of them."""
    records = raw_records(spark, sf).withColumn("record_key", F.col("encounter_id").cast("long"))
    places = {c: f"scaled_{FEATURES.index(c)}" for c in _SHOWN}
    s = score(record_model(spark, sf), records, FEATURES, keep=["record_key", *places.values()])
    return train_test_split(s, "record_key").select(
        F.col("record_key").alias("encounter_id"), "split", *[F.round(p, 6).alias(f"scaled_{c}") for c, p in places.items()],
        "readmission_prediction", F.round(PROBABILITY_COLUMN, 6).alias(PROBABILITY_COLUMN))
