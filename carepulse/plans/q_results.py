"""Queries over scored results: latest per patient, KPIs, ordered limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from carepulse.operators.results import first_n, latest_per_key, risk_kpi, sort_desc, top_k
from carepulse.plans.catalog import register
from carepulse.plans.standins import PREDICTIONS_SQL, predictions, table

_LATEST_SQL = f"""
WITH p AS ({PREDICTIONS_SQL}),
latest AS (
  SELECT encounter_id, patient_nbr, segment, readmission_prediction, readmission_probability_pct
  FROM (SELECT *, row_number() OVER (PARTITION BY patient_nbr
                  ORDER BY encounter_id DESC, segment DESC, readmission_prediction DESC,
                           readmission_probability_pct DESC) AS rn FROM p)
  WHERE rn = 1)
"""


def latest(spark, sf):
    return latest_per_key(predictions(spark, sf), "patient_nbr", "encounter_id")


@register("latest_per_patient", _LATEST_SQL + "SELECT * FROM latest")
def q_latest_per_patient(spark, sf):
    return latest(spark, sf)


@register("latest_sorted", _LATEST_SQL + "SELECT * FROM latest ORDER BY encounter_id DESC")
def q_latest_sorted(spark, sf):
    return sort_desc(latest(spark, sf), "encounter_id")


@register("risk_kpi", _LATEST_SQL + """
SELECT CASE WHEN grouping(segment) = 1 THEN 'ALL' ELSE segment END AS segment,
       count(*) AS total_patients,
       CAST(sum(CASE WHEN readmission_prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_patients,
       round(sum(CASE WHEN readmission_prediction = 1 THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS high_risk_pct
FROM latest GROUP BY ROLLUP (segment)
""")
def q_risk_kpi(spark, sf):
    return risk_kpi(latest(spark, sf), by="segment")


@register("first_n", f"""
SELECT * FROM ({PREDICTIONS_SQL}) ORDER BY encounter_id LIMIT 50
""")
def q_first_n(spark, sf):
    return first_n(predictions(spark, sf), 50, ["encounter_id"])


@register("top_k", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 15
""")
def q_top_k(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return top_k(li, 15, "l_extendedprice", ["l_orderkey", "l_linenumber"])


def flagship(spark, sf):
    """entry(): risk KPI per segment and in total on the latest result per patient."""
    return q_risk_kpi(spark, sf).orderBy(F.col("segment"))
