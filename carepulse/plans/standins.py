"""Stand-in views: encounter-shaped data that Spark derives from the driver tables.

The reference's own encounter data is not shipped, so every registered query
reads the TPC-H-style tables and derives encounter-shaped columns from them
with plain expressions (SURVEY 7.2). Each derivation has a DuckDB twin (the
``*_SQL`` strings) used by the oracles, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Scored results (D8-like): one row per order = one scored encounter.
# class: thresholds on o_totalprice; probability: o_totalprice scaled to %.
# ---------------------------------------------------------------------------
def _pred_class(price):
    return (F.when(price < 150000, 0).when(price < 300000, 1).otherwise(2)).cast("int")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("encounter_id"),
        F.col("o_custkey").alias("patient_nbr"),
        F.col("o_orderpriority").alias("segment"),
        _pred_class(F.col("o_totalprice")).alias("readmission_prediction"),
        F.round(F.col("o_totalprice") / F.lit(5000.0), 6).alias("readmission_probability_pct"),
    )


PREDICTIONS_SQL = """
SELECT o_orderkey AS encounter_id,
       o_custkey AS patient_nbr,
       o_orderpriority AS segment,
       CAST(CASE WHEN o_totalprice < 150000 THEN 0 WHEN o_totalprice < 300000 THEN 1 ELSE 2 END AS INTEGER)
         AS readmission_prediction,
       round(o_totalprice / 5000.0, 6) AS readmission_probability_pct
FROM orders
"""


# ---------------------------------------------------------------------------
# Raw encounter records (D1 subset, all text, with '?' markers, unseen values,
# numeric ages, decimal and alphanumeric diagnosis codes).
# ---------------------------------------------------------------------------
ENCOUNTER_STANDIN_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "time_in_hospital",
    "num_lab_procedures", "diag_1", "diag_2", "insulin", "change", "diabetesMed",
    "readmitted",
]


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    decade = (c % 10) * 10
    return o.select(
        k.cast("string").alias("encounter_id"),
        c.cast("string").alias("patient_nbr"),
        F.when(pr == "1-URGENT", "Caucasian").when(pr == "2-HIGH", "AfricanAmerican")
         .when(pr == "3-MEDIUM", "Asian").when(pr == "4-NOT SPECIFIED", "?")
         .otherwise("Martian").alias("race"),
        F.when(st == "F", "Male").when(st == "O", "Female").otherwise("Unknown/Invalid").alias("gender"),
        F.when(c % 11 == 0, "?").when(c % 11 == 1, "60")
         .otherwise(F.concat(F.lit("["), decade.cast("string"), F.lit("-"),
                             (decade + 10).cast("string"), F.lit(")"))).alias("age"),
        ((k % 14) + 1).cast("string").alias("time_in_hospital"),
        F.when(k % 9 == 0, "?").otherwise(((k % 150)).cast("string")).alias("num_lab_procedures"),
        F.col("o_totalprice").cast("string").alias("diag_1"),
        F.when(k % 7 == 0, "V57").when(k % 7 == 1, "?").otherwise("250.83").alias("diag_2"),
        F.when(pr == "1-URGENT", "Up").when(pr == "2-HIGH", "Down").when(pr == "5-LOW", "Steady")
         .otherwise("No").alias("insulin"),
        F.when(k % 2 == 0, "Ch").otherwise("No").alias("change"),
        F.when(c % 3 == 0, "No").otherwise("Yes").alias("diabetesMed"),
        F.when(st == "F", "<30").when(st == "O", ">30").otherwise("NO").alias("readmitted"),
    )


ENCOUNTERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id,
       CAST(o_custkey AS VARCHAR) AS patient_nbr,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Caucasian' WHEN '2-HIGH' THEN 'AfricanAmerican'
            WHEN '3-MEDIUM' THEN 'Asian' WHEN '4-NOT SPECIFIED' THEN '?' ELSE 'Martian' END AS race,
       CASE o_orderstatus WHEN 'F' THEN 'Male' WHEN 'O' THEN 'Female' ELSE 'Unknown/Invalid' END AS gender,
       CASE WHEN o_custkey % 11 = 0 THEN '?' WHEN o_custkey % 11 = 1 THEN '60'
            ELSE '[' || CAST((o_custkey % 10) * 10 AS VARCHAR) || '-'
                 || CAST((o_custkey % 10) * 10 + 10 AS VARCHAR) || ')' END AS age,
       CAST(o_orderkey % 14 + 1 AS VARCHAR) AS time_in_hospital,
       CASE WHEN o_orderkey % 9 = 0 THEN '?' ELSE CAST(o_orderkey % 150 AS VARCHAR) END AS num_lab_procedures,
       CAST(o_totalprice AS VARCHAR) AS diag_1,
       CASE WHEN o_orderkey % 7 = 0 THEN 'V57' WHEN o_orderkey % 7 = 1 THEN '?' ELSE '250.83' END AS diag_2,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Up' WHEN '2-HIGH' THEN 'Down' WHEN '5-LOW' THEN 'Steady'
            ELSE 'No' END AS insulin,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Ch' ELSE 'No' END AS change,
       CASE WHEN o_custkey % 3 = 0 THEN 'No' ELSE 'Yes' END AS diabetesMed,
       CASE o_orderstatus WHEN 'F' THEN '<30' WHEN 'O' THEN '>30' ELSE 'NO' END AS readmitted
FROM orders
"""
