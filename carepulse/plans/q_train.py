"""Training-table queries: impute, encode, dedupe, standardise, split."""

from __future__ import annotations

from pyspark.sql import functions as F

from carepulse.operators.clean import (
    distinct_rows, drop_all_null, impute_median, impute_mode, label_encode, standardize,
    train_test_split,
)
from carepulse.plans.catalog import register
from carepulse.plans.standins import table
from carepulse.session import new_scratch

# --- lineitem with holes (no NULLs in the driver tables, so make some) -----
_HOLED_LI_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS l_quantity,
       CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount END AS l_discount,
       l_tax
FROM lineitem
"""


def _holed_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_orderkey") % 5 == 0, None).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_linenumber") == 2, None).otherwise(F.col("l_discount")).alias("l_discount"),
        "l_tax",
    )


_MED_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("impute_median", f"""
WITH h AS ({_HOLED_LI_SQL}),
m AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in _MED_COLS)} FROM h)
SELECT l_orderkey, l_linenumber, {", ".join(f"COALESCE({c}, m_{c}) AS {c}" for c in _MED_COLS)}
FROM h, m
""")
def q_impute_median(spark, sf):
    return impute_median(_holed_lineitem(spark, sf))


# --- part strings with holes; p_name entirely NULL -> 'Unknown' -------------
_HOLED_PART_SQL = """
SELECT p_partkey, CAST(NULL AS VARCHAR) AS p_name,
       CASE WHEN p_size < 10 THEN NULL ELSE p_brand END AS p_brand,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS p_type
FROM part
"""


def _holed_part(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", F.lit(None).cast("string").alias("p_name"),
        F.when(F.col("p_size") < 10, None).otherwise(F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_partkey") % 4 == 0, None).otherwise(F.col("p_type")).alias("p_type"),
    )


def _mode_sql(c: str) -> str:
    return (f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM h WHERE {c} IS NOT NULL GROUP BY 1) "
            f"ORDER BY n DESC, v LIMIT 1)")


@register("impute_mode", f"""
WITH h AS ({_HOLED_PART_SQL})
SELECT p_partkey, {", ".join(f"COALESCE({c}, {_mode_sql(c)}, 'Unknown') AS {c}" for c in ["p_name", "p_brand", "p_type"])}
FROM h
""")
def q_impute_mode(spark, sf):
    return impute_mode(_holed_part(spark, sf))


# --- M1 ---------------------------------------------------------------------
@register("label_encode", """
SELECT o_orderkey,
       CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS o_orderstatus,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q_label_encode(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_mktsegment")
    return label_encode(joined, ["o_orderstatus", "o_orderpriority", "c_mktsegment"])


# --- M5 ---------------------------------------------------------------------
_STD_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("standardize", f"""
WITH s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _STD_COLS)} FROM lineitem)
SELECT l_orderkey, l_linenumber,
       {", ".join(f"round(CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END, 6) AS {c}" for c in _STD_COLS)}
FROM lineitem, s
""")
def q_standardize(spark, sf):
    li = table(spark, sf, "lineitem")
    z = standardize(li, _STD_COLS, keep=["l_orderkey", "l_linenumber"])
    return z.select("l_orderkey", "l_linenumber", *[F.round(F.col(c), 6).alias(c) for c in _STD_COLS])


# --- M2 ---------------------------------------------------------------------
@register("train_test_split", """
SELECT o_orderkey, o_custkey,
       CASE WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 10 < 7
            THEN 'train' ELSE 'test' END AS split
FROM orders
""")
def q_train_test_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return train_test_split(o, "o_orderkey")


# --- S8 + P17 + A1 + A2 + M1 + W2 + K7: the whole training clean -------------
_CLEAN_SQL = f"""
WITH h AS (
  SELECT CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS l_quantity,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS l_returnflag,
         l_linestatus
  FROM lineitem),
k AS (SELECT * FROM h WHERE l_quantity IS NOT NULL OR l_discount IS NOT NULL
                           OR l_returnflag IS NOT NULL OR l_linestatus IS NOT NULL),
m AS (SELECT median(l_quantity) AS mq, median(l_discount) AS md FROM k),
f AS (SELECT COALESCE(l_quantity, mq) AS l_quantity, COALESCE(l_discount, md) AS l_discount,
             COALESCE(l_returnflag, (SELECT v FROM (SELECT l_returnflag AS v, count(*) AS n FROM k
                 WHERE l_returnflag IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1), 'Unknown') AS l_returnflag,
             COALESCE(l_linestatus, (SELECT v FROM (SELECT l_linestatus AS v, count(*) AS n FROM k
                 WHERE l_linestatus IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1), 'Unknown') AS l_linestatus
      FROM k, m)
SELECT DISTINCT l_quantity, l_discount,
       CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS l_returnflag,
       CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS INTEGER) AS l_linestatus
FROM f
"""


def clean_training_table(df):
    """The training clean path: drop all-NULL rows -> medians -> modes -> codes -> dedupe."""
    kept = drop_all_null(df)
    filled = impute_mode(impute_median(kept))
    return distinct_rows(label_encode(filled))


@register("clean_train_table", _CLEAN_SQL)
def q_clean_train_table(spark, sf):
    li = table(spark, sf, "lineitem")
    holed = li.select(
        F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_orderkey") % 5 == 0, None).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linenumber") == 3, None).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
    )
    cleaned = clean_training_table(holed)
    # K7: save the cleaned table (shared scratch folder), serve the saved copy.
    path = new_scratch(spark, "clean_train")
    cleaned.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
