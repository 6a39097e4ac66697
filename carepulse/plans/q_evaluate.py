"""Evaluation queries (A6-A13) on 3-class orders (status vs a price-threshold prediction) and 2-class labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from carepulse.operators.evaluate import (
    accuracy, auc_ovr, class_distribution, classification_report, confusion_long,
    label_binarize, roc_points,
)
from carepulse.plans.catalog import register
from carepulse.plans.standins import table

_T_SQL = """
t AS (SELECT o_orderkey, o_orderstatus AS a,
             CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 300000 THEN 'O' ELSE 'P' END AS p,
             round(o_totalprice / 1000) AS s
      FROM orders)
"""


def scored_orders(spark, sf):
    o = table(spark, sf, "orders")
    price = F.col("o_totalprice")
    return o.select(
        "o_orderkey", F.col("o_orderstatus").alias("a"),
        F.when(price < 150000, "F").when(price < 300000, "O").otherwise("P").alias("p"),
        F.round(price / 1000).alias("s"))


def _r6(df, cols):
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("class_distinct", "SELECT DISTINCT o_orderstatus AS label FROM orders")
def q_class_distinct(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderstatus").alias("label")).distinct()


@register("class_distribution", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def q_class_distribution(spark, sf):
    return class_distribution(table(spark, sf, "orders"), "o_orderstatus")


_CM_SQL = "WITH " + _T_SQL + """,
l AS (SELECT a AS label FROM t UNION SELECT p FROM t),
c AS (SELECT a, p, count(*) AS n FROM t GROUP BY 1, 2),
cm AS (SELECT x.label AS actual, y.label AS predicted, COALESCE(c.n, 0) AS n
       FROM l x CROSS JOIN l y LEFT JOIN c ON c.a = x.label AND c.p = y.label)
"""


@register("confusion_matrix", "WITH " + _T_SQL + "SELECT a AS actual, p AS predicted, count(*) AS n FROM t GROUP BY 1, 2")
def q_confusion_matrix(spark, sf):
    return confusion_long(scored_orders(spark, sf), "a", "p")


@register("classification_report", _CM_SQL + """,
sa AS (SELECT actual AS label, sum(n) AS support,
              sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS tp FROM cm GROUP BY 1),
sp AS (SELECT predicted AS label, sum(n) AS pn FROM cm GROUP BY 1),
per AS (SELECT sa.label, CASE WHEN pn = 0 THEN 0.0 ELSE tp * 1.0 / pn END AS precision,
               CASE WHEN support = 0 THEN 0.0 ELSE tp * 1.0 / support END AS recall, support
        FROM sa JOIN sp ON sa.label = sp.label),
per2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                        ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM per)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM per2
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM per2
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM per2
""")
def q_classification_report(spark, sf):
    rep = classification_report(scored_orders(spark, sf), "a", "p")
    return _r6(rep, ["precision", "recall", "f1"])


@register("accuracy", "WITH " + _T_SQL + """
SELECT round(avg(CASE WHEN a = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM t
""")
def q_accuracy(spark, sf):
    return _r6(accuracy(scored_orders(spark, sf), "a", "p"), ["accuracy"])


@register("label_binarize", """
SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus_F,
       CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O,
       CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P
FROM orders
""")
def q_label_binarize(spark, sf):
    return label_binarize(table(spark, sf, "orders"), "o_orderstatus", keep=["o_orderkey"])


_SC_SQL = """
cls AS (SELECT DISTINCT a AS class FROM t),
sc AS (SELECT cls.class, t.s AS score,
              sum(CASE WHEN t.a = cls.class THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN t.a <> cls.class THEN 1 ELSE 0 END) AS neg
       FROM t CROSS JOIN cls GROUP BY 1, 2)
"""


@register("roc_points", "WITH " + _T_SQL + "," + _SC_SQL + """,
cum AS (SELECT class, score,
               sum(pos) OVER (PARTITION BY class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tps,
               sum(neg) OVER (PARTITION BY class ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps,
               sum(pos) OVER (PARTITION BY class) AS P, sum(neg) OVER (PARTITION BY class) AS N
        FROM sc)
SELECT class, score AS threshold, round(fps * 1.0 / N, 6) AS fpr, round(tps * 1.0 / P, 6) AS tpr,
       CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps
FROM cum
UNION ALL SELECT class, CAST(NULL AS DOUBLE), 0.0, 0.0, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM cls
""")
def q_roc_points(spark, sf):
    return _r6(roc_points(scored_orders(spark, sf), "a", "s"), ["fpr", "tpr"])


_AUC_TAIL = """,
c2 AS (SELECT class, score, pos, neg,
              sum(neg) OVER (PARTITION BY class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_le
       FROM sc),
per AS (SELECT class, sum(pos * (neg_le - neg + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM c2 GROUP BY class)
SELECT class, round(auc, 6) AS auc FROM per
UNION ALL SELECT 'macro', round(avg(auc), 6) FROM per
"""


@register("auc_ovr", "WITH " + _T_SQL + "," + _SC_SQL + _AUC_TAIL)
def q_auc_ovr(spark, sf):
    return _r6(auc_ovr(scored_orders(spark, sf), "a", "s"), ["auc"])


@register("auc_binary", """
WITH t AS (SELECT CAST(quality AS VARCHAR) AS a, CAST(toxic AS DOUBLE) AS s FROM labels),""" + _SC_SQL + _AUC_TAIL)
def q_auc_binary(spark, sf):
    lab = table(spark, sf, "labels").select(F.col("quality").cast("string").alias("a"),
                                            F.col("toxic").cast("double").alias("s"))
    return _r6(auc_ovr(lab, "a", "s"), ["auc"])


_MULTI_SQL = """
t AS (SELECT o_orderstatus AS a, round(o_totalprice / 1000) AS s_F,
             round(abs(o_totalprice - 250000) / 1000) AS s_O, round((500000 - o_totalprice) / 1000) AS s_P
      FROM orders),
st AS (SELECT a, 'F' AS class, s_F AS score FROM t UNION ALL SELECT a, 'O', s_O FROM t
       UNION ALL SELECT a, 'P', s_P FROM t),
sc AS (SELECT class, score, sum(CASE WHEN a = class THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN a <> class THEN 1 ELSE 0 END) AS neg FROM st GROUP BY 1, 2)
"""


@register("auc_ovr_scores", "WITH " + _MULTI_SQL + _AUC_TAIL)
def q_auc_ovr_scores(spark, sf):
    """A12 with one score column per class (the shape of a model's class probabilities)."""
    o = table(spark, sf, "orders")
    p = F.col("o_totalprice")
    scored = o.select(F.col("o_orderstatus").alias("a"), F.round(p / 1000).alias("s_F"),
                      F.round(F.abs(p - 250000) / 1000).alias("s_O"), F.round((500000 - p) / 1000).alias("s_P"))
    return _r6(auc_ovr(scored, "a", {"F": "s_F", "O": "s_O", "P": "s_P"}), ["auc"])
