"""Result-table operators: latest record per key, risk KPIs, ordered limits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.schemas import HIGH_RISK_CLASS, quote


def latest_per_key(df: DataFrame, key: str | list[str], order_col: str) -> DataFrame:
    """Keep, per `key`, the row with the highest `order_col`.

    Expressed as ``max(struct(order_col, <rest>))`` per key instead of a
    ``row_number()`` window: the aggregate runs map-side first, so a patient
    holding a third of all rows is reduced to one row per input partition
    before the shuffle, and ties on `order_col` are broken deterministically by
    the remaining columns (struct ordering), never by physical row order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order_col]
    packed = F.struct(*[F.col(quote(c)) for c in [order_col, *rest]]).alias("_latest")
    return (df.groupBy(*[F.col(quote(k)) for k in keys])
              .agg(F.max(packed).alias("_latest"))
              .select(*[F.col(quote(k)) for k in keys], "_latest.*")
              .select(*[quote(c) for c in df.columns]))


def risk_kpi(df: DataFrame, class_col: str = "readmission_prediction",
             high_risk: int = HIGH_RISK_CLASS, by: str | None = None,
             total_label: str = "ALL") -> DataFrame:
    """A3 + A5 + P18: rows, high-risk rows and their percent (NULL-safe on 0 rows).

    With `by`, one row per group plus one total row (label `total_label`),
    computed in a single aggregation pass via ROLLUP.
    """
    is_high = F.col(quote(class_col)) == F.lit(high_risk)
    aggs = [
        F.count(F.lit(1)).alias("total_patients"),
        F.count_if(is_high).alias("high_risk_patients"),
    ]
    if by is None:
        out = df.agg(*aggs)
        grp: list[Column] = []
    else:
        out = (df.rollup(F.col(quote(by)).alias(by)).agg(*aggs, F.grouping_id().alias("_gid")))
        grp = [F.when(F.col("_gid") == 1, F.lit(total_label)).otherwise(F.col(quote(by))).alias(by)]
    pct = F.round(F.try_divide(F.col("high_risk_patients") * F.lit(100.0),
                               F.col("total_patients")), 6)
    return out.select(*grp, "total_patients", "high_risk_patients", pct.alias("high_risk_pct"))


def first_n(df: DataFrame, n: int, order: Iterable[str | Column]) -> DataFrame:
    """The first `n` rows by an explicit order (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, k: int, score_col: str, tie_cols: Iterable[str] = ()) -> DataFrame:
    """Top `k` by `score_col` descending, ties by `tie_cols` ascending."""
    return df.orderBy(F.col(quote(score_col)).desc(), *[F.col(quote(c)).asc() for c in tie_cols]).limit(k)


def sort_desc(df: DataFrame, col: str) -> DataFrame:
    """Descending sort (range-partitioned sort; ties stay unordered)."""
    return df.orderBy(F.col(quote(col)).desc())
