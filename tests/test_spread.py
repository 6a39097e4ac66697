"""Per-row work is spread over tasks by its rows, not by its files."""

from __future__ import annotations

from pyspark.sql import functions as F

from carepulse.operators.spread import FEW_ROWS, MOST_ROWS, spread, tasks_for
from carepulse.plans import q_model, q_wide


def orders(spark, path: str, rows: int) -> str:
    """An `orders` table in one file with one row group."""
    k = F.col("id")
    frame = spark.range(0, rows, 1, 1).select(
        k.alias("o_orderkey"), (k % 1000).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (k % 3 + 1).cast("int")).alias("o_orderstatus"),
        F.lit("2-HIGH").alias("o_orderpriority"), (k * 1.25).alias("o_totalprice"))
    frame.coalesce(1).write.parquet(f"{path}/orders.parquet")
    return path


def test_tasks_grow_with_the_rows_alone():
    assert [tasks_for(n) for n in (0, 1, FEW_ROWS, FEW_ROWS + 1, 10 * FEW_ROWS)] == [1, 1, 1, 2, 10]
    for n in (10**6, 10**7, 10**8):
        assert n / tasks_for(n) <= MOST_ROWS


def test_spread_keeps_rows_copies_and_nulls(spark):
    df = spark.range(0, 3 * FEW_ROWS, 1, 1).select(F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("a-b"), F.lit("x").alias("t"))
    out = spread(df)
    assert out.rdd.getNumPartitions() == 3
    assert sorted(out.groupBy("a-b", "t").count().collect(), key=str) == sorted(df.groupBy("a-b", "t").count().collect(), key=str)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 1.1 * FEW_ROWS  # equal rows are no hot key


def test_training_and_scoring_rows_of_one_file_are_spread(spark, tmp_path):
    sf = orders(spark, str(tmp_path), 2 * FEW_ROWS)
    assert q_model.encoded_encounters(spark, sf).rdd.getNumPartitions() > 1
    assert q_wide.raw_records(spark, sf).rdd.getNumPartitions() > 1


def test_profiles_of_one_file_are_spread(spark, tmp_path, monkeypatch):
    sf, seen = orders(spark, str(tmp_path), 2 * FEW_ROWS), []
    monkeypatch.setattr(q_model, "trained_model", lambda *_: None)

    def scored(model, df, features, keep):
        seen.append(df.rdd.getNumPartitions())
        return df.select("record_key", F.lit(0).alias("readmission_prediction"), F.lit(0.0).alias(q_model.PROBABILITY_COLUMN))

    monkeypatch.setattr(q_model, "score", scored)
    assert q_model.q_score_numeric_profile(spark, sf).count() == 2 * FEW_ROWS
    assert seen[0] > 1
