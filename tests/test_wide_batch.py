"""The wide batch job: its encoder is compiled, its records are scored once."""

from __future__ import annotations

from pyspark.sql import functions as F

from carepulse.functions.encode import encode_features
from carepulse.plans import q_wide
from carepulse.schemas import ENCOUNTER_COLUMNS, FEATURE_COLUMNS

JVM_LIMIT = 8000  # bytes of a method that HotSpot compiles


def longest_method(df) -> int:
    parts = df._jdf.queryExecution().debug().codegenToSeq()
    return max((parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())), default=0)


def test_encoder_of_raw_records_is_compiled(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([tuple(["?"] * len(ENCOUNTER_COLUMNS)), tuple([" 250.83 "] * len(ENCOUNTER_COLUMNS)), tuple(["1e999"] * len(ENCOUNTER_COLUMNS)), tuple([None] * len(ENCOUNTER_COLUMNS))],
                          ", ".join(f"`{c}` string" for c in ENCOUNTER_COLUMNS)).write.parquet(path)
    for numeric, value in (("int", 250), ("double", 250.83)):
        out = encode_features(spark.read.parquet(path), FEATURE_COLUMNS, numeric=numeric)
        assert longest_method(out) < JVM_LIMIT
        assert sorted(r[0] for r in out.select("time_in_hospital").collect()) == [0, 0, 0, value]


def test_wide_records_are_scored_once(spark, tmp_path, monkeypatch):
    sf, held = str(tmp_path), []
    spark.sql("SELECT id AS o_orderkey, id AS o_custkey, 'F' AS o_orderstatus, '2-HIGH' AS o_orderpriority, 1.5D AS o_totalprice FROM range(10)").write.parquet(f"{sf}/orders.parquet")
    monkeypatch.setattr(q_wide, "record_model", lambda *_: None)
    scored = lambda model, records: records.select(*[F.lit(0).alias(c) for c in FEATURE_COLUMNS], F.lit(1).alias("readmission_prediction"), F.lit(2.5).alias(q_wide.PROBABILITY_CSV_NAME))
    monkeypatch.setattr(q_wide, "wide_scores", scored)
    real = q_wide.publish
    monkeypatch.setattr(q_wide, "publish", lambda df, path: (held.append("InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString()), real(df, path)))
    assert q_wide.q_batch_score_wide(spark, sf).count() == 10
    assert held == [True, True]
