"""Physical-plan checks: pushdown, pruning, no Python on the data path, partial aggregation."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["risk_kpi", "encode_features", "value_map", "confusion_matrix",
                                  "standardize", "validate_domain", "lookup_decode"])
def test_no_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_latest_per_patient_aggregates_map_side(spark):
    plan = _plan(E.queries()["latest_per_patient"](spark, SF_SMALL))
    assert "partial_max" in plan  # hot patients collapse before the shuffle
    assert "Window" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["top_k"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan


def test_filter_pushed_to_scan(spark):
    from pyspark.sql import functions as F
    from carepulse.plans.standins import table
    df = table(spark, SF_SMALL, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in _plan(df)


def test_forest_scoring_stays_in_the_jvm(spark):
    plan = _plan(E.queries()["score_proba"](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_streaming_plan_has_no_python_udf(spark, scratch):
    from carepulse.plans import q_stream
    from carepulse.streaming.jobs import CORRUPT, message_stream, narrow_result, parse_messages
    landing = q_stream.land_messages(spark, SF_SMALL)
    both = narrow_result(parse_messages(message_stream(spark, path=landing)), q_stream.rule_scorer, carry=[CORRUPT])
    assert both.isStreaming
    logical = both._jdf.queryExecution().analyzed().toString()
    assert "PythonUDF" not in logical and "pythonUDF" not in logical
    assert logical.count("from_json") == 1  # each message parsed once
