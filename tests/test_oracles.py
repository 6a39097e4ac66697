"""Every registered query against its DuckDB oracle (row count, column names, value multiset).

Runs on sf0.001 to stay quick; the driver repeats this at sf0.01.
"""

import re

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from carepulse.plans.verify import compare, duck

ORACLE_KEYS = sorted(E.oracle_sql())
# the keys of the llm subpackage have tests of their own in tests/llm
ROWS_ONLY = sorted(k for k in set(E.queries()) - set(E.oracle_sql()) if not re.match(r"op\d+_|pipeline$", k))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", ORACLE_KEYS)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["cols_match"], r
    assert r["rows_match"], r
    assert r["values_match"], r


def test_every_key_has_a_plan():
    assert set(E.oracle_sql()) <= set(E.queries())
    # micro-batch metrics have no oracle
    assert set(ROWS_ONLY) == {"stream_progress"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["segment", "total_patients", "high_risk_patients", "high_risk_pct"]
    assert rows and rows[0]["segment"] is not None
