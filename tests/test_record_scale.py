"""The record pipeline at many rows: generated code of wide projections, codes by dictionary size, the scaler's fit."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from carepulse.functions.encode import coerce_double, coerce_int, encode_features
from carepulse.operators import clean
from carepulse.operators.stages import PopulationScaler
from carepulse.plans import q_wide
from carepulse.schemas import ENCOUNTER_COLUMNS
from tests.test_spread import orders
from tests.test_wide_batch import JVM_LIMIT, longest_method


def test_raw_records_are_compiled(spark, tmp_path):
    raw = q_wide.raw_records(spark, orders(spark, str(tmp_path), 100))
    assert longest_method(raw) < JVM_LIMIT
    assert raw.columns == ENCOUNTER_COLUMNS and raw.count() == 100


def codes(spark, n: int):
    """A dictionary of two columns, one with many texts, and rows with every text, an unseen one and missing ones."""
    dictionary = spark.createDataFrame([("many", f"v{i:04d}", i) for i in range(n)] + [("few", "a", 0), ("few", "b", 1)], "name string, v string, code int")
    rows = spark.createDataFrame([(i, f"v{i:04d}", "ab"[i % 2]) for i in range(n)] + [(-1, "?", "zz"), (-2, None, "?"), (-3, "other", None), (-3, "other", None)], "id int, many string, few string")
    return dictionary, rows, sorted([(i, i, i % 2) for i in range(n)] + [(-1, None, 2), (-2, None, None), (-3, n, None), (-3, n, None)], key=str)


@pytest.mark.parametrize("broadcast", [1_000_000, 10])
def test_many_texts_are_not_searched_one_by_one(spark, monkeypatch, broadcast):
    monkeypatch.setattr(clean, "BROADCAST_ENTRIES", broadcast)
    dictionary, rows, want = codes(spark, 300)
    out = clean.code_columns(rows, ["many", "few"], dictionary)
    assert "Join" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert out.columns == ["id", "many", "few"] and dict(out.dtypes)["many"] == "int"


def test_dictionary_leaves_out_markers_and_nulls(spark):
    train = spark.createDataFrame([("b", "?"), ("?", None), (None, "NaN"), ("a", "x"), ("b", "x")], "metformin string, A1Cresult string")
    got = {(r["name"], r["v"]): r["code"] for r in clean.text_code_dictionary(train).collect()}
    assert got == {("metformin", "a"): 0, ("metformin", "b"): 1, ("A1Cresult", "x"): 0}


def test_texts_of_many_columns_are_coerced_as_one(spark):
    odd = ["250.83", " 7 ", "\t-7.9\n", "+1e3", "1E-2", ".5", "5.", ".", "", " ", "V57", "?", "1e", "1 2", "--1", "250d", "NaN", "Infinity", "0x10", "1e999", "-1e999", "99999999999", "\x0012", "١٢", "12\x0b", None]
    rows = spark.createDataFrame([(x,) for x in odd], "diag_1 string")
    for numeric, one in (("int", coerce_int), ("double", coerce_double)):
        got = [r[0] for r in encode_features(rows, ["diag_1"], numeric=numeric).collect()]
        assert got == [r[0] for r in rows.select(F.coalesce(one(F.col("diag_1")), F.lit(0))).collect()]


def test_scaler_fits_as_the_exact_aggregates(spark):
    rows = spark.createDataFrame([(0.0, 1, None, 0.1, float("nan"), None), (2.5, 1, 4.0, 0.1, 1.0, None), (-7.25, 3, 5.5, 0.1, 2.0, None)], "`a-b` double, n int, holed double, same double, nan double, none double")
    names = rows.columns
    model = PopulationScaler(inputCols=names, outputCols=[f"s{i}" for i in range(len(names))]).fit(rows.repartition(2))
    exact = rows.agg(*[f(f"`{c}`") for c in names for f in (F.avg, F.stddev_pop)]).first()
    for i, (mean, deviation) in enumerate(zip(model.getOrDefault(model.means), model.getOrDefault(model.deviations))):
        for got, want in ((mean, exact[2 * i]), (deviation, exact[2 * i + 1])):
            assert got == pytest.approx(want or 0.0, abs=1e-12) or math.isnan(got) and math.isnan(want)
    assert model.getOrDefault(model.deviations)[3] == 0.0
