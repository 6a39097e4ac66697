"""The scaler of many columns is compiled, the fit encodes a row once."""

from __future__ import annotations

from pyspark.sql import functions as F

from carepulse.operators import forest
from carepulse.operators.stages import EncounterEncoder, PopulationScaler
from carepulse.schemas import FEATURE_COLUMNS
from tests.test_wide_batch import JVM_LIMIT, longest_method


def test_scaler_of_many_columns_is_compiled(spark, tmp_path):
    path, names = str(tmp_path / "n"), [f"c-{i}" for i in range(49)]
    spark.createDataFrame([tuple(float(i * k) if k or i % 2 else None for i in range(49)) for k in range(4)], ", ".join(f"`{c}` double" for c in names)).write.parquet(path)
    rows = spark.read.parquet(path)
    out = PopulationScaler(inputCols=names, outputCols=[f"scaled_{i}" for i in range(49)]).fit(rows).transform(rows)
    assert longest_method(out.select(*[f"scaled_{i}" for i in range(49)])) < JVM_LIMIT
    got = {r[0]: tuple(r)[1:] for r in out.select("`c-3`", "scaled_0", "scaled_2", "scaled_3").collect()}
    assert got[0.0][:2] == (None, None) and got[9.0][0] == 0.0  # no deviation: 0, a missing value stays missing
    assert abs(got[9.0][2] - 1.3416407864998738) < 1e-12


def test_fit_reads_encoded_numbers_that_are_held(spark, monkeypatch):
    seen = []

    class Body:
        stages: list = []

        def fit(self, df):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            return self

    monkeypatch.setattr(forest, "build_pipeline", lambda *a, **k: Body())
    train = spark.createDataFrame([("[10-20)", "NO"), ("[20-30)", "<30")], "age string, readmitted string")
    model = forest.fit_forest(train, FEATURE_COLUMNS, "readmitted", before=[EncounterEncoder()])
    assert seen[0].lstrip().startswith("InMemoryTableScan") and len(model.stages) == 2
