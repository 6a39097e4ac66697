"""Hot keys: one patient / one value holding a third of all rows must not change results."""

import random

from pyspark.sql import functions as F

from carepulse.operators.clean import column_modes, impute_median
from carepulse.operators.results import latest_per_key, risk_kpi


def test_latest_per_key_with_hot_patient(spark):
    rnd = random.Random(2)
    rows = [(7, i, rnd.randint(0, 2)) for i in range(3000)]            # hot patient: a third of the rows
    rows += [(rnd.randint(100, 400), 10_000 + i, rnd.randint(0, 2)) for i in range(6000)]
    df = spark.createDataFrame(rows, "patient_nbr long, encounter_id long, readmission_prediction int") \
        .repartition(16)
    got = {r.patient_nbr: (r.encounter_id, r.readmission_prediction)
           for r in latest_per_key(df, "patient_nbr", "encounter_id").collect()}
    want = {}
    for p, e, c in rows:
        if p not in want or e > want[p][0]:
            want[p] = (e, c)
    assert got == want
    kpi = risk_kpi(latest_per_key(df, "patient_nbr", "encounter_id")).first()
    assert kpi.total_patients == len(want)
    assert kpi.high_risk_patients == sum(1 for e, c in want.values() if c == 1)


def test_latest_per_key_ties_are_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z")], "k int, o int, v string")
    assert latest_per_key(df, "k", "o").first().v == "b"
    assert latest_per_key(df.repartition(3), "k", "o").first().v == "b"


def test_hot_value_median_and_mode(spark):
    xs = [42.0] * 5000 + [float(i) for i in range(10_000)] + [None] * 100
    df = spark.createDataFrame([(x, "hot" if x == 42.0 else f"v{int(x) % 7}" if x is not None else None)
                                for x in xs], "x double, s string").repartition(8)
    filled = impute_median(df, ["x"])
    assert filled.where(F.col("x").isNull()).count() == 0
    vals = sorted(x for x in xs if x is not None)
    n = len(vals)
    med = (vals[(n - 1) // 2] + vals[n // 2]) / 2
    assert filled.where(F.col("s").isNull()).select("x").distinct().first().x == med
    assert column_modes(df, ["s"]).first()["mode"] == "hot"
