"""Encoder edge cases on D1-shaped rows (FIXTURES edge-case list)."""

from pyspark.sql import functions as F

from carepulse.functions.encode import (
    apply_value_maps, coerce_double, coerce_int, encode_features, replace_null_markers,
)
from carepulse.schemas import AGE_MAP, ENCOUNTER_COLUMNS, ENCOUNTER_SCHEMA, FEATURE_COLUMNS, VALUE_MAPS


def _records(spark, rows):
    """rows: list of dicts over a few D1 fields; the rest stay NULL."""
    full = [tuple(r.get(c) for c in ENCOUNTER_COLUMNS) for r in rows]
    return spark.createDataFrame(full, ENCOUNTER_SCHEMA)


def test_every_map_table_and_default(spark):
    for col, (mapping, default) in VALUE_MAPS.items():
        rows = [{"encounter_id": str(i), col: k} for i, k in enumerate(mapping)]
        rows += [{"encounter_id": "u", col: "never-seen"}, {"encounter_id": "n", col: None},
                 {"encounter_id": "q", col: "?"}, {"encounter_id": "e", col: ""}]
        got = {r["encounter_id"]: r[col] for r in apply_value_maps(_records(spark, rows)).collect()}
        for i, (k, v) in enumerate(mapping.items()):
            assert got[str(i)] == v, (col, k)
        for key in "unqe":
            assert got[key] == default, (col, key)


def test_numeric_age_maps_to_default(spark):
    got = encode_features(_records(spark, [{"age": "60"}, {"age": "[60-70)"}])).collect()
    assert [r["age"] for r in got] == [0.0, float(AGE_MAP["[60-70)"])]


def test_coercions(spark):
    df = spark.createDataFrame([("250.83",), ("V57",), ("?",), (None,), ("NaN",), ("",), ("12",), ("-3.9",)], "x string")
    got = df.select(coerce_int(F.col("x")).alias("i"), coerce_double(F.col("x")).alias("d")).collect()
    assert [r["i"] for r in got][:3] == [250, None, None]
    assert [r["d"] for r in got][:2] == [250.83, None]
    assert got[6]["i"] == 12 and got[7]["i"] == -3  # truncation toward zero
    assert got[5]["i"] is None and got[5]["d"] is None


def test_encoder_shape_types_and_no_nulls(spark):
    rows = [{"encounter_id": "1", "patient_nbr": "2", "gender": "Male", "age": "[70-80)", "race": "?",
             "diag_1": "250.83", "diag_2": "V57", "insulin": "Up", "metformin": "No", "weight": "?"},
            {}]
    out = encode_features(_records(spark, rows))
    assert out.columns == FEATURE_COLUMNS
    assert all(f.dataType.typeName() == "double" for f in out.schema.fields)
    r0, r1 = out.collect()
    assert r0["gender"] == 1 and r0["age"] == 75 and r0["race"] == 0 and r0["diag_1"] == 250.83
    assert r0["diag_2"] == 0 and r0["insulin"] == 2 and r0["metformin"] == 0
    assert all(v is not None for v in r1)
    assert r1["gender"] == -1


def test_insulin_flag_and_int_mode(spark):
    rows = [{"insulin": "Down", "diag_1": "250.83"}]
    a = encode_features(_records(spark, rows), insulin=False, numeric="int").first()
    assert a["insulin"] == 0 and a["diag_1"] == 250
    b = encode_features(_records(spark, rows)).first()
    assert b["insulin"] == 3


def test_missing_and_extra_columns(spark):
    df = spark.createDataFrame([("M", "x")], "gender string, extra string").withColumnRenamed("gender", "gender")
    out = encode_features(df.withColumn("gender", F.lit("Female")))
    assert out.columns == FEATURE_COLUMNS
    assert out.first()["gender"] == 0 and out.first()["number_inpatient"] == 0.0


def test_null_marker_only_touches_strings(spark):
    df = spark.createDataFrame([("?", 1, "a?")], "s string, n int, t string")
    r = replace_null_markers(df).first()
    assert r["s"] is None and r["n"] == 1 and r["t"] == "a?"


def test_encoder_stays_in_codegen(spark):
    """No Python evaluation node on the data path."""
    df = _records(spark, [{"age": "[10-20)"}])
    plan = encode_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_unmapped_text_gets_training_codes(spark):
    from carepulse.operators.clean import apply_text_codes, text_code_dictionary
    train = _records(spark, [{"metformin": "No", "payer_code": "MC"}, {"metformin": "Steady", "payer_code": "?"},
                             {"metformin": "Steady", "payer_code": "BC"}])
    dic = text_code_dictionary(train)
    serve = _records(spark, [{"encounter_id": "1", "metformin": "Steady", "payer_code": "BC"},
                             {"encounter_id": "2", "metformin": "Up", "payer_code": "?"},
                             {"encounter_id": "3", "metformin": None, "payer_code": "XX"}])
    out = {r.encounter_id: r for r in encode_features(apply_text_codes(serve, dic), keep=["encounter_id"]).collect()}
    assert out["1"]["metformin"] == 1 and out["1"]["payer_code"] == 0      # alphabetical training codes
    assert out["2"]["metformin"] == 2                                       # unseen -> one past the last code
    assert out["2"]["payer_code"] == 0 and out["3"]["metformin"] == 0       # '?' / NULL -> missing -> 0
    assert out["3"]["payer_code"] == 2
    # the default serving path still turns unmapped text into 0
    assert encode_features(serve).collect()[0]["metformin"] == 0


def test_validate_encounter_profiles(spark):
    from carepulse.functions.quality import validate_encounters
    df = _records(spark, [{"encounter_id": "1", "race": "Caucasian", "gender": "Male", "age": "[70-80)",
                           "time_in_hospital": "4", "num_procedures": "12"},
                          {"encounter_id": "2", "race": "Martian", "gender": "Female", "age": "60",
                           "time_in_hospital": "31", "num_procedures": "1"}])
    got = {r.encounter_id: r for r in validate_encounters(df).collect()}
    assert got["1"].violations == ["num_procedures:range"] and not got["1"].is_valid
    assert got["2"].violations == ["age:domain", "race:domain", "time_in_hospital:range"]
    scoring = {r.encounter_id: r for r in validate_encounters(df, "scoring").collect()}
    # the scoring profile wants a numeric age: a bucket text breaks it, "60" passes; 12 procedures is in 0..20
    assert scoring["1"].violations == ["age:range"]
    assert scoring["2"].violations == ["time_in_hospital:range"]


def test_format_pct_and_label(spark):
    from carepulse.functions.records import format_pct, predict_label
    df = spark.createDataFrame([(12.345, 1), (None, None), (0.0, 2)], "p double, c int")
    got = df.select(format_pct(F.col("p")).alias("t"), format_pct(F.col("p"), 1).alias("t1"),
                    predict_label(F.col("c")).alias("l")).collect()
    assert [r.t for r in got] == ["12.35%", None, "0.00%"]
    assert [r.t1 for r in got] == ["12.3%", None, "0.0%"]
    halves = spark.createDataFrame([(x,) for x in (0.125, 2.675, 0.375, 1.005, 99.995, -0.125, 0.005, 1e15, 7.0)], "p double")
    assert [r.t for r in halves.select(format_pct(F.col("p")).alias("t")).collect()] == [f"{x:.2f}%" for x in (0.125, 2.675, 0.375, 1.005, 99.995, -0.125, 0.005, 1e15, 7.0)]
    assert [r.l for r in got] == ["Readmitted", "Not Readmitted", "Not Readmitted"]


def test_format_pct_equals_a_format_string_next_to_halves(spark):
    import math
    import random
    rng = random.Random(2)
    xs = [rng.randrange(10 ** 6) / 8 for _ in range(300)] + [rng.randrange(10 ** 5) / 1000 + 0.005 for _ in range(300)]
    xs += [math.nextafter(x, s) for x in xs for s in (-math.inf, math.inf)] + [10.0 ** e * rng.random() for e in range(-8, 18) for _ in range(20)]
    xs += [2.0 ** 53 + 2, 2.0 ** 62, 9007199254740993.0, 4503599627370496.5, 1e13 + 0.125, 0.0, -0.0, 0.5, 1.5, 2.5]
    xs += [-x for x in xs]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "p double")
    for decimals in (0, 1, 2, 3):
        got = {r.p: r.t for r in df.select("p", format_pct_of(decimals).alias("t")).collect()}
        assert got[None] is None
        for x in xs:
            assert got[x].lstrip("-") == f"{abs(x):.{decimals}f}%" and (x >= 0 or got[x][0] == "-"), x


def format_pct_of(decimals):
    from carepulse.functions.records import format_pct
    return format_pct(F.col("p"), decimals)
