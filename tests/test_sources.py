"""Source / sink round trips with our own small fixtures."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepulse.schemas import ENCOUNTER_COLUMNS, ENCOUNTER_SCHEMA
from carepulse.sources.files import (
    read_first_available, read_header_dir, read_headerless_csv, read_positional, read_results,
)
from carepulse.sources.lookups import decode, encode_strict, lookup_frame, read_code_lookups
from carepulse.sources.writers import from_file_names, publish_json, write_csv
from carepulse.functions.records import default_fields, row_to_csv


def _record(i, **kw):
    r = {c: "No" for c in ENCOUNTER_COLUMNS}
    r.update({"encounter_id": str(i), "patient_nbr": str(100 + i), "race": "Caucasian", "gender": "Male"})
    r.update(kw)
    return tuple(r[c] for c in ENCOUNTER_COLUMNS)


def test_headerless_fifty_columns_and_comma_in_value(spark, scratch):
    path = scratch("hl")
    df = spark.createDataFrame([_record(1, medical_specialty="Surgery, General"), _record(2)], ENCOUNTER_SCHEMA)
    df.write.csv(path, header=False)
    back = read_headerless_csv(spark, path)
    assert back.count() == 2
    assert {r.medical_specialty for r in back.collect()} == {"Surgery, General", "No"}


def test_header_dir_rejects_reordered_header(spark, scratch):
    path = scratch("hd")
    df = spark.createDataFrame([_record(1)], ENCOUNTER_SCHEMA)
    df.select(*reversed(df.columns)).write.csv(path, header=True)
    with pytest.raises(Exception):
        read_header_dir(spark, path).collect()


def test_header_dir_absent_or_empty_is_quiet(spark, scratch):
    assert read_header_dir(spark, scratch("none")).count() == 0
    empty = scratch("empty")
    spark.createDataFrame([], "a string").write.csv(empty)  # folder exists, holds no data file
    assert read_header_dir(spark, empty).count() == 0


def test_positional_rename_checks_count(spark, scratch):
    path = scratch("pos")
    spark.createDataFrame([(1, 2.5)], "a int, b double").write.csv(path)
    assert read_positional(spark, path, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        read_positional(spark, path, ["x"])


def test_results_union_by_name_and_fallback(spark, scratch):
    a, b = scratch("a"), scratch("b")
    spark.createDataFrame([(1, "x")], "k long, s string").write.csv(a, header=True)
    spark.createDataFrame([(2, 0.5)], "k long, v double").write.csv(b, header=True)
    u = read_results(spark, [(a, T.StructType.fromJson({"type": "struct", "fields": [
        {"name": "k", "type": "long", "nullable": True, "metadata": {}},
        {"name": "s", "type": "string", "nullable": True, "metadata": {}}]})), b])
    assert sorted(u.columns) == ["k", "s", "v"] and u.count() == 2
    sch = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])
    assert read_first_available(spark, [scratch("missing1"), scratch("missing2")], sch).count() == 0
    assert read_first_available(spark, [scratch("missing"), a], sch).count() == 1


def test_overwrite_and_append_sinks(spark, scratch):
    path = scratch("ow")
    df = spark.createDataFrame([(1, 12.5)], "encounter_id long, readmission_probability_pct double")
    write_csv(df, path)
    write_csv(df, path)
    raw = spark.read.csv(path, header=True)
    assert "readmission_probability(%)" in raw.columns and raw.count() == 1
    write_csv(df, path, mode="append")
    assert from_file_names(spark.read.csv(path, header=True)).count() == 2


def test_publish_and_row_to_csv(spark, scratch):
    df = spark.createDataFrame([(1, "a,b", None)], "id int, t string, n string")
    msgs = publish_json(df, scratch("pub"))
    assert msgs.first().value == '{"id":1,"t":"a,b"}'
    assert row_to_csv(df).first().line == '1,"a,b",'


def test_default_fields_complete_and_stable_ids(spark):
    df = spark.createDataFrame([(None, "Male"), (None, "Female")], "encounter_id string, gender string")
    out = default_fields(df).collect()
    assert len(out[0]) == 50 and out[0]["metformin"] == "No" and out[0]["diabetesMed"] == "Yes"
    assert out[0]["encounter_id"] != out[1]["encounter_id"]
    assert all(0 <= int(r[c]) < 2 ** 63 for r in out for c in ("encounter_id", "patient_nbr"))
    assert out[0]["encounter_id"] != out[0]["patient_nbr"]
    same = spark.createDataFrame([("Male", 0), ("Male", 1)], "gender string, line long")
    assert len({r["encounter_id"] for r in default_fields(same, sequence=["line"]).collect()}) == 2
    assert out[0]["insulin"] is None
    assert [r["encounter_id"] for r in default_fields(df).collect()] == [r["encounter_id"] for r in out]


LOOKUP_TEXT = """admission_type_id,description
2,Urgent
1,Emergency
6,NULL
,
discharge_disposition_id,description
1,Discharged to home
7,"Left AMA, against advice"
,
admission_source_id,description
1, Physician Referral
4,Transfer from a hospital
"""


def test_code_lookup_file(spark, scratch, tmp_path):
    p = tmp_path / "ids.csv"
    p.write_text(LOOKUP_TEXT)
    rows = read_code_lookups(spark, str(p)).collect()
    by = {(r.lookup, r.id): r.description for r in rows}
    assert len(rows) == 7
    assert by[("admission_type_id", 6)] == "NULL"
    assert by[("discharge_disposition_id", 7)] == "Left AMA, against advice"
    assert by[("admission_source_id", 1)] == "Physician Referral"


def test_strict_encode_and_decode(spark):
    dim = lookup_frame(spark, {"Emergency": 1, "Urgent": 2})
    df = spark.createDataFrame([("Urgent",)], "label string")
    assert encode_strict(df, dim, "label", "label", "id", "code").first().code == 2
    for label in ("Trauma", None):
        with pytest.raises(Exception, match="unknown label"):
            encode_strict(spark.createDataFrame([(label,)], "label string"), dim, "label", "label", "id", "code").collect()
    assert decode(df, dim, "label").first().id == 2


def test_publish_keyed_messages_with_limit(spark, scratch):
    df = spark.createDataFrame([(i, f"p{i % 2}") for i in range(10)], "encounter_id int, patient_nbr string")
    msgs = publish_json(df, scratch("pub"), key_col="encounter_id", limit=3, order_by="encounter_id")
    rows = msgs.collect()
    assert msgs.columns == ["key", "value"] and len(rows) == 3
    assert rows[0].key == "0" and rows[0].value == '{"encounter_id":0,"patient_nbr":"p0"}'


def test_code_lookup_file_with_crlf(spark, tmp_path):
    p = tmp_path / "ids_crlf.csv"
    p.write_bytes(LOOKUP_TEXT.replace("\n", "\r\n").encode())
    rows = read_code_lookups(spark, str(p)).collect()
    by = {(r.lookup, r.id): r.description for r in rows}
    assert len(rows) == 7 and by[("admission_source_id", 4)] == "Transfer from a hospital"
