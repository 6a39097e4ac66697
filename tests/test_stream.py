"""Streaming: parse, quarantine, replay-safe sinks, restart, empty batches, forest in the stream."""

import json

from pyspark.sql import functions as F

from carepulse.plans.q_model import FEATURES, encoded_encounters, trained_model
from carepulse.plans.q_stream import rule_scorer
from carepulse.operators.forest import score
from carepulse.schemas import ENCOUNTER_COLUMNS, VITALS_SCHEMA
from carepulse.streaming.jobs import (
    CORRUPT, compact_upserts, land_raw, message_stream, parse_messages, parse_typed, read_upserted,
    keyed_upsert_sink, run_available, score_stream, scored_sink, write_batch_partition,
)
from conftest import SF_SMALL


def _msg(i, **kw):
    d = {"encounter_id": str(i), "patient_nbr": str(500 + i % 3), "gender": "Female", "age": "[50-60)",
         "time_in_hospital": "3", "num_lab_procedures": "40", "race": "Asian"}
    d.update(kw)
    return json.dumps(d)


def _land(spark, path, lines, files=2):
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(files).write.mode("append").text(path)


def test_parse_quarantine_and_markers(spark, scratch):
    lines = [_msg(1), _msg(2, extra_field="x"), '{"encounter_id": "3", "gender": ', _msg(4, race="NaN"),
             json.dumps({"encounter_id": "5"})]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = {r.encounter_id: r for r in parse_messages(df).collect() if r.encounter_id}
    bad = parse_messages(df).where(F.col(CORRUPT).isNotNull()).collect()
    assert len(bad) == 1 and bad[0].encounter_id is None and bad[0].gender is None
    assert rows["4"].race is None             # text "NaN" is a null marker
    assert rows["5"].gender is None           # missing field -> NULL
    assert rows["2"].gender == "Female"       # extra field ignored


def test_typed_parse_accepts_quoted_numbers(spark):
    df = spark.createDataFrame([('{"patient_id":"p","age":"45","blood_pressure":"1x"}',)], "value string")
    r = parse_typed(df, VITALS_SCHEMA).first()
    assert r.age == 45 and r.blood_pressure is None


def test_score_stream_replay_and_restart(spark, scratch):
    landing, res, quar, ckpt = scratch("land"), scratch("res"), scratch("quar"), scratch("ckpt")
    _land(spark, landing, [_msg(i) for i in range(20)] + ["not json"], files=3)
    score_stream(spark, message_stream(spark, path=landing, max_per_trigger=1), rule_scorer, res, quar, ckpt)
    first = spark.read.option("header", True).csv(res).count()
    assert first == 20
    assert spark.read.json(quar).count() == 1
    # restart on the same checkpoint: nothing is re-emitted
    score_stream(spark, message_stream(spark, path=landing, max_per_trigger=1), rule_scorer, res, quar, ckpt)
    assert spark.read.option("header", True).csv(res).count() == 20
    # new data after the restart is picked up
    _land(spark, landing, [_msg(100 + i) for i in range(5)], files=1)
    score_stream(spark, message_stream(spark, path=landing, max_per_trigger=1), rule_scorer, res, quar, ckpt)
    out = spark.read.option("header", True).csv(res)
    assert out.count() == 25
    assert set(out.columns) >= {"encounter_id", "readmission_prediction", "readmission_probability_pct", "batch_id"}


def test_sink_replay_of_a_batch_is_a_no_op(spark, scratch):
    res, quar = scratch("res"), scratch("quar")
    sink = scored_sink(res, quar)
    batch = spark.createDataFrame([(1, None), (2, None), (None, "bad")], "encounter_id long, _corrupt_record string")
    sink(batch, 7)
    sink(batch, 7)  # replay after a failure
    sink(spark.createDataFrame([], "encounter_id long, _corrupt_record string"), 8)  # empty batch: nothing
    assert spark.read.option("header", True).csv(res).count() == 2
    assert spark.read.json(quar).count() == 1


def test_land_raw_restart_exactly_once(spark, scratch):
    landing, out, ckpt = scratch("land"), scratch("raw"), scratch("ckpt")
    _land(spark, landing, [_msg(i) for i in range(30)], files=3)
    land_raw(message_stream(spark, path=landing, max_per_trigger=1), out, ckpt)
    land_raw(message_stream(spark, path=landing, max_per_trigger=1), out, ckpt)
    assert spark.read.parquet(out).count() == 30


def test_keyed_upsert_latest_wins(spark, scratch):
    out = scratch("ups")
    sink = keyed_upsert_sink(out, "k", "seq")
    sink(spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), (None, 2, "z")], "k string, seq long, v string"), 0)
    sink(spark.createDataFrame([("a", 2, "old"), ("b", 5, "w")], "k string, seq long, v string"), 1)
    got = {r.k: r.v for r in read_upserted(spark, out, "k", "seq").collect()}
    assert got == {"a": "y", "b": "w", "unknown": "z"}


def test_forest_scores_inside_the_stream(spark, scratch):
    model = trained_model(spark, SF_SMALL)

    def forest(enc):
        return score(model, enc, FEATURES, keep=enc.columns)

    landing, res, quar, ckpt = scratch("land"), scratch("res"), scratch("quar"), scratch("ckpt")
    _land(spark, landing, [_msg(i) for i in range(12)], files=2)
    score_stream(spark, message_stream(spark, path=landing, max_per_trigger=1), forest, res, quar, ckpt)
    out = spark.read.option("header", True).csv(res).collect()
    assert len(out) == 12
    assert all(0.0 <= float(r["readmission_probability_pct"]) <= 100.0 for r in out)


def test_processing_time_trigger(spark, scratch):
    """A continuous micro-batch query with a processing-time trigger, stopped after catching up."""
    landing, res, quar, ckpt = scratch("land"), scratch("res"), scratch("quar"), scratch("ckpt")
    _land(spark, landing, [_msg(i) for i in range(8)], files=2)
    q = score_stream(spark, message_stream(spark, path=landing), rule_scorer, res, quar, ckpt,
                     processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.option("header", True).csv(res).count() == 8


def test_keyed_upsert_compaction_keeps_answers(spark, scratch):
    out, snap = scratch("ups"), scratch("snap")
    sink = keyed_upsert_sink(out, "k", "seq")
    sink(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, seq long, v string"), 0)
    sink(spark.createDataFrame([("a", 3, "z")], "k string, seq long, v string"), 1)
    upto = compact_upserts(spark, out, "k", "seq", snap)
    assert upto == 1
    sink(spark.createDataFrame([("b", 1, "old"), ("c", 9, "w")], "k string, seq long, v string"), 2)
    full = sorted(tuple(r) for r in read_upserted(spark, out, "k", "seq").collect())
    fast = sorted(tuple(r) for r in read_upserted(spark, out, "k", "seq", snap, upto).collect())
    assert full == fast == [("a", 3, "z"), ("b", 2, "y"), ("c", 9, "w")]


def test_keyed_upsert_by_arrival(spark, scratch):
    """Equal order values, and no order value at all: the last message wins, whatever its payload."""
    for order in ("seq", None):
        out = scratch("arrive")
        sink = keyed_upsert_sink(out, "k", order)
        one = spark.createDataFrame([("a", 1, "zzz first"), ("a", 1, "aaa second"), (None, 1, "x")], "k string, seq long, v string").coalesce(1)
        sink(one, 0)
        sink(spark.createDataFrame([("b", 1, "w"), (None, 1, "a smaller payload")], "k string, seq long, v string").coalesce(1), 1)
        got = {r.k: r.v for r in read_upserted(spark, out, "k", order).collect()}
        assert got == {"a": "aaa second", "b": "w", "unknown": "a smaller payload"}


def test_every_reason_of_the_quarantine(spark, scratch):
    from pyspark.sql import functions as F
    from carepulse.schemas import VITALS_SCHEMA
    from carepulse.streaming import quarantine
    texts = [('{"patient_id":"1","age":"45","blood_pressure":"120.5"}', None, []), ('{"patient_id":"1","age":', "not_json", []), ("[1, 2]", "not_json", []), ("plain", "not_json", []),
             ("", "empty", []), ("  ", "empty", []), (None, "empty", []), ("{}", "empty", []), ('{"other":1}', "empty", []), ('{"patient_id":null}', "empty", []),
             ('{"age":"old","blood_pressure":"high","gender":"Male"}', "wrong_type", ["age", "blood_pressure"]), ('{"age":"450"}', "domain", ["age:range"]),
             ('{"age":45,"gender":"?"}', "domain", ["gender:domain"])]
    frame = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "id long, value string")
    got = {r.id: (r.reason, r.details) for r in quarantine.judged(frame, VITALS_SCHEMA, {"gender": ["Male", "Female"]}, {"age": (0, 120)}, keep=["id"]).collect()}
    assert got == {i: (reason, details) for i, (_, reason, details) in enumerate(texts)}
    landing, good, bad, ckpt, out = (scratch(t) for t in ("in", "good", "bad", "ckpt", "out"))
    frame.where("value is not null").select("value").write.text(landing)
    quarantine.quarantine_stream(spark.readStream.format("text").load(landing), VITALS_SCHEMA, good, bad, ckpt, {"gender": ["Male", "Female"]}, {"age": (0, 120)})
    assert quarantine.good_rows(spark, good, None, VITALS_SCHEMA).count() == 1
    for mended, want in ((lambda raw, reason: F.lit(None), 1), (lambda raw, reason: F.when(reason == "domain", F.lit('{"age":"46"}')), 3), (lambda raw, reason: F.lit(None), 1)):
        quarantine.redrive(spark, bad, out, mended, VITALS_SCHEMA, {"gender": ["Male", "Female"]}, {"age": (0, 120)})
        rows = quarantine.good_rows(spark, good, out, VITALS_SCHEMA).collect()
        assert len(rows) == want and all(r.batch_id == 0 for r in rows)


def test_default_trigger_goes_on(spark, scratch):
    """Without an interval a batch starts as soon as the last one ended, and files that arrive later are scored too."""
    import time
    from carepulse.plans.q_stream import encounter_messages, rule_scorer
    from carepulse.streaming.jobs import message_stream, score_stream
    messages = encounter_messages(spark, SF_SMALL).select("value").limit(40).collect()
    landing, res, quar, ckpt = (scratch(t) for t in ("in", "res", "quar", "ckpt"))
    first, second = ([r.value for r in messages[:20]], [r.value for r in messages[20:]])
    spark.createDataFrame([(v,) for v in first], "value string").coalesce(1).write.text(landing)
    q = score_stream(spark, message_stream(spark, path=landing), rule_scorer, res, quar, ckpt, continuous=True, fmt="parquet")
    try:
        spark.createDataFrame([(v,) for v in second], "value string").coalesce(1).write.mode("append").text(landing)
        seen, until = 0, time.time() + 120
        while seen < 40 and time.time() < until:
            time.sleep(1)
            q.processAllAvailable()
            seen = spark.read.parquet(res).count() + spark.read.json(quar, schema="raw string").count()
        assert q.isActive and seen == 40
    finally:
        q.stop()
