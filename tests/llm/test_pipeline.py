"""The pipeline's stages against plain versions, and the guard of the entry point."""

import re

import corpus_pipeline
import pytest

from carepulse.llm import decontamination, secret_scan, sentencepiece_bpe
from tests.llm.test_operators import PIECES, brute_classes, empty_docs, odd_docs, plain_secrets

SMALL = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).cache()
        frames[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    quality = {r.doc_id for r in frames["quality"]}
    good, bad = [d for d, q in labels.items() if q == 1 and d in rows], [d for d, q in labels.items() if q == 0 and d in rows]
    assert sum(d in quality for d in good) >= 0.97 * len(good) and sum(d in quality for d in bad) <= 0.1 * len(bad)
    classes, _ = brute_classes([(d, rows[d].text) for d in quality], 5, 80)
    assert {r.doc_id for r in frames["near_duplicates"]} == {c for _, _, c in classes}
    held = {r.doc_id for r in decontamination.contaminated(spark.createDataFrame(frames["near_duplicates"]), spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in frames["decontamination"]} == {r.doc_id for r in frames["near_duplicates"]} - held
    for r in frames["secrets"]:
        assert not plain_secrets(r.text)
        if not plain_secrets(rows[r.doc_id].text) and r.text != rows[r.doc_id].text:
            assert "[SECRET]" in r.text
    codec = sentencepiece_bpe.MergeCodec(PIECES)
    texts = {r.doc_id: r.text for r in frames["secrets"]}
    assert {(r.doc_id, bytes(r.ids)) for r in frames["tokens"]} == {(d, codec.encode(t)) for d, t in texts.items()}


def test_run_equals_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and rows.count() > 100


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, name, stage):
    rows = stage(spark, odd_docs(spark), SMALL).collect()
    assert len(rows) <= 14
    assert stage(spark, empty_docs(spark), SMALL).collect() == []


def test_entry_has_all_queries():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(re.match(rf"op{n}_", x) for x in names) for n in range(1, 11))
    assert secret_scan.KINDS[0] == "assign"
