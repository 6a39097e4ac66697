"""The registered queries opN_<name>: each dealt operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.llm import (
    best_fit_packing, decontamination, fill_in_middle, importance_resampling, jaccard_join, learned_index, license_scan, periodic_runs,
    pii_scan, secret_scan, sentencepiece_bpe, token_store, url_filter,
)
from carepulse.llm.common import register, stored, table
from carepulse.llm.spans import let, listed
from carepulse.session import new_scratch


#: The URL rules of op5 as (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@register("op1_importance_resampling")
def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_bpe.round_trip(table(spark, sf_dir, "documents"), model)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@register("op3_ngram_jaccard")
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"), width=4, percent=85)


@register("op7_token_store")
def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_store.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register("op5_url_filter")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, url_filter.fit(url_filter.labelled_urls(spark)))


@register("op6_learned_index")
def op6_learned_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = learned_index.Index(table(spark, sf_dir, "embeddings"))
    return index.search(index.rows.where(F.col("vec_id") % 20 == 0), k=20)


@register("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[_count("base", k) for k in ("assign", "access", "hex")], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@register("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op10_pii_scan")
def op10_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[_count("base", k) for k in ("email", "ip", "card", "phone")], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """op11's texts: of documents whose id's crc32 ends in 0, the words from one place on repeat the first few from there."""
    h, text = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.coalesce("text", F.lit(""))
    g = F.floor(h / 10).cast("bigint")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " ")

    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    planted = F.when(h % 10 == 0, let(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")))
    return docs.select("doc_id", F.coalesce(planted, text).alias("text"))


@register("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda s, r: F.when(s.isNull() | (r["length"] * s["period"] > s["length"] * r["period"]), r).otherwise(s))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents),
drawn AS (
  SELECT *, len(tokens) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM texts),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle, array_to_string(tokens[b + 1:n], '') AS suffix
  FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@register("op12_fill_in_middle", OP12_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.transform(table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@register("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = best_fit_packing.tokenised(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=0)
    packed = best_fit_packing.pack(stored(pieces, "packing-pieces"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
