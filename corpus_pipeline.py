"""The corpus pipeline: documents through five stages, each stage's result written and read as the next one's input.

1. quality: importance resampling against the labelled good documents; rejected documents go.
2. near_duplicates: the n-gram Jaccard join (five words, similarity 0.8); the document with the smallest id of each class stays.
3. decontamination: documents that hold a benchmark item go.
4. secrets: found spans are replaced in the text, documents stay.
5. tokens: SentencePiece ids of what is left, with the decoded text's digest.

All stages but the last return the columns of documents. Null texts count as empty and are kept; rows without an id are kept
by the second stage (they link with nothing); rows that repeat an id with one text are one document there. Empty tables
give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.llm import decontamination, importance_resampling, jaccard_join, secret_scan, sentencepiece_bpe
from carepulse.llm.common import table
from carepulse.session import new_scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return importance_resampling.Resampler(docs, table(spark, sf_dir, "labels")).kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.deduplicated(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_bpe.round_trip(docs, model)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminate), ("secrets", secrets), ("tokens", tokens)]

#: Trained weights, alignment and the encoder can't be said in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
