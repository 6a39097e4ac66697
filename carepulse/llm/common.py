"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.session import new_scratch, scratch_root

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a (spark, sf_dir) -> DataFrame query, with its oracle SQL where SQL can say it."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it (on a cluster that is deployed with the library)."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed table as literals in the plan (one partition, nothing leaves the JVM)."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that a text operator reads, under fixed names, null text as empty; others are left behind."""
    importable(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


#: Rows whose texts, or numbers made of them, a Python worker holds at one time.
TOGETHER = 500


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, TOGETHER at a time: what is made of them in Python stays small."""
    for batch in batches:
        for at in range(0, len(batch), TOGETHER):
            yield batch.slice(at, TOGETHER)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: computed once, no lineage to lose."""
    path = new_scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder (``spark.checkpoint.dir``)."""
    scratch_root(df.sparkSession)
    return df.checkpoint()
