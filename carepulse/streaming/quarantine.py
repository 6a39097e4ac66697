"""Quarantine with a reason for each row, and a job that drives mended rows back under their original micro-batch.

Reasons, the first that holds: ``not_json`` (no JSON object), ``empty`` (blank, or an object without any field of the record), ``wrong_type`` (a field
that isn't of its type; ``details`` names the fields), ``domain`` (a rule of `functions.quality` broken; ``details`` names the rules).
Good rows have no reason. Each micro-batch writes its own partition of both sides, so a replay replaces. ``redrive`` judges
the mended texts anew and publishes the outcome as one snapshot: running it again, with the same mend or a better one, replaces
what the last run said, never adds to it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepulse.functions.quality import violations_expr
from carepulse.schemas import quote
from carepulse.sources.snapshots import publish, read_current
from carepulse.streaming.jobs import CORRUPT, parse_messages, run_available, write_batch_partition

REASON = "reason string, details array<string>, raw string"


def judged(messages: DataFrame, schema: T.StructType, allowed: Mapping[str, Sequence] | None = None,
           ranges: Mapping[str, tuple] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """`keep`, the typed fields, reason (NULL: good), details, raw of every message text `value`; a NULL message is empty text."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = parse_messages(messages.withColumn("value", F.coalesce("value", F.lit(""))), texts, [*keep, "value"])
    typed = {f.name: F.col(quote(f.name)).try_cast(f.dataType) for f in schema.fields}
    wrong = F.array_compact(F.array(*[F.when(F.col(quote(n)).isNotNull() & c.isNull(), F.lit(n)) for n, c in typed.items()]))
    broken = violations_expr(allowed, ranges)
    text = F.trim(F.col("value"))
    no_object = (text != "") & (~text.startswith("{") | F.get_json_object(text, "$").isNull())
    unread = F.col(CORRUPT).isNotNull()
    reason = (F.when(unread & no_object, "not_json").when(unread, "empty").when(F.size(wrong) > 0, "wrong_type").when(F.size(broken) > 0, "domain"))
    details = F.when(unread, F.array().cast("array<string>")).when(F.size(wrong) > 0, wrong).otherwise(broken)
    return parsed.select(*[F.col(quote(k)) for k in keep], *[c.alias(n) for n, c in typed.items()],
                         reason.alias("reason"), details.alias("details"), F.col("value").alias("raw"))


def quarantine_stream(messages: DataFrame, schema: T.StructType, good_path: str, bad_path: str, checkpoint: str,
                      allowed: Mapping[str, Sequence] | None = None, ranges: Mapping[str, tuple] | None = None):
    """Judge a stream to its end: good rows to one Parquet folder, the others with reason, details and text to another."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch_partition(batch.where(F.col("reason").isNull()).drop("reason", "details", "raw"), good_path, batch_id, "parquet")
            write_batch_partition(batch.where(F.col("reason").isNotNull()).select("reason", "details", "raw"), bad_path, batch_id, "parquet")
        finally:
            batch.unpersist()

    writer = judged(messages, schema, allowed, ranges).writeStream.outputMode("append").foreachBatch(sink)
    return run_available(writer, checkpoint)


def redrive(spark: SparkSession, bad_path: str, out_path: str, mend: Callable[[Column, Column], Column], schema: T.StructType,
            allowed: Mapping[str, Sequence] | None = None, ranges: Mapping[str, tuple] | None = None) -> None:
    """Judge every quarantined text anew, as `mend(raw, reason)` makes it (NULL: as it was), and publish the outcome with its batch id."""
    bad = spark.read.schema(f"{REASON}, batch_id long").parquet(bad_path)
    mended = bad.select("batch_id", F.coalesce(mend(F.col("raw"), F.col("reason")), F.col("raw")).alias("value"))
    publish(judged(mended, schema, allowed, ranges, keep=["batch_id"]), out_path)


def good_rows(spark: SparkSession, good_path: str, redriven_path: str | None, schema: T.StructType) -> DataFrame:
    """All good rows with their batch id: those of the stream and, after a `redrive`, the mended ones."""
    own = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(own).parquet(good_path)
    if redriven_path is None:
        return rows
    back = read_current(spark, redriven_path).where(F.col("reason").isNull())
    return rows.unionByName(back.select(*[F.col(quote(f.name)) for f in own.fields]))
