"""Structured Streaming: sources, parsing, quarantine, idempotent sinks.

The whole path (parse -> encode -> score) stays inside the streaming plan;
``foreachBatch`` is only the sink. Every sink is replay-safe: a micro-batch
writes into its own ``batch_id`` partition with dynamic partition overwrite,
so re-running a batch after a failure replaces, never duplicates. Every query
has a checkpoint, so a restart resumes where the last committed batch ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carepulse.functions.encode import coerce_int, encode_features
from carepulse.schemas import ENCOUNTER_SCHEMA, PROBABILITY_COLUMN, quote
from carepulse.streaming.store import store_batch

CORRUPT = "_corrupt_record"


# --- sources ------------------------------------------------------------------
def message_stream(spark: SparkSession, *, path: str | None = None, kafka_servers: str | None = None,
                   topic: str | None = None, starting_offsets: str = "latest",
                   max_per_trigger: int | None = None) -> DataFrame:
    """A stream of message texts in a `value` column.

    Kafka when a broker is given (needs the connector jar; `startingOffsets`
    applies to the first start only, the checkpoint rules afterwards), else a
    folder of JSON-lines files (one message per line).
    """
    if kafka_servers:
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("subscribe", topic).option("startingOffsets", starting_offsets))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        return r.load().select(F.col("value").cast("string").alias("value"))  # P1
    r = spark.readStream.format("text")
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    return r.load(path)


def parse_messages(df: DataFrame, schema: T.StructType = ENCOUNTER_SCHEMA,
                   keep: Sequence[str] = ()) -> DataFrame:
    """JSON text -> flat columns; malformed text is kept in `_corrupt_record`.

    A message without any field (empty text, `{}`, a tombstone) is malformed
    too; a NULL message is kept as empty text. Text "NaN" in a string field is
    a null marker, not a number.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value"), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = df.select(*[F.col(quote(k)) for k in keep], F.col("value").alias("_text"), parsed.alias("m"))
    nothing = F.coalesce(*[F.col("m").getField(f.name).cast("string") for f in schema.fields]).isNull()
    raw = F.coalesce(F.col("m").getField(CORRUPT), F.when(nothing, F.coalesce(F.col("_text"), F.lit(""))))
    broken = raw.isNotNull()
    cols = []
    for f in schema.fields:
        c = F.col("m").getField(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit("NaN"))
        # a malformed message contributes no fields, whatever a partial parse found
        cols.append(F.when(broken, F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
    return out.select(*[F.col(quote(k)) for k in keep], *cols, raw.alias(CORRUPT))


def parse_typed(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Typed record from JSON whose numbers may arrive as text (`"45"`).

    Parse every field as text, then `try_cast` to the pinned type: a quoted
    number still arrives, an unparsable one becomes NULL instead of failing.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = parse_messages(df, as_text, keep)
    return parsed.select(*[F.col(quote(k)) for k in keep],
                         *[F.col(quote(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields],
                         CORRUPT)


# --- scoring projection ----------------------------------------------------
def narrow_result(parsed: DataFrame, scorer: Callable[[DataFrame], DataFrame],
                  carry: Sequence[str] = ()) -> DataFrame:
    """P13 + D8: ids, encoded demographics, coerced stay, class and percent (pinned types).

    `scorer` maps an encoded frame (49 DOUBLE features) to one adding
    `readmission_prediction` and `readmission_probability_pct` (a fitted
    forest or a rule). `carry` columns pass through unchanged.
    """
    src = parsed.select("*", F.col("encounter_id").alias("_eid"), F.col("patient_nbr").alias("_pid"),
                        F.col("time_in_hospital").alias("_stay"))
    enc = encode_features(src, keep=["_eid", "_pid", "_stay", *carry])
    scored = scorer(enc)
    return scored.select(
        F.col("_eid").try_cast("long").alias("encounter_id"),
        F.col("_pid").try_cast("long").alias("patient_nbr"),
        F.col("age").cast("int").alias("age"),
        F.col("gender").cast("int").alias("gender"),
        F.col("race").cast("int").alias("race"),
        coerce_int(F.col("_stay")).alias("time_in_hospital"),
        F.col("readmission_prediction").cast("int").alias("readmission_prediction"),
        F.col(PROBABILITY_COLUMN).cast("double").alias(PROBABILITY_COLUMN),
        *[F.col(quote(c)) for c in carry],
    )


# --- sinks -------------------------------------------------------------------
def write_batch_partition(df: DataFrame, path: str, batch_id: int, fmt: str = "csv") -> None:
    """K1: write one micro-batch into `batch_id=<id>`; a replay overwrites only that partition."""
    w = (df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id"))
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def scored_sink(result_path: str, quarantine_path: str, fmt: str = "csv", progress_path: str | None = None):
    """T4 + T5 + T6: good rows to the results, malformed rows to quarantine, both per batch.

    The batch (bounded by the source's per-trigger limit) is materialised once
    (persist + count, which also tells an empty batch: it writes nothing) and
    both writes read the cached rows, so parse, encode and score run once per
    row. A failing write raises, so the checkpoint does not advance and the
    batch is retried (never silently dropped). ``fmt`` "store" keeps the
    results in a store that `streaming.store.compact` folds.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.count() == 0:
                return
            good = batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "value")
            bad = batch.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"))
            if fmt == "store":
                store_batch(good, result_path, batch_id)
            else:
                write_batch_partition(good, result_path, batch_id, fmt)
            write_batch_partition(bad, quarantine_path, batch_id, "text" if fmt == "text" else "json")
            if progress_path is not None:
                counts = batch.agg(F.count(F.lit(1)).alias("input_rows"), F.count(F.col(CORRUPT)).alias("quarantined_rows"))
                write_batch_partition(counts.coalesce(1), progress_path, batch_id, "parquet")
        finally:
            batch.unpersist()
    return sink


def run_available(writer, checkpoint: str, timeout_s: float | None = None) -> StreamingQuery:
    """T1/T7 for tests and catch-up jobs: process everything available, then stop; `timeout_s` None waits as long as it takes."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def score_stream(spark: SparkSession, messages: DataFrame, scorer, result_path: str,
                 quarantine_path: str, checkpoint: str, *, processing_time: str | None = None,
                 continuous: bool = False, timeout_s: float | None = None, progress_path: str | None = None,
                 fmt: str = "csv") -> StreamingQuery:
    """The live path: messages -> parse -> encode -> score -> foreachBatch(results, quarantine).

    `processing_time` ("10 seconds", T1) or `continuous` (the default trigger,
    a batch as soon as the last one ended, T2) starts a query that goes on;
    neither runs an availableNow catch-up and returns after it finished.
    `progress_path` keeps a row for every micro-batch (T9).
    """
    # One branch: every message is parsed once and carries its corrupt text
    # through; the sink splits results from quarantine (the scores computed
    # for a malformed row's empty fields are never written).
    both = narrow_result(parse_messages(messages), scorer, carry=[CORRUPT])
    writer = both.writeStream.outputMode("append").foreachBatch(scored_sink(result_path, quarantine_path, fmt, progress_path))
    if processing_time:
        return writer.option("checkpointLocation", checkpoint).trigger(processingTime=processing_time).start()
    if continuous:
        return writer.option("checkpointLocation", checkpoint).start()
    return run_available(writer, checkpoint, timeout_s)


def land_raw(messages: DataFrame, path: str, checkpoint: str, timeout_s: float | None = None) -> StreamingQuery:
    """K6 + T8: append raw messages to a file sink; the checkpoint makes restarts exactly-once.

    Every trigger flushes what arrived (no count threshold that strands a
    remainder); the source's maxFilesPerTrigger / maxOffsetsPerTrigger paces it.
    Parquet, because a line format would cut a message with a newline in two.
    """
    writer = messages.select("value").writeStream.format("parquet").option("path", path).outputMode("append")
    return run_available(writer, checkpoint, timeout_s)


ARRIVAL = "_arrival"


def keyed_upsert_sink(path: str, key: str, order_col: str | None = None):
    """K5: keyed landing, later message replaces earlier (merge-on-read).

    Each batch keeps its latest row per key in its own `batch_id` partition,
    replay-safe. Latest is by `order_col` (the record's sequence, or a topic's
    offset), where given, and then by arrival: of equal ones, and of all
    without an `order_col`, the last message of the batch wins, whatever its
    payload. Readers resolve the latest row per key across batches with
    `read_upserted`; nothing ever reads and overwrites the same files in one
    plan. A missing key is the key "unknown".
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        keyed = batch.withColumn(key, F.coalesce(F.col(quote(key)), F.lit("unknown"))).withColumn(ARRIVAL, F.monotonically_increasing_id())
        first = [c for c in (order_col, ARRIVAL) if c]
        rest = [c for c in keyed.columns if c != key and c not in first]
        latest = (keyed.groupBy(key).agg(F.max(F.struct(*first, *rest)).alias("_r"))
                       .select(key, "_r.*"))
        write_batch_partition(latest, path, batch_id, "parquet")
    return sink


def _resolve_latest(df: DataFrame, key: str, order_col: str | None, keep_batch: bool = False) -> DataFrame:
    first = [c for c in (order_col, "batch_id", ARRIVAL) if c]
    rest = [c for c in df.columns if c != key and c not in first]
    out = [*first, *rest] if keep_batch else [*([order_col] if order_col else []), *rest]
    return (df.groupBy(key).agg(F.max(F.struct(*first, *rest)).alias("_r"))
              .select(key, *[F.col(f"_r.{c}").alias(c) for c in out]))


def read_upserted(spark: SparkSession, path: str, key: str, order_col: str | None = None,
                  snapshot: str | None = None, snapshot_upto: int | None = None) -> DataFrame:
    """K5 read side: the latest row per key over all landed batches.

    "Latest" is the record's own order column (a sequence number or offset),
    where given, then the batch id, then the arrival in the batch: messages
    that arrive out of order across partitions can never let an older record
    win, and a re-sent record replaces its earlier copy. With a `snapshot` from `compact_upserts`, only
    the batches after `snapshot_upto` are read (partition pruning on
    `batch_id`), so the read cost stops growing with the history.
    """
    df = spark.read.parquet(path)
    if snapshot is not None:
        df = df.where(F.col("batch_id") > F.lit(int(snapshot_upto))).unionByName(spark.read.parquet(snapshot))
    return _resolve_latest(df, key, order_col)


def compact_upserts(spark: SparkSession, path: str, key: str, order_col: str | None, out_path: str) -> int:
    """K5 compaction: fold every landed batch into one snapshot at a new folder; returns the last batch id folded.

    Writes to `out_path` (never to `path`), keeps each row's batch id so the
    tie-break is unchanged; pass the result to `read_upserted(snapshot=...)`.
    """
    df = spark.read.parquet(path)
    upto = df.agg(F.max("batch_id")).first()[0]
    if upto is None:
        raise ValueError("nothing landed yet")
    _resolve_latest(df.where(F.col("batch_id") <= F.lit(int(upto))), key, order_col, keep_batch=True) \
        .write.mode("errorifexists").parquet(out_path)
    return int(upto)


def progress_frame(spark: SparkSession, path: str) -> DataFrame:
    """One row for every finished micro-batch that had rows: batch id, input rows, quarantined rows.

    Read from what the sink wrote (`score_stream(progress_path=...)`), so no
    batch is missing however long the query ran or however often it restarted.
    """
    return spark.read.schema("input_rows long, quarantined_rows long, batch_id long").parquet(path).select("batch_id", "input_rows", "quarantined_rows")


def score_partial_records(parsed: DataFrame, scorer: Callable[[DataFrame], DataFrame],
                          features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """P10 + P8 (X10 fix): score records that carry only some of the features.

    The features present in the record schema are encoded (text through the
    maps, numbers as they are); the absent ones are constant 0, so the model
    always sees the full, ordered feature vector. A record schema with none of
    the features is an error (nothing to score), raised before the stream starts.
    """
    present = [c for c in features if c in parsed.columns]
    if not present:
        raise ValueError("no model feature in the record schema")
    hidden = {k: f"_keep_{i}" for i, k in enumerate(keep)}
    src = parsed.select("*", *[F.col(quote(k)).alias(a) for k, a in hidden.items()])
    enc = encode_features(src, list(features), keep=list(hidden.values()))
    scored = scorer(enc)
    return scored.select(*[F.col(a).alias(k) for k, a in hidden.items()],
                         F.col("readmission_prediction").cast("int").alias("readmission_prediction"),
                         F.col(PROBABILITY_COLUMN).cast("double").alias(PROBABILITY_COLUMN))
