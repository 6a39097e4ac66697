"""File and message sinks.

Writers never ``coalesce(1)``: each task writes its own part file, so the
write scales with the cluster. Output names that are awkward in SQL (the
reference's ``readmission_probability(%)``) are applied only at the file
boundary and removed again by the matching reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.functions.records import row_to_json
from carepulse.schemas import PROBABILITY_COLUMN, PROBABILITY_CSV_NAME


def to_file_names(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(PROBABILITY_COLUMN, PROBABILITY_CSV_NAME)


def from_file_names(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(PROBABILITY_CSV_NAME, PROBABILITY_COLUMN)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """K3 (overwrite) / K4 (append): headered CSV parts; every part file carries the header."""
    to_file_names(df).write.mode(mode).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """K7: save a table (Parquet keeps types; CSV is for the dashboard only)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def publish_json(df: DataFrame, path: str | None = None, *, kafka_servers: str | None = None,
                 topic: str | None = None, key_col: str | None = None, limit: int | None = None,
                 order_by: str | None = None) -> DataFrame:
    """Publish each row as one JSON message.

    Builds the Kafka-shaped frame (`key`, `value`) and writes it to the topic
    when a broker is given (needs the Kafka connector on the classpath), or to
    `path` as JSON-lines text otherwise. `limit` publishes the first rows by `order_by`. Returns the message frame.
    """
    if limit is not None and order_by is None:
        raise ValueError("a limit needs order_by: the first rows by what?")
    src = df.orderBy(order_by).limit(limit) if limit is not None else df
    msgs = row_to_json(src)
    if key_col is not None:
        msgs = src.select(F.col(key_col).cast("string").alias("key"),
                          F.to_json(F.struct(*[F.col(f"`{c}`") for c in src.columns])).alias("value"))
    if kafka_servers and topic:
        (msgs.write.format("kafka").option("kafka.bootstrap.servers", kafka_servers)
             .option("topic", topic).save())
    elif path is not None:
        msgs.select("value").write.mode("overwrite").text(path)
    return msgs
