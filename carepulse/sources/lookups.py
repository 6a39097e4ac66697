"""Code-lookup dimensions: parse the stacked id/description file (S13) and decode ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_code_lookups(spark: SparkSession, path: str) -> DataFrame:
    """A file of stacked ``<name>_id,description`` sections separated by lone-comma lines.

    Returns (lookup, id, description): lookup = the section's header name,
    id = INT (NULL if not a number), description = trimmed text; quoted commas
    stay inside the description and the text ``NULL`` stays a label.
    The file is a small code dimension, read one row per file.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("value"), F.input_file_name().alias("file"))
    sections = whole.select("file", F.posexplode(F.split(F.col("value"), r"\r?\n\s*,\s*(\r?\n|$)")).alias("sec", "body"))
    lines = (sections.select("file", "sec", F.posexplode(F.split(F.col("body"), r"\r?\n")).alias("ln", "line"))
                     .where(F.trim(F.col("line")) != ""))
    parsed = lines.select(
        "file", "sec", "ln",
        F.from_csv(F.col("line"), "id STRING, description STRING",
                   {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}).alias("r"))
    section = Window.partitionBy("file", "sec")
    named = (parsed.withColumn("_first", F.min("ln").over(section))
                   .withColumn("lookup", F.max(F.when(F.col("ln") == F.col("_first"), F.col("r.id"))).over(section)))
    body = named.where(F.col("ln") != F.col("_first"))
    return body.select("lookup", F.col("r.id").try_cast("int").alias("id"), F.col("r.description").alias("description"))


def lookup_frame(spark: SparkSession, mapping: Mapping[str, int], key: str = "label",
                 code: str = "id") -> DataFrame:
    """A small literal dimension (e.g. the legacy label -> id profile codes)."""
    return spark.createDataFrame([(k, int(v)) for k, v in mapping.items()], f"{key} string, {code} int")


def decode(df: DataFrame, dim: DataFrame, on: str | list, how: str = "left") -> DataFrame:
    """Join a code dimension; Spark broadcasts it when its bytes allow."""
    return df.join(dim, on, how)


def encode_strict(df: DataFrame, dim: DataFrame, label_col: str, dim_label: str, dim_code: str,
                  out: str) -> DataFrame:
    """Label -> id in one join; an unknown label (or a NULL one) fails the job that reads the result."""
    joined = decode(df, dim.select(F.col(dim_label).alias(label_col), F.col(dim_code).alias(out)), label_col)
    unknown = F.raise_error(F.concat(F.lit(f"unknown {label_col}: "), F.coalesce(F.col(label_col).cast("string"), F.lit("NULL"))))
    return joined.withColumn(out, F.when(F.col(out).isNull(), unknown.cast("int")).otherwise(F.col(out)))
