"""File scans: CSV (positional, headered, inferred), result folders, fallbacks.

Schemas are explicit wherever the record layout is known. Headered CSVs are
read with ``enforceSchema=False`` so a file whose header lists the same
columns in another order is an error instead of a silent column swap.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from carepulse.schemas import ENCOUNTER_SCHEMA


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if `path` exists on its file system (metadata call on the driver)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def has_files(spark: SparkSession, path: str, suffix: str = "") -> bool:
    """True if `path` holds at least one non-empty data file (hidden/_ files ignored)."""
    if not path_exists(spark, path):
        return False
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if name.startswith((".", "_")) or not name.endswith(suffix):
            continue
        if st.getLen() > 0:
            return True
    return False


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# --- S4 ---------------------------------------------------------------------
def read_headerless_csv(spark: SparkSession, path: str,
                        schema: T.StructType = ENCOUNTER_SCHEMA) -> DataFrame:
    """Positional CSV without header; `schema` gives names and types."""
    return spark.read.csv(path, header=False, schema=schema, mode="PERMISSIVE")


# --- S5 ---------------------------------------------------------------------
def read_header_dir(spark: SparkSession, path: str,
                    schema: T.StructType = ENCOUNTER_SCHEMA) -> DataFrame:
    """A folder of headered CSVs; absent or empty folder -> empty frame (quiet end).

    ``enforceSchema=False`` validates every file's header against `schema`.
    """
    if not has_files(spark, path):
        return empty_frame(spark, schema)
    return (spark.read.option("header", True).option("enforceSchema", False)
            .schema(schema).csv(path))


# --- S6 ---------------------------------------------------------------------
def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with inferred types (an extra pass over the data; avoid in production)."""
    return spark.read.csv(path, header=True, inferSchema=True)


# --- S7 ---------------------------------------------------------------------
def read_positional(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Headerless CSV, inferred types, renamed by position; the counts must agree."""
    df = spark.read.csv(path, header=False, inferSchema=True)
    if len(df.columns) != len(names):
        raise ValueError(f"{path}: {len(df.columns)} columns, {len(names)} names")
    return df.toDF(*names)


# --- S9 / W6 ----------------------------------------------------------------
def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Align frames by column name; columns missing in one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_results(spark: SparkSession, folders: Sequence,
                 schema: T.StructType | None = None) -> DataFrame:
    """Every `*.csv` under each folder as one table (folders may differ in columns).

    `folders` holds paths or (path, schema) pairs. One scan per folder (a
    folder holds one layout); folders are aligned by column name, so a layout
    change between writers never shifts columns. No files at all -> an empty
    frame of `schema`.
    """
    frames = []
    for f in folders:
        path, sch = (f if isinstance(f, tuple) else (f, schema))
        if not has_files(spark, path, ".csv"):
            continue
        r = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
        r = r.option("enforceSchema", False).schema(sch) if sch is not None \
            else r.option("inferSchema", True)
        frames.append(r.csv(path))
    if not frames:
        if schema is None:
            raise FileNotFoundError("no result files and no schema for an empty result")
        return empty_frame(spark, schema)
    return union_by_name(frames)


# --- S10 --------------------------------------------------------------------
def read_first_available(spark: SparkSession, paths: Sequence[str], schema: T.StructType,
                         fmt: str = "csv", **options) -> DataFrame:
    """Primary location, else fallback(s), else an empty frame of `schema`."""
    for p in paths:
        if has_files(spark, p):
            r = spark.read.format(fmt).schema(schema)
            if fmt == "csv":
                r = r.option("header", True).option("enforceSchema", False)
            for k, v in options.items():
                r = r.option(k, v)
            return r.load(p)
    return empty_frame(spark, schema)
