"""Atomic replacement of a dataset: whole snapshots in new folders, and a pointer that is switched by one rename (K3, K1, K2).

``publish`` writes the frame into a folder of its own with Spark's committed writer, then renames a small pointer file over the old one. Readers
resolve the pointer first, so they see the old snapshot or the new one, never a mixture, and never an empty folder while
a job overwrites. A job that dies on the way leaves the old pointer. Older snapshots are removed by ``expire`` only, so a
reader that resolved one before can finish. Paths may be on any file system that Hadoop's FileContext knows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT.json"  # no leading underscore: Spark hides such files


def _context(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, target.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)


def switch(spark: SparkSession, path: str, state: dict) -> None:
    """Make ``state`` (with the snapshot's folder under "folder") the current one, in one rename."""
    jvm, fs, context = _context(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}/_new-{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), options)


def current(spark: SparkSession, path: str) -> dict | None:
    """The state last switched to; None before the first."""
    jvm, fs, _ = _context(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(f"{path}/{POINTER}").collect()))  # one line


def new_folder() -> str:
    return f"snapshot-{uuid.uuid4().hex[:16]}"


def publish(df: DataFrame, path: str, fmt: str = "parquet", **state) -> str:
    """Replace what ``path`` holds by ``df``; returns the snapshot's folder name. ``state`` is kept beside it."""
    folder = new_folder()
    writer = df.write.option("header", True) if fmt == "csv" else df.write
    writer.format(fmt).save(f"{path}/{folder}")
    switch(df.sparkSession, path, {"folder": folder, "format": fmt, **state})
    return folder


def read_current(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The snapshot that the pointer names; a schema keeps CSV types."""
    state = current(spark, path)
    if state is None:
        raise FileNotFoundError(f"{path}: nothing published yet")
    reader = spark.read.option("header", True).option("enforceSchema", False) if state["format"] == "csv" else spark.read
    return (reader.schema(schema) if schema is not None else reader).format(state["format"]).load(f"{path}/{state['folder']}")


def expire(spark: SparkSession, path: str, prefix: str = "snapshot-") -> list[str]:
    """Remove the snapshots that the pointer doesn't name (once no reader of theirs is left); returns their folders."""
    jvm, fs, _ = _context(spark, path)
    state = current(spark, path) or {}
    gone = [s.getPath().getName() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path)) if s.getPath().getName().startswith(prefix) and s.getPath().getName() != state.get("folder")]
    for name in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return sorted(gone)
