"""A store of scored micro-batches that is compacted while streams write to it (K1, K2).

Below its path a store has ``batches/batch_id=N`` (what the sink wrote, one folder of small files for each micro-batch), folded folders
of large files, and the pointer of ``sources.snapshots``, which names the folded folders, oldest first, and the last
batch in them. Folding writes the committed batches to a new folder and switches the pointer in one rename. Folded folders are
merged like a binary counter, the last two as soon as the newer one isn't smaller than half of the older: their number stays
logarithmic in the rows, and a row is rewritten as often at most.

A batch counts as committed when the stream's checkpoint says so (``committed_upto``), so a batch that is still being written is never
folded. A replayed batch that was folded already is not written again; any other replaces its own folder. Readers resolve the
pointer once: folded folders and the batches after them. ``expire`` removes what the pointer no longer needs,
to be called once no older reader is left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepulse.sources.snapshots import _context, current, new_folder, switch

#: Size of a folded file.
FILE_BYTES = 128 << 20


def _state(spark: SparkSession, path: str) -> dict:
    return current(spark, path) or {"folders": [], "upto": -1}


def _names(spark: SparkSession, folder: str) -> list[str]:
    jvm, fs, _ = _context(spark, folder)
    place = jvm.org.apache.hadoop.fs.Path(folder)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def _size(spark: SparkSession, folder: str) -> int:
    jvm, fs, _ = _context(spark, folder)
    return int(fs.getContentSummary(jvm.org.apache.hadoop.fs.Path(folder)).getLength())


def store_batch(df: DataFrame, path: str, batch_id: int) -> bool:
    """Write one micro-batch; False if it was folded before (a replay after compaction is a no-op)."""
    if batch_id <= _state(df.sparkSession, path)["upto"]:
        return False
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(f"{path}/batches"))
    return True


def committed_upto(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that the stream's checkpoint holds as committed; -1 before the first."""
    return max((int(n) for n in _names(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def _landed(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in _names(spark, f"{path}/batches") if n.startswith("batch_id="))


def _batches(spark: SparkSession, path: str, schema: T.StructType, ids: list[int]) -> DataFrame:
    """The batches of these ids, by their folders: no other is listed or read."""
    rows = spark.read.schema(schema).option("basePath", f"{path}/batches").parquet(*[f"{path}/batches/batch_id={i}" for i in ids])
    return rows.select(*[f.name for f in schema.fields])


def read_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows (``schema`` ends with batch_id): folded folders, and the batches after them."""
    state = _state(spark, path)
    parts = [spark.read.schema(schema).parquet(f"{path}/{name}") for name, _ in state["folders"]]
    new = [i for i in _landed(spark, path) if i > state["upto"]]
    if new:
        parts.append(_batches(spark, path, schema, new))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def compact(spark: SparkSession, path: str, schema: T.StructType, upto: int, file_bytes: int = FILE_BYTES) -> dict:
    """Fold the batches up to ``upto`` (see ``committed_upto``); returns the new state. One compaction of a store runs at a time.

    Small files are packed into tasks by Spark's reader and written as files of about ``file_bytes``: rows are not exchanged.
    """
    state = _state(spark, path)
    ids = [i for i in _landed(spark, path) if state["upto"] < i <= upto]
    if not ids:
        return state
    folders = [tuple(f) for f in state["folders"]]

    def written(rows: DataFrame, size: int) -> tuple[str, int]:
        name = new_folder()
        rows.coalesce(max(1, -(-size // file_bytes))).write.parquet(f"{path}/{name}")
        return name, _size(spark, f"{path}/{name}")

    folders.append(written(_batches(spark, path, schema, ids), sum(_size(spark, f"{path}/batches/batch_id={i}") for i in ids)))
    while len(folders) > 1 and 2 * folders[-1][1] >= folders[-2][1]:
        (older, a), (newer, b) = folders[-2:]
        folders[-2:] = [written(spark.read.schema(schema).parquet(f"{path}/{older}", f"{path}/{newer}"), a + b)]
    state = {"folders": folders, "upto": ids[-1]}
    switch(spark, path, state)
    return state


def expire(spark: SparkSession, path: str) -> int:
    """Remove folded batches and merged folders; returns how many. Readers that resolved an older pointer must have ended."""
    state = _state(spark, path)
    kept = {name for name, _ in state["folders"]}
    gone = [f"batches/batch_id={i}" for i in _landed(spark, path) if i <= state["upto"]]
    gone += [n for n in _names(spark, path) if n.startswith("snapshot-") and n not in kept]
    jvm, fs, _ = _context(spark, path)
    for name in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return len(gone)
