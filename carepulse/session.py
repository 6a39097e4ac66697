"""Session helpers: a local session for tests / bench, and the shared scratch folder.

Library code never creates a session or picks a master; callers pass theirs.
Intermediate files (round-trip scans, streaming sinks, checkpoints) live under
the folder the cluster names in ``spark.checkpoint.dir`` so that every executor
sees them and a lost executor's work can be recomputed from them. Only when
that setting is absent (local tests, the correctness driver) do we set one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "carepulse",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (never used by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CAREPULSE_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir`` if the cluster sets one.

    If unset (as in tests) a fresh folder is created once and registered as the
    checkpoint dir, so ``DataFrame.checkpoint()`` and our writers agree.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf = sc.getConf().get(_CHECKPOINT_KEY, None) or spark.conf.get(_CHECKPOINT_KEY, None)
    if not conf:
        if not sc.master.startswith("local"):
            # a machine-local folder is invisible to other executors: refuse
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
        conf = tempfile.mkdtemp(prefix="carepulse-ckpt-")
    sc.setCheckpointDir(conf)
    # setCheckpointDir adds a per-application subfolder; use that.
    return (sc.getCheckpointDir() or conf).rstrip("/")


def new_scratch(spark: SparkSession, tag: str) -> str:
    """A brand-new, never reused folder path under the shared scratch root."""
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
