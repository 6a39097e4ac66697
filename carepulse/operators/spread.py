"""Rows over enough tasks for per-row work (encoding, fitting, scoring), however few files or row groups a table has.

A file is read by as many tasks as it has row groups, which may be one; what follows without an exchange, a cached copy
included, then stays in that one task. The number of tasks depends on the rows alone, so that a fit with one seed doesn't vary with the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.schemas import quote

#: Rows of a task while there are at most FEW_TASKS, and the most beyond (a cached training row takes about 1 KB).
FEW_ROWS, FEW_TASKS, MOST_ROWS = 16_384, 32, 200_000


def tasks_for(rows: int) -> int:
    return max(1, min(FEW_TASKS, -(-rows // FEW_ROWS)), -(-rows // MOST_ROWS))


def spread(df: DataFrame) -> DataFrame:
    """The rows of ``df``, dealt in turn (no key is hot) and put in a fixed order within each task; few rows stay as they are."""
    tasks = tasks_for(df.count())
    if tasks == 1:
        return df
    return df.repartition(tasks).sortWithinPartitions(F.xxhash64(*[F.col(quote(c)) for c in df.columns]))
