"""A task's share of the counting sketch: two bytes a cell, full counts stay, few texts at one time."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyspark

from carepulse.llm import jaccard_join
from carepulse.llm.common import TOGETHER


def test_counts_are_small_and_stay_when_full():
    counts = np.zeros(8, dtype=np.uint16)
    counts[5] = jaccard_join.MOST_COUNT - 1
    for _ in range(3):
        jaccard_join._count(counts, np.array([1, 5, 5, 7]))
    assert counts.tolist() == [0, 3, 0, 0, 0, jaccard_join.MOST_COUNT, 0, 3]


def test_a_task_holds_few_texts_and_two_bytes_a_cell(monkeypatch):
    class Docs:
        def mapInArrow(self, scan, schema):
            return scan

    class Context:
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(pyspark, "TaskContext", Context)
    n = 2 * TOGETHER + 1
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([f"a b c d e {k % 7}" for k in range(n)])], ["doc_id", "text"])
    out = list(jaccard_join.sets_and_sketch(Docs(), 5)(iter([batch])))
    rows = [b for b in out if b.column("counts").null_count == len(b)]
    assert max(map(len, rows)) <= TOGETHER and sum(map(len, rows)) == n
    shares = [zlib.decompress(b.column("counts")[0].as_py()) for b in out if b not in rows]
    assert {len(x) for x in shares} == {2 * jaccard_join.BLOCK}
    # seven sets: a shingle that all hold, and one of each
    assert sum(int(np.frombuffer(x, np.uint16).sum()) for x in shares) == 14
    assert max(int(np.frombuffer(x, np.uint16).max()) for x in shares) == 7
