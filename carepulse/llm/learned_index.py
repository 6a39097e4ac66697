"""Approximate nearest neighbours by learned partitions (largest inner product).

Fitting, on a bounded sample of ``SAMPLE`` vectors (lowest hash of id and vector), in one task:

1. the sample's exact neighbour graph (``GRAPH`` neighbours each, made mutual by adding the reverse links);
2. a balanced partitioning of the graph into ``parts``: seeded by balanced clustering, then refined by rounds in which each
   vector moves to the part that holds most of its neighbours, as far as the part has room;
3. a small classifier, multinomial logistic regression on the vector, that predicts the part.

4. the number of parts that a query probes: ``HELD`` sample vectors are kept out of 1 to 3; probes are added until the most probable
   parts hold ``TARGET`` of their nearest sample vectors (which are further away than the nearest of all, so the estimate is a careful one).

Indexing assigns every vector to its most probable part. A query goes to its most probable parts; all vectors of these parts are reranked by
exact inner products in double precision. Equal rows (id and vector) are one from the start. Parts are cut into lanes of about ``LANE`` vectors by a hash of
id and vector, and the queries of a lane into blocks, so neither a large part nor an id or a vector that a third of all rows share lands in one task; every lane
gives its k best ids, and these are merged.

``parts`` grows with the table (about ``PART_SIZE`` vectors each, ``MOST_PARTS`` at most, as many as the sample can fit).

Defined results: vectors that are null, of another length than the most common, zero, or hold null or non-finite components take no part; null ids neither;
a query's own id is no candidate; ties go to the smaller id; repeated rows of an id are one candidate
(the best score counts); fewer candidates than k are all returned; an empty table gives an empty result. Extra columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from carepulse.llm.common import importable, stored

SAMPLE, GRAPH = 8192, 12
PART_SIZE, MOST_PARTS = 4096, 64
HELD, HELD_NEAREST, TARGET = 512, 20, 0.96
LANE, QUERY_BLOCK = 16_384, 1024
FIT_STEPS = 300


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, in double precision; a repeated row once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    rows = stored(rows.distinct(), "vectors").select("vec_id", F.col("v").cast("array<double>").alias("v"))
    fine = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    size = fine.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return fine.where(F.size("v") == (size[0].d if size else 0))


def graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row by row the indices of the k largest inner products, the row's own excluded."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1024):
        s = x[at:at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else out[at:at + 1024]
    return out


def _balanced(scores: np.ndarray, room: int) -> np.ndarray:
    """Each row to its best column that has room; rows with the clearest choice first."""
    part = np.full(len(scores), -1)
    free = np.full(scores.shape[1], room)
    ranked = np.argsort(-scores, axis=1, kind="stable")
    best = np.take_along_axis(scores, ranked[:, :2], axis=1)
    for i in np.argsort(-(best[:, 0] - best[:, -1]), kind="stable"):
        for p in ranked[i]:
            if free[p]:
                part[i], free[p] = p, free[p] - 1
                break
    return part


def partition(x: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A balanced partitioning of the sample's neighbour graph."""
    rng = np.random.default_rng(seed)
    room = -(-len(x) * 11 // (parts * 10))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = unit[rng.choice(len(x), parts, replace=False)]
    for _ in range(8):
        part = _balanced(unit @ centres.T, room)
        sums = np.zeros((parts, x.shape[1]))
        np.add.at(sums, part, unit)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    near = graph(x, GRAPH)
    rows = np.repeat(np.arange(len(x)), near.shape[1])
    for _ in range(6):
        held = np.zeros((len(x), parts))
        np.add.at(held, (rows, part[near.ravel()]), 1.0)
        np.add.at(held, (near.ravel(), part[rows]), 0.5)
        part = _balanced(held + 1e-3 * (unit @ centres.T), room)
    return part


def fit_router(x: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    """Weights (dimension + 1, parts) of a multinomial logistic regression, by full-batch Adam."""
    scale = np.sqrt((x ** 2).mean()) or 1.0
    z = np.hstack([x / scale, np.ones((len(x), 1))])
    target = np.eye(parts)[part]
    w, m, v = (np.zeros((z.shape[1], parts)) for _ in range(3))
    for t in range(1, FIT_STEPS + 1):
        s = z @ w
        s = np.exp(s - s.max(axis=1, keepdims=True))
        grad = z.T @ (s / s.sum(axis=1, keepdims=True) - target) / len(z) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    w[:-1] /= scale
    return w


def probabilities(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    s = x @ w[:-1] + w[-1]
    s = np.exp(s - s.max(axis=1, keepdims=True))
    return s / s.sum(axis=1, keepdims=True)


def probes_needed(held: np.ndarray, x: np.ndarray, w: np.ndarray) -> int:
    """How many of its most probable parts hold TARGET of the nearest of a held-out vector, on average."""
    parts = w.shape[1]
    home = np.argmax(probabilities(x, w), axis=1)
    ranked = np.argsort(-probabilities(held, w), axis=1, kind="stable")
    place = np.argsort(ranked, axis=1)  # of each part in a query's order
    k = min(HELD_NEAREST, len(x))
    near = np.argpartition(-(held @ x.T), k - 1, axis=1)[:, :k]
    at = np.take_along_axis(place, home[near], axis=1).ravel()
    share = np.cumsum(np.bincount(at, minlength=parts)) / len(at)
    return int(np.searchsorted(share, TARGET)) + 1 if len(at) else parts


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def best(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, candidate, score) of each query's k best ids in a block, an id by its best row, ties to the smaller id.

    The matrix product finds who can be among the best; scores are then summed anew pair by pair, in one fixed order, so
    equal vectors have equal scores wherever they stand in a block.
    """
    out = []
    scores = q @ c.T
    scores[q_ids[:, None] == c_ids[None, :]] = -np.inf
    by_id = np.argsort(c_ids, kind="stable")
    first = np.flatnonzero(np.diff(c_ids[by_id], prepend=c_ids[by_id[0]] - 1))
    tops = scores if len(first) == len(c_ids) else np.maximum.reduceat(scores[:, by_id], first, axis=1)
    for i, row in enumerate(scores):
        near, top = np.flatnonzero(row > -np.inf), tops[i]
        if np.count_nonzero(top > -np.inf) > k:
            kth = -np.partition(-top, k - 1)[k - 1]
            near = np.flatnonzero(row >= kth - 1e-9 * max(1.0, abs(kth)))
        exact = (c[near] * q[i]).sum(axis=1)
        order = np.lexsort((c_ids[near], -exact))
        taken: set[int] = set()
        for j in order:
            if len(taken) == k:
                break
            if (own := int(c_ids[near[j]])) not in taken:
                taken.add(own)
                out.append((int(q_ids[i]), own, float(exact[j])))
    return out


class Index:
    """Partitions, router and the assigned table of a vector table."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int | None = None, probes: int | None = None):
        importable(vectors.sparkSession)
        self.rows = usable(vectors, id_col, vector_col)
        n = self.rows.count()
        fitted = self.rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE)
        self.parts = parts or max(1, min(MOST_PARTS, n // PART_SIZE, min(n, SAMPLE) // 32))

        def learn(table: pa.Table) -> pa.Table:
            x = _matrix(table.column("v").combine_chunks())
            if own == 1:
                return pa.table({"w": [[0.0] * (x.shape[1] + 1)], "probes": pa.array([1], pa.int32())})
            cut = min(HELD, len(x) // 8)  # the sample comes in no order that has to do with the vectors
            w = fit_router(x[cut:], partition(x[cut:], own), own)
            return pa.table({"w": [w.ravel().tolist()], "probes": pa.array([probes_needed(x[:cut], x[cut:], w)], pa.int32())})

        own = self.parts
        found = fitted.withColumn("all", F.lit(1)).groupBy("all").applyInArrow(learn, "w array<double>, probes int").collect() if n else []
        self.weights = np.array(found[0].w).reshape(-1, self.parts) if found else np.zeros((1, 1))
        self.probes = min(self.parts, probes or (found[0].probes if found else 1))
        self.assigned = stored(self._route(self.rows, 1), "assigned")

    def _route(self, rows: DataFrame, probes: int) -> DataFrame:
        """(vec_id, v, part) for each of the most probable parts."""
        w = self.weights

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                p = probabilities(_matrix(batch.column("v")), w)
                ranked = np.argsort(-p, axis=1, kind="stable")[:, :probes]
                row, at = np.divmod(np.arange(ranked.size), probes)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(row)), batch.column("v").take(pa.array(row)), pa.array(ranked[row, at], pa.int32())], ["vec_id", "v", "part"])

        return rows.mapInArrow(send, "vec_id long, v array<double>, part int")

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, vec_id, score): the k best found of each of the ``queries`` (vec_id, v as in ``rows``)."""
        routed = stored(self._route(queries, self.probes), "routed")
        n = F.count(F.lit(1))
        # a row for each part: lanes of its vectors, blocks of its queries
        sizes = self.assigned.groupBy("part").agg(F.ceil(n / LANE).cast("int").alias("lanes"))
        asked = routed.groupBy("part").agg(F.ceil(n / QUERY_BLOCK).cast("int").alias("blocks"))
        cut = F.broadcast(sizes.join(asked, "part"))
        each = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
        c = self.assigned.join(cut, "part").select("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("lanes")).cast("int").alias("lane"), each("blocks").alias("block"), "vec_id", "v")
        q = routed.join(cut, "part").select("part", each("lanes").alias("lane"), F.pmod(F.xxhash64("vec_id", "v", F.lit(3)), F.col("blocks")).cast("int").alias("block"), "vec_id", "v")

        def rerank(key, left: pa.Table, right: pa.Table) -> pa.Table:
            found = []
            if len(left) and len(right):
                q_ids, qs = left.column("vec_id").to_numpy(), _matrix(left.column("v").combine_chunks())
                c_ids, cs = right.column("vec_id").to_numpy(), _matrix(right.column("v").combine_chunks())
                for at in range(0, len(qs), 256):
                    found += best(qs[at:at + 256], q_ids[at:at + 256], cs, c_ids, k)
            cols = list(zip(*found)) or [[], [], []]
            return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

        near = (q.groupBy("part", "lane", "block").cogroup(c.groupBy("part", "lane", "block")).applyInArrow(rerank, "query_id long, vec_id long, score double"))
        near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = W.Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
