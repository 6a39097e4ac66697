"""Quality classifier by importance resampling.

Two generative models, bags of hashed byte n-grams (``ORDERS``) and of how often a document repeats its
``REPEAT``-byte n-grams, are counted: the *target* over labelled good
documents and the *raw* over all documents. A document's log importance weight is the sum over its n-grams
of log p_target - log p_raw. Gumbel top-k draws k documents without replacement, with chances in
proportion to the weights: each document gets weight + Gumbel noise (from a hash of id, text and seed, so a
task that runs again draws the same), and the k largest are kept; the rest are rejected.

k is a parameter; by default it is the number of documents, over the whole table, whose weight is above the cut that
separates the labelled sample best (middle of the widest best gap; good documents weigh ``GOOD_COST``-fold), so that clean documents are
drawn with near certainty and the noise decides only about the border.

The labelled sample is bounded by ``SAMPLE_LABELS`` documents (lowest hash of the id; one label for each document, the worst);
all counts, weights, k and the k-th largest key cover every document. The k-th key is found by histogram
refinement on the cluster, never by collecting keys.

Defined results: null text is empty, weight 0; null ids draw like any other; repeated rows have equal keys, and rows
tied at the cut all stay; an empty table, or one without labelled good documents, keeps everything
(weight 0). A text of any length is scored whole, in slices. The result has the columns of the input and nothing else.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import importable, slices, stored

ORDERS = (1, 2, 3, 4)
#: Bytes of the n-grams whose repetition inside a document is modelled.
REPEAT = 8
#: Rejected good documents count as so many accepted bad ones when the cut is chosen.
GOOD_COST = 4.0
CELL_BITS = 16
#: Labelled documents that the target model and the cut are fitted on, at most.
SAMPLE_LABELS = 20_000
#: Added to each cell's count in both models.
SMOOTHING = 1.0
SLICE = 1 << 20


def repeats(data: bytes) -> np.ndarray:
    """For each REPEAT-byte n-gram of a text the cell of (how often the text holds it, how long the text is), both by powers of two."""
    b = np.frombuffer(data, dtype=np.uint8)
    n = len(b) - REPEAT + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint32)
    code = np.zeros(n, dtype=np.uint64)
    for k in range(REPEAT):
        code = (code << np.uint64(8)) | b[k:n + k]
    _, counts = np.unique(code, return_counts=True)
    times = np.repeat(np.log2(counts).astype(np.uint32), counts)
    return ((times * np.uint32(64) + np.uint32(math.log2(n) / 3) + np.uint32(REPEAT * 0x51ED27)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELL_BITS)


def cells(data: bytes) -> Iterator[np.ndarray]:
    """The hash cells of all n-grams of a text, slice by slice, and those of their repetition."""
    if len(own := repeats(data)):
        yield own
    for at in range(0, max(len(data), 1), SLICE):
        b = np.frombuffer(data[at:at + SLICE + ORDERS[-1] - 1], dtype=np.uint8).astype(np.uint32)
        code = np.zeros(len(b), dtype=np.uint32)
        for n in range(1, ORDERS[-1] + 1):
            if len(b) < n:
                break
            code = (code[:len(b) - n + 1] << np.uint32(8)) | b[n - 1:]
            if n in ORDERS:
                own = code[:SLICE]  # a slice counts the n-grams that begin in it
                yield ((own + np.uint32(n * 0x51ED27)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELL_BITS)


def labelled_sample(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of at most SAMPLE_LABELS labelled documents."""
    clean = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    return (clean.groupBy("doc_id").agg(F.min("quality").alias("good"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_LABELS))


def _counts(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cell counts of all documents and of the sample's good ones."""
    good = sample.where("good > 0").select("doc_id", F.lit(True).alias("aim"))
    rows = docs.join(F.broadcast(good), "doc_id", "left").select(F.coalesce("aim", F.lit(False)).alias("aim"), "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << CELL_BITS), dtype=np.int64)
        for batch in slices(batches):
            for which in (False, True):
                held, size = [], 0
                for text, aim in zip(batch.column("text").to_pylist(), batch.column("aim").to_pylist()):
                    if text and (aim or not which):
                        for c in cells(text.encode()):
                            held.append(c)
                            size += len(c)
                            if size > SLICE:
                                totals[int(which)] += np.bincount(np.concatenate(held), minlength=1 << CELL_BITS)
                                held, size = [], 0
                if held:
                    totals[int(which)] += np.bincount(np.concatenate(held), minlength=1 << CELL_BITS)
        for which in (0, 1):
            full = np.flatnonzero(totals[which])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(full), which), pa.int32()), pa.array(full, pa.int32()), pa.array(totals[which][full], pa.int64())], ["aim", "cell", "n"])

    out = np.zeros((2, 1 << CELL_BITS))
    counted = rows.mapInArrow(scan, "aim int, cell int, n long").groupBy("aim", "cell").agg(F.sum("n").alias("n")).toPandas()
    out[counted["aim"], counted["cell"]] = counted["n"]
    return out[0], out[1]


def _scorer(docs: DataFrame, ratio: np.ndarray):
    table = docs.sparkSession.sparkContext.broadcast(ratio)

    @F.pandas_udf("double")
    def weight(texts: pd.Series) -> pd.Series:
        own = table.value
        return pd.Series([math.fsum(float(own[c].sum()) for c in cells(t.encode())) if t else 0.0 for t in texts], dtype="float64")

    return weight


def _key(weight: Column, doc_id: Column, text: Column, seed: int) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 11).cast("double") + 0.5) / float(1 << 53)
    return weight - F.log(-F.log(u))


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest of a column of doubles, by refining a histogram of fixed size."""
    name, cells_ = keys.columns[0], 4096
    low, high = keys.agg(F.min(name), F.max(name)).head()
    while low < high:
        step = (high - low) / cells_
        at = F.least(F.greatest(F.floor((F.col(name) - low) / step), F.lit(0)), F.lit(cells_ - 1))
        inside = keys.where(F.col(name).between(low, high))
        found = inside.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).orderBy(F.desc("at")).collect()
        for row in found:
            if k <= row.n:
                low, high = row.low, row.high
                break
            k -= row.n
    return low


def best_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The middle of the first widest gap among those that part good from bad best; -inf without both kinds."""
    if not good.any() or good.all():
        return -math.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    below_bad, below_good = np.cumsum(~g), np.cumsum(g)
    gain = below_bad / below_bad[-1] - GOOD_COST * below_good / below_good[-1]
    gap = np.append(np.diff(s), 0.0)
    gain[gap <= 0] = -1.0
    if gain.max() <= 0:
        return -math.inf
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    at = best[np.argmax(gap[best])]
    return float((s[at] + s[at + 1]) / 2)


class Resampler:
    """Fitted on a document table and its labels: weights, k and the cut; ``kept`` and ``sampled`` apply it."""

    def __init__(self, docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 17):
        self.seed = seed
        importable(docs.sparkSession)
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        sample = stored(labelled_sample(labels).coalesce(1), "sample")
        raw, aim = _counts(rows, sample)
        if aim.sum():
            model = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * len(c)))
            ratio = (model(aim) - model(raw)) / len(ORDERS)
        else:
            ratio = np.zeros(1 << CELL_BITS)
        self.weight = _scorer(docs, ratio)
        scored = rows.select("doc_id", self.weight("text").alias("log_weight"), F.col("text"))
        self.scored = stored(scored.select("doc_id", "log_weight", _key(F.col("log_weight"), F.col("doc_id"), F.col("text"), seed).alias("key")), "scored")
        known = self.scored.join(F.broadcast(sample), "doc_id").select("log_weight", "good").toPandas()
        if k is None:
            cut = best_cut(known["log_weight"].to_numpy(dtype=float), known["good"].to_numpy() > 0)
            k = self.scored.where(F.col("log_weight") > cut).count()
        n = self.scored.count()
        self.k = min(k, n)
        self.cut = -math.inf if self.k >= n else math.inf if self.k <= 0 else kth_largest(self.scored.select("key"), self.k)

    def sampled(self) -> DataFrame:
        """doc_id, log_weight and key of the drawn documents."""
        return self.scored.where(F.col("key") >= self.cut)

    def kept(self, docs: DataFrame) -> DataFrame:
        """The drawn rows of ``docs`` itself, with its own columns (weights are computed anew, no text is shuffled)."""
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        name = f"key_{uuid.uuid4().hex}"
        key = _key(self.weight(text), F.col("doc_id").cast("long"), text, self.seed)
        return docs.withColumn(name, key).where(F.col(name) >= self.cut).select(*docs.columns)


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 17) -> DataFrame:
    """The drawn documents: doc_id, log_weight, key."""
    return Resampler(docs, labels, k, seed).sampled()
