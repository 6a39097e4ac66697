"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. *Rarity.* One pass counts, over all documents, every word that benchmark items use. An n-gram of an item is
   rare when the number of times it is expected by chance in a document (from these word rates and the
   mean document length) is below ``CHANCE`` divided by the number of all n-grams. Expectation, not the
   n-gram's own count, is what counts: a passage that leaked a thousand times stays rare. Each item keeps
   all its rare n-grams, and its ``LEAST_SEEDS`` rarest in any case.
2. *Seeds.* In the second pass each document's n-grams are joined with the seeds by integer codes; a hit gives an
   item and a diagonal (place in the document minus place in the item). Hits of an item on close diagonals make one
   passage.
3. *Alignment.* Each passage, widened by ``SLACK`` of the item's length on both sides, is aligned with the item by
   Smith-Waterman over words (match +2, mismatch -1, gap -1). The score is divided by a full match's; from
   ``threshold`` on the document holds the item, in an exact, edited or paraphrased copy.

Items are taken in blocks of ``BLOCK_WORDS`` words, a bounded table that travels to the tasks; a larger benchmark
makes more passes. Texts are not shuffled. Words are runs of characters between ASCII white space and
punctuation, lower-cased.

Defined results: null or empty texts and items hold nothing and match nothing; items shorter than a seed are one
seed; repeated items (same id) are judged each and reported once, with the best score; repeated documents
are reported once for each row; empty tables give an empty result. A text of any length is scanned whole.
Extra columns are left behind.
"""

from __future__ import annotations

import bisect
import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import id_text

SEED = 3
CHANCE, LEAST_SEEDS = 0.05, 3
SLACK = 0.25
BLOCK_WORDS = 2_000_000
MATCH, MISMATCH, GAP = 2, -1, 1

_TO_WORDS = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_TO_WORDS).split()


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two code arrays, and the place after its end in the passage."""
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    ramp = GAP * np.arange(len(passage) + 1)
    best, end = 0, 0
    for w in item:
        new = np.maximum(row - GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(passage == w, MATCH, MISMATCH), out=new[1:])
        row = np.maximum.accumulate(new + ramp) - ramp
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


class Seeds:
    """The seeds of a block of items, by n-gram code."""

    def __init__(self, items: list[tuple[int, list[bytes]]], rates: dict[bytes, float], mean_words: float):
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.base = len(self.vocabulary) + 1
        self.items = [(i, np.array([self.vocabulary[w] for w in ws], dtype=np.int64)) for i, ws in items]
        rate = np.array([rates.get(w, 0.0) for w in self.vocabulary])
        total = max(1, sum(max(1, len(c) - SEED + 1) for _, c in self.items))
        found: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for k, (_, c) in enumerate(self.items):
            n = min(SEED, len(c))
            if not n:
                continue
            codes = self.codes(c, n)
            chance = np.prod([rate[c[j:len(c) - n + 1 + j]] for j in range(n)], axis=0) * mean_words
            rare = set(np.flatnonzero(chance <= CHANCE / total).tolist()) | set(np.argsort(chance, kind="stable")[:LEAST_SEEDS].tolist())
            for at in sorted(rare):
                found[n][int(codes[at])].append((k, at))
        self.by_code = {n: dict(x) for n, x in found.items()}
        self.sorted = {n: np.array(sorted(x), dtype=np.int64) for n, x in found.items()}

    def codes(self, c: np.ndarray, n: int) -> np.ndarray:
        out = c[:len(c) - n + 1].copy()
        for j in range(1, n):
            out = out * self.base + c[j:len(c) - n + 1 + j]
        return out

    def search(self, text: str, threshold: float) -> list[tuple[int, float, int, int]]:
        """(item_id, score, first word, word after the last) of each item held by a text, best passage."""
        known, foreign = self.vocabulary, self.base - 1
        ws = words(text)
        c = np.fromiter((known.get(w, foreign) for w in ws) if len(ws) < 8 else map(known.get, ws, [foreign] * len(ws)), dtype=np.int64, count=len(ws))
        diagonals: dict[int, set[int]] = defaultdict(set)
        for n, seeds in self.sorted.items():
            if len(c) < n:
                continue
            codes = self.codes(c, n)
            at = np.searchsorted(seeds, codes)
            at[at == len(seeds)] = 0
            for place in np.flatnonzero(seeds[at] == codes).tolist():
                for k, offset in self.by_code[n][int(codes[place])]:
                    diagonals[k].add(place - offset)
        best: dict[int, tuple[float, int, int]] = {}
        for k, places in diagonals.items():
            item_id, item = self.items[k]
            slack = max(2, int(SLACK * len(item)))
            ordered = sorted(places)
            while ordered:
                cut = bisect.bisect_right(ordered, ordered[0] + slack)
                low, high = max(0, ordered[0] - slack), min(len(c), ordered[cut - 1] + len(item) + slack)
                ordered = ordered[cut:]
                score, end = align(item, c[low:high])
                if (share := score / (MATCH * len(item))) >= threshold and share > best.get(item_id, (0.0,))[0]:
                    _, back = align(item[::-1], c[low:low + end][::-1])
                    best[item_id] = (share, low + end - back, low + end)
        return [(i, *v) for i, v in sorted(best.items())]


def _rates(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, float], float]:
    """The rate in all words of all documents of each word in ``vocabulary``, and the mean words of a document."""
    names = sorted(vocabulary)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: k for k, w in enumerate(names)}
        counts = np.zeros(len(names) + 1, dtype=np.int64)
        rows = total = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                ws = words(text)
                rows, total = rows + 1, total + len(ws)
                counts += np.bincount(np.fromiter(map(place.get, ws, [len(names)] * len(ws)), dtype=np.int64, count=len(ws)), minlength=len(names) + 1) if len(ws) > len(names) else 0
                if len(ws) <= len(names):
                    np.add.at(counts, np.fromiter(map(place.get, ws, [len(names)] * len(ws)), dtype=np.int64, count=len(ws)), 1)
        full = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *full.tolist()], pa.int64()), pa.array([rows, total, *counts[full].tolist()], pa.int64())], ["word", "n"])

    got = {r.word: r.n for r in docs.select("text").mapInArrow(scan, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    rows, total = got.get(-2, 0), got.get(-1, 0)
    return {names[k]: n / total for k, n in got.items() if k >= 0}, total / max(rows, 1)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items in blocks of bounded size, read partition by partition."""
    block, size = [], 0
    for row in id_text(benchmark, id_col, text_col).where("doc_id is not null").toLocalIterator():
        block.append((row.doc_id, words(row.text)))
        size += len(block[-1][1])
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _prepared(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str) -> Iterator:
    for block in _blocks(benchmark, item_col, item_text):
        rates, mean = _rates(docs, {w for _, ws in block for w in ws})
        yield docs.sparkSession.sparkContext.broadcast(Seeds(block, rates, mean))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, score, first_word, end_word): documents that hold a benchmark item."""
    rows = id_text(docs, id_col, text_col)
    schema = "doc_id long, item_id long, score double, first_word long, end_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for seeds in _prepared(rows, benchmark, item_col, item_text):
        def scan(batches: Iterator[pa.RecordBatch], held=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(d, *f) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for f in held.value.search(t, threshold)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], schema=ARROW)

        out = out.unionByName(rows.mapInArrow(scan, schema))
    return out


ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])


def _holder(seeds, threshold: float):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(seeds.value.search(t or "", threshold)) for t in texts], dtype=bool)

    return holds


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their own columns."""
    out = docs
    for seeds in _prepared(id_text(docs), benchmark, "item_id", "text"):
        out = out.where(~_holder(seeds, threshold)(F.col("text").cast("string")))
    return out
