"""Packing of tokenised documents into as few full sequences as can be, planned on the histogram of lengths.

1. Documents become ids with an end id; those longer than a sequence are cut into whole sequences and a rest. Every task numbers its
   pieces of each length as it writes them, so ranking all pieces of a length takes one small table of counts, no shuffle of pieces.
2. The histogram (at most ``size`` numbers, however large the corpus) is planned on the driver: the configuration linear program, to
   cover every length's pieces by as few fillings (configurations) of a sequence as can be, is solved by multiplicative weights.
   A length's price is its size times exp(-STEEP * (its coverage beyond schedule)); a knapsack dynamic program over the prices
   gives, for each longer length, the best filling of what it leaves, and the best filling of an empty sequence.
3. Rounding: the shares of the steps in each length are cut at whole numbers; fillings are kept as far as pieces are left for all
   of a copy, and what they leave over is placed by best fit, longest pieces first. Every piece is placed.
4. A piece's rank within its length tells by interval search which copy of which filling it belongs to, and where.

The plan is a list of (filling, copies) of bounded length: ROUNDS * BLOCKS and ROUNDS times the longer lengths at most, and a few for each
length. It is shipped to the tasks.

Defined results: null and empty texts are the end id alone; repeated rows and null ids are packed each; a document of any length is cut
as stated; an empty table packs into nothing. Extra columns of the input are left behind.
"""

from __future__ import annotations

import itertools
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from carepulse.llm.common import id_text, stored
from carepulse.llm.word_end_tokens import tokens

SIZE = 2048
#: Turns of each longer length in the multiplicative weights, blocks of lengths that take turns (prices change between them),
#: and how fast prices fall with coverage beyond schedule.
ROUNDS, BLOCKS, STEEP = 16, 8, 8.0
#: Rounding keeps the program's fillings that leave up to so much of a sequence unused, and of their copies so much, so that
#: short pieces are left to fill up what it doesn't keep; the pair of bounds that needs fewest sequences holds.
WASTES, SHARES = (0.0, 0.01, 0.1, 1.0), (1.0, 0.95, 0.8, 0.5, 0.2)

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint, ids binary"
Filling = tuple[tuple[int, int], ...]  # (length, pieces of it), longest first


def tokenised(docs: DataFrame, tokenizer_file: str, end_id: int | None, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (ids as little-endian uint32), ids (in the tokenizer's own width), and
    ``nth`` of its length in the task ``part``. Store it before it is packed: both belong to one attempt of a task."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, part = tokens(tokenizer_file), TaskContext.get().partitionId()
        end = np.array([] if end_id is None else [end_id], own.dtype)
        seen = [0] * (size + 1)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        names = [f.split()[0] for f in PIECES.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.encode(batch.column("text"))):
                ids = np.concatenate([ids, end])
                for piece, low in enumerate(range(0, len(ids), size)):
                    cut = ids[low:low + size]
                    rows.append((doc_id, piece, low, len(cut), zlib.crc32(cut.astype("<u4")), part, seen[len(cut)], cut.tobytes()))
                    seen[len(cut)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=names)

    return id_text(docs, id_col, text_col).mapInArrow(cut, PIECES)


# ---- the plan, on the histogram

def _knapsack(lengths: np.ndarray, prices: np.ndarray, most: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each room the best filling: pieces of each length (a row for each room)."""
    size = int(room.max(initial=0))
    best, taken = np.zeros(size + 1), np.empty(size + 1)
    bundles: list[tuple[int, int, int, np.ndarray]] = []
    for k, (length, price, left) in enumerate(zip(lengths.tolist(), prices.tolist(), np.minimum(most, size // lengths).tolist())):
        many = 1
        while left > 0:
            many = min(many, left)
            weight = length * many
            new, old, better = taken[weight:], best[weight:], np.zeros(size + 1, bool)
            np.add(best[:size + 1 - weight], price * many, out=new)
            np.greater(new, old, out=better[weight:])
            np.maximum(new, old, out=old)
            bundles.append((k, many, weight, better))
            left -= many
            many *= 2
    counts = np.zeros((len(room), len(lengths)), np.int32)
    free = room.copy()
    for k, many, weight, better in reversed(bundles):
        took = better[free]
        if took.any():
            counts[took, k] += many
            free[took] -= weight
    return counts


def _program(histogram: np.ndarray, size: int, rounds: int) -> dict[Filling, int]:
    """The configuration program by multiplicative weights, its shares cut at whole numbers: filling -> copies."""
    lengths = np.flatnonzero(histogram[:size])
    long, short = lengths[lengths > size // 2], lengths[lengths <= size // 2]
    if not len(short):
        return {((int(x), 1),): int(histogram[x]) for x in long}
    demand = histogram[short].astype(float)
    gaps = int(((size - long) * histogram[long]).sum())
    empty = max(0, -(-(int((short * histogram[short]).sum()) - gaps) // size))  # sequences without a longer piece, at least
    rooms = np.append(size - long, size)
    copies = np.append(histogram[long], empty).astype(np.int64)
    coverage = np.zeros(len(short))
    phase = (np.arange(len(rooms)) * 0.6180339887498949) % 1.0
    plan: dict[Filling, int] = {}
    steps = rounds * BLOCKS
    for t in range(steps):
        own = np.append(np.arange(t % BLOCKS, len(long), BLOCKS), len(long))  # a block of the longer lengths, and the empty sequence
        turns = np.where(own < len(long), rounds, steps)
        turn = np.where(own < len(long), t // BLOCKS, t)
        prices = short * np.exp(np.clip(-STEEP * (coverage - t / steps), -30, 30))
        counts = _knapsack(short, prices, histogram[short], rooms[own])
        coverage += (copies[own] / turns) @ counts / demand
        share = (np.where(turn + 1 == turns, copies[own], _whole(copies[own], turn + 1, turns, phase[own]))
                 - np.where(turn == 0, 0, _whole(copies[own], turn, turns, phase[own])))
        for k in np.flatnonzero(share).tolist():
            filled = np.flatnonzero(counts[k])[::-1]
            filling = tuple(zip(short[filled].tolist(), counts[k][filled].tolist()))
            if own[k] < len(long):
                filling = ((int(long[own[k]]), 1), *filling)
            plan[filling] = plan.get(filling, 0) + int(share[k])
    return plan


def _whole(copies: np.ndarray, turn: np.ndarray, turns: np.ndarray, phase: np.ndarray) -> np.ndarray:
    """Whole copies due after so many turns; the phase spreads the turns at which lengths of few pieces have theirs."""
    return np.clip(np.floor(copies * turn / turns + phase).astype(np.int64), 0, copies)


class _Left:
    """Pieces that are not placed yet, and the fillings so far."""

    def __init__(self, histogram: np.ndarray, size: int):
        self.size, self.left = size, histogram.tolist()
        self.alive = [x for x in range(1, size + 1) if self.left[x]]
        self.out: list[tuple[Filling, int]] = []

    def use(self, own: dict[int, int], copies: int) -> int:
        """As many copies of a filling, up to so many, as there are pieces for."""
        left = self.left
        for x, a in own.items():
            copies = min(copies, left[x] // a)
        if copies > 0 and own:
            for x, a in own.items():
                left[x] -= a * copies
                if not left[x]:
                    del self.alive[bisect_right(self.alive, x) - 1]
            self.out.append((tuple(sorted(own.items(), reverse=True)), copies))
        return copies

    def fill(self) -> None:
        """Place all that is left by best fit, longest pieces first, equal fillings at once."""
        left, alive = self.left, self.alive
        while alive:
            own: dict[int, int] = {}
            free, at, copies = self.size, len(alive) - 1, left[alive[-1]]
            while free and at >= 0:
                x = alive[at]
                had = own.get(x, 0)
                if x > free or left[x] <= had:
                    at = min(at - 1, bisect_right(alive, free) - 1)
                    continue
                own[x] = had + 1
                free -= x
                copies = min(copies, left[x] // own[x])
            self.use(own, copies)


def plan(histogram: np.ndarray, size: int = SIZE, rounds: int = ROUNDS) -> list[tuple[Filling, int]]:
    """(filling, copies) that hold every piece once; ``histogram[n]`` pieces have length n."""
    histogram = np.asarray(histogram, np.int64)
    full = [(((size, 1),), int(histogram[size]))] if histogram[size] else []
    rest = histogram.copy()
    rest[size] = 0
    program = sorted(((f, n, size - sum(x * a for x, a in f)) for f, n in _program(rest, size, rounds).items()), key=lambda f: (f[2], -f[0][0][0]))
    best: list[tuple[Filling, int]] | None = None
    for waste, share in itertools.product(WASTES, SHARES):
        left = _Left(rest, size)
        for filling, copies, free in program:
            if free > waste * size:
                break
            left.use(dict(filling), math.ceil(share * copies))
        left.fill()
        if best is None or sum(n for _, n in left.out) < sum(n for _, n in best):
            best = left.out
    return full + (best or [])


def best_fit_bins(histogram: np.ndarray, size: int = SIZE) -> int:
    """Sequences that best fit alone takes, longest pieces first: what the program is measured against."""
    left = _Left(np.asarray(histogram, np.int64), size)
    left.fill()
    return sum(n for _, n in left.out)


class Places:
    """Where the pieces of each rank within their length go, by interval search over a plan."""

    def __init__(self, fillings: list[tuple[Filling, int]], size: int = SIZE):
        rows: list[tuple[int, int, int, int, int]] = []
        used, sequence = [0] * (size + 1), 0
        for filling, copies in fillings:
            offset = 0
            for length, a in filling:
                rows.append((length, used[length], a, sequence, offset))
                used[length] += a * copies
                offset += a * length
            sequence += copies
        rows.sort()
        self.sequences = sequence
        self.length, self.first, self.each, self.sequence, self.offset = np.array(rows, np.int64).reshape(-1, 5).T.copy()

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        at = np.empty(len(length), np.int64)
        for x in np.unique(length):
            low, high = np.searchsorted(self.length, [x, x + 1])
            own = length == x
            at[own] = low + np.searchsorted(self.first[low:high], rank[own], side="right") - 1
        nth = rank - self.first[at]
        return self.sequence[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def pack(pieces: DataFrame, size: int = SIZE, rounds: int = ROUNDS) -> DataFrame:
    """Stored pieces with sequence_id (from 0) and offset: each sequence holds at most ``size`` ids, without gaps from 0."""
    counts = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = np.zeros(size + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        histogram[row.length] = row.n
    places = pieces.sparkSession.sparkContext.broadcast(Places(plan(histogram, size, rounds), size))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.value.of(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ahead = W.Window.partitionBy("length").orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)  # one row for each task
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("placed", placed("length", F.col("base") + F.col("nth")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "placed.sequence_id", "placed.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence: sequence_id, length, ids of its pieces one after the other (binary), doc_ids and offsets of the pieces."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids"))).alias("p"))
    return rows.select("sequence_id", F.aggregate("p", F.lit(0).cast("bigint"), lambda s, x: s + x["length"]).alias("length"),
                       F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"),
                       F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
