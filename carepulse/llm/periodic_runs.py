"""Periodic runs of words by online dyadic square catching.

A run is a stretch of words with smallest period q (words q apart are equal), at least ``exponent`` periods and
``least`` words long, that no neighbouring word extends. Words are what white space (space, tab to carriage return) separates.

Words are appended to a :class:`SquareCatchers`. A run that repeats with period p holds so many equal words p apart that a
whole aligned block of a power of two lies among them. Each completed block is therefore a catcher for one
range of periods: every window that the appended words complete is compared with the few blocks that lie in that
range before it (by a rolling hash), so a word costs a constant number of comparisons on each of the
log(n) levels. Where a window equals its block, both are extended by longest common suffix and
prefix (binary search on the hash), then compared word by word. A stretch that reaches the end of what has been appended stays open
and grows with the next words. Squares of one period that overlap are one run; windows inside a
run of a smaller period are not compared again, and of equal stretches the smallest period counts.

Rows are independent: a text is one task's work, memory is proportional to the text (about 60 bytes a word). Spark splits the table by rows, so
copies and hot sources need no exchange at all.

Defined results: null, empty and blank texts have no words and no runs; repeated rows, and rows with a null id, are handled each;
an empty table gives an empty result; a text is taken whole at any length. Extra columns of the input are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import id_text

#: Contract of a run: periods in it, and words.
EXPONENT, LEAST = 3, 24
#: Words appended at once, and candidates extended at once; both bound temporary arrays only.
CHUNK, SLICE = 1 << 18, 1 << 19
#: Fixed value: an odd multiplier of the rolling hash modulo 2**64, and its inverse.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)

_POWERS = {FACTOR: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2**64, kept by the worker."""
    if len(_POWERS[base]) <= n:
        grown = np.full(max(n + 1, 2 * len(_POWERS[base])), base, np.uint64)
        grown[0] = 1
        _POWERS[base] = np.multiply.accumulate(grown)
    return _POWERS[base]


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    return a if len(a) >= n else np.concatenate([a, np.empty(max(n, 2 * len(a)) - len(a), a.dtype)])


class SquareCatchers:
    """Append word numbers; ``runs()`` are those of all words so far."""

    def __init__(self, exponent: int = EXPONENT, least: int = LEAST):
        if exponent < 2:
            raise ValueError("a run repeats: the exponent is 2 or more")
        self.exponent, self.least, self.n = exponent, least, 0
        self.words, self.sums = np.empty(0, np.int64), np.zeros(1, np.uint64)
        self.found: dict[tuple[int, int], int] = {}  # (period, start): end
        self.open: dict[int, int] = {}  # period: start of the stretch that reaches the last word, run or not yet
        self.levels = self._ranges()
        self.done = [0] * len(self.levels)  # words whose windows a level has compared

    def _equal_words(self, period: int) -> int:
        """So many words at least equal the one a period later in a run."""
        return max((self.exponent - 1) * period, self.least - period)

    def _ranges(self) -> list[tuple[int, int, int]]:
        """(least period, period beyond the last, block) of each level: a run of such a period holds an aligned block of equal words."""
        levels: list[tuple[int, int, int]] = []
        for k in range(48):
            low, beyond = 1 << k, 2 << k
            turn = self.least // self.exponent  # up to here a run needs more periods to be long enough
            shortest = min(self._equal_words(p) for p in (low, beyond - 1, turn, turn + 1) if low <= p < beyond)
            block = 1 << ((shortest + 1) // 2).bit_length() - 1
            if levels and levels[-1][2] == block:
                low = levels.pop()[0]
            levels.append((low, beyond, block))
        return levels

    def append(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """The words that follow; returns the runs (start, length, period) that are new or grew."""
        before, known = self.n, dict(self.found)
        for at in range(0, len(words), CHUNK):
            self._append(np.asarray(words[at:at + CHUNK], np.int64))
        return [(s, e - s, p) for (p, s), e in self.found.items() if known.get((p, s)) != e] if self.n > before else []

    def _append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        self.words, self.sums = _grown(self.words, self.n), _grown(self.sums, self.n + 1)
        self.words[old:self.n] = words
        value = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(29)
        self.sums[old + 1:self.n + 1] = self.sums[old] + np.cumsum(value * _powers(FACTOR, self.n)[old:self.n], dtype=np.uint64)
        for period, start in list(self.open.items()):
            self._grow(period, start, old)
        for k, (low, beyond, block) in enumerate(self.levels):
            if low * self.exponent > self.n:
                break
            self._caught(self.done[k], low, beyond, block)
            self.done[k] = self.n

    def _grow(self, period: int, start: int, old: int) -> None:
        """The open stretch with the new words."""
        w, end = self.words, old
        while end < self.n:
            step = min(self.n - end, max(64, end - old))
            differ = np.flatnonzero(w[end:end + step] != w[end - period:end + step - period])
            if len(differ):
                end += int(differ[0])
                del self.open[period]
                break
            end += step
        self._keep(period, start, end)

    def _keep(self, period: int, start: int, end: int) -> None:
        if end - start - period >= self._equal_words(period):
            self.found[period, start] = end
        if end == self.n:
            self.open[period] = start

    def _hashes(self, at: np.ndarray | slice, ends: np.ndarray | slice, inverse: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[at]) * inverse

    def _caught(self, old: int, low: int, beyond: int, block: int) -> None:
        """Compare the windows that the new words complete with the blocks ``low`` to ``beyond`` words before them."""
        first = max(0, old - block + 1) // block * block
        last = self.n - block  # the last window's start
        if last < max(first, low):
            return
        inverse = _powers(INVERSE, self.n)
        windows = self._hashes(slice(first, last + 1), slice(first + block, last + 1 + block), inverse[first:last + 1])
        rows = -(-len(windows) // block)
        grid = np.zeros(rows * block, np.uint64)
        grid[:len(windows)] = windows
        grid = grid.reshape(rows, block)
        back = (beyond - 1) // block
        numbers = np.arange(max(0, first // block - back), first // block + rows)
        numbers = numbers[numbers * block + block <= self.n]
        blocks = self._hashes(numbers * block, numbers * block + block, inverse[numbers * block])
        covered: np.ndarray | None = None
        for r in range(low // block, back + 1):
            own = np.arange(rows) + first // block - r - numbers[0]  # the block r before each row of windows
            valid = (own >= 0) & (own < len(blocks))
            if not valid.any():
                continue
            same = (grid == blocks[np.where(valid, own, 0)][:, None]) & valid[:, None]
            if not same.any():
                continue
            j = np.flatnonzero(same) + first
            i = (j // block - r) * block
            p = j - i
            inside = (p >= low) & (p < beyond) & (j <= last)
            if covered is None:
                covered = self._covered(min(block, low - 1))
            inside &= covered[i] < j + block
            i, j = i[inside], j[inside]
            for at in range(0, len(i), SLICE):
                self._extend(i[at:at + SLICE], j[at:at + SLICE], block)

    def _covered(self, longest: int) -> np.ndarray:
        """Of each word, the farthest end of a run with a period up to ``longest`` that began there or before."""
        reach = np.zeros(self.n, np.int64)
        for (period, start), end in self.found.items():
            if period <= longest and reach[start] < end:
                reach[start] = end
        return np.maximum.accumulate(reach)

    def _common(self, i: np.ndarray, p: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words from i on (or before i) have equal hashes to those p later."""
        power, sums, n = _powers(FACTOR, self.n)[p], self.sums, np.zeros(len(i), np.int64)
        for bit in range(int(most.max(initial=0)).bit_length() - 1, -1, -1):
            longer = n + (1 << bit)
            fits = longer <= most
            longer = np.where(fits, longer, n)
            a, b = (i, i + longer) if ahead else (i - longer, i)
            n = np.where(fits & ((sums[b] - sums[a]) * power == sums[b + p] - sums[a + p]), longer, n)
        return n

    def _extend(self, i: np.ndarray, j: np.ndarray, block: int) -> None:
        if not len(i):
            return
        p = j - i
        starts = i - self._common(i, p, i, ahead=False)
        ends = i + block + self._common(i + block, p, self.n - j - block, ahead=True)  # of the equal words
        least = np.maximum((self.exponent - 1) * p, self.least - p)
        hopeful = np.flatnonzero((ends - starts >= least) | (ends + p == self.n))
        seen: set[tuple[int, int]] = set()
        for k in hopeful.tolist():
            period, start, end, at = int(p[k]), int(starts[k]), int(ends[k]), int(i[k])
            if (period, start) in seen or self.found.get((period, start), 0) >= end + period:
                continue
            seen.add((period, start))
            differ = start + np.flatnonzero(self.words[start:end] != self.words[start + period:end + period])
            if len(differ):  # equal hashes of different words
                if ((differ >= at) & (differ < at + block)).any():
                    continue
                start = int(max((d for d in differ.tolist() if d < at), default=start - 1)) + 1
                end = int(min((d for d in differ.tolist() if d >= at), default=end))
            self._keep(period, start, end + period)

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) by start, then period."""
        smallest: dict[tuple[int, int], int] = {}
        for (period, start), end in self.found.items():
            smallest[start, end - start] = min(period, smallest.get((start, end - start), period))
        return sorted(((s, n, p) for (s, n), p in smallest.items()), key=lambda r: (r[0], r[2]))


def runs_of(words: list[bytes], exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """The runs of one sequence of words."""
    if len(words) < least:
        return []
    number = dict.fromkeys(words)
    if len(number) == len(words):
        return []
    number = dict(zip(number, range(len(number))))
    catchers = SquareCatchers(exponent, least)
    catchers.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    return catchers.runs()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but for those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(keep).tolist()]


RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_words, runs (by start, then period), collapsed (the text's kept words, one space between)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ends, flat, texts = [], [0], [], []
            for text in batch.column("text").to_pylist():
                words = text.split()  # of bytes: space and tab to carriage return
                runs = runs_of(words, exponent, least)
                counts.append(len(words))
                flat += runs
                ends.append(len(flat))
                texts.append(b" ".join(collapsed(words, runs)))
            columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, ["start", "length", "period"])),
                 pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = id_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(scan, f"doc_id bigint, n_words bigint, runs {RUN}, collapsed string")
