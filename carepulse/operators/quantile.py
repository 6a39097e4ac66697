"""Exact order statistics (medians) by distributed histogram refinement.

The global ``median`` aggregate merges a value -> count map of every distinct
value inside one task, and a sort-based rank needs a shuffle of every
distinct value. Here each round is one scan with a partial aggregation that
returns a fixed-size histogram (``BINS`` buckets per open cell): the bucket
holding the wanted rank becomes the next round's cell, with the exact rank
offset carried along. Buckets are contiguous value ranges (the bucket
function is monotone in the value), so ranks stay exact; a cell whose
values are all equal (a hot value) resolves at once, and only a cell too narrow
to divide (its ends are a few neighbouring doubles) is finished by its values.
A round shrinks a cell's value range about ``BINS``-fold, so a few scans
suffice; nothing proportional to the data ever reaches one task or the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
MAX_ROUNDS = 64


def _bucket(v: Column, lo: float, w: float) -> Column:
    b = F.floor((v - F.lit(lo)) / F.lit(w))
    return F.least(F.greatest(b, F.lit(0)), F.lit(BINS - 1)).cast("int")


class _Cell:
    __slots__ = ("name", "conds", "count", "vmin", "vmax")

    def __init__(self, name, conds, count, vmin, vmax):
        self.name, self.conds, self.count, self.vmin, self.vmax = name, conds, count, vmin, vmax

    @property
    def key(self):
        return (self.name, self.conds)

    def predicate(self) -> Column:
        p = (F.col("name") == F.lit(self.name)) & _finite(F.col("v"))
        for lo, w, b in self.conds:
            p = p & (_bucket(F.col("v"), lo, w) == F.lit(b))
        return p

    def width(self) -> float:
        # vmax/BINS - vmin/BINS never overflows, unlike (vmax - vmin)/BINS
        return self.vmax / BINS - self.vmin / BINS


def _finite(v: Column) -> Column:
    return (v != F.lit(math.inf)) & (v != F.lit(-math.inf))


def _cell_id(cells: list[_Cell]) -> Column:
    e = None
    for i, c in enumerate(cells):
        e = F.when(c.predicate(), F.lit(i)) if e is None else e.when(c.predicate(), F.lit(i))
    return e


def column_stats(long: DataFrame) -> dict:
    """name -> Row(n, neg_inf, pos_inf, lo, hi) of a (name, v) frame: one scan, one row per column.

    lo / hi are over the finite values; infinities are counted apart (they sit
    at the two ends of the order and never enter a bucket).
    """
    v = F.col("v")
    fin = _finite(v)
    return {r["name"]: r for r in long.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(v == F.lit(-math.inf)).alias("neg_inf"),
        F.count_if(v == F.lit(math.inf)).alias("pos_inf"),
        F.min(F.when(fin, v)).alias("lo"), F.max(F.when(fin, v)).alias("hi")).collect()}


def rank_values(long: DataFrame, wanted: dict[str, Sequence[int]],
                stats: dict | None = None) -> dict[tuple[str, int], float]:
    """Exact value at each 0-based rank of each column of a (name, v) frame (NULLs already removed)."""
    stats = stats if stats is not None else column_stats(long)
    pending: dict[tuple[str, int], tuple[_Cell, int]] = {}
    done_early: dict[tuple[str, int], float] = {}
    for name, ranks in wanted.items():
        s = stats.get(name)
        if s is None:
            continue
        n, neg, pos = int(s["n"]), int(s["neg_inf"]), int(s["pos_inf"])
        finite = n - neg - pos
        root = _Cell(name, (), finite, float(s["lo"]) if finite else 0.0, float(s["hi"]) if finite else 0.0)
        for r in ranks:
            if not 0 <= r < n:
                raise ValueError(f"rank {r} outside 0..{n - 1} for {name}")
            if r < neg:
                done_early[(name, r)] = -math.inf
            elif r >= neg + finite:
                done_early[(name, r)] = math.inf
            else:
                pending[(name, r)] = (root, r - neg)
    done: dict[tuple[str, int], float] = dict(done_early)
    to_collect: dict[tuple[str, int], tuple[_Cell, int]] = {}
    for _ in range(MAX_ROUNDS):
        refine: dict[tuple[str, int], tuple[_Cell, int]] = {}
        for t, (cell, r) in pending.items():
            w = cell.width()
            if cell.vmin == cell.vmax:
                done[t] = cell.vmin
            elif not (w > 0 and math.isfinite(w)) or cell.vmin + w == cell.vmin or cell.vmax - w == cell.vmax:
                to_collect[t] = (cell, r)
            else:
                refine[t] = (cell, r)
        if not refine:
            break
        cells = list({c.key: c for c, _ in refine.values()}.values())
        index = {c.key: i for i, c in enumerate(cells)}
        cid = _cell_id(cells)
        bucket = None
        for i, c in enumerate(cells):
            be = _bucket(F.col("v"), c.vmin, c.width())
            bucket = F.when(F.col("_cell") == i, be) if bucket is None else bucket.when(F.col("_cell") == i, be)
        hist = (long.select(cid.alias("_cell"), "v").where(F.col("_cell").isNotNull())
                    .groupBy("_cell", bucket.alias("_b"))
                    .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                    .collect())  # at most len(cells) * BINS rows
        by_cell: dict[int, list] = {}
        for h in hist:
            by_cell.setdefault(h["_cell"], []).append(h)
        pending = {}
        for t, (cell, r) in refine.items():
            before = 0
            for h in sorted(by_cell[index[cell.key]], key=lambda x: x["_b"]):
                if r < before + h["n"]:
                    nxt = _Cell(cell.name, cell.conds + ((cell.vmin, cell.width(), int(h["_b"])),),
                                int(h["n"]), float(h["lo"]), float(h["hi"]))
                    pending[t] = (nxt, r - before)
                    break
                before += h["n"]
    else:
        raise RuntimeError("rank refinement did not converge")
    if to_collect:
        cells = list({c.key: c for c, _ in to_collect.values()}.values())
        index = {c.key: i for i, c in enumerate(cells)}
        rows = (long.select(_cell_id(cells).alias("_cell"), "v").where(F.col("_cell").isNotNull())
                    .groupBy("_cell", "v").agg(F.count(F.lit(1)).alias("n"))
                    .collect())  # at most a few thousand neighbouring doubles of each cell
        by_cell: dict[int, list] = {}
        for h in rows:
            by_cell.setdefault(h["_cell"], []).append(h)
        for t, (cell, r) in to_collect.items():
            before = 0
            for h in sorted(by_cell[index[cell.key]], key=lambda x: x["v"]):
                if r < before + h["n"]:
                    done[t] = float(h["v"])
                    break
                before += h["n"]
    return done


def medians(long: DataFrame) -> dict[str, tuple[float, int]]:
    """name -> (median, non-NULL count); the median of an even count is the mean of the two middle values."""
    stats = column_stats(long)
    sizes = {name: int(r["n"]) for name, r in stats.items()}
    wanted = {name: sorted({(n - 1) // 2, n // 2}) for name, n in sizes.items() if n > 0}
    vals = rank_values(long, wanted, stats)
    out = {}
    for name, n in sizes.items():
        a, b = vals[(name, (n - 1) // 2)], vals[(name, n // 2)]
        out[name] = ((a + b) / 2, n)
    return out
