"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of distinct word shingles is at least
``percent`` / 100, in whole numbers. Shingles are 64-bit hashes.

1. *Sets.* One pass gives each document its set size and a signature of the whole set; documents of equal sets
   are one class from here on. The same pass counts how many sets hold a shingle, in a counting sketch of
   ``2**SKETCH_BITS`` cells (fixed size, summed over all data). The sketch only orders shingles and
   estimates costs: a saturated one makes the join slower, never wrong.
2. *Prefixes.* All sets are sorted by the same order, rare shingles first. Linked sets that are cut to their first
   ``n - ceil(t n) + l`` shingles share at least l of them. Each document picks the l (up to ``MAX_MATCHES``)
   with the least estimated cost: a longer prefix means more postings, but only a partner that shares l
   of them is verified (about 1 / l of the postings met). A pair of documents with different l must share the
   smaller of the two. Shingles that just the same documents have make one bucket, with their number as its weight.
3. *Hubs.* In each shingle's bucket every document is first held only against the bucket's hub, the document
   with the commonest prefix (an original is commoner than its edited copies), which is linear in the bucket.
   Verified links give components. A link of two sizes needs r shared shingles, and what two sets share beyond the prefix that
   ends first lies in the rest of that set: pairs with fewer than r less that rest are left to the next step.
4. *The rest.* Buckets whose documents are in one component are done, whatever their size. In the others all
   pairs from different components that share enough prefix shingles are verified; as a link of their sizes needs r, the l
   lie within the first ``n - r + l`` of both, a little more than half a prefix for equal sizes. So every link between
   different components is found, and none inside one is needed for the classes (``links`` gives all of them).

Before two documents are paired, a parity bitmap of each set bounds their difference: a bit is the parity of the set's shingles that
fall on it, so two bitmaps differ in at most as many bits as the sets differ in shingles. Pairs whose bitmaps differ in more bits
than linked sets of these sizes can are left out inside the join. Long sets fill the bitmap and pass, which is as right.

Candidates are verified on the whole sets; these are read for documents in candidate pairs only (a fixed-size
bitmap of their signatures travels to the tasks, so the texts are not shuffled). Prefix tokens that occur once in
the corpus are mostly dropped before any posting is shuffled, by a bitmap of the cells that were met twice.

Defined results: null or empty texts and texts without words have an empty set and link with nothing; fewer
words than a shingle make one shingle of the whole sequence; rows of equal id are judged each by its own text;
an empty table gives an empty result. Extra columns are left behind.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import id_text, slices, stored
from carepulse.llm.components import components

#: Cells of the counting sketch (2 bytes each while a task counts, up to MOST_COUNT for its own part; 1 byte on the driver and in each worker afterwards) and bits of the bitmap.
SKETCH_BITS, BITMAP_BITS, MOST_COUNT = 24, 27, (1 << 16) - 1
#: The sketch keeps a count c as the whole part of LEVELS_PER_OCTAVE * log2(1 + c), so at most 9 % off, up to 2**(255 / LEVELS_PER_OCTAVE).
LEVELS_PER_OCTAVE = 8
#: Prefix tokens are counted in 16 cells for each of them, to find those that occur twice, but in 2**MOST_CELL_BITS at most.
MOST_CELL_BITS = 28
BLOCK = 1 << 16
#: Columns of a set's parity bitmap, 64 bits each.
PARITY = ("p0", "p1", "p2", "p3")
#: Most prefix matches that a document may ask for, and the cost of verifying a pair in postings read.
MAX_MATCHES, VERIFY_COST = 4, 20.0
#: The low bits of a set's meta: how common its shingles are, later the place of a token.
LOW = (1 << 24) - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text; A-Z lower-cased, words between ASCII white space."""
    import xxhash

    words = text.encode().lower().split()
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))] if words else [], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out = h[:len(h) - width + 1].copy()
    for k in range(1, width):
        out ^= out >> np.uint64(29)
        out *= _ODD
        out += h[k:len(h) - width + 1 + k]
    out ^= out >> np.uint64(32)
    out *= _ODD
    return np.unique(out)


def _key(grams: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64))


def parity(grams: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set, as len(PARITY) signed 64-bit numbers."""
    bits = np.bincount(((grams >> np.uint64(16)) % np.uint64(64 * len(PARITY))).astype(np.int64), minlength=64 * len(PARITY)) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _cells(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _count(counts: np.ndarray, cells: np.ndarray) -> None:
    """One more in each of ``cells``, which may name a cell twice; a full count stays."""
    own, times = np.unique(cells, return_counts=True)
    counts[own] = np.minimum(counts[own] + times, MOST_COUNT)


def sets_and_sketch(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, n, key) for documents, and rows (part, block, counts) with a task's share of the sketch."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("key", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts, seen = np.zeros(1 << SKETCH_BITS, dtype=np.uint16), set()
        for batch in slices(batches):
            sizes, keys = [], []
            for text in batch.column("text").to_pylist():
                grams = shingles(text, width)
                key = _key(grams)
                sizes.append(len(grams))
                keys.append(key)
                if key not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(key)
                    _count(counts, _cells(grams))
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()),
                                              none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary())], schema=schema)
        part = TaskContext.get().partitionId()
        for k in range(0, len(counts), BLOCK):
            own = counts[k:k + BLOCK]
            if own.any():
                yield pa.RecordBatch.from_pylist([{"part": part, "block": k // BLOCK, "counts": zlib.compress(own.tobytes(), 1)}], schema=schema)

    return docs.mapInArrow(scan, "doc_id long, n int, key long, part int, block int, counts binary")


class Sketch:
    """Counts by cell, a byte each on a logarithmic scale; indexed by cells it gives counts."""

    def __init__(self, levels: np.ndarray):
        self.levels = levels

    def __getitem__(self, cells: np.ndarray) -> np.ndarray:
        return _COUNT_OF[self.levels[cells]]

    def mean(self) -> float:
        return float(np.bincount(self.levels, minlength=256) @ _COUNT_OF / len(self.levels))


_COUNT_OF = np.exp2(np.arange(256) / LEVELS_PER_OCTAVE) - 1


def _sketch(rows: DataFrame) -> Sketch:
    """The sum of all tasks' shares: first within groups of tasks, then over the groups; fixed size."""
    def total(table: pa.Table, kind: type) -> np.ndarray:
        out = np.zeros(BLOCK, dtype=np.uint64)
        for c in table.column("counts").to_pylist():
            out += np.frombuffer(zlib.decompress(c), dtype=kind)
        return out

    def row(table: pa.Table, values: np.ndarray) -> pa.Table:
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "counts": pa.array([zlib.compress(values.tobytes(), 1)])})

    def added(table: pa.Table) -> pa.Table:
        return row(table, np.minimum(total(table, np.uint16), 0xFFFFFFFF).astype(np.uint32))

    def levels(table: pa.Table) -> pa.Table:
        # the small addend keeps counts that are a level's own value from falling below it
        return row(table, np.minimum(255, np.log2(1.0 + total(table, np.uint32)) * LEVELS_PER_OCTAVE + 1e-9).astype(np.uint8))

    schema = "block int, counts binary"
    first = rows.where("counts is not null").select("block", (F.col("part") / 256).cast("int").alias("lane"), "counts")
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    for r in first.groupBy("block", "lane").applyInArrow(added, schema).groupBy("block").applyInArrow(levels, schema).collect():
        out[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(r.counts), dtype=np.uint8)
    return Sketch(out)


def prefix(grams: np.ndarray, counts: np.ndarray | Sketch, noise: float, percent: int) -> tuple[np.ndarray, int, int]:
    """A set's prefix under the common order, the matches it asks for and how common its shingles are."""
    n = len(grams)
    held = counts[_cells(grams)]
    order = np.lexsort((grams, held))
    need = -(-percent * n // 100)
    most = max(1, min(MAX_MATCHES, need))
    longest = n - need + most
    held = held[order[:longest]].astype(np.float64)
    partners = np.cumsum(np.maximum(0.0, held - 1 - noise))
    lengths = n - need + np.arange(1, most + 1)
    cost = lengths + partners[lengths - 1] * (1 + VERIFY_COST / np.arange(1, most + 1))
    matches = int(np.argmin(cost)) + 1
    return grams[order[:n - need + matches]], matches, int(min(held[:n - need + 1].mean(), (1 << 24) - 1))


def prefixes(docs: DataFrame, width: int, percent: int, sketch: Sketch, first: np.ndarray) -> DataFrame:
    """Rows (key, meta, tokens, *PARITY) for each set: meta packs size, matches asked for and commonness.

    Of the documents with one set only the first is read (marked in the bitmap ``first``; a few others may pass by chance,
    and a row twice only makes a count of matches too large).
    """
    noise = sketch.mean()
    noise += 2 * noise ** 0.5
    counts = docs.sparkSession.sparkContext.broadcast((sketch, first))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, marks = counts.value
        for batch in slices(batches):
            keys, metas, tokens, bits = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                grams = shingles(text, width)
                if len(grams) and _marked(marks, (key := _key(grams)) ^ doc_id, BITMAP_BITS):
                    own, matches, common = prefix(grams, held, noise, percent)
                    keys.append(key)
                    metas.append(len(grams) << 32 | matches << 24 | common)
                    tokens.append(own.view(np.int64))
                    bits.append(parity(grams))
            offsets = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
            values = pa.array(np.concatenate(tokens) if tokens else np.array([], dtype=np.int64))
            columns = np.array(bits, dtype=np.int64).reshape(len(bits), len(PARITY)).T
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(metas, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values),
                                              *[pa.array(np.ascontiguousarray(c)) for c in columns]], ["key", "meta", "tokens", *PARITY])

    return docs.mapInArrow(scan, "key long, meta long, tokens array<long>, " + ", ".join(f"{p} long" for p in PARITY))


def _marked(bits: np.ndarray, mark: int, size: int) -> int:
    mark &= (1 << size) - 1
    return int(bits[mark >> 6]) >> (mark & 63) & 1


def _bitmap(marks: DataFrame, size: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of 2**size bits with the low bits of each row's ``mark`` set; at most its words reach the driver."""
    word = F.col("mark").bitwiseAND((1 << size) - 1)
    rows = (marks.select(F.shiftright(word, 6).alias("w"), F.expr("shiftleft(1L, cast(mark & 63 as int))").alias("bit"))
            .groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (size - 6), dtype=np.uint64)
    for batch in rows.to_batches():
        out[batch.column("w").to_numpy()] = batch.column("bits").to_numpy().view(np.uint64)
    return out


def shared_only(postings: DataFrame) -> DataFrame:
    """Rows (key, meta, token, at) of ``postings`` (key, meta, tokens) without most tokens that no other row has; ``at`` is a token's place.

    Tokens are counted by cell, of which there are at least 16 for each token: only the small cell numbers are shuffled. Cells met
    twice come back as a bitmap; beyond MOST_CELL_BITS it fills up and lets more pass, which is as right.
    """
    n = postings.agg(F.sum(F.size("tokens"))).head()[0] or 1
    size = min(MOST_CELL_BITS, max(16, math.ceil(math.log2(16 * n))))
    # the low bits: prefixes prefer small numbers among equally rare shingles, so the high ones are crowded
    mask = (1 << size) - 1
    cells = postings.select(F.explode(F.transform("tokens", lambda t: t.bitwiseAND(mask).cast("int"))).alias("cell"))
    twice = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bits = postings.sparkSession.sparkContext.broadcast(_bitmap(twice.select(F.col("cell").cast("long").alias("mark")), size))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        for batch in slices(batches):
            lists = batch.column("tokens")
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64) if len(batch) else np.zeros(0, np.uint64)
            row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False)) if len(batch) else np.zeros(0, int)
            cell = flat & np.uint64(mask)
            keep = (held[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1
            at = pa.array(row[keep])
            first = np.searchsorted(row, row[keep])
            yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("meta").take(at), pa.array(flat[keep].view(np.int64)),
                                              pa.array((np.flatnonzero(keep) - first).astype(np.int32))], ["key", "meta", "token", "at"])

    return postings.mapInArrow(scan, "key long, meta long, token long, at int")


def merged_buckets(postings: DataFrame) -> DataFrame:
    """(token, hub, hub_meta, weight) for each group of documents that share tokens: the first token, in the common order, that just these have, and the number of such.

    Documents with a passage in common share dozens of tokens; so they meet once, and not once a token. Groups are told apart by their hub and
    by the sums of both halves of their members' keys, 64-bit hashes.
    """
    buckets = (postings.groupBy("token")
               .agg(F.count(F.lit(1)).alias("members"), F.sum(F.shiftrightunsigned("key", 32)).alias("high"), F.sum(F.col("key").bitwiseAND(0xFFFFFFFF)).alias("low"),
                    F.max(F.struct(F.col("meta").bitwiseAND(LOW).alias("c"), "key", "meta", "at")).alias("hub"))
               .where("members > 1").select("token", "members", "high", "low", F.col("hub.key").alias("hub"), F.col("hub.meta").alias("hub_meta"), F.col("hub.at").alias("hub_at")))
    return (buckets.groupBy("members", "high", "low", "hub", "hub_meta").agg(F.min(F.struct("hub_at", "token")).alias("first"), F.count(F.lit(1)).alias("weight"))
            .select(F.col("first.token").alias("token"), "hub", _placed("hub_meta", F.col("first.hub_at")).alias("hub_meta"), "weight"))


def _placed(meta: str, at):
    """``meta`` with a token's place (LOW, if it is beyond) where how common the set is was."""
    return F.col(meta).bitwiseAND(~LOW).bitwiseOR(F.least(at, F.lit(LOW)).cast("long"))


def whole_sets(docs: DataFrame, width: int, needed: DataFrame) -> DataFrame:
    """(key, grams) of the documents that ``needed`` (key, doc_id) names, and a few others by chance; no text is shuffled."""
    # by id, so that only texts that may be needed are cut into shingles, and by set, as an id may have several texts
    bits = docs.sparkSession.sparkContext.broadcast((_bitmap(needed.select(F.col("doc_id").alias("mark"))),
                                                     _bitmap(needed.select((F.col("key").bitwiseXOR(F.col("doc_id"))).alias("mark")))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = bits.value
        for batch in slices(batches):
            keys, sets = [], []
            at = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64) & ((1 << BITMAP_BITS) - 1)
            batch = batch.filter(pa.array((ids[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1))
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                grams = shingles(text, width)
                if len(grams) and _marked(held, (key := _key(grams)) ^ doc_id, BITMAP_BITS):
                    keys.append(key)
                    sets.append(grams.view(np.int64))
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = pa.array(np.concatenate(sets) if sets else np.array([], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values)], ["key", "grams"])

    return docs.mapInArrow(scan, "key long, grams array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, with the shared count."""
    first = sets.select(F.col("key").alias("a"), F.col("grams").alias("ga"))
    second = sets.select(F.col("key").alias("b"), F.col("grams").alias("gb"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b")
    counted = both.select("a", "b", (F.size("ga") + F.size("gb")).alias("n"), F.size(F.array_intersect("ga", "gb")).alias("shared"))
    return counted.where(100 * F.col("shared") >= percent * (F.col("n") - F.col("shared"))).select("a", "b", "shared")


class Join:
    """The join's tables for one document table; ``classes`` and ``links`` read them."""

    def __init__(self, docs: DataFrame, width: int, percent: int, id_col: str, text_col: str):
        self.percent = percent
        self.width = width
        rows = id_text(docs, id_col, text_col)
        scanned = stored(sets_and_sketch(rows, width), "sets")
        self.documents = scanned.where("counts is null").select("doc_id", "n", "key")
        self.rows = rows.where("doc_id is not null")
        self.first = self.documents.where("n > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
        first = _bitmap(self.first.select((F.col("key").bitwiseXOR(F.col("doc_id"))).alias("mark")))
        own = stored(prefixes(self.rows, width, percent, _sketch(scanned), first), "prefixes")
        self.parity = own.select("key", *PARITY).dropDuplicates(["key"])
        postings = stored(shared_only(own.select("key", "meta", "tokens")), "postings")
        self.matched = stored(postings.withColumn("meta", _placed("meta", F.col("at"))).drop("at").join(merged_buckets(postings), "token"), "matched")

    def _sets(self, pairs: DataFrame) -> DataFrame:
        """The whole sets of the documents in ``pairs``, and a few others by chance."""
        needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
        return stored(whole_sets(self.rows, self.width, needed.join(self.first, "key")), "whole")

    def _fits(self, a: str, b: str):
        """The sizes allow a link."""
        na, nb = F.shiftright(a, 32), F.shiftright(b, 32)
        return 100 * F.least(na, nb) >= self.percent * F.greatest(na, nb)

    def _close(self, na, nb, other: str):
        """Sets of these sizes and parity bitmaps (the second under names with ``other`` before) may be linked."""
        bits = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"{other}{p}"))) for p in PARITY[1:]), F.bit_count(F.col(PARITY[0]).bitwiseXOR(F.col(f"{other}{PARITY[0]}"))))
        return (100 + self.percent) * bits <= (100 - self.percent) * (na + nb)

    def _parity(self, name: str, before: str = "") -> DataFrame:
        return self.parity.select(F.col("key").alias(name), *[F.col(p).alias(f"{before}{p}") for p in PARITY])

    def _early(self, a: str, b: str):
        """A shared token is within the first n - r + l of both sets, of whose tokens sets that share r or more have l in common."""
        size, asked, at = (lambda m: F.shiftright(m, 32)), (lambda m: F.shiftright(m, 24).bitwiseAND(0xFF)), (lambda m: F.col(m).bitwiseAND(LOW))
        return self.percent * (size(a) + size(b)) <= (100 + self.percent) * (F.least(size(a) - at(a), size(b) - at(b)) + F.least(asked(a), asked(b)) - 1)

    def _matches(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a < b) with their number k of matches, of rows (a, ma, b, mb, weight) with one for each shared bucket, in either order."""
        turned = lambda x, y: F.when(F.col("a") > F.col("b"), F.col(y)).otherwise(F.col(x))
        # buckets orient a pair each by its own hub or main label: all matches of a pair are counted together
        pairs = pairs.select(F.least("a", "b").alias("a"), turned("ma", "mb").alias("ma"), F.greatest("a", "b").alias("b"), turned("mb", "ma").alias("mb"), "weight")
        return (pairs.groupBy("a", "b").agg(F.sum("weight").alias("k"), F.first("ma").alias("ma"), F.first("mb").alias("mb"))
                .select("a", "b", "k", *[F.shiftright(f"m{x}", 32).alias(f"n{x}") for x in "ab"], *[F.shiftright(f"m{x}", 24).bitwiseAND(0xFF).alias(f"l{x}") for x in "ab"]))

    def hub_links(self) -> DataFrame:
        met = self.matched.where("key <> hub").where(self._fits("meta", "hub_meta")).select(
            F.col("key").alias("a"), F.col("meta").alias("ma"), F.col("hub").alias("b"), F.col("hub_meta").alias("mb"), "weight")
        beyond = [F.expr(f"({self.percent} * n{x} + 99) div 100 - l{x}") for x in "ab"]
        met = self._matches(met).where((100 + self.percent) * (F.col("k") + F.greatest(*beyond)) >= self.percent * (F.col("na") + F.col("nb")))
        met = met.join(self._parity("a"), "a").join(self._parity("b", "other_"), "b")
        pairs = stored(met.where(self._close(F.col("na"), F.col("nb"), "other_")).select("a", "b"), "pairs")
        return stored(verified(pairs, self._sets(pairs), self.percent), "links")

    def other_links(self, labels: DataFrame | None) -> DataFrame:
        """Links between documents of different labels (None: all links)."""
        # a table without weights holds every token
        rows = self.matched.select("token", "key", "meta", F.col("weight") if "weight" in self.matched.columns else F.lit(1).alias("weight"))
        rows = (rows.withColumn("label", F.col("key")) if labels is None else
                rows.join(labels.select(F.col("node").alias("key"), "component"), "key", "left")
                .select("token", "key", "meta", "weight", F.coalesce("component", "key").alias("label")))
        sizes = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c"))
        mixed = (sizes.groupBy("token").agg(F.max(F.struct("c", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
                 .where("labels > 1").select("token", F.col("main.label").alias("main")))
        rows = stored(rows.join(mixed, "token").join(self.parity, "key"), "mixed")
        a = rows.where("label <> main").select("token", F.col("key").alias("a"), F.col("meta").alias("ma"), F.col("label").alias("la"), "weight", *PARITY)
        b = rows.select("token", F.col("key").alias("b"), F.col("meta").alias("mb"), F.col("label").alias("lb"), "main", *[F.col(p).alias(f"other_{p}") for p in PARITY])
        pairs = a.join(b, "token").where((F.col("la") != F.col("lb")) & ((F.col("lb") == F.col("main")) | (F.col("a") < F.col("b")))
                                         & self._fits("ma", "mb") & self._early("ma", "mb") & self._close(F.shiftright("ma", 32), F.shiftright("mb", 32), "other_"))
        pairs = stored(self._matches(pairs).where(F.col("k") >= F.least("la", "lb")).select("a", "b"), "pairs")
        return stored(verified(pairs, self._sets(pairs), self.percent), "links")


def jaccard_links(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All links between different sets: (doc_a, doc_b, shared), each set under the smallest id that has it."""
    join = Join(docs, width, percent, id_col, text_col)
    ids = join.first.select(F.col("key").alias("a"), F.col("doc_id").alias("doc_a"))
    return (join.other_links(None).join(ids, "a").join(ids.select(F.col("a").alias("b"), F.col("doc_a").alias("doc_b")), "b")
            .select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"), "shared"))


def _classes(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> tuple[Join, DataFrame]:
    join = Join(docs, width, percent, id_col, text_col)
    links = join.hub_links()
    links = links.unionByName(join.other_links(components(links)))
    return join, components(links).withColumnRenamed("node", "key")


def jaccard_classes(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    join, labels = _classes(docs, width, percent, id_col, text_col)
    rows = (join.documents.join(labels, "key", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "key")).alias("label")))
    lowest = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("low"))
    return rows.join(lowest, "label", "left").select("doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each class, that with the smallest doc_id, with its own columns.

    Rows with an empty set, or without an id, all stay. Rows that repeat an id are judged each by their text; of those in
    one class one stays.
    """
    join, labels = _classes(docs, width, percent, "doc_id", "text")
    rows = (join.documents.where("n > 0 and doc_id is not null").join(labels, "key", "left")
            .select("doc_id", "key", F.coalesce("component", "key").alias("label")))
    lowest = rows.groupBy("label").agg(F.min("doc_id").alias("low"))
    ranked = rows.join(lowest, "label")
    gone = ranked.where("doc_id <> low").select("doc_id").distinct()
    repeated = stored(join.documents.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id"), "repeated")
    name, doc_id = f"id_{uuid.uuid4().hex}", F.col("doc_id").cast("long")
    if repeated.isEmpty():
        return docs.join(gone.withColumnRenamed("doc_id", name), doc_id == F.col(name), "left_anti")
    # an id may stay with one of its texts and go with another: such rows are placed by their own sets
    once = docs.join(gone.unionByName(repeated).distinct().withColumnRenamed("doc_id", name), doc_id == F.col(name), "left_anti")
    again = docs.join(repeated.withColumnRenamed("doc_id", name), doc_id == F.col(name), "left_semi")
    key, label, low = (f"{x}_{uuid.uuid4().hex}" for x in ("key", "label", "low"))

    @F.pandas_udf("long")
    def key_of(texts: pd.Series) -> pd.Series:
        grams = [shingles(t or "", width) for t in texts]
        return pd.Series([_key(g) if len(g) else None for g in grams], dtype="Int64")

    placed = ranked.select(F.col("key").alias(key), F.col("label").alias(label), F.col("low").alias(low)).distinct()
    again = again.withColumn(key, key_of(F.col("text").cast("string"))).join(placed, key, "left")
    empty = again.where(F.col(label).isNull()).select(*docs.columns)
    # of the rows of a class's smallest id, which may be a third of the table, each task sends one
    best = (again.where(doc_id == F.col(low)).groupBy(label)
            .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.struct(key, F.xxhash64("text"))).alias(key)))
    return once.unionByName(empty).unionByName(best.select(f"{key}.*"))
