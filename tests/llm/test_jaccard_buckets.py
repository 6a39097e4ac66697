"""The near-duplicate join's postings: what is left out before they meet, and that no link is lost by it."""

import numpy as np
from pyspark.sql import functions as F

from carepulse.llm import jaccard_join


def _postings(spark, lists):
    return spark.createDataFrame([(k, 9 << 32 | 1 << 24 | k, ts) for k, ts in lists.items()], "key long, meta long, tokens array<long>")


def test_tokens_of_one_row_are_left_out_however_crowded_their_high_bits(spark):
    lists = {k: [k * 50 + i for i in range(50)] for k in range(1, 40)}
    lists[1][7] = lists[2][9]
    got = {(r.key, r.token, r.at) for r in jaccard_join.shared_only(_postings(spark, lists)).collect()}
    assert got == {(1, lists[2][9], 7), (2, lists[2][9], 9)}


def test_tokens_of_the_same_documents_are_one_bucket(spark):
    # 11, 12, 13 have three tokens in common, 11 and 12 two more, 13 one alone; a row that comes twice is another group
    lists = {11: [1, 2, 3, 4, 5], 12: [1, 2, 3, 4, 5], 13: [2, 4, 5, 8]}
    rows = [(k, 9 << 32 | 1 << 24 | k, t, i) for k, ts in lists.items() for i, t in enumerate(ts)] + [(11, 9 << 32 | 1 << 24 | 11, 3, 2)]
    found = jaccard_join.merged_buckets(spark.createDataFrame(rows, "key long, meta long, token long, at int")).collect()
    assert sorted((r.token, r.hub, r.hub_meta & jaccard_join.LOW, r.weight) for r in found) == [(1, 12, 0, 1), (2, 13, 0, 3), (3, 12, 2, 1)]


def test_linked_sets_share_enough_early_tokens(spark):
    """Sets over the limit have the smaller number of matches asked for at places that _early lets meet; edited templates that don't link hardly meet."""
    rng = np.random.default_rng(8)
    counts = rng.integers(1, 9, 1 << jaccard_join.SKETCH_BITS).astype(np.uint32)
    join = object.__new__(jaccard_join.Join)
    join.percent, rows, asked = 85, [], {}
    for p in range(400):
        base = np.unique(rng.integers(0, 1 << 63, rng.integers(4, 300)).astype(np.uint64))
        if p % 2:
            # the template is common, the edits are rare: few of both sets' rarest tokens are shared
            counts[jaccard_join._cells(base)] += 50
        edited = [np.unique(np.concatenate([base[rng.random(len(base)) > c], rng.integers(0, 1 << 63, int(len(base) * c)).astype(np.uint64)]))
                  for c in rng.choice([0.02, 0.06, 0.12], 2)]
        n, shared = [len(x) for x in edited], len(np.intersect1d(*edited))
        (a, la, _), (b, lb, _) = (jaccard_join.prefix(x, counts, 3.0, 85) for x in edited)
        asked[p] = (100 * shared >= 85 * (sum(n) - shared), min(la, lb))
        for t in np.intersect1d(a, b):
            rows.append((p, n[0] << 32 | la << 24 | int(np.flatnonzero(a == t)[0]), n[1] << 32 | lb << 24 | int(np.flatnonzero(b == t)[0])))
    frame = spark.createDataFrame(rows, "p int, ma long, mb long")
    early = dict(frame.groupBy("p").agg(F.count_if(join._early("ma", "mb"))).collect())
    linked, met = [p for p, (yes, _) in asked.items() if yes], [p for p, (yes, _) in asked.items() if not yes]
    assert len(linked) > 60 and all(early.get(p, 0) >= asked[p][1] for p in linked)
    assert sum(early.get(p, 0) for p in met) < 0.5 * sum(1 for p, *_ in rows if not asked[p][0])
