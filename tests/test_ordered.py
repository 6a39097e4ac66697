"""Distributed exact statistics vs brute force on small fixtures, including a hot value."""

import random
import statistics

from pyspark.sql import functions as F

from carepulse.operators.clean import column_medians, column_modes, label_dictionary, label_encode
from carepulse.operators.evaluate import auc_ovr, roc_points
from carepulse.operators.ordered import dense_index, running_sum


import pytest


@pytest.fixture(params=[False, True])
def path(request, spark):
    """Run the ordered-statistics tests over joined small ranges and over many separate ones."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, str(not request.param).lower())
    yield request.param
    spark.conf.set(key, before)


def test_running_sum_matches_cumsum(spark, path):
    rnd = random.Random(7)
    rows = [(g, i, rnd.randint(0, 9)) for g in ("a", "b", "c") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, w int")
    got = {(r.g, r.k): r.c for r in running_sum(df, ["k"], "w", by=["g"], out="c", num_partitions=7).collect()}
    for g in ("a", "b", "c"):
        acc = 0
        for (gg, k, w) in rows:
            if gg == g:
                acc += w
                assert got[(g, k)] == acc


def test_median_with_hot_value_and_even_counts(spark):
    rnd = random.Random(1)
    xs = [5.0] * 400 + [rnd.uniform(-100, 100) for _ in range(799)] + [None] * 10
    ys = [float(i) for i in range(1, 1001)] + [None] * 209
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double").repartition(5)
    got = {r["name"]: r["median"] for r in column_medians(df).collect()}
    assert abs(got["x"] - statistics.median([v for v in xs if v is not None])) < 1e-12
    assert got["y"] == 500.5


def test_mode_ties_pick_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    assert column_modes(df).first()["mode"] == "a"


def test_dense_index_and_label_encode(spark, path):
    vals = ["z", "a", "m", "a", None, "b", "z"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    idx = {r.s: r._idx for r in dense_index(df, "s", num_partitions=3).collect()}
    assert idx == {"a": 0, "b": 1, "m": 2, "z": 3}
    enc = {r.i: r.s for r in label_encode(df, ["s"]).collect()}
    assert [enc[i] for i in range(len(vals))] == [3, 0, 2, 0, None, 1, 3]
    dic = label_dictionary(df, ["s"])
    assert dic.count() == 4


def _brute_auc(ys, ss, pos):
    P = [s for y, s in zip(ys, ss) if y == pos]
    N = [s for y, s in zip(ys, ss) if y != pos]
    u = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in P for n in N)
    return u / (len(P) * len(N))


def test_auc_and_roc_vs_brute_force(spark, path):
    rnd = random.Random(3)
    ys = [rnd.choice("xyz") for _ in range(300)]
    ss = [float(rnd.randint(0, 20)) for _ in range(300)]
    df = spark.createDataFrame(list(zip(ys, ss)), "y string, s double")
    got = {r["class"]: r.auc for r in auc_ovr(df, "y", "s").collect()}
    for c in "xyz":
        assert abs(got[c] - _brute_auc(ys, ss, c)) < 1e-12
    assert abs(got["macro"] - sum(got[c] for c in "xyz") / 3) < 1e-12
    roc = roc_points(df, "y", "s").where(F.col("class") == "x").collect()
    P = sum(1 for y in ys if y == "x")
    assert [(r.fpr, r.tpr, r.tps, r.fps) for r in roc if r.threshold is None] == [(0.0, 0.0, 0, 0)]
    for r in roc:
        if r.threshold is None:
            continue
        tp = sum(1 for y, s in zip(ys, ss) if y == "x" and s >= r.threshold)
        assert abs(r.tpr - tp / P) < 1e-12


def test_histogram_refinement_rounds(spark, monkeypatch):
    """Force several refinement rounds (tiny cells and bins) against brute force."""
    from carepulse.operators import quantile
    monkeypatch.setattr(quantile, "BINS", 4)
    rnd = random.Random(11)
    cols = {
        "hot": [7.25] * 300 + [rnd.uniform(-5, 20) for _ in range(301)],
        "wide": [rnd.choice([-1e300, 1e300, 0.0]) for _ in range(50)] + [rnd.gauss(0, 1) for _ in range(551)],
        "ints": [float(rnd.randint(0, 3)) for _ in range(601)],
        "even": [rnd.uniform(0, 1) for _ in range(600)] + [None],
        "infs": [float("inf")] * 100 + [float("-inf")] * 50 + [rnd.uniform(-3, 3) for _ in range(451)],
        "toppos": [float("inf")] * 400 + [rnd.uniform(-3, 3) for _ in range(201)],
    }
    rows = list(zip(*cols.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = {r["name"]: r["median"] for r in column_medians(df).collect()}
    for c, xs in cols.items():
        assert got[c] == statistics.median([x for x in xs if x is not None]), c


def test_classification_report_vs_brute_force(spark):
    from carepulse.operators.evaluate import classification_report, confusion_long
    rnd = random.Random(9)
    pairs = [(rnd.choice("abc"), rnd.choice("abcd")) for _ in range(400)]   # 'd' only ever predicted
    df = spark.createDataFrame(pairs, "y string, p string")
    rep = {r.label: r for r in classification_report(df, "y", "p").collect()}
    labels = sorted({x for pr in pairs for x in pr})
    stats = {}
    for lab in labels:
        tp = sum(1 for y, p in pairs if y == lab and p == lab)
        sup = sum(1 for y, _ in pairs if y == lab)
        pn = sum(1 for _, p in pairs if p == lab)
        pr_ = tp / pn if pn else 0.0
        rc = tp / sup if sup else 0.0
        f1 = 2 * pr_ * rc / (pr_ + rc) if pr_ + rc else 0.0
        stats[lab] = (pr_, rc, f1, sup)
        r = rep[lab]
        assert abs(r.precision - pr_) < 1e-12 and abs(r.recall - rc) < 1e-12 and abs(r.f1 - f1) < 1e-12
        assert r.support == sup
    n = len(pairs)
    assert abs(rep["macro avg"].f1 - sum(v[2] for v in stats.values()) / len(labels)) < 1e-12
    assert abs(rep["weighted avg"].recall - sum(v[1] * v[3] for v in stats.values()) / n) < 1e-12
    cm = confusion_long(df, "y", "p").collect()
    assert {(r.actual, r.predicted) for r in cm} == set(pairs) and sum(r.n for r in cm) == n
    extra = {r.label for r in classification_report(df, "y", "p", labels=labels + ["z"]).collect()}
    assert "z" in extra
