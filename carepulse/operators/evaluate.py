"""Model evaluation as DataFrames (A6-A13, M8): confusion matrix, report, accuracy, ROC, AUC.

Every metric is an aggregation over an (actual, predicted[, score]) table of
any size. Only A13, whose columns are the classes, brings the class list to the
driver. ROC and AUC never sort the scored
table in one task: they count per (class, score) first and take running
totals over range partitions (operators.ordered).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.operators.ordered import running_sum
from carepulse.schemas import quote


def _q(c: str) -> Column:
    return F.col(quote(c))


def class_values(df: DataFrame, *cols: str) -> list:
    """Sorted distinct labels over `cols`, for callers that need them as column names."""
    u = None
    for c in cols:
        d = df.select(_q(c).cast("string").alias("label"))
        u = d if u is None else u.unionByName(d)
    return sorted(r[0] for r in u.where(F.col("label").isNotNull()).distinct().collect())


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per label."""
    return df.groupBy(_q(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))


def _pair_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, n): the scored table read once."""
    a, p = _q(actual).cast("string"), _q(predicted).cast("string")
    return (df.select(a.alias("actual"), p.alias("predicted"))
              .where(F.col("actual").isNotNull() & F.col("predicted").isNotNull())
              .groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n")))


def confusion_long(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(actual, predicted, n) for every label pair that occurs; a pair that is absent has no rows.

    One aggregation of one scan, whatever the number of labels.
    """
    return _pair_counts(df, actual, predicted)


def classification_report(df: DataFrame, actual: str, predicted: str,
                          labels: Sequence[str] | None = None) -> DataFrame:
    """Per-class precision / recall / f1 / support + macro and weighted averages (0 when undefined).

    Every label of the union occurs as an actual or a predicted value, so the
    per-label sums come straight from the (actual, predicted) counts: each
    count row feeds its actual label (support, true positives) and its
    predicted label (predicted total) in one aggregation, no join. `labels`
    restricts / extends the report to a given label list.
    """
    counts = _pair_counts(df, actual, predicted)
    fed = counts.select(F.inline(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0)).alias("tp"),
                 F.lit(0).cast("long").alias("pn")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.lit(0).cast("long").alias("tp"), F.col("n").alias("pn")))))
    sums = fed.groupBy("label").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                                    F.sum("pn").alias("pn"))
    if labels is not None:
        every = df.sparkSession.createDataFrame([(x,) for x in labels], "label string")
        sums = every.join(sums, "label", "left").fillna(0)
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pn")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = sums.select("label", prec.alias("precision"), rec.alias("recall"), F.col("support").cast("long").alias("support"))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    per = per.withColumn("f1", f1)
    tot = F.sum("support")

    def wavg(c):
        return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), tot), F.lit(0.0))

    summary = per.agg(F.inline(F.array(
        F.struct(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                 F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), wavg("precision").alias("precision"),
                 wavg("recall").alias("recall"), wavg("f1").alias("f1"), tot.alias("support")))))
    cols = ["label", "precision", "recall", "f1", "support"]
    return per.select(*cols).unionByName(summary.select(*cols))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """A10: share of rows with actual == predicted, and `n`, the rows that have both."""
    hit = (_q(actual).cast("string") == _q(predicted).cast("string")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(hit).alias("n"))


def label_binarize(df: DataFrame, label: str, classes: Sequence[str] | None = None,
                   keep: Sequence[str] = (), prefix: str | None = None) -> DataFrame:
    """One 0/1 column per class (one-vs-rest indicator matrix)."""
    classes = list(classes) if classes is not None else class_values(df, label)
    pre = prefix if prefix is not None else f"{label}_"
    y = _q(label).cast("string")
    return df.select(*[_q(k) for k in keep],
                     *[F.coalesce((y == F.lit(c)).cast("int"), F.lit(0)).alias(f"{pre}{c}") for c in classes])


def _score_counts(df: DataFrame, actual: str, score: str, classes: Sequence[str]) -> DataFrame:
    """(class, score, pos, neg): per distinct score, rows of that class vs the rest."""
    y = _q(actual).cast("string")
    per_score = df.where(_q(score).isNotNull() & y.isNotNull()).groupBy(_q(score).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(y == F.lit(c)).alias(f"_p{i}") for i, c in enumerate(classes)])
    stacked = per_score.select("score", "_all", F.inline(F.array(*[
        F.struct(F.lit(c).alias("class"), F.col(f"_p{i}").alias("pos")) for i, c in enumerate(classes)])))
    return stacked.select("class", "score", "pos", (F.col("_all") - F.col("pos")).alias("neg"))


def _class_score_counts(df: DataFrame, actual: str, class_scores: dict) -> DataFrame:
    """(class, score, pos, neg) when every class has its own score column (e.g. its probability)."""
    y = _q(actual).cast("string")
    stacked = df.where(y.isNotNull()).select(y.alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(str(c)).alias("class"), _q(col).cast("double").alias("score"))
        for c, col in class_scores.items()])))
    return (stacked.where(F.col("score").isNotNull()).groupBy("class", "score")
                   .agg(F.count_if(F.col("_y") == F.col("class")).alias("pos"),
                        F.count_if(F.col("_y") != F.col("class")).alias("neg")))


def _counts(df: DataFrame, actual: str, score, classes) -> DataFrame:
    if isinstance(score, dict):
        return _class_score_counts(df, actual, score)
    classes = list(classes) if classes is not None else class_values(df, actual)
    return _score_counts(df, actual, score, classes)


def roc_points(df: DataFrame, actual: str, score, classes: Sequence[str] | None = None) -> DataFrame:
    """One-vs-rest ROC: per class and distinct threshold (descending), fpr and tpr.

    Every distinct score is a threshold (no collinear-point dropping); a row
    means "predict positive when score >= threshold". Each class starts at
    (0, 0), the row whose threshold is NULL (above every score). `score` is one
    column shared by all classes, or {class: column} (each class its own probability).
    """
    sc = _counts(df, actual, score, classes).withColumn("_desc", -F.col("score"))
    cum = running_sum(sc, ["_desc"], ["pos", "neg"], by=["class"], out=["tps", "fps"])
    # totals from the materialised running-total table, not a second scan of the input
    totals = cum.groupBy("class").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    start = totals.select("class", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                          F.lit(0).cast("long").alias("tps"), F.lit(0).cast("long").alias("fps"))
    return start.unionByName(cum.join(totals, "class").select("class", F.col("score").alias("threshold"),
                       F.coalesce(F.try_divide(F.col("fps").cast("double"), F.col("N")), F.lit(0.0)).alias("fpr"),
                       F.coalesce(F.try_divide(F.col("tps").cast("double"), F.col("P")), F.lit(0.0)).alias("tpr"),
                       F.col("tps").cast("long").alias("tps"), F.col("fps").cast("long").alias("fps")))


def _mann_whitney(sc: DataFrame) -> DataFrame:
    """(class, _u, P, N) of (class, score, pos, neg) rows."""
    cum = running_sum(sc, ["score"], "neg", by=["class"], out="neg_le")
    return cum.groupBy("class").agg(
        F.sum(F.col("pos") * (F.col("neg_le") - F.col("neg") + F.col("neg") / 2.0)).alias("_u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))


def _mann_whitney_shared(df: DataFrame, actual: str, score: str, classes: Sequence[str] | None) -> DataFrame:
    """The same for one score shared by all classes, without a row for each class and score.

    One running total of all rows over the scores, and one of each class's own
    rows where they occur: negatives up to a score = all up to it - own up to it.
    """
    y = _q(actual).cast("string")
    pos = (df.where(_q(score).isNotNull() & y.isNotNull())
             .groupBy(y.alias("class"), _q(score).cast("double").alias("score")).agg(F.count(F.lit(1)).alias("pos")))
    pos = running_sum(pos, ["score"], "pos", by=["class"], out="pos_le")
    every = running_sum(pos.groupBy("score").agg(F.sum("pos").alias("all")), ["score"], "all", out="all_le")
    total = every.agg(F.max("all_le")).head()[0] or 0
    own = pos if classes is None else pos.where(F.col("class").isin(list(classes)))
    below = (F.col("all_le") - F.col("all")) - (F.col("pos_le") - F.col("pos"))
    per = own.join(every, "score").groupBy("class").agg(
        F.sum(F.col("pos") * (below + (F.col("all") - F.col("pos")) / 2.0)).alias("_u"), F.sum("pos").alias("P"))
    return per.select("class", "_u", "P", (F.lit(total) - F.col("P")).alias("N"))


def auc_ovr(df: DataFrame, actual: str, score, classes: Sequence[str] | None = None) -> DataFrame:
    """AUC per class (one-vs-rest, Mann-Whitney with half credit for ties) + macro average.

    AUC = sum over scores of pos(s) * (neg below s + neg(s) / 2) / (P * N).
    A class without negatives gets NULL (undefined) and is left out of the
    macro average; one without positives has no row. `score` as in
    `roc_points`; with one probability column per class this is the
    multi-class one-vs-rest macro AUC.
    """
    per = _mann_whitney(_class_score_counts(df, actual, score)) if isinstance(score, dict) else _mann_whitney_shared(df, actual, score, classes)
    per = per.select("class", F.try_divide(F.col("_u"), F.col("P") * F.col("N")).alias("auc"))
    macro = per.agg(F.lit("macro").alias("class"), F.avg("auc").alias("auc"))
    return per.unionByName(macro)
