"""Data-quality checks: domain validation (P23) and column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.functions.encode import coerce_double
from carepulse.schemas import quote


def violations_expr(allowed: Mapping[str, Sequence] | None = None,
                    ranges: Mapping[str, tuple] | None = None):
    """ARRAY<STRING> of the rules a row breaks, sorted: `col:domain`, `col:range`.

    NULL values break no rule (missing data is handled by imputation). Range
    checks parse text as a number first, so `"12"` passes 1..30 and `"V57"`
    breaks it.
    """
    checks = []
    for c, values in (allowed or {}).items():
        col = F.col(quote(c))
        checks.append(F.when(col.isNotNull() & ~col.isin(list(values)), F.lit(f"{c}:domain")))
    for c, (lo, hi) in (ranges or {}).items():
        num = coerce_double(F.col(quote(c)).cast("string"))
        broke = F.col(quote(c)).isNotNull() & (num.isNull() | (num < F.lit(lo)) | (num > F.lit(hi)))
        checks.append(F.when(broke, F.lit(f"{c}:range")))
    if not checks:
        return F.array().cast("array<string>")
    return F.array_sort(F.array_compact(F.array(*checks)))


def validate_domain(df: DataFrame, allowed: Mapping[str, Sequence] | None = None,
                    ranges: Mapping[str, tuple] | None = None) -> DataFrame:
    """Add `violations` (sorted rule names) and `is_valid`."""
    v = violations_expr(allowed, ranges)
    return df.withColumn("violations", v).withColumn("is_valid", F.size("violations") == 0)


def column_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A15 + A4: one row per column: name, type, rows, non_null, distinct (exact).

    One scan: every row is unpivoted to (column, value-as-text) pairs and a
    single aggregation per column counts rows, non-NULL values and distinct
    values (Spark plans the distinct count as a (column, value) pre-aggregation,
    so a hot value is combined map-side before any shuffle).
    """
    cols = list(cols) if cols is not None else df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(quote(c)).cast("string").alias("v")) for c in cols])))
    stats = pairs.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("non_null"),
                                      F.count_distinct("v").alias("distinct"))
    kinds = df.sparkSession.createDataFrame([(c, types[c]) for c in cols], "name string, type string")
    return (kinds.join(F.broadcast(stats), "name", "left")  # one row per column on both sides
                 .select("name", "type", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
                         F.coalesce("non_null", F.lit(0)).cast("long").alias("non_null"),
                         F.coalesce("distinct", F.lit(0)).cast("long").alias("distinct")))


def validate_encounters(df: DataFrame, profile: str = "intake") -> DataFrame:
    """P23 with the two rule sets of the reference kept apart (they disagree on ranges).

    "intake": the submission form (allowed race / gender / age / admission /
    discharge / source / insulin values and the count ranges); "scoring": the
    numeric one-row profile (F7) ranges. Columns absent from `df` are skipped.
    """
    from carepulse import schemas as S
    if profile == "intake":
        allowed = {"race": S.RACE_VALUES, "gender": S.GENDER_VALUES, "age": S.AGE_VALUES,
                   "admission_type_id": S.ADMISSION_TYPE_VALUES,
                   "discharge_disposition_id": S.DISCHARGE_DISPOSITION_VALUES,
                   "admission_source_id": S.ADMISSION_SOURCE_VALUES, "insulin": S.INSULIN_VALUES}
        ranges = S.FORM_RANGES
    elif profile == "scoring":
        allowed, ranges = {}, S.PROFILE_RANGES
    else:
        raise ValueError("profile must be 'intake' or 'scoring'")
    present = set(df.columns)
    return validate_domain(df, {k: v for k, v in allowed.items() if k in present},
                           {k: v for k, v in ranges.items() if k in present})
