"""Record-level helpers: defaulting, labels, number formatting, row <-> text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.schemas import (
    ENCOUNTER_COLUMNS, HIGH_RISK_CLASS, NOT_READMITTED_LABEL, READMITTED_LABEL,
    RECORD_DEFAULTS, quote,
)


def default_fields(df: DataFrame, columns: Iterable[str] = ENCOUNTER_COLUMNS,
                   defaults: Mapping[str, str] = RECORD_DEFAULTS,
                   id_columns: Iterable[str] = ("encounter_id", "patient_nbr"),
                   sequence: Iterable[str] = ()) -> DataFrame:
    """Complete partial submissions to the full record.

    Present columns keep their value and fall back to the default when NULL;
    absent columns become the default (or NULL when there is none). A missing
    id is a LONG (as text, like every field) hashed from the column's name, the
    `sequence` columns (what tells equal submissions apart: partition and
    offset of a topic, a line number) and the record's content, never the wall
    clock: a replayed record gets the same id again, so idempotent sinks stay
    idempotent, and the two ids of one record differ. `sequence` columns that
    are no record fields are not returned.
    """
    seq = list(sequence)
    present = [c for c in df.columns if c not in seq or c in set(columns)]
    ids = set(id_columns)
    content = [F.col(quote(c)) for c in [*seq, *present]]
    out = []
    for c in columns:
        base = F.col(quote(c)).cast("string") if c in present else F.lit(None).cast("string")
        if c in defaults:
            base = F.coalesce(base, F.lit(defaults[c]))
        elif c in ids:
            base = F.coalesce(base, F.shiftrightunsigned(F.xxhash64(F.lit(c), *content), 1).cast("string"))
        out.append(base.alias(c))
    return df.select(*out)


def predict_label(col: Column, high_risk: int = HIGH_RISK_CLASS) -> Column:
    """Class code -> display text (NULL code -> NOT_READMITTED_LABEL, as `!= 1`)."""
    return F.when(col == F.lit(high_risk), F.lit(READMITTED_LABEL)).otherwise(F.lit(NOT_READMITTED_LABEL))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a name bound by a lambda is never inlined)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def format_pct(col: Column, decimals: int = 2) -> Column:
    """Number -> '12.35%' text; NULL stays NULL.

    The number's exact binary value is rounded, exact halves to the even digit
    (0.125 -> 0.12%, 2.675, which is a little less, -> 2.67%), as a format
    string does outside the JVM. The JVM's own format string differs only next
    to a half, so numbers near one are rounded here without error: the fraction
    is split into two parts whose products with the scale are exact. From 2**63
    on, where no double has a fraction, the JVM's digits stand.
    """
    scale = 10 ** int(decimals)

    def exact(x: Column) -> Column:
        return _let(F.struct(F.floor(x).alias("whole"), (x - F.floor(x)).alias("part")),
                    lambda n: _let(n["part"] * 134217729.0 - (n["part"] * 134217729.0 - n["part"]),
                                   lambda high: rounded(n["whole"], high, n["part"] - high)))

    def rounded(whole: Column, high: Column, low: Column) -> Column:
        def past_half(k: Column) -> Column:  # sign: the fraction against (k + 1/2) / scale
            return (high * (2 * scale) - (2 * k + 1)) + low * (2 * scale)

        def nearest(k: Column) -> Column:
            odd = (whole + k) % 2 == 1 if decimals == 0 else k % 2 == 1
            return F.when((past_half(k) > 0) | ((past_half(k) == 0) & odd), k + 1).otherwise(k)

        floor = F.floor((high + low) * scale)
        return _let(F.when(past_half(floor - 1) < 0, floor - 1).otherwise(floor), lambda k: _let(nearest(k), lambda up: text(whole, up)))

    def text(whole: Column, k: Column) -> Column:
        units = F.when(k == scale, whole + 1).otherwise(whole).cast("string")
        return units if decimals == 0 else F.concat(units, F.lit("."), F.lpad((k % scale).cast("string"), int(decimals), "0"))

    x = F.abs(col)
    near = (F.abs(x * scale - F.floor(x * scale) - 0.5) < x * scale * 2.0 ** -50 + 1e-9) | (x >= 2.0 ** 40)
    sign = F.when(col < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(near & (x < 2.0 ** 63), F.concat(sign, exact(x), F.lit("%"))).when(col.isNotNull(), F.format_string(f"%.{int(decimals)}f%%", col))


def row_to_csv(df: DataFrame, cols: Iterable[str] | None = None, alias: str = "line") -> DataFrame:
    """P20: each row as one RFC-4180 CSV line (commas inside values are quoted)."""
    names = list(cols) if cols is not None else df.columns
    return df.select(F.to_csv(F.struct(*[F.col(quote(c)) for c in names])).alias(alias))


def row_to_json(df: DataFrame, cols: Iterable[str] | None = None, alias: str = "value") -> DataFrame:
    """P20 / K9: each row as one JSON object text, the Kafka `value` shape."""
    names = list(cols) if cols is not None else df.columns
    return df.select(F.to_json(F.struct(*[F.col(quote(c)) for c in names])).alias(alias))
