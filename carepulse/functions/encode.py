"""Column-level cleaning and encoding (P3-P12): one select, all JVM-side.

Everything here returns Column expressions or a single ``select`` over the
input, so Catalyst keeps the whole encoder inside one whole-stage-codegen span
and pushes it into whatever scan or stream sits below.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, NumericType

from carepulse.schemas import FEATURE_COLUMNS, NULL_MARKERS, VALUE_MAPS, quote


def _c(name: str) -> Column:
    return F.col(quote(name))


def in_pieces(columns: Iterable[Column]) -> list[Column]:
    """The same columns, for one projection of many: a lambda keeps it out of the stage's one generated method, which would be too long
    for the JVM to compile, so that it's generated in pieces."""
    first, *others = columns
    return [F.transform(F.array(first), lambda x: x)[0], *others]


# --- P3 null markers -------------------------------------------------------
def null_marker_expr(col: Column, markers: Iterable[str] = NULL_MARKERS) -> Column:
    """`?` (and any other marker) -> NULL; other values unchanged."""
    out = col
    for m in markers:
        out = F.nullif(out, F.lit(m))
    return out


def replace_null_markers(df: DataFrame, cols: Iterable[str] | None = None,
                         markers: Iterable[str] = NULL_MARKERS) -> DataFrame:
    """Replace marker text by NULL in `cols` (default: every string column)."""
    string_cols = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    target = set(cols) if cols is not None else string_cols
    return df.select(*[
        null_marker_expr(_c(f.name), markers).alias(f.name)
        if f.name in target and f.name in string_cols else _c(f.name)
        for f in df.schema.fields
    ])


# --- P4 value -> code maps -------------------------------------------------
def value_map_expr(col: Column, mapping: Mapping[str, int], default: int) -> Column:
    """Map text to a code; unknown text and NULL both give `default`."""
    lits = []
    for k, v in mapping.items():
        lits += [F.lit(k), F.lit(int(v))]
    return F.coalesce(F.try_element_at(F.create_map(*lits), col), F.lit(int(default)))


def apply_value_maps(df: DataFrame, maps: Mapping[str, tuple[Mapping[str, int], int]] = VALUE_MAPS,
                     insulin: bool = True) -> DataFrame:
    """P4 over a frame: every mapped column present in `df` becomes its INT code.

    ``insulin=False`` reproduces the landing-file batch job, which has no insulin
    map and therefore always scores insulin as 0.
    """
    out = []
    for f in df.schema.fields:
        if f.name in maps and (insulin or f.name != "insulin"):
            mapping, default = maps[f.name]
            out.append(value_map_expr(_c(f.name), mapping, default).alias(f.name))
        else:
            out.append(_c(f.name))
    return df.select(*out)


# --- P5 / P6 coercion ------------------------------------------------------
# The JVM parser also takes `NaN`, `Infinity`, `250d`, `1f`, `0x1p3` (letters below) and trims control characters; with a `?` it takes none of them.
_NOT_DECIMAL = r"[dDfFxXnN\x00-\x08\x0E-\x1F]"


def coerce_double(col: Column) -> Column:
    """Text -> finite DOUBLE, anything else -> NULL (`250.83` stays 250.83, `V57`, `250d`, `NaN`, `Infinity` -> NULL).

    Every step names the one before once (`nullif` binds it), so a derived column isn't computed again; only numbers
    beyond the largest double are infinite by then.
    """
    return F.nullif(F.nullif(_parsed(col), F.lit(float("inf"))), F.lit(float("-inf")))


def _parsed(col: Column) -> Column:
    return F.regexp_replace(col, _NOT_DECIMAL, "?").try_cast("double")


def coerce_int(col: Column) -> Column:
    """P5: text -> INT with decimals truncated (`250.83` -> 250), unparsable -> NULL.

    A plain cast raises under ANSI and `try_cast('250.83' as int)` is NULL, so
    parse as DOUBLE first and truncate; out-of-range values become NULL.
    """
    return _parsed(col).try_cast("int")


_NUMBERS = "_coerced_numbers"
#: The texts that `_parsed` takes: other ones cost the JVM's parser an exception each.
_DECIMAL = r"\A[\t-\r ]*+[+-]?+(?:[0-9]++\.?+[0-9]*+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+[\t-\r ]*+\z"


def _coerced(cols: list[str], numeric: str) -> Column:
    """The texts of `cols`, coerced as by `coerce_double` or `coerce_int`, as one array."""
    parsed = F.transform(F.array(*[_c(c).cast("string") for c in cols]), lambda x: F.when(x.rlike(_DECIMAL), x.try_cast("double")))
    if numeric == "int":
        return F.transform(parsed, lambda x: x.try_cast("int"))
    return F.transform(parsed, lambda x: F.when(F.abs(x) < float("inf"), x))


# --- P8 / P9 / P10 feature alignment ---------------------------------------
def align_features(df: DataFrame, features: Iterable[str], fill: float = 0.0,
                   keep: Iterable[str] = ()) -> DataFrame:
    """P8+P9: ordered projection of `features`; absent ones become constant `fill`."""
    present = set(df.columns)
    cols = [_c(k) for k in keep]
    for name in features:
        cols.append(_c(name) if name in present else F.lit(fill).alias(name))
    return df.select(*cols)


def intersect_features(df: DataFrame, features: Iterable[str]) -> list[str]:
    """P10: the features that the frame actually carries, in feature order."""
    present = set(df.columns)
    return [c for c in features if c in present]


# --- the one encoder used by training and serving -------------------------
def encode_features(df: DataFrame, features: list[str] = FEATURE_COLUMNS, *,
                    insulin: bool = True, numeric: str = "double",
                    keep: Iterable[str] = (), fill: float = 0.0) -> DataFrame:
    """P3 -> P4 -> P8/P9 -> P5|P6 -> P7 in a single projection.

    Returns `keep` columns (untouched) followed by the `features`, each a
    finite non-null number of type `numeric` ("double" or "int"). Text columns go
    through the markers, maps and coercion; columns that already arrive as
    numbers (a numeric profile, a typed vitals record) are taken as they are,
    so a numeric age is an age, not an unknown bucket.
    """
    if numeric not in ("double", "int"):
        raise ValueError("numeric must be 'double' or 'int'")
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in features if c in types and not isinstance(types[c], NumericType) and not (c in VALUE_MAPS and (insulin or c != "insulin"))]
    # All texts are coerced as one array: a projection with a lambda isn't inlined into the stage's one generated method, which would
    # be too long for the JVM to compile at 49 columns, but generated in pieces.
    df = df.select("*", _coerced(text, numeric).alias(_NUMBERS)) if text else df
    empty = F.lit(float(fill) if numeric == "double" else int(fill))  # typed: a cast for each column makes the generated code too long to compile
    out = [_c(k) for k in keep]
    for name in features:
        if name not in types:
            e = empty
        elif isinstance(types[name], NumericType):
            own = _c(name)
            if isinstance(types[name], FractionalType):  # NaN and the infinities are missing numbers
                own = F.when(F.abs(own) < float("inf"), own)
            e = F.coalesce(own.cast(numeric), empty)
        elif name in VALUE_MAPS and (insulin or name != "insulin"):
            mapping, default = VALUE_MAPS[name]
            e = value_map_expr(_c(name), mapping, default).cast(numeric)  # a null marker is no key: the default
        else:
            e = F.coalesce(F.col(_NUMBERS)[text.index(name)], empty)  # and no finite number: NULL
        out.append(e.alias(name))
    return df.select(*out)


def cast_all_string(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[_c(c).cast("string").alias(c) for c in df.columns])


def fill_zero(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NULL -> 0 in numeric columns (`cols` or all)."""
    return df.fillna(0, subset=list(cols) if cols is not None else None)
