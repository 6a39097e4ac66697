"""Training-table cleaning: drop, dedupe, impute, label-encode, standardise, split.

All statistics are exact and distributed: a global ``median`` or ``mode``
aggregate would merge a value->count map of every distinct value inside one
task, so medians come from histogram refinement (operators.quantile: a few
scans returning fixed-size histograms) and modes from value counts reduced by
a global min.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepulse.operators.ordered import dense_index
from carepulse.operators.quantile import medians
from carepulse.functions.encode import in_pieces
from carepulse.schemas import NULL_MARKERS, UNMAPPED_TEXT_COLUMNS, quote


def _q(c: str):
    return F.col(quote(c))


# --- P19 -----------------------------------------------------------------
def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# --- P11 / P17 / W2 --------------------------------------------------------
def drop_target(df: DataFrame, target: str) -> DataFrame:
    return df.drop(target)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Remove rows in which every column is NULL."""
    return df.dropna(how="all")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row dedupe (partial aggregation per map task, then one shuffle)."""
    return df.distinct()


# --- shared: (name, value) long form ---------------------------------------
def _long(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), _q(c).cast(cast).alias("v")) for c in cols])
    return df.select(F.inline(pairs)).where(F.col("v").isNotNull())


# --- A1 median -------------------------------------------------------------
def _numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, v) DOUBLE long form without NULL and NaN (NaN is missing, as in pandas)."""
    long = _long(df, cols, "double")
    return long.where(~F.isnan("v"))


def column_median_values(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, tuple[float, int]]:
    """name -> (exact median, non-missing count); see operators.quantile (a few scans, no big shuffle)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return medians(_numbers(df, cols)) if cols else {}


def column_medians(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact (mean-of-middle-pair) median of each column: rows (name, median, n); one row per column."""
    vals = column_median_values(df, cols)
    return df.sparkSession.createDataFrame([(k, float(m), int(n)) for k, (m, n) in vals.items()],
                                           "name string, median double, n long")


def impute_median(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: fill missing values (NULL, and NaN in floating columns) of every numeric column with its exact median.

    Integral columns that receive a fractional median become DOUBLE (as a
    pandas column with NaN would) instead of silently truncating the median.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}

    def missing(c):
        m = _q(c).isNull()
        return m | F.isnan(_q(c)) if isinstance(types[c], T.FractionalType) else m

    # One cheap pass first: only columns with missing values need a median.
    counts = df.agg(*[F.count_if(missing(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    holed = [c for i, c in enumerate(cols) if counts[f"m{i}"] > 0]
    med = {k: v[0] for k, v in column_median_values(df, holed).items()} if holed else {}
    out = []
    for c in df.columns:
        if c in med and med[c] is not None:
            m = med[c]
            if isinstance(types[c], T.IntegralType) and float(m).is_integer():
                out.append(F.coalesce(_q(c), F.lit(int(m)).cast(types[c])).alias(c))
            else:
                out.append(F.when(missing(c), F.lit(float(m))).otherwise(_q(c).cast("double")).alias(c))
        else:
            out.append(_q(c))
    return df.select(*out)


# --- A2 mode ---------------------------------------------------------------
def column_modes(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Most frequent non-NULL value per column, smallest value on ties: rows (name, mode)."""
    cols = list(cols) if cols is not None else string_columns(df)
    counts = _long(df, cols, "string").groupBy("name", "v").agg(F.count(F.lit(1)).alias("w"))
    best = counts.groupBy("name").agg(F.min(F.struct((-F.col("w")).alias("nw"), F.col("v").alias("v"))).alias("b"))
    return best.select("name", F.col("b.v").alias("mode"))


def impute_mode(df: DataFrame, cols: Sequence[str] | None = None, all_null: str = "Unknown") -> DataFrame:
    """A2: fill NULLs of every string column with its mode; an all-NULL column gets `all_null`."""
    cols = list(cols) if cols is not None else string_columns(df)
    modes = {r["name"]: r["mode"] for r in column_modes(df, cols).collect()}  # one row per column
    fills = {c: modes.get(c) if modes.get(c) is not None else all_null for c in cols}
    return df.select(*[F.coalesce(_q(c), F.lit(fills[c])).alias(c) if c in fills else _q(c)
                       for c in df.columns])


# --- M1 label encoding -----------------------------------------------------
def label_dictionary(df: DataFrame, cols: Sequence[str], ignored: Sequence[str] = ()) -> DataFrame:
    """(name, v, code): sorted distinct strings of each column but the `ignored` ones -> 0..k-1."""
    if not cols:
        return dense_index(_long(df, cols, "string"), "v", by=["name"], out="code")
    long = df.select(F.posexplode(F.array(*[_q(c).cast("string") for c in cols])).alias("_place", "v")).where(F.col("v").isNotNull())
    if ignored:
        long = long.where(~F.col("v").isin(list(ignored)))
    names = F.array(*[F.lit(c) for c in cols])  # found for the distinct values only
    return dense_index(long.distinct().select(names[F.col("_place")].alias("name"), "v"), "v", by=["name"], out="code")


#: A column's dictionary of up to so many entries is a map, whose entries are searched one by one; a larger one is joined.
MAP_ENTRIES = 64
#: Joined dictionaries are broadcast up to so many entries together (about 100 bytes each); beyond, their columns' values are exchanged.
BROADCAST_ENTRIES = 1_000_000


def code_columns(df: DataFrame, cols: Sequence[str], dictionary: DataFrame, unseen: int | str | None = "keep",
                 markers: bool = True) -> DataFrame:
    """The codes (INT) of all `cols` in one pass over the rows, by a dictionary (name, v, code).

    `unseen` text: "keep" = one past the column's last code, NULL, or a fixed code. NULL (and, with `markers`, `?`) stays NULL. Columns
    with few texts (`MAP_ENTRIES`) find them in a constant map, others in a broadcast dictionary, so no row is exchanged; beyond
    `BROADCAST_ENTRIES` the values of those others are joined in long form, once for all, and folded back by row.
    """
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    src = df
    if markers:
        text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}.intersection(present)
        marked = [F.when(~_q(c).isin(NULL_MARKERS), _q(c)) if c in text else _q(c) for c in df.columns]
        src = df.select(*[x.alias(c) for c, x in zip(df.columns, in_pieces(marked))])
    own = dictionary.where(F.col("name").isin(present)).withColumn("v", F.col("v").cast("string"))
    sizes = {r["name"]: (int(r["n"]), int(r["last"])) for r in own.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max("code").alias("last")).collect()}  # one row per column

    def coded(c: str, code):
        if unseen is None:
            return code.cast("int")
        fallback = (sizes[c][1] + 1 if c in sizes else 0) if unseen == "keep" else int(unseen)
        return F.when(_q(c).isNotNull(), F.coalesce(code.cast("int"), F.lit(fallback)))

    large = [c for c in present if c in sizes and sizes[c][0] > MAP_ENTRIES]
    small = [c for c in present if c not in large]
    codes = {}
    if sum(sizes[c][0] for c in large) <= BROADCAST_ENTRIES or df.isStreaming:
        for i, c in enumerate(large):
            entries = own.where(F.col("name") == c).groupBy(F.col("v").alias(f"_v{i}")).agg(F.max("code").alias(f"_code{i}"))
            [key] = in_pieces([_q(c).cast("string")])  # nor is a join of rows with so many columns one method
            src = src.join(F.broadcast(entries), key == F.col(f"_v{i}"), "left")
            codes[c] = coded(c, F.col(f"_code{i}"))
    else:
        src = _coded_by_join(src, large, own, coded)
    texts = {c: [] for c in small}  # MAP_ENTRIES a column at most
    for r in own.where(F.col("name").isin(small)).select("name", "v", "code").collect() if sizes and small else []:
        texts[r["name"]] += [F.lit(r["v"]), F.lit(int(r["code"]))]
    for c, entries in texts.items():
        codes[c] = coded(c, F.try_element_at(F.create_map(*entries), _q(c).cast("string")) if entries else F.lit(None))
    return src.select(*[x.alias(c) for c, x in zip(df.columns, in_pieces(codes.get(c, _q(c)) for c in df.columns))])


def _coded_by_join(df: DataFrame, cols: list[str], dictionary: DataFrame, coded) -> DataFrame:
    """Distinct values find their codes, once for all columns; then the columns of a row, told apart by its own values, take them.

    The rows are numbered in a stored copy, so both sides of the fold see the same numbers.
    """
    from carepulse.session import new_scratch
    path = new_scratch(df.sparkSession, "coded")
    df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    long = rows.select("_row", F.inline(F.array(*[F.struct(F.lit(c).alias("name"), _q(c).cast("string").alias("v")) for c in cols]))).where(F.col("v").isNotNull())
    found = long.join(dictionary, ["name", "v"])  # a hot value is one entry: the skewed side is split, the dictionary's never large
    folded = found.groupBy("_row").agg(*[F.max(F.when(F.col("name") == c, F.col("code"))).alias(f"_code{i}") for i, c in enumerate(cols)])
    codes = {c: coded(c, F.col(f"_code{i}")).alias(c) for i, c in enumerate(cols)}
    return rows.join(folded, "_row", "left").select(*[codes.get(c, _q(c)) for c in df.columns])


def label_encode(df: DataFrame, cols: Sequence[str] | None = None, dictionary: DataFrame | None = None,
                 unseen: int | str | None = None) -> DataFrame:
    """M1: replace each string column by its dense alphabetical code (INT), all columns in one pass.

    The dictionary is built distributedly unless one is given. NULL stays
    NULL; a value absent from a given dictionary gets `unseen`: NULL (default),
    a fixed code, or "keep" = one past the column's last code (the number of
    labels the column was fitted on).
    """
    cols = list(cols) if cols is not None else string_columns(df)
    # a fitted dictionary is a checkpointed (or caller-owned) frame: re-reading it is cheap
    dic = dictionary if dictionary is not None else label_dictionary(df, cols)
    return code_columns(df, cols, dic, unseen, markers=False)


def text_code_dictionary(train: DataFrame, cols: Sequence[str] = UNMAPPED_TEXT_COLUMNS) -> DataFrame:
    """X1 fix: codes for the text columns that have no value map, fitted on the training split."""
    present = [c for c in cols if c in train.columns]
    return label_dictionary(train, present, ignored=NULL_MARKERS)


def apply_text_codes(df: DataFrame, dictionary: DataFrame,
                     cols: Sequence[str] = UNMAPPED_TEXT_COLUMNS) -> DataFrame:
    """X1 fix: unmapped text -> its training code (unseen -> one past the last code) before `encode_features`.

    The codes are numbers, so `encode_features` takes them as they are instead
    of coercing the text to NULL -> 0 (the reference's serving behaviour,
    still the default when this step is skipped). `?` is a NULL marker first.
    """
    return code_columns(df, cols, dictionary)


# --- M5 standardisation ----------------------------------------------------
def standardize(df: DataFrame, cols: Sequence[str], keep: Iterable[str] = (),
                stats: dict | None = None) -> DataFrame:
    """M5: (x - mean) / population std; zero variance -> 0. Stats from one global aggregate."""
    if stats is None:
        row = df.agg(*[F.avg(_q(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(_q(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        stats = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}
    out = [_q(k) for k in keep]
    for c in cols:
        mean, std = stats[c]
        if std is None or std == 0:
            out.append(F.when(_q(c).isNull(), None).otherwise(F.lit(0.0)).alias(c))
        else:
            out.append(((_q(c) - F.lit(mean)) / F.lit(std)).alias(c))
    return df.select(*out)


# --- M2 split --------------------------------------------------------------
def hash_bucket(key_col: str, buckets: int = 10):
    """Stable bucket of a key: first 32 bits of md5(text) mod `buckets`."""
    h = F.conv(F.substring(F.md5(_q(key_col).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(buckets))


def train_test_split(df: DataFrame, key_col: str, train_fraction_tenths: int = 7,
                     out: str = "split") -> DataFrame:
    """M2: deterministic 70/30 split by key hash; independent of partitioning and engine."""
    return df.withColumn(out, F.when(hash_bucket(key_col) < train_fraction_tenths, F.lit("train"))
                             .otherwise(F.lit("test")))
