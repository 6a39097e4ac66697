"""Secret scan: pattern matches, and a battery of randomness tests under length-aware false-discovery control.

*Base.* Three kinds by pattern: ``assign`` (a secret-like name, a separator, a value of 6 or more
characters), ``access`` (access key ids) and ``hex`` (runs of 24 or more lower-case hexadecimal digits); all leftmost
non-overlapping matches of each pattern, those that fail the length test dropped.

*Battery.* Candidates are runs of 16 or more characters of the base64 alphabets that hold a letter and a digit. The encoding
is inferred as the smallest of the alphabets that holds all characters (hexadecimal, base32, lower case and digits, alphanumeric,
base64). Three statistics measure how far a run is from uniform random characters of that alphabet: chi-squared of
the character counts, the runs test of codes above and below the alphabet's middle, and the lag-1 serial correlation of the codes,
each as a standard score; the largest is the run's *distance*.

*Control.* The null is ordinary text, by one model at every table size (``modelled``): a candidate's p-value is the chance that ordinary
text of its own length and encoding comes as close to random. The model's letter frequencies are fixed values, so neither copies, other
documents nor the table's size move a p-value. Short candidates, which ordinary text imitates well, thus need to be much closer to random
than long ones. Benjamini-Hochberg at ``ALPHA`` over the distinct candidates of the whole table decides; copies count once. Its
histogram has a fixed size (lengths x encodings x cells) and covers every document; only it reaches the driver. Accepted candidates that
overlap no base span are added as ``random``.

Everything is DataFrame functions. Defined results: null or empty text has no spans; repeated rows are scanned each; an empty
table gives an empty result; texts of any length are scanned whole (places are code points, end exclusive).
Extra columns are left behind by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import id_text
from carepulse.llm.spans import find_spans, let

#: The base patterns (Java), kind by kind in the order of the output.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the maximal run decides, so a run of 20 or more is the same as this
HEX = r"[0-9a-f]{24,}"  # likewise
ASSIGN_GATE = r"(?i)password|passwd|secret|token|api_?key"
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
CELLS, CELL = 400, 0.05
ALPHA = 0.01
#: Lengths are told apart from SHORTEST on; LONGEST and longer are one.
SHORTEST, LONGEST = 16, 128
#: Ordinary text of the modelled null: letters by English frequency (a to z); capitals among letters as
#: measured once on a sample of 10,000 documents (2.96 %); digits and separators as in names and paths that hold a digit.
LETTERS = (.0817, .0149, .0278, .0425, .1270, .0223, .0202, .0609, .0697, .0015, .0077, .0403, .0241, .0675, .0751, .0193, .0010, .0599, .0633, .0906, .0276, .0098, .0236, .0015, .0197, .0007)
CAPITALS, DIGITS, SEPARATORS = 0.03, 0.1, 0.05

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Inferred encodings, smallest first: pattern of the whole run and the alphabet in code order.
ENCODINGS = (
    (r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    (r"^[a-z]+$", _LOWER),
    (r"^[A-Z]+$", _UPPER),
    (r"^[A-Z2-7]+$", _UPPER + "234567"),
    (r"^[a-z0-9]+$", _LOWER + _DIGITS),
    (r"^[A-Z0-9]+$", _UPPER + _DIGITS),
    (r"^[A-Za-z]+$", _UPPER + _LOWER),
    (r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    (r"^", _UPPER + _LOWER + _DIGITS + "+/"),
)


def _core(value: Column) -> Column:
    """A run as it is tested: padding dropped, the URL-safe marks as their base64 fellows."""
    return F.translate(F.regexp_replace(value, "=+", ""), "-_", "+/")


def distance(value: Column) -> Column:
    """How far a run of characters is from uniform random ones of its encoding: the largest of three standard scores."""
    def tested(core: Column) -> Column:
        out = F.lit(None).cast("double")
        for pattern, alphabet in reversed(ENCODINGS):
            out = F.when(core.rlike(pattern), _battery(core, F.length(core).cast("double"), alphabet)).otherwise(out)
        return out

    return let(_core(value), tested)


def _battery(core: Column, n: Column, alphabet: str) -> Column:
    m = len(alphabet)
    characters = F.array_distinct(F.split(core, ""))
    counts = F.transform(characters, lambda c: n - F.length(F.replace(core, c, F.lit(""))))
    squares = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c * c)
    chi = (squares * m / n - n - (m - 1)) / (2.0 * (m - 1)) ** 0.5
    bits = F.translate(core, alphabet, "0" * (m // 2) + "1" * (m - m // 2))
    ones = n - F.length(F.replace(bits, F.lit("1"), F.lit("")))
    changes = F.regexp_count(bits, F.lit("01")) + F.regexp_count(bits, F.lit("10"))
    mean = ones * (n - ones) * 2 / n
    spread = F.sqrt(F.greatest(mean * (mean - 1) / (n - 1), F.lit(1e-9)))
    runs = F.when(mean > 1, F.abs(changes - mean) / spread).otherwise(F.sqrt(n))

    def serial(codes: Column) -> Column:
        return let(F.aggregate(codes, F.lit(0.0), lambda s, x: s + x) / n, lambda mu: let(
            F.transform(codes, lambda x: x - mu), lambda d: let(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x), lambda var: F.when(
                var > 0, F.abs(F.aggregate(F.zip_with(F.slice(d, F.lit(1), F.size(d) - 1), F.slice(d, F.lit(2), F.size(d) - 1), lambda x, y: x * y),
                                           F.lit(0.0), lambda s, x: s + x) / var) * F.sqrt(n)).otherwise(F.sqrt(n)))))

    codes = F.transform(F.split(core, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double"))
    return F.when(n >= 2, F.greatest(chi, runs, let(codes, serial)))


def _cell(value: Column) -> Column:
    return F.least(F.greatest(F.ceil(distance(value) / CELL), F.lit(0)), F.lit(CELLS)).cast("int")


def _is_candidate(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(_core(value)) >= SHORTEST)


def _size(value: Column) -> Column:
    return F.least(F.greatest(F.length(_core(value)), F.lit(SHORTEST)), F.lit(LONGEST)) - SHORTEST


def _encoding(value: Column) -> Column:
    def found(core: Column) -> Column:
        out = F.lit(len(ENCODINGS) - 1)
        for k, (pattern, _) in reversed(list(enumerate(ENCODINGS))[:-1]):
            out = F.when(core.rlike(pattern), F.lit(k)).otherwise(out)
        return out

    return let(_core(value), found)


def _gamma(shape: float, x: float) -> float:
    """The distribution function of a gamma variable of scale 1 (series of the incomplete gamma function)."""
    if x <= 0:
        return 0.0
    term = total = 1.0 / shape
    k = shape
    while term > total * 1e-12:
        k += 1
        term *= x / k
        total += term
    return min(1.0, total * math.exp(shape * math.log(x) - x - math.lgamma(shape)))


def _ordinary(alphabet: str) -> list[float]:
    """The chances of an alphabet's characters in ordinary text."""
    def weight(c: str) -> float:
        if c in _LOWER:
            return LETTERS[ord(c) - 97] * (1 - CAPITALS if set(_UPPER) & set(alphabet) else 1)
        if c in _UPPER:
            return LETTERS[ord(c) - 65] * (CAPITALS if set(_LOWER) & set(alphabet) else 1)
        return DIGITS / 10 if c in _DIGITS else SEPARATORS / 2

    weights = [weight(c) for c in alphabet]
    return [w / sum(weights) for w in weights]


@lru_cache(None)
def modelled(n: int, encoding: int, cell: int) -> float:
    """The chance that ordinary text of n characters of an encoding comes as close to random as a cell.

    The chi-squared statistic is that of the number of equal character pairs, gamma distributed with its exact mean and variance for
    characters drawn as in ordinary text; the other two are standard normal for any text without order, which is the closest text can come.
    """
    alphabet = ENCODINGS[encoding][1]
    m, q, d = len(alphabet), _ordinary(alphabet), cell * CELL
    second, third = sum(x ** 2 for x in q), sum(x ** 3 for x in q)
    mean = n * (n - 1) / 2 * second
    variance = n * (n - 1) / 2 * (second - second ** 2) + n * (n - 1) * (n - 2) * (third - second ** 2)
    equal = (((d * (2.0 * (m - 1)) ** 0.5 + m - 1 + n) * n / m) - n) / 2
    return _gamma(mean ** 2 / variance, equal * mean / variance) * math.erf(d / 2 ** 0.5) ** 2


def thresholds(docs: DataFrame, alpha: float = ALPHA) -> list[int]:
    """The last accepted distance cell (-1: none) of each length and encoding (``_slot``), from the whole corpus."""
    runs = docs.select(F.explode(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).alias("v")).where(_is_candidate(F.col("v")))
    counted = (runs.distinct().select(_size(F.col("v")).alias("size"), _encoding(F.col("v")).alias("encoding"), _cell(F.col("v")).alias("cell"))
               .groupBy("size", "encoding", "cell").agg(F.count(F.lit(1)).alias("candidates")).collect())
    return decided([(r["size"], r.encoding, r.cell, r.candidates) for r in counted if r.cell is not None], alpha)


def decided(counted: list[tuple[int, int, int, int]], alpha: float) -> list[int]:
    """The last accepted cells by ``_slot``, of (size, encoding, cell, candidates) rows: Benjamini-Hochberg over all of them."""
    out = [-1] * (LONGEST - SHORTEST + 1) * len(ENCODINGS)
    chance = lambda size, encoding, cell: modelled(size + SHORTEST, encoding, cell)
    tests = sum(row[3] for row in counted)
    found, limit = 0, -1.0
    for p, n in sorted((chance(*row[:3]), row[3]) for row in counted if row[2] < CELLS):  # the last cell is open and never accepted
        found += n
        if p * tests <= alpha * found:
            limit = p
    for size, encoding in {row[:2] for row in counted}:
        out[_place(size, encoding)] = max((cell for cell in range(CELLS) if chance(size, encoding, cell) <= limit), default=-1)
    return out


def _place(size, encoding):
    return size * len(ENCODINGS) + encoding


def _slot(value: Column) -> Column:
    return _place(_size(value), _encoding(value))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))


def base_spans(text: Column) -> Column:
    """array<struct<start, order, end, kind, value>> of the pattern matches, by start, then kind."""
    assign = F.filter(find_spans(text, ASSIGN, text.rlike(ASSIGN_GATE)), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6)
    access = find_spans(text, ACCESS, text.contains("AKIA"))
    return F.array_sort(F.concat(_of_kind(assign, "assign"), _of_kind(access, "access"), _of_kind(find_spans(text, HEX), "hex")))


def random_spans(text: Column, limits: list[int]) -> Column:
    accepted = F.array(*[F.lit(x) for x in limits])
    runs = F.filter(find_spans(text, CANDIDATE, text.rlike(r"[0-9][A-Za-z+/_=-]|[A-Za-z+/_=-][0-9]")), lambda s: _is_candidate(s["value"]))
    near = F.filter(runs, lambda s: _cell(s["value"]) <= F.element_at(accepted, _slot(s["value"]) + 1))
    return _of_kind(near, "random")


def scan(docs: DataFrame, alpha: float = ALPHA, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base and spans, both array<struct<start, order, end, kind, value>> by start, then kind."""
    rows = id_text(docs, id_col, text_col)
    text = F.col("text")
    found = rows.select("doc_id", base_spans(text).alias("base"), random_spans(text, thresholds(rows, alpha)).alias("more"))
    return found.select("doc_id", "base", _together(F.col("base"), F.col("more")).alias("spans"))


def _together(base: Column, more: Column) -> Column:
    free = F.filter(more, lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return F.array_sort(F.concat(base, free))


def redact(docs: DataFrame, mark: str = "[SECRET]", alpha: float = ALPHA) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark`` and ``n_chars`` counted anew; texts without spans stay."""
    rows = id_text(docs)
    limits = thresholds(rows, alpha)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    a, b, spans = (f"{x}_{uuid.uuid4().hex}" for x in ("base", "more", "spans"))
    found = docs.withColumn(a, base_spans(text)).withColumn(b, random_spans(text, limits)).withColumn(spans, _together(F.col(a), F.col(b)))
    # overlapping spans are cut together: what lies between the furthest end so far and the next start is kept
    pieces = F.aggregate(F.col(spans), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("all")), lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.when(x["start"] >= s["at"], F.concat(s["all"], F.array(F.concat(F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark))))).otherwise(s["all"]).alias("all")),
        lambda s: F.concat(F.array_join(s["all"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    masked = F.when(F.size(spans) > 0, pieces).otherwise(F.col("text"))
    out = found.withColumn("text", masked)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
