"""Places of regular-expression matches in DataFrame functions: all leftmost non-overlapping matches of a pattern.

Spark's ``regexp_extract_all`` gives the matches and ``split`` what lies between them; running sums of their
lengths give the places, in code points. Sums are taken in blocks, so a text with very many matches stays
near linear.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
SPAN = "array<struct<start:int,end:int,value:string>>"
NEAR = 40
SPAN_NEAR = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a name bound by a lambda is never inlined)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def find_spans(text: Column, pattern: str, gate: Column | None = None, near: bool = False) -> Column:
    """array<struct<start, end, value>> of the matches of a Java pattern whose matches are never empty.

    ``gate``: a cheaper test that every text with a match passes. ``near``: with up to NEAR characters before and
    after each match, as far as the neighbouring matches.
    """
    kind = SPAN_NEAR if near else SPAN

    def placed(matches: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda gaps: let(F.zip_with(
            F.transform(F.slice(gaps, F.lit(1), F.size(matches)), lambda g, i: F.struct(g.alias("g"), F.get(gaps, i + 1).alias("next"))), matches,
            lambda g, m: F.struct(F.length(g["g"]).alias("g"), F.length(m).alias("m"), m.alias("value"), *(
                [F.right(g["g"], F.lit(NEAR)).alias("before"), F.left(g["next"], F.lit(NEAR)).alias("after")] if near else []))), cut))

    def cut(lengths: Column) -> Column:
        last = F.floor((F.size(lengths) - 1) / BLOCK).cast("int")
        return let(F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))), joined)

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda own: F.aggregate(own, F.lit(0), lambda s, x: s + x["g"] + x["m"]))
        starts = F.aggregate(totals, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
                             lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")))["all"]
        return F.flatten(F.zip_with(blocks, starts, within))

    def within(own: Column, at: Column) -> Column:
        return F.aggregate(own, F.struct(at.alias("at"), F.array().cast(kind).alias("all")), lambda s, x: F.struct(
            (s["at"] + x["g"] + x["m"]).alias("at"), F.concat(s["all"], F.array(F.struct(
                (s["at"] + x["g"]).alias("start"), (s["at"] + x["g"] + x["m"]).alias("end"), x["value"].alias("value"),
                *([x["before"].alias("before"), x["after"].alias("after")] if near else [])))).alias("all")))["all"]

    has = text.rlike(pattern) if gate is None else gate & text.rlike(pattern)
    return F.when(has, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(F.array().cast(kind))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
