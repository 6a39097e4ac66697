"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

1. *Paragraphs* are the lines of a text, and windows of consecutive lines for notices that are wrapped: around each line that holds one of
   the ``STEMS``, from that line or ``BEFORE`` words before it, up to each number of words in ``WINDOWS`` (the last holds every template), as far
   as the next line without words. Only a paragraph that holds a stem can have a feature of the classifier (every
   n-gram in its vocabulary holds one), so others are unknown by construction and never leave the scan; nor do windows with
   less than two word pairs of the templates. Comment marks hold no words.
2. *Classifier*: sparse counts of word 1- to 3-grams that hold a stem, and a multinomial logistic regression over the licence
   families and ``unknown``. It is fitted on ``TEMPLATES``, the hand-written ``OTHERS``, and a bounded sample of ``SAMPLE`` distinct corpus
   lines that hold a stem and little of any template as further unknowns.
3. *Calibration*: a second model is fitted without every third template; the temperature that gives the held-out paragraphs the
   least log loss divides the scores before the softmax. A paragraph is unknown when that has the largest probability or the
   best family has less than ``CONFIDENT``.
4. *Confirmation*: the share of a template's word pairs that the paragraph holds must reach ``COVERED`` for the best template of the predicted family
   (two ``VERSIONS`` of one licence, whose features are much the same, count as one family up to here, then as the one that is held more). Of lines and windows of a family that
   overlap, the one that holds most stays, of those the shortest.

DataFrame functions and Spark ML only; the models are broadcast by Spark ML and are bounded by the template table.
Defined results: null and empty texts have no paragraphs; repeated paragraphs and rows are reported each (rows told apart by place, for the grouping of what was found); an empty table gives an empty
result; a paragraph of any length is read whole. Extra columns are left behind.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.llm.common import id_text, literal_table
from carepulse.llm.spans import let

UNKNOWN = "unknown"
SAMPLE = 200
CONFIDENT, COVERED = 0.5, 0.6
L2, MAX_STEPS = 0.001, 40
#: Words of the windows of lines, and words that a notice may have before its first stem.
WINDOWS, BEFORE = (15, 30, 50), 16
#: Unknown corpus lines hold less than this share of each template, and have less than this share of their own word pairs from them.
FOREIGN = 0.3
VERSIONS = ("gpl-2.0", "gpl-3.0")
_WORD = r"[\p{L}\p{N}]+"

#: What every feature holds one of (beginnings of words).
STEMS = ("licen", "copyright", "permission", "warrant", "apache", "gnu", "mozilla", "creative", "cc", "spdx", "redistribut", "reserved", "unlicense", "domain", "bsd", "mit", "gpl", "lgpl", "mpl", "agpl")
_GATE = r"(?i)\b(?:" + "|".join(STEMS) + ")"

#: Licence families and notices of them, in the usual wordings.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the MIT License."),
    ("mit", "Licensed under the MIT license. See LICENSE for details."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache-2.0", "Released under the Apache License 2.0."),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, without warranties or conditions of any kind."),
    ("bsd", "Released under the BSD License."),
    ("bsd", "Licensed under the BSD 3-Clause License."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("bsd", "This software is distributed under the terms of the BSD license."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "Released under the GNU General Public License v3.0."),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("gpl-3.0", "This program is free software: you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-2.0", "Released under the GNU General Public License v2.0."),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("gpl-2.0", "This program is free software; you can redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 3."),
    ("lgpl", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License."),
    ("lgpl", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3.0", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl-2.0", "Licensed under the Mozilla Public License 2.0."),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "Licensed under CC0 1.0 Universal. To the extent possible under law, the author has waived all copyright."),
    ("cc0", "This work is dedicated to the public domain under CC0 1.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("unlicense", "Released under the Unlicense."),
    ("proprietary", "Copyright 2020 Example Company. All rights reserved."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without prior written permission."),
]

#: Paragraphs that hold a stem and name no licence.
OTHERS = [
    "He lost his driving licence after the accident.", "The licence plate of the car could not be read.", "You need a fishing licence to fish here.",
    "The city council granted the restaurant a licence to serve wine.", "She asked her parents for permission to travel.", "File permissions are set by the administrator.",
    "The seller gives a two year warranty on all parts.", "The police had a search warrant.", "The Apache helicopter landed at the base.", "Gnus migrate over the plain in June.",
    "A creative solution was found by the pupils.", "The domain of the function is the set of real numbers.", "Copyright law was reformed in that year.", "The tables at the window are reserved.",
    "The wealth was redistributed by the new tax.", "MIT is a university in Massachusetts.", "Please send a copy (cc) to the office.", "A licensed electrician must check the wiring.",
    "Mozilla published a new browser today.", "The domain name has expired.",
]


def words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _joined(ws: Column, n: int) -> Column:
    every = F.transform(F.sequence(F.lit(0), F.size(ws) - n), lambda i: F.concat_ws(" ", *[F.get(ws, i + k) for k in range(n)]))
    return F.when(F.size(ws) >= n, every).otherwise(F.array().cast("array<string>"))


def grams(words_: Column) -> Column:
    """The 1- to 3-grams of a word array that hold a stem."""
    return let(words_, lambda ws: F.filter(F.concat(*[_joined(ws, n) for n in (1, 2, 3)]), lambda g: g.rlike(_GATE)))


def pairs(words_: Column) -> Column:
    """Distinct word pairs of a word array (of a single word: itself)."""
    return let(words_, lambda ws: F.when(F.size(ws) > 1, F.array_distinct(_joined(ws, 2))).otherwise(ws))


def _window(lines: Column, first: Column, most: int) -> Column:
    """struct<first, lines, text> of the lines from ``first`` to the one that makes ``most`` words, or the last before one without words."""
    start = F.struct(F.array().cast("array<string>").alias("all"), F.lit(0).alias("n"), F.lit(True).alias("open"))
    taken = F.aggregate(F.slice(lines, first + 1, F.lit(most)), start, lambda s, x: F.when(
        s["open"] & (x["n"] > 0) & (s["n"] < most), F.struct(F.concat(s["all"], F.array(x["text"])).alias("all"), (s["n"] + x["n"]).alias("n"), F.lit(True).alias("open")))
        .otherwise(F.struct(s["all"].alias("all"), s["n"].alias("n"), F.lit(False).alias("open"))))
    return let(taken["all"], lambda all_: F.struct(first.alias("first"), F.size(all_).alias("lines"), F.array_join(all_, "\n").alias("text")))


def _earlier(lines: Column, at: Column) -> Column:
    """The place of the line that lies BEFORE words before line ``at``, or of the first after one without words."""
    back = F.reverse(F.slice(lines, F.greatest(at - BEFORE, F.lit(0)) + 1, F.least(at, F.lit(BEFORE))))
    start = F.struct(at.alias("at"), F.lit(0).alias("n"), F.lit(True).alias("open"))
    return F.aggregate(back, start, lambda s, x: F.when(
        s["open"] & (x["n"] > 0) & (s["n"] < BEFORE), F.struct((s["at"] - 1).alias("at"), (s["n"] + x["n"]).alias("n"), F.lit(True).alias("open")))
        .otherwise(F.struct(s["at"].alias("at"), s["n"].alias("n"), F.lit(False).alias("open"))))["at"]


def paragraphs(docs: DataFrame) -> DataFrame:
    """(row, doc_id, paragraph, lines, text) of the lines that hold a stem and of the windows around them.

    ``row`` tells the rows of ``docs`` apart; a paragraph has the number of its first line, from 0 over all lines that aren't blank.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").where(F.col("text").rlike(_GATE))
    split = F.transform(F.split("text", r"\n"), lambda x: F.struct(x.alias("text"), F.regexp_count(x, F.lit(_WORD)).alias("n")))

    def around(lines: Column) -> Column:
        stems = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i)["text"].rlike(_GATE))
        single = F.transform(stems, lambda i: F.struct(i.alias("first"), F.lit(1).alias("lines"), F.get(lines, i)["text"].alias("text")))
        wide = F.flatten(F.transform(stems, lambda i: let(_earlier(lines, i), lambda e: F.array(*[_window(lines, at, most) for at in (i, e) for most in WINDOWS]))))
        wide = F.filter(wide, lambda w: (w["lines"] > 1) & w["text"].rlike(_GATE))
        # numbered over lines that aren't blank
        blank = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(F.get(lines, i)["text"]) == "")
        return let(blank, lambda bs: F.transform(F.concat(single, F.array_distinct(wide)), lambda w: F.struct(
            (w["first"] - F.size(F.filter(bs, lambda b: b < w["first"]))).alias("paragraph"), w["lines"].alias("lines"), w["text"].alias("text"))))

    found = rows.select("row", "doc_id", F.explode(let(split, around)).alias("w")).select("row", "doc_id", "w.*")
    held = F.size(F.array_intersect(pairs(words(F.col("text"))), F.array(*map(F.lit, template_pairs())))) >= 2
    return found.where(F.when(F.col("lines") > 1, held).otherwise(True))


def plain_pairs(text: str) -> list[str]:
    """``pairs`` of the words of a template."""
    ws = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(" ".join(p) for p in zip(ws, ws[1:]))) if len(ws) > 1 else ws


def template_pairs() -> list[str]:
    return sorted({p for _, t in TEMPLATES for p in plain_pairs(t)})


def _coverage(own: Column, templates: list[list[str]]) -> Column:
    """The share of the best of some templates that word pairs hold."""
    shares = [F.size(F.array_intersect(own, F.array(*map(F.lit, t)))) / F.lit(float(len(t))) for t in templates]
    return F.greatest(*shares, F.lit(0.0))


def unknown_lines(docs: DataFrame) -> DataFrame:
    """(text): SAMPLE distinct lines of lowest hash that hold a stem, and little of any template."""
    lines = docs.where(F.col("text").rlike(_GATE)).select(F.explode(F.split("text", r"\n")).alias("text")).where(F.col("text").rlike(_GATE))
    lines = lines.distinct().withColumn("own", pairs(words(F.col("text"))))
    few = F.size(F.array_intersect("own", F.array(*map(F.lit, template_pairs())))) < FOREIGN * F.size("own")
    foreign = F.when(few, _coverage(F.col("own"), [plain_pairs(t) for _, t in TEMPLATES]) < FOREIGN).otherwise(False)
    return lines.where(foreign).select("text").orderBy(F.xxhash64("text"), "text").limit(SAMPLE)


class Classifier:
    """Fitted on the templates and a bounded corpus sample."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        self.families = sorted({f for f, _ in TEMPLATES}) + [UNKNOWN]
        others = [(UNKNOWN, t) for t in OTHERS] + [(UNKNOWN, r.text) for r in unknown_lines(docs).collect()]
        rows = [(f, t, k % 3 == 2) for k, (f, t) in enumerate([*TEMPLATES, *others])]
        table = literal_table(spark, rows, ["family", "text", "held"]).withColumn("grams", grams(words(F.col("text"))))
        vocabulary = sorted({g for r in table.select("grams").collect() for g in r.grams})
        self.counter = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features", minTF=None, binary=True)
        at = {f: float(k) for k, f in enumerate(self.families)}
        label = F.element_at(F.create_map(*[x for f, k in at.items() for x in (F.lit(f), F.lit(k))]), F.col("family"))
        ready = self.counter.transform(table.withColumn("label", label)).select("features", "label", "held").coalesce(1).cache()
        try:
            model = LogisticRegression(regParam=L2, maxIter=MAX_STEPS, family="multinomial", standardization=False)
            held = [(int(r.label), list(r.raw)) for r in model.fit(ready.where("not held")).transform(ready.where("held")).select("label", vector_to_array("rawPrediction").alias("raw")).collect()]
            self.model: LogisticRegressionModel = model.fit(ready)
        finally:
            ready.unpersist()
        self.temperature = min((0.25 * 1.2 ** k for k in range(20)), key=lambda t: sum(_loss(raw, y, t) for y, raw in held))
        self.templates = {f: [plain_pairs(t) for g, t in TEMPLATES if g == f] for f in self.families[:-1]}

    def judge(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with a column text) with family, probability and coverage."""
        raw = vector_to_array("rawPrediction")
        scored = self.model.transform(self.counter.transform(rows.withColumn("grams", grams(words(F.col("text")))))).select(*rows.columns, raw.alias("raw"))
        families = F.array(*map(F.lit, self.families))
        one, other = VERSIONS

        def shared(soft: Column) -> Column:
            """Versions share what they have together, which goes to the likelier one."""
            a, b = (F.get(soft, self.families.index(f)) for f in VERSIONS)
            merged = {one: F.when(a >= b, a + b).otherwise(F.lit(0.0)), other: F.when(a >= b, F.lit(0.0)).otherwise(a + b)}
            return F.array(*[merged.get(f, F.get(soft, k)) for k, f in enumerate(self.families)])

        def confirmed(family: Column, probability: Column, own: Column) -> Column:
            turned = F.when(family.isin(*VERSIONS), let(F.array(*[_coverage(own, self.templates[f]) for f in VERSIONS]), lambda c: F.when(
                F.get(c, 0) > F.get(c, 1), one).when(F.get(c, 0) < F.get(c, 1), other).otherwise(family))).otherwise(family)

            def covered(f: Column) -> Column:
                out = F.lit(0.0)
                for g, templates in self.templates.items():
                    out = F.when(f == g, _coverage(own, templates)).otherwise(out)
                return F.struct(f.alias("family"), probability.alias("probability"), out.alias("coverage"))

            return let(turned, covered)

        soft = let(F.array_max("raw"), lambda top: F.transform("raw", lambda x: F.exp((x - top) / self.temperature)))
        best = let(let(soft, shared), lambda s: let(F.array_max(s), lambda m: F.struct(
            F.element_at(families, F.array_position(s, m).cast("int")).alias("f"), (m / F.aggregate(s, F.lit(0.0), lambda t, x: t + x)).alias("p"))))
        found = let(best, lambda x: let(pairs(words(F.col("text"))), lambda own: confirmed(x["f"], x["p"], own)))
        # a generated column is computed once, whatever is asked of it
        return scored.select(*rows.columns, F.explode(F.array(found)).alias("j")).select(*rows.columns, "j.*")


def _loss(raw: list[float], label: int, temperature: float) -> float:
    top = max(raw)
    return math.log(sum(math.exp((x - top) / temperature) for x in raw)) - (raw[label] - top) / temperature


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The licence paragraphs: doc_id, paragraph, family, probability, coverage, text."""
    rows = id_text(docs, id_col, text_col)
    judged = Classifier(rows).judge(paragraphs(rows))
    found = judged.where((F.col("family") != UNKNOWN) & (F.col("probability") >= CONFIDENT) & (F.col("coverage") >= COVERED))
    # only what was found is grouped: by what it holds, the fewest lines first
    each = F.struct((-F.col("coverage")).alias("less"), "lines", "paragraph", "family", "probability", "coverage", "text")
    hits = found.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(each)).alias("hits"))
    kin = lambda x, y: (x["family"] == y["family"]) | x["family"].isin(*VERSIONS) & y["family"].isin(*VERSIONS)
    overlaps = lambda x, y: kin(x, y) & (x["paragraph"] < y["paragraph"] + y["lines"]) & (y["paragraph"] < x["paragraph"] + x["lines"])
    kept = F.aggregate("hits", F.slice("hits", 1, 0), lambda s, x: F.when(F.exists(s, lambda y: overlaps(x, y)), s).otherwise(F.concat(s, F.array(x))))
    return hits.select("doc_id", F.explode(kept).alias("x")).select("doc_id", F.col("x.paragraph").cast("long").alias("paragraph"), *(f"x.{c}" for c in ("family", "probability", "coverage", "text")))
