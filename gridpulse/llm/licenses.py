"""Licence scans: a trained paragraph classifier, calibrated, whose findings templates confirm.

A multinomial logistic regression over the templates' words and word pairs tells licence families from other text. It is
trained on the templates below, on copies of them with words left out, and on all of the corpus' own paragraphs as the
class without licence: those that hold the same of these words are one row, weighted by their number. The probability
that counts as sure is calibrated on all of them too, each judged by a model that was trained without it. A paragraph that looks like a licence but is unsure, or that no template matches, counts as unknown; where a relative of the
predicted family matches better, it is that one's. Lines are read in windows, and of long ones also the short stretches
around words of the templates. Stretches that run over several lines are first looked for by the words of the templates;
the classifier then judges them like any other. Everything runs in Spark's own operators.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import stored, texts

# Notices by which public licences are declared.
TEMPLATES = {
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Content is available under the Creative Commons Attribution License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under the Creative Commons Attribution NonCommercial license, for non-commercial use only.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License. See the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "reserved": [
        "All rights reserved.",
        "Copyright by the authors. All rights reserved. No part of this publication may be reproduced without prior written permission.",
    ],
}
FAMILIES = sorted(TEMPLATES)

VARIANTS = 30  # copies of a template to learn from
NEGATIVES = 4_000  # copies that the corpus' paragraphs weigh as much as, at most
STEPS = 10_000  # of the probability that counts as sure
MIN_COVER, MIN_SHARE = 0.6, 0.5  # of a template's words in the paragraph; of the paragraph's words in the template
FALSE_ALARMS = 0.001  # paragraphs without licence that may look sure
# What stands between words of lower-cased text: all but letters and digits, ASCII first, which is told faster.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F[^\x00-\x7F\p{L}\p{N}]]+"
# The same beside spaces and line feeds, ASCII signs one by one, which are told from a table.
SIGNS = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum() and chr(c) not in " \n") + r"[^\x00-\x7F\p{L}\p{N}]]+"
SPAN = 128  # words read together across line ends; half of it holds any template
LONG = 12  # words; shorter templates have to stand across line ends word for word
TELLING = 6  # letters of the words of which every match of a template holds one
WINDOW = 64  # words; longer paragraphs are read in windows that overlap by half
SHORT = (16, 6)  # words; longer windows are read in stretches of these lengths as well, where they hold a short template's words


def _one_end(text: Column) -> Column:
    """Lines end with a line feed, a carriage return, or both."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def _lines(text: Column) -> Column:
    return F.split(_one_end(text), "\n")


def _clean(text: Column) -> Column:
    """Lower-cased, with spaces for signs. This expression is compiled once, one to split at for every line split."""
    return F.regexp_replace(F.lower(_one_end(text)), SIGNS, " ")


def _clean_lines(text: Column) -> Column:
    return F.split(_clean(text), "\n")


def _spaced(clean: Column) -> Column:
    return F.array_remove(F.split(clean, " "), "")


def words(text: Column) -> Column:
    """Only the first and the last piece of a split can be empty."""
    return F.array_remove(F.split(F.lower(text), BETWEEN), "")


def _once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def paragraphs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(d, rid, p_at, part, w): the words of each paragraph, a line with any, or of each window of a long one."""
    # Split inside of the explode: a column would be computed once for the filter and again for the rows.
    split = texts(docs).select("d", "rid", F.posexplode(F.transform(_clean_lines(F.col("t")), _spaced)).alias("p_at", "all"))
    split = split.filter(F.size("all") > 0)
    n = F.greatest(F.lit(1), F.ceil(F.size("all") / (window // 2)).cast("int") - 1)
    parts = split.select("d", "rid", "p_at", "all", F.explode(F.sequence(F.lit(0), n - 1)).alias("part"))
    return parts.select("d", "rid", "p_at", "part", F.slice("all", F.col("part") * (window // 2) + 1, window).alias("w"))


def _stretches(short: int) -> tuple[Column, Column]:
    """Whether window ``w`` can have, and its stretches of ``short`` words that do have, all words of a template that short."""
    array = lambda items: F.array(*[F.lit(x) for x in items])
    spoken = [sorted(set(_plain(t))) for f in FAMILIES for t in TEMPLATES[f] if len(_plain(t)) <= short // 2]
    longest = array(sorted({max(t, key=len) for t in spoken}))

    def holds(w: Column) -> Column:
        whole = [F.size(F.array_intersect(w, array(t))) == len(t) for t in spoken]
        return F.arrays_overlap(w, longest) & reduce(lambda a, b: a | b, whole)

    starts = F.sequence(F.lit(1), F.size("w") - short // 2, F.lit(short // 2))
    cut = F.filter(F.transform(starts, lambda i: F.slice("w", i, F.lit(short))), holds)
    return (F.size("w") > short) & F.arrays_overlap("w", longest), cut


def with_stretches(windows: DataFrame, lengths: tuple[int, ...] = SHORT) -> DataFrame:
    """``windows``, marked as ``whole``, and of longer ones the stretches, overlapping by half, that hold all words of a
    short template."""
    every = F.array("w")
    for possible, cut in map(_stretches, lengths):
        every = F.concat(every, F.when(possible, cut).otherwise(F.array().cast("array<array<string>>")))
    each = windows.select("d", "rid", "p_at", "part", F.posexplode(every).alias("at", "w"))
    return each.select("d", "rid", "p_at", "part", (F.col("at") == 0).alias("whole"), "w")


def _grams(w: Column) -> Column:
    """Words of the templates and pairs of such neighbours; NULL stands between others."""
    spoken = sorted({x for f in FAMILIES for t in TEMPLATES[f] for x in _plain(t)})

    def with_pairs(known: Column) -> Column:
        following = F.slice(known, F.lit(2), F.greatest(F.size(known), F.lit(1)))
        return F.array_compact(F.concat(known, F.zip_with(known, following, lambda a, b: F.concat(a, F.lit("_"), b))))

    return _once(F.transform(w, lambda x: F.when(x.isin(spoken), x)), with_pairs)


def _vectors() -> CountVectorizerModel:
    """Which words of the templates, and pairs of neighbours that stand in templates or lack a word between, ``grams`` hold."""
    plain = [_plain(t) for f in FAMILIES for t in TEMPLATES[f]]
    pairs = {f"{a}_{b}" for t in plain for i, a in enumerate(t) for b in t[i + 1 : i + 3]}
    model = CountVectorizerModel.from_vocabulary(sorted({w for t in plain for w in t} | pairs), inputCol="grams", outputCol="x")
    return model.setBinary(True)


def _examples(spark) -> DataFrame:
    """(label, w): each template and copies without about a tenth of its words."""
    rows = [(i, t) for i, f in enumerate(FAMILIES, start=1) for t in TEMPLATES[f]]
    base = spark.createDataFrame(rows, "label int, t string").select("label", "t", words(F.col("t")).alias("all"))
    copies = base.select("label", "t", "all", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("copy"))
    dropped = F.filter("all", lambda w, i: (F.col("copy") == 0) | (F.pmod(F.xxhash64("t", "copy", i), F.lit(10)) > 0))
    return copies.select(F.col("label").cast("double").alias("label"), dropped.alias("w"))


def _training(negatives: DataFrame, examples: DataFrame, most: int) -> DataFrame:
    """(label, x, weight): ``negatives`` (x, n), which together weigh at most as much as ``most`` copies, and ``examples``."""
    total = negatives.agg(F.sum("n")).first()[0] or 0
    weight = F.col("n") * F.lit(min(1.0, most / max(total, 1)))
    return negatives.select(F.lit(0.0).alias("label"), "x", weight.alias("weight")).unionByName(
        examples.select("label", "x", F.lit(1.0).alias("weight"))
    )


def _trained(rows: DataFrame):
    # Each step runs a task for every part: small tables have few.
    rows = rows.coalesce(4 + rows.count() // 50_000)
    return LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="weight", family="multinomial", regParam=1e-4, maxIter=60, standardization=False
    ).fit(rows)


def _family_p() -> Column:
    return F.array_max(F.slice("p", 2, len(FAMILIES)))


def _classed(model, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("p", vector_to_array("probability"))


def calibrated(judged: DataFrame, false_alarms: float = FALSE_ALARMS) -> float:
    """The least probability, at least a half and in ``STEPS``, that no more than this share of the paragraphs in
    ``judged`` (f, n) reaches; n counts those alike."""
    bins = judged.groupBy(F.floor(F.col("f") * STEPS).cast("int").alias("bin")).agg(F.sum("n").alias("n")).collect()
    room, least = false_alarms * sum(r["n"] for r in bins), STEPS // 2
    for r in sorted(bins, key=lambda r: -r["bin"]):
        room -= r["n"]
        if room < 0:
            return max(r["bin"] + 1, least) / STEPS
    return least / STEPS


def _plain(template: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in template.lower()).split()


def _in_order(w: Column, template: list[str]) -> Column:
    """Length of the longest common subsequence of the words and a template."""
    own = F.array(*[F.lit(x) for x in template])

    def row(above: Column, word: Column) -> Column:
        def cell(left: Column, j: Column) -> Column:
            longer = F.greatest(F.get(above, j), F.get(left, j - 1))
            return F.concat(left, F.array(F.when(F.get(own, j - 1) == word, F.get(above, j - 1) + 1).otherwise(longer)))

        return F.aggregate(F.sequence(F.lit(1), F.lit(len(template))), F.array(F.lit(0)), cell)

    return F.get(F.aggregate(w, F.array_repeat(F.lit(0), len(template) + 1), row), F.lit(len(template)))


def _needed(template: list[str]) -> int:
    """How many of a template's words a match holds: all of a short one's."""
    own = len(set(template))
    return own if len(template) < LONG else math.ceil(MIN_COVER * own)


def _telling() -> list[str]:
    """Words of which every match of a template holds one: the long ones, and more of templates that have too few."""
    telling: set[str] = set()
    for own in [set(_plain(t)) for f in FAMILIES for t in TEMPLATES[f]]:
        telling |= {w for w in own if len(w) >= TELLING}
    for plain in [_plain(t) for f in FAMILIES for t in TEMPLATES[f]]:
        others = sorted(set(plain) - telling, key=lambda w: (-len(w), w))
        telling.update(others[: max(0, len(others) - _needed(plain) + 1)])
    return sorted(telling)


def _matches_by_short(template: list[str]) -> bool:
    """Whether a match may lack all of the template's long words."""
    return len({w for w in template if len(w) < TELLING}) >= _needed(template)


def _may_match(grams: Column) -> Column:
    """Whether ``grams`` hold a long word of any template, or as many words as a match of one that can do without."""
    plain = [_plain(t) for f in FAMILIES for t in TEMPLATES[f]]
    long = sorted({w for t in plain for w in t if len(w) >= TELLING})
    may = F.exists(grams, lambda g: g.isin(long))
    for template in filter(_matches_by_short, plain):
        own = F.array(*[F.lit(x) for x in sorted(set(template))])
        may = may | (F.size(F.array_intersect(own, grams)) >= _needed(template))
    return may


def _fit(w: Column, templates: list[str]) -> Column:
    """How well the best of ``templates`` fits: 1 if it stands in the paragraph word for word, else the lesser of cover
    and share. 0 if either is too low, too few words stand in the template's order, or the template is a short one.

    A template is compared only where the paragraph holds as many of its words as a match does."""
    text = F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
    spoken = F.array(*[F.lit(x) for x in sorted({x for t in templates for x in _plain(t)})])

    def against(template: str, common: Column) -> Column:
        plain = _plain(template)
        own = sorted(set(plain))
        whole = F.contains(text, F.lit(f" {' '.join(plain)} "))

        def fit(both: Column) -> Column:
            if len(plain) < LONG:
                return F.when((both >= _needed(plain)) & whole, 1.0).otherwise(0.0)
            cover, share = both / len(own), both / F.size(F.array_distinct(w))
            near = (cover >= MIN_COVER) & (share >= MIN_SHARE)
            ordered = F.when(near, _in_order(w, plain) >= MIN_COVER * len(plain))
            return F.when(both < _needed(plain), 0.0).when(whole, 1.0).when(ordered, F.least(cover, share)).otherwise(0.0)

        return _once(F.size(F.array_intersect(common, F.array(*[F.lit(x) for x in own]))), fit)

    def best(common: Column) -> Column:
        least = min(_needed(_plain(t)) for t in templates)
        return F.when(F.size(common) < least, 0.0).otherwise(F.greatest(F.lit(0.0), *[against(t, common) for t in templates]))

    return F.when(w.isNotNull(), _once(F.array_intersect(w, spoken), best))


def wrapped_notices(docs: DataFrame) -> DataFrame:
    """(d, rid, p_at, match, name, w): lines of notices that run over line ends, without blank ones between. ``match`` is 0
    for all lines of a notice but its middle one, which counts for it. ``w`` are the notice's words.

    A template is compared at every start of a window only where the window holds as many of its words as a match does."""
    plain = [(f, _plain(t)) for f in FAMILIES for t in TEMPLATES[f]]
    telling = sorted({w for _, t in plain for w in t if len(w) >= TELLING})
    whole = texts(docs).filter(F.contains("t", F.lit("\n")) | F.contains("t", F.lit("\r")))
    whole = whole.filter(F.arrays_overlap(F.split(F.lower("t"), BETWEEN), F.array(*[F.lit(x) for x in telling])))
    lines = F.transform(_clean_lines(F.col("t")), lambda line, i: F.struct(i.alias("at"), _spaced(line).alias("w")))
    # A line without words is -1, so a window that holds one is cut there.
    flat = F.flatten(
        F.transform(
            lines,
            lambda x: F.when(F.size(x["w"]) == 0, F.array(F.struct(F.lit(-1).alias("at"), F.lit("").alias("w")))).otherwise(
                F.transform(x["w"], lambda w: F.struct(x["at"].alias("at"), w.alias("w")))
            ),
        )
    )
    flat = whole.select("d", "rid", flat.alias("all"))
    last = F.greatest(F.lit(0), F.ceil(F.size("all") / (SPAN // 2)).cast("int") - 2)
    parts = flat.select("d", "rid", "all", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    parts = parts.select("d", "rid", F.slice("all", F.col("part") * (SPAN // 2) + 1, SPAN).alias("x"))
    parts = parts.select("d", "rid", F.col("x.at").alias("at"), F.col("x.w").alias("w"))
    parts = parts.filter(F.arrays_overlap("w", F.array(*[F.lit(x) for x in telling])))
    spoken = sorted({w for _, t in plain for w in t})
    parts = parts.withColumn("common", F.array_intersect("w", F.array(*[F.lit(x) for x in spoken])))
    parts = parts.filter(F.size("common") >= min(_needed(t) for _, t in plain))

    def best(family: str, template: list[str]) -> Column:
        """The stretch that fits best: fit, name, first and last line; NULL if none does or it is in one line."""
        m, own = len(template), sorted(set(template))
        known, text = F.array(*[F.lit(x) for x in own]), F.array(*[F.lit(x) for x in template])

        def fit(i: Column) -> Column:
            w = F.slice("w", i, F.lit(m))
            both = F.size(F.array_intersect(w, known))
            cover, share = both / len(own), both / F.size(F.array_distinct(w))
            near = F.when((cover >= MIN_COVER) & (share >= MIN_SHARE), F.least(cover, share)).otherwise(0.0)
            value = F.when(w == text, 1.0).otherwise(near if m >= LONG else F.lit(0.0))
            end = F.least(i + m - 1, F.size("w"))
            first, final = F.get("at", i - 1), F.get("at", end - 1)
            inside = (F.array_position(F.slice("at", i, F.lit(m)), -1) == 0) & (first != final)
            middle = F.get("at", F.floor((i + end) / 2).cast("int") - 1)
            return F.struct(
                F.when(inside, value).otherwise(0.0).alias("fit"), (-i).alias("back"), F.lit(family).alias("name"),
                first.alias("first"), final.alias("final"), middle.alias("middle"), w.alias("w"),
            )

        # Only stretches that begin or end with a word of the template can be the best.
        starts = F.filter(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - m + 1)),
            lambda i: F.array_contains(known, F.get("w", i - 1)) | F.array_contains(known, F.get("w", F.least(i + m - 1, F.size("w")) - 1)),
        )
        possible = F.size(F.array_intersect("common", known)) >= _needed(template)
        return F.when(possible, F.array_max(F.transform(starts, fit)))

    every = F.filter(F.array(*[best(f, t) for f, t in plain]), lambda m: m["fit"] > 0)
    found = parts.select("d", "rid", every.alias("all"))
    # Relatives differ in a word: of notices in the same lines the one that fits best counts.
    clear = F.filter(
        "all",
        lambda m: ~F.exists(
            "all", lambda o: (o["fit"] > m["fit"]) & (o["name"] != m["name"]) & (o["first"] < m["final"]) & (m["first"] < o["final"])
        ),
    )
    found = found.select("d", "rid", F.explode(clear).alias("m"))
    each = found.select("d", "rid", "m", F.explode(F.sequence("m.first", "m.final")).alias("p_at"))
    match = F.when(F.col("p_at") == F.col("m.middle"), F.col("m.fit")).otherwise(0.0)
    each = each.select("d", "rid", "p_at", match.alias("match"), F.col("m.name").alias("name"), F.col("m.w").alias("w"))
    return each.distinct()


def _read(docs: DataFrame, telling: list[str]) -> DataFrame:
    """(d, rid, p_at, part, whole, x, w): windows and stretches as vectors, written once. ``whole`` marks the windows; ``w``
    are the words of what holds a ``telling`` one, without which no template matches, and may match otherwise, too."""
    vectors = _vectors().transform(with_stretches(paragraphs(docs)).withColumn("grams", _grams(F.col("w"))))
    tells = F.exists("grams", lambda g: g.isin(telling)) & _may_match(F.col("grams"))
    return stored(vectors.select("d", "rid", "p_at", "part", "whole", "x", F.when(tells, F.col("w")).alias("w")), "licence-read")


def scan_licenses(docs: DataFrame, negatives: int = NEGATIVES) -> DataFrame:
    """Per row of ``docs``: doc_id, families (sorted), n_paragraphs, n_licensed, n_unknown, best_match.

    ``families`` are those that confirmed paragraphs declare; n_licensed counts such paragraphs, n_unknown those that look
    like a licence of no confirmed family. A paragraph is a line; a notice wrapped over several counts at its middle one,
    and its other lines are not unknown. NULL, empty and blank texts have no paragraph. Repeated rows come back alike,
    as often as they came. All columns but doc_id depend on the text and, by the training, on the corpus.
    ``negatives`` is the weight of all the corpus' paragraphs in the training, in copies of a template.
    """
    spark = docs.sparkSession
    plain = [t for f in FAMILIES for t in TEMPLATES[f]]
    read = _read(docs, _telling())
    wrapped = stored(wrapped_notices(docs), "licence-wrapped")
    covered = wrapped.select(F.col("d").alias("wd"), F.col("rid").alias("wrid"), F.col("p_at").alias("w_at")).distinct()
    same = F.col("d").eqNullSafe(F.col("wd")) & (F.col("rid") == F.col("wrid")) & (F.col("p_at") == F.col("w_at"))
    # A licence line is no example of text without licence.
    likeness = F.when(F.col("w").isNull(), 0.0).otherwise(_fit(F.col("w"), plain))
    nothing = read.filter("whole").join(covered, same, "left_anti").filter(likeness == 0)
    nothing = nothing.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    nothing = stored(nothing.withColumn("half", F.pmod(F.xxhash64(vector_to_array("x")), F.lit(2)).cast("int")), "licence-negatives")
    examples = stored(_vectors().transform(_examples(spark).withColumn("grams", _grams(F.col("w")))).select("label", "x"), "licence-examples")
    model = _trained(_training(nothing, examples, negatives))

    # Calibrated on paragraphs that the model didn't learn from: what hardly any without licence reaches is sure.
    judged = None
    for half in (0, 1):
        other = _trained(_training(nothing.filter(F.col("half") != half), examples, negatives))
        part = _classed(other, nothing.filter(F.col("half") == half)).select(_family_p().alias("f"), "n")
        judged = part if judged is None else judged.unionByName(part)
    sure = calibrated(judged)

    scored = _classed(model, read)
    looks = scored.filter(F.get("p", F.lit(0)) < 0.5).withColumn("top", _family_p())
    looks = looks.select("d", "rid", "p_at", "w", "top", (F.array_position("p", F.col("top")) - 1).cast("int").alias("family"))
    looks = looks.withColumn("fits", F.array(*[F.coalesce(_fit(F.col("w"), TEMPLATES[f]), F.lit(0.0)) for f in FAMILIES]))
    looks = looks.withColumn("match", F.when(F.col("top") >= sure, F.array_max("fits")).otherwise(0.0))
    # The predicted family, unless another one's template fits better: close relatives differ in a word.
    own = F.get("fits", F.col("family") - 1)
    closest = F.when(own == F.array_max("fits"), F.col("family") - 1).otherwise(F.array_position("fits", F.array_max("fits")) - 1)
    name = F.get(F.array(*[F.lit(f) for f in FAMILIES]), closest.cast("int"))
    # Windows of one paragraph count once; of repeated rows all but one are left out here.
    lines = looks.select("d", "rid", "p_at", "match", name.alias("name"), F.lit(False).alias("covered"))
    # A notice over several lines needs the classifier's word as well.
    notices = _classed(model, _vectors().transform(wrapped.withColumn("grams", _grams(F.col("w"))))).filter(F.get("p", F.lit(0)) < 0.5)
    lines = lines.unionByName(notices.select("d", "rid", "p_at", "match", "name", F.lit(True).alias("covered")))
    judged = lines.groupBy("d", "rid", "p_at").agg(
        F.max("match").alias("match"),
        F.array_sort(F.collect_set(F.when(F.col("match") > 0, F.col("name")))).alias("names"),
        F.max("covered").alias("covered"),
    )
    by_row = judged.groupBy(F.col("d").alias("jd"), F.col("rid").alias("jrid")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("families"),
        F.count_if(F.col("match") > 0).alias("n_licensed"),
        F.count_if((F.col("match") == 0) & ~F.col("covered")).alias("n_unknown"),
        F.max("match").alias("best_match"),
    )
    full = F.filter(_lines(F.col("t")), lambda line: line.rlike(r"[a-z\p{L}\p{N}]"))
    rows = texts(docs).select("d", "rid", F.size(full).cast("long").alias("n_paragraphs"))
    joined = rows.join(by_row, F.col("d").eqNullSafe(F.col("jd")) & (F.col("rid") == F.col("jrid")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        F.col("d").alias("doc_id"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        "n_paragraphs",
        F.coalesce("n_licensed", zero).alias("n_licensed"),
        F.coalesce("n_unknown", zero).alias("n_unknown"),
        F.coalesce("best_match", F.lit(0.0)).alias("best_match"),
    )
