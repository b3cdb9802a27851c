"""Licence notices: a trained paragraph classifier, confirmed by templates.

A paragraph is a line of a text (of a wrapped notice every line is one, as each
stands in the template).  Paragraphs are classified by a multinomial logistic regression
over sparse word n-grams (one to three words) into licence families and ``unknown``.
The probabilities are calibrated by a temperature chosen on notices among other
words (``mixed``); ``unknown`` wins whenever no family reaches ``LEAST``.  A predicted family must be
confirmed by its templates: at least ``CONFIRM`` of the paragraph's distinct pairs of
neighbouring words stand in them, and one of these in no other family's.  A line may
hold notices among other words: its windows of ``WIDTHS`` words are classified
as well, under the stricter share ``WITHIN`` and with ``PAIRS`` pairs or more.  A line gives one
row: the family of the whole line, else of the best confirmed window (largest share, then
widest, then first), and the list of all families that are confirmed in it.

Every line of every text is held against the templates; what these rule out, whole and
in every window, can be no family, and is not listed.  The classifier then judges the rest, some
of it ``unknown``.

Training happens on the driver, in a second, from the fixed notices below and
their croppings; nothing is learnt from the corpus, so every run has the same
model.  Scoring is column expressions only: one pass over whole texts, no
shuffle, no Python on the executors.  The model is a constant of the plan.

Defined cases: null and empty texts list nothing; null ids and repeated rows are
handed through; families that tie in probability are taken in the order of ``FAMILIES``; lines and
texts of any length are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.spans import bound

UNKNOWN = "unknown"
LEAST = 0.5
CONFIRM = 0.4
WIDTHS = (6, 10, 16)
WITHIN = 0.6
PAIRS = 3
LOT = 256

# Customary notices of the families, as training text and templates.
NOTICES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "SPDX-License-Identifier: MIT",
        "This code is licensed under the MIT license.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Distributed under the terms of GPLv3 or later.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice in the documentation and other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 license.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, you can obtain one at the Mozilla site; see the Mozilla Public License.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License version 2.0.",
        "Use is subject to the terms of the MPL 2.0.",
    ),
    "epl": (
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "public-domain": (
        "This work has been dedicated to the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright 2020 the authors. All rights reserved.",
        "This document is proprietary and confidential; no part may be reproduced without prior written permission.",
        "Unauthorised copying or redistribution of this material is prohibited. All rights reserved.",
    ),
    UNKNOWN: (
        "She renewed her driving license last week and the license plate was stolen.",
        "The council granted permission for the new building near the river.",
        "The police obtained a warrant and searched the house.",
        "The dealer offered a two year warranty on the car.",
        "Critics said the film took poetic licence with the facts.",
        "The committee discussed copyright law and its effects on libraries.",
        "Without permission nobody could enter the hall.",
        "The redistribution of income was the subject of the debate.",
        "The company announced a new licensing deal with the studio.",
        "The fishing licence costs ten pounds a year.",
        "The software uses a proprietary format that few tools can read.",
        "The question of public domain maps came up in the meeting.",
        "You may not use this lift except in an emergency.",
        "All the rights of the tenants were reserved for a later debate.",
    ),
}
FAMILIES = tuple(NOTICES)


def word_list(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def grams(words: list[str]) -> list[str]:
    """Distinct n-grams of one to three words, in order."""
    return list(dict.fromkeys(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)))


def pairs_of(words: list[str]) -> list[str]:
    """Distinct pairs of neighbouring words, in order."""
    return list(dict.fromkeys(" ".join(words[i : i + 2]) for i in range(len(words) - 1)))


@dataclass
class LicenceModel:
    weights: dict[str, list[float]]  # n-gram -> weight of each family, divided by the temperature
    bias: list[float]
    pairs: dict[str, list[str]]  # family -> pairs of neighbouring words in its notices

    @cached_property
    def own(self) -> dict[str, list[str]]:
        """family -> its pairs that no other family has."""
        times = Counter(p for f in FAMILIES for p in self.pairs[f])
        return {f: [p for p in self.pairs[f] if times[p] == 1] for f in FAMILIES}

    @cached_property
    def apart(self) -> frozenset[str]:
        return frozenset(p for f, own in self.own.items() if f != UNKNOWN for p in own)

    @cached_property
    def every(self) -> frozenset[str]:
        return frozenset(p for f in FAMILIES if f != UNKNOWN for p in self.pairs[f])

    def score(self, text: str) -> tuple[str, float, float, str] | None:
        """(family, probability, containment, all families) of a paragraph; None where the templates rule all out."""
        words = word_list(text)
        def possible(words: list[str], least: float, many: int) -> bool:
            two = pairs_of(words)
            shared = [p for p in two if p in self.every]
            return len(shared) >= many and len(shared) >= least * len(two) and not self.apart.isdisjoint(two)

        windows = [
            (width, at, words[at : at + width])
            for width in WIDTHS
            for at in range(len(words) - width + 1)
            if possible(words[at : at + width], WITHIN, PAIRS)
        ]
        if not possible(words, CONFIRM, 1) and not windows:
            return None
        whole = self.judge(words, CONFIRM)
        found = [((made[2], width, -at), made) for width, at, w in windows if (made := self.judge(w, WITHIN))[0] != UNKNOWN]
        top = whole if whole[0] != UNKNOWN or not found else max(found)[1]
        named = {m[0] for m in [whole, *(m for _, m in found)]} - {UNKNOWN}
        return (*top, ",".join(sorted(named)))

    def judge(self, words: list[str], confirm: float) -> tuple[str, float, float]:
        z = list(self.bias)
        for g in grams(words):
            if g in self.weights:
                z = [a + b for a, b in zip(z, self.weights[g], strict=True)]
        shares = softmax(z)
        best = max(range(len(shares)), key=lambda i: (shares[i], -i))
        family = FAMILIES[best]
        two = pairs_of(words)
        shared = set(two) & set(self.pairs[family])
        part = len(shared) / len(two) if two else 0.0
        if family == UNKNOWN or shares[best] < LEAST or part < confirm or not shared & set(self.own[family]):
            family = UNKNOWN
        return family, shares[best], part


def softmax(z: list[float]) -> list[float]:
    top = max(z)
    e = [math.exp(v - top) for v in z]
    return [v / sum(e) for v in e]


def examples() -> list[tuple[list[str], int]]:
    """The notices whole, and their windows of six words or more."""
    out = []
    for label, family in enumerate(FAMILIES):
        for notice in NOTICES[family]:
            words = word_list(notice)
            out.append((grams(words), label))
            for width in (6, 10, 16):
                for at in range(0, len(words) - width, width // 2):
                    out.append((grams(words[at : at + width]), label))
    return out


def mixed(turn: int) -> list[tuple[list[str], int]]:
    """Every notice between parts of two other sentences; even and odd turns share none of these."""
    others = [word_list(x) for x in NOTICES[UNKNOWN]][turn % 2 :: 2]
    out = []
    for label, family in enumerate(FAMILIES):
        for n, notice in enumerate(NOTICES[family]):
            before, after = others[(n + turn) % len(others)], others[(2 * n + 3) % len(others)]
            out.append((grams(before[: len(before) // 2] + word_list(notice) + after[len(after) // 2 :]), label))
    return out


def descend(rows: list[tuple[list[str], int]], rounds: int, rate: float = 0.3, ridge: float = 1e-4):
    """Multinomial logistic regression by adaptive stochastic descent; row order is fixed."""
    many = len(FAMILIES)
    weights: dict[str, list[float]] = defaultdict(lambda: [0.0] * many)
    seen: dict[str, list[float]] = defaultdict(lambda: [1e-6] * many)
    bias, bias_seen = [0.0] * many, [1e-6] * many
    share = [0] * many
    for _, label in rows:
        share[label] += 1
    for k in range(rounds):
        for n in range(len(rows)):
            features, label = rows[(n * 7919 + k) % len(rows)]
            z = list(bias)
            for g in features:
                z = [a + b for a, b in zip(z, weights[g], strict=True)]
            p = softmax(z)
            cost = len(rows) / (many * share[label])
            for c in range(many):
                slope = cost * (p[c] - (c == label))
                if abs(slope) < 1e-4:
                    continue
                bias_seen[c] += slope * slope
                bias[c] -= rate * slope / math.sqrt(bias_seen[c])
                for g in features:
                    step = slope + ridge * weights[g][c]
                    seen[g][c] += step * step
                    weights[g][c] -= rate / math.sqrt(1 + len(features)) * step / math.sqrt(seen[g][c])
    return weights, bias


@cache
def trained(rounds: int = 30) -> LicenceModel:
    weights, bias = descend(examples() + mixed(0), rounds)
    held = mixed(1)  # paragraphs that no weight is fitted to

    def cost(t: float) -> float:
        out = 0.0
        for features, label in held:
            z = [sum(weights[g][c] for g in features if g in weights) + bias[c] for c in range(len(bias))]
            out -= math.log(max(softmax([v / t for v in z])[label], 1e-12))
        return out

    heat = min((0.25 * 1.25**i for i in range(16)), key=cost)
    small = {g: [round(v / heat, 4) for v in w] for g, w in weights.items()}
    pairs = {
        f: sorted({p for n in NOTICES[f] for p in pairs_of(word_list(n))})
        for f in FAMILIES
    }
    return LicenceModel(small, [round(v / heat, 4) for v in bias], pairs)


def constant(value: object, kind: str) -> Column:
    """A constant of a nested type; the optimiser folds it into one literal."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line, family, score, containment, families of every paragraph that the templates do not rule out."""
    model = trained()
    own = {f: p for f, p in model.own.items() if f != UNKNOWN}
    apart, every = sorted(model.apart), sorted(model.every)

    def joined(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), F.concat(a, F.lit(" "), b))

    def shifted(w: Column, by: int) -> Column:
        return F.slice(w, 1 + by, F.greatest(F.size(w) - by, F.lit(0)))

    def in_pairs(w: Column) -> Column:
        return F.slice(F.zip_with(w, shifted(w, 1), joined), 1, F.greatest(F.size(w) - 1, F.lit(0)))

    def pairs(w: Column) -> Column:
        return F.array_distinct(in_pairs(w))

    def known(two: Column, templates: list[str]) -> Column:
        return F.filter(two, lambda p: p.isin(templates))

    def possible(two: Column, least: float, many: int) -> Column:
        shared = F.size(known(two, every))
        return (shared >= many) & (shared >= least * F.size(two)) & F.exists(two, lambda p: p.isin(apart))

    words = F.regexp_extract_all(F.lower("paragraph"), F.lit("[a-z0-9]+"), F.lit(0))
    # A line without a first and a second word of an own pair side by side has none: most lines end here.
    firsts, seconds = (sorted({p.split(" ")[i] for p in apart}) for i in (0, 1))
    beside = F.zip_with("words", shifted(F.col("words"), 1), lambda a, b: a.isin(firsts) & b.isin(seconds))
    spots = F.transform(F.col("all"), lambda p, i: F.when(p.isin(every), i + 1))
    lines = (
        docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line", "paragraph"))
        .select("doc_id", "line", words.alias("words"))
        .where(F.exists(beside, lambda x: F.coalesce(x, F.lit(False))))
        .select("doc_id", "line", "words", in_pairs(F.col("words")).alias("all"))
        .where(F.exists("all", lambda p: p.isin(apart)))
        .select("doc_id", "line", "words", F.array_distinct("all").alias("two"), F.filter(spots, lambda i: i.isNotNull()).alias("hits"))
        # A window needs PAIRS pairs of the templates, the whole line its share.
        .where((F.size("hits") >= PAIRS) | possible(F.col("two"), CONFIRM, 1))
    )

    grams_known = sorted(model.weights)
    weights = constant(model.weights, "map<string,array<double>>")
    bias = constant(model.bias, "array<double>")
    templates = constant([model.pairs[f] for f in FAMILIES], "array<array<string>>")
    owned = constant([own.get(f, []) for f in FAMILIES], "array<array<string>>")
    names = constant(list(FAMILIES), "array<string>")

    def sums(w: Column) -> Column:
        found = bound(in_pairs(w), lambda two: F.concat(w, two, F.filter(F.zip_with(two, shifted(w, 2), joined), lambda g: g.isNotNull())))
        found = F.array_distinct(found)
        return F.aggregate(
            F.filter(found, lambda g: g.isin(grams_known)),
            bias,
            lambda acc, g: F.zip_with(acc, F.element_at(weights, g), lambda a, b: a + b),
        )

    def probability(z: Column) -> Column:
        return 1 / F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - F.array_max(z)))

    def judged(w: Column, two: Column, confirm: float) -> Column:
        """struct<family, score, containment>."""

        def told(z: Column) -> Column:
            best = F.array_position(z, F.array_max(z)).cast("int")
            shared = F.array_intersect(two, F.element_at(templates, best))
            part = F.when(F.size(two) > 0, F.size(shared) / F.size(two)).otherwise(0.0)
            sure = (
                (F.element_at(names, best) != UNKNOWN) & (probability(z) >= LEAST) & (part >= confirm)
                & F.arrays_overlap(shared, F.element_at(owned, best))
            )
            return F.struct(
                F.when(sure, F.element_at(names, best)).otherwise(UNKNOWN).alias("family"),
                probability(z).alias("score"), part.alias("containment"),
            )

        return bound(sums(w), told)

    def windows(width: int) -> Column:
        # Of PAIRS neighbouring hits within a window its possible starts follow.
        hits, last = F.col("hits"), F.size("words") - width + 1
        close = F.filter(
            F.zip_with(hits, shifted(hits, PAIRS - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            lambda x: x["b"].isNotNull() & (x["b"] - x["a"] <= width - 2),
        )
        starts = F.transform(close, lambda x: F.sequence(F.greatest(x["b"] - width + 2, F.lit(1)), F.least(x["a"], last)))
        starts = F.when(last >= 1, F.array_distinct(F.flatten(starts))).otherwise(F.array().cast("array<int>"))

        def taken(i: Column) -> Column:
            lot = ((i - 1) / LOT).cast("int")
            return F.slice(F.element_at("lots", lot + 1), i - lot * LOT, width)

        cut = F.transform(starts, lambda i: bound(taken(i), lambda c: F.struct((-i).alias("at"), c.alias("w"), pairs(c).alias("two"))))
        return F.filter(cut, lambda c: possible(c["two"], WITHIN, PAIRS))

    # A slice costs its whole array: windows are sliced from lots of words.
    lots = F.transform(F.sequence(F.lit(0), (F.size("words") / LOT).cast("int")), lambda k: F.slice("words", k * LOT + 1, LOT + max(WIDTHS)))
    lines = lines.withColumn("lots", lots)
    kept = lines.withColumn("kept", F.concat(*[windows(width) for width in WIDTHS])).where(
        (F.size("kept") > 0) | possible(F.col("two"), CONFIRM, 1)
    )
    told = F.transform("kept", lambda c: F.struct(c["at"].alias("at"), F.size(c["w"]).alias("width"), judged(c["w"], c["two"], WITHIN).alias("j")))
    ranked = F.transform(
        F.filter("told", lambda c: c["j"]["family"] != UNKNOWN),
        lambda c: F.struct(
            c["j"]["containment"].alias("containment"), c["width"].alias("width"), c["at"].alias("at"),
            c["j"]["family"].alias("family"), c["j"]["score"].alias("score"),
        ),
    )
    top = F.when(F.col("whole.family") == UNKNOWN, F.array_max("sure"))
    named = F.filter(F.concat(F.array("whole.family"), F.transform("sure", lambda c: c["family"])), lambda f: f != UNKNOWN)
    return (
        kept.select("doc_id", "line", judged(F.col("words"), F.col("two"), CONFIRM).alias("whole"), told.alias("told"))
        .select("doc_id", "line", "whole", ranked.alias("sure"))
        .select("doc_id", "line", "whole", top.alias("top"), F.array_join(F.array_sort(F.array_distinct(named)), ",").alias("families"))
        .select("doc_id", "line", *[F.coalesce(F.col("top")[c], F.col("whole")[c]).alias(c) for c in ("family", "score", "containment")], "families")
    )
