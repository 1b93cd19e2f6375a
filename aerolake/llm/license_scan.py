"""Licence scan: lines, whole texts and runs of words against licence templates by Dice over word bigrams.

Units are the lines of a text (numbered from 1) and, where it has several lines, the text as a whole (line 0).
A unit is normalised to lower-case words of letters and digits; its bigrams are a bag. Similarity to a template
is ``2 * common / (unit bigrams + template bigrams)``. A template of ``b`` bigrams can only reach the threshold
for units of between ``b * t / (2 - t)`` and ``b * (2 - t) / t`` bigrams, so the size bounds choose the candidate
templates of a unit, and only those that share a bigram are counted out.

A notice that is wrapped over several lines or stands inside a longer line is found as a run: as many consecutive
words of the text as the template has, wherever a shared bigram's place in the template puts them (cut at the ends of
the text). What counts as its place goes from its first to its last shared bigram; it is reported at the line where
that begins. Of runs of one template that overlap only the most similar counts, then the first, and none counts where
the whole text or a line it touches already matches that template. A run at the threshold has at least ``need`` of the template's bigrams within its length, so texts without so dense a place
are left before any run is counted out. The SQL knows lines and whole texts only.

Everything happens inside the row: no shuffle, no join. Templates are constants of the plan.

Edge cases: null, empty and one-word units match nothing; a text that repeats a line reports each line; repeated
rows repeat; an empty table gives no matches. Only the key and the text are read.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Usual one-line notices and opening paragraphs of public licences, with their SPDX names.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this "
                "work."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def normal_words(text: str) -> list[str]:
    """Lower-case words of letters and digits, as the scan itself cuts them."""
    return re.findall(r"[^\W_]+", text.lower())


def template_cells(templates=TEMPLATES) -> list[tuple[int, str, list[tuple[str, int]]]]:
    """(number, licence, bigrams with counts) of each template that has a bigram."""
    out = []
    for i, (licence, text) in enumerate(templates):
        words = normal_words(text)
        if len(words) > 1:
            out.append((i, licence, sorted(Counter(map(" ".join, zip(words, words[1:]))).items())))
    return out


def _bounds(n: int, threshold: float) -> tuple[int, int]:
    """Least and most bigrams of a unit that can reach the threshold with a template of ``n``."""
    sizes = [a for a in range(1, int(n * (2 - threshold) / threshold) + 2) if 2 * min(a, n) >= threshold * (a + n)]
    return min(sizes), max(sizes)


def _need(n: int, threshold: float) -> int:
    """Fewest common bigrams at the threshold of a run for a template of ``n``."""
    low = _bounds(n, threshold)[0]
    return next(c for c in range(low + 1) if 2 * c >= threshold * (low + n) or c == low)


def _constants(cells, threshold: float, texts: list[str]) -> Column:
    def one(number, licence, grams):
        n = sum(c for _, c in grams)
        low, high = _bounds(n, threshold)
        words = normal_words(texts[number])
        return F.struct(
            F.lit(number).alias("template"), F.lit(licence).alias("licence"), F.lit(n).alias("n"),
            F.lit(low).alias("low"), F.lit(high).alias("high"), F.lit(_need(n, threshold)).alias("need"),
            F.array(*[F.struct(F.lit(" ".join(words[j:j + 2])).alias("g"), F.lit(j).alias("j")) for j in range(n)])
            .alias("places"),
            F.array(*[F.lit(g) for g, _ in grams]).alias("grams"),
            F.array(*[F.struct(F.lit(g).alias("g"), F.lit(c).alias("c")) for g, c in grams]).alias("cells"))
    return F.array(*[one(*x) for x in cells])


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _grams(words: Column) -> Column:
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))


def _dice(grams: Column, t: Column) -> Column:
    common = F.aggregate(t["cells"], F.lit(0), lambda a, x: a + F.least(
        x["c"], F.size(F.filter(grams, lambda g: g == x["g"]))))
    return F.lit(2.0) * common / (F.size(grams) + t["n"])


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per unit or run and template at or above the threshold: key, line, template, licence, dice."""
    cells = template_cells(templates)
    constants = _constants(cells, threshold, [t for _, t in templates])
    return _units(docs, threshold, cells, constants, key, text).unionByName(
        _runs(docs, threshold, cells, constants, key, text))


def _units(docs: DataFrame, threshold: float, cells, constants: Column, key: str, text: str) -> DataFrame:
    bounds = [_bounds(sum(c for _, c in g), threshold) for _, _, g in cells]
    least, most = min(b for b, _ in bounds), max(b for _, b in bounds)
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(whole, "\n")
    units = F.when(F.size(lines) > 1, F.concat(F.array(whole), lines)).otherwise(F.concat(F.array(F.lit("")), lines))
    found = docs.select(key, F.posexplode(units).alias("line", "unit")) \
        .where(F.length("unit") > 2) \
        .select(key, "line", _words(F.col("unit")).alias("words")) \
        .where(F.size("words").between(least + 1, most + 1)) \
        .select(key, "line", _grams(F.col("words")).alias("grams"))
    grams, n = F.col("grams"), F.size("grams")
    near = F.filter(constants, lambda t: (n >= t["low"]) & (n <= t["high"]) & F.arrays_overlap(
        grams, t["grams"]))
    scored = F.transform(near, lambda t: F.struct(
        t["template"].alias("template"), t["licence"].alias("licence"), _dice(grams, t).alias("dice")))
    return found.select(key, "line", F.inline(F.filter(scored, lambda s: s["dice"] >= threshold)))


def _runs(docs: DataFrame, threshold: float, cells, constants: Column, key: str, text: str) -> DataFrame:
    known = sorted({g for _, _, grams in cells for g, _ in grams})
    begins = sorted({g.split(" ")[0] for g in known})
    least = min(_need(sum(c for _, c in g), threshold) for _, _, g in cells)
    # A condition that Spark takes for non-deterministic: the filters below stay above what they read instead of being
    # rewritten into it, which would split every text again for each use.
    once = lambda c: F.when(F.monotonically_increasing_id() >= 0, c)
    words, lines, hits, size = F.col("__words"), F.col("__lines"), F.col("__hits"), F.size("__words")
    places = F.transform(F.slice(words, F.lit(1), F.greatest(size - 1, F.lit(0))), lambda w, i: F.struct(
        i.alias("i"), F.when(w.isin(begins), F.concat_ws(" ", w, F.get(words, i + 1))).alias("g")))

    def mine(t):
        """Places of a template's bigrams, in order."""
        return F.filter(hits, lambda h: F.array_contains(t["grams"], h["g"]))

    def dense(t, own):
        """Whether ``need`` of the places lie within the template's length."""
        return F.exists(F.transform(own, lambda h, k: F.get(own, k + t["need"] - 1)["i"] - h["i"] < t["n"]),
                        lambda x: F.coalesce(x, F.lit(False)))

    def matches(unit, t):
        n = F.size(unit) - 1
        return (n >= t["low"]) & (n <= t["high"]) & F.exists(
            F.array(_grams(unit)), lambda g: _dice(g, t) >= threshold)

    def runs(t, own):
        starts = F.array_distinct(F.flatten(F.transform(own, lambda h: F.transform(
            F.filter(t["places"], lambda p: p["g"] == h["g"]), lambda p: h["i"] - p["j"]))))
        cut = F.transform(starts, lambda s: F.struct(
            F.greatest(s, F.lit(0)).alias("first"), F.least(s + t["n"] + 1, size).alias("stop")))
        wide = F.filter(cut, lambda w: w["stop"] - w["first"] > t["low"])
        with_grams = F.transform(wide, lambda w: F.struct(w["first"].alias("first"), w["stop"].alias("stop"), F.transform(
            F.sequence(w["first"], w["stop"] - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
            .alias("grams")))
        scored = F.transform(with_grams, lambda w: F.struct(
            (-_dice(w["grams"], t)).alias("order"), F.filter(F.sequence(w["first"], w["stop"] - 2), lambda i: F.array_contains(
                t["grams"], F.get(w["grams"], i - w["first"]))).alias("shared")))
        near = F.transform(F.filter(scored, lambda w: w["order"] <= -threshold), lambda w: F.struct(
            w["order"].alias("order"), F.get(w["shared"], F.lit(0)).alias("first"),
            (F.element_at(w["shared"], -1) + 2).alias("stop")))
        alone = F.filter(near, lambda w: ~F.exists(
            F.sequence(F.get(F.col("__owner"), w["first"]), F.get(F.col("__owner"), w["stop"] - 1)),
            lambda i: matches(F.get(lines, i), t)))
        picked = F.aggregate(F.sort_array(alone), F.filter(near, lambda w: F.lit(False)), lambda got, w: F.when(
            F.exists(got, lambda g: (g["first"] < w["stop"]) & (w["first"] < g["stop"])), got)
            .otherwise(F.concat(got, F.array(w))))
        return F.transform(picked, lambda w: F.struct(
            (F.get(F.col("__owner"), w["first"]) + 1).alias("line"), t["template"].alias("template"),
            t["licence"].alias("licence"), (-w["order"]).alias("dice")))

    split = docs.select(key, once(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), _words)).alias("__lines"))
    placed = split.select(key, "__lines", once(F.flatten("__lines")).alias("__words")) \
        .select(key, "__lines", "__words", once(F.filter(places, lambda h: h["g"].isin(known))).alias("__hits")) \
        .where(F.size("__hits") >= least)
    hoped = placed.select(key, "__lines", "__words", once(F.filter(F.transform(F.filter(
        constants, lambda t: F.size(hits) >= t["need"]), lambda t: F.struct(t.alias("t"), mine(t).alias("own"))),
        lambda x: dense(x["t"], x["own"]))).alias("__near")).where(F.size("__near") > 0)
    near = hoped.select(key, "__lines", "__words", "__near", once(F.flatten(F.transform(lines, lambda ws, i: F.transform(
        ws, lambda w: i)))).alias("__owner"))
    left = F.filter("__near", lambda x: ~matches(words, x["t"]))
    found = near.select(key, once(F.flatten(F.transform(left, lambda x: runs(x["t"], x["own"])))).alias("__found"))
    return found.select(key, F.inline("__found"))
