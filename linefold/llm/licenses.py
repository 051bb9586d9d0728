"""Licence scan: windows of a text against licence templates by Dice coefficient over word bigrams.

A text is normalised (A-Z folded, everything but letters a-z and digits, line
ends too, separates words). A window is a run of words anywhere in it; its set of
word bigrams is compared with a template's if its size is within the template's
bounds: a Dice coefficient of ``t`` needs between t/(2-t) and (2-t)/t times as
many bigrams as the template has. A window's size counts repeated bigrams, of
which it may have as many beyond the upper bound as the template repeats. A text is
looked at only if it holds a marker word; every window that can reach ``t`` holds
one (``marker_words``). Only windows that begin and end with a bigram of the
template are compared: cutting any other off an end never lowers the coefficient.

Of the windows that reach ``t`` the one with the largest coefficient is a notice,
then the next one that shares no word with a notice, and so on (``notices``); among
equal coefficients the first template wins, then the shorter window, then the first.
``scan`` is the older comparison of whole lines and sentences only.

Row-local and native. Defined results: a null or empty text, or one of fewer than
two words, has no licence; repeated notices count each.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import ascii_lower, let, text_of

THRESHOLD = 0.8

#: The notices of public licences, as they are written.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)
#: Words too common in any text to look for.
COMMON = frozenset("a all an and any are as at be by for from in is it may no not of on or that the this to under use with you".split())

_WINDOW = "struct<cost:double,number:int,n:int,at:int>"
_PASSAGE_END = r"[\r\n]+|(?<=[.!?:])[\x20\t]+"


def words_of(text: str) -> list[str]:
    """Normalised words of a template or a passage."""
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split("[^a-z0-9]+", folded) if w]


def bigrams_of(text: str) -> list[str]:
    w = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Fewest and most bigrams of a passage that can reach the threshold with a template of ``n``."""
    ratio = threshold / (2 - threshold)
    return math.ceil(ratio * n - 1e-9), math.floor(n / ratio + 1e-9)


def _unmarked_bigrams_allowed(own: list[str], threshold: float) -> int:
    """How many of a template's bigrams may lack a marker word.

    A passage that reaches the threshold shares at least ``threshold / 2 * (its size + the template's)`` bigrams with
    the template, so with fewer unmarked ones than that, it shares one that holds a marker.
    """
    return math.ceil(threshold / 2 * (size_bounds(len(own), threshold)[0] + len(own)) - 1e-9) - 1


def marker_words(threshold: float = THRESHOLD) -> list[str]:
    """Words of which every passage that reaches the threshold with a template holds one: per template the words in
    most of its bigrams still without one, uncommon words first."""
    chosen: set[str] = set()
    for _, text in TEMPLATES:
        own = bigrams_of(text)
        while len(bare := [b for b in own if not chosen & set(b.split())]) > _unmarked_bigrams_allowed(own, threshold):
            words = {w for b in bare for w in b.split()}
            chosen.add(min(words, key=lambda w: (w in COMMON, -sum(w in b.split() for b in bare), -len(w), w)))
    return sorted(chosen)


def _marker(threshold: float) -> str:
    return "(?i)(?<![a-z0-9])(?:" + "|".join(marker_words(threshold)) + ")(?![a-z0-9])"


def _pairs(text: Column) -> Column:
    """All word bigrams in order, repeats included."""
    words = F.filter(F.split(ascii_lower(text), "[^a-z0-9]+"), lambda w: w != "")
    pairs = lambda w: F.when(
        F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))
    ).otherwise(F.array().cast("array<string>"))
    return let(words, pairs)


def _bigrams(passage: Column) -> Column:
    return F.array_distinct(_pairs(passage))


def _matches(passage: Column, threshold: float) -> Column:
    """The templates a passage reaches, as ``array<struct<dice, template>>``."""

    def against(b: Column) -> Column:
        found = []
        for i, (_, text) in enumerate(TEMPLATES):
            own = bigrams_of(text)
            low, high = size_bounds(len(own), threshold)
            template = F.array(*[F.lit(x) for x in own])
            dice = F.lit(2.0) * F.size(F.array_intersect(b, template)) / (F.size(b) + len(own))
            found.append(F.when(F.size(b).between(low, high), F.struct(dice.alias("dice"), F.lit(-i).alias("template"))))
        return F.filter(F.array(*found), lambda m: m["dice"] >= threshold)

    return let(_bigrams(passage), against)


def scan(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, into: str = "licences") -> DataFrame:
    """``docs`` with ``into``: per passage that reaches a template, its best ``struct<dice, template>`` in order.

    ``template`` is the negated place in ``TEMPLATES``, so that the larger struct is the better match.
    """
    text = text_of(F.col(text_col))
    marker = _marker(threshold)

    def passages(t: Column) -> Column:
        some = F.filter(F.split(t, _PASSAGE_END), lambda p: p.rlike(marker))
        best = F.transform(some, lambda p: F.array_max(_matches(p, threshold)))
        return F.filter(best, lambda m: m.isNotNull())

    none = F.array().cast("array<struct<dice:double,template:int>>")
    return docs.withColumn(into, let(text, lambda t: F.when(t.rlike(marker), passages(t)).otherwise(none)))


def _windows(grams: Column, hits: Column, number: int, threshold: float) -> Column:
    """Windows that reach a template, the best first, as ``array<struct<cost, number, n, at>>``: ``n`` bigrams from ``at``."""
    text = TEMPLATES[number][1]
    own = bigrams_of(text)
    low, high = size_bounds(len(own), threshold)
    longest = high + len(words_of(text)) - 1 - len(own)
    template = F.array(*[F.lit(x) for x in own])

    def reaching(h: Column) -> Column:
        def from_(p: Column, k: Column) -> Column:
            # a window that reaches the threshold holds at least `low` bigrams of the template
            ends = F.filter(F.slice(h, k + low, longest), lambda q: q["at"] < p["at"] + longest)

            def window(q: Column) -> Column:
                n = q["at"] - p["at"] + 1
                dice = lambda b: F.lit(2.0) * F.size(F.array_intersect(b, template)) / (F.size(b) + len(own))
                cost = -let(F.array_distinct(F.slice(grams, p["at"] + 1, n)), dice)
                return F.struct(cost.alias("cost"), F.lit(number).alias("number"), n.alias("n"), p["at"].alias("at"))

            return F.filter(F.transform(ends, window), lambda w: w["cost"] <= -threshold)

        return F.flatten(F.transform(h, from_))

    mine = F.filter(hits, lambda p: p["gram"].isin(own))
    return let(mine, lambda h: F.when(F.size(h) >= low, reaching(h)).otherwise(F.array().cast(f"array<{_WINDOW}>")))


def _apart(windows: Column) -> Column:
    """Of the windows, best first, those that share no word with one taken before."""
    meets = lambda w, v: (w["at"] <= v["at"] + v["n"]) & (v["at"] <= w["at"] + w["n"])
    step = lambda taken, w: F.when(F.exists(taken, lambda v: meets(w, v)), taken).otherwise(F.concat(taken, F.array(w)))
    return F.aggregate(F.array_sort(windows), F.array().cast(f"array<{_WINDOW}>"), step)


def notices(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, into: str = "licences") -> DataFrame:
    """``docs`` with ``into``: the notices of the text in order, each as ``struct<dice, template>``.

    ``template`` is the negated place in ``TEMPLATES``, so that the larger struct is the better match.
    """
    text = text_of(F.col(text_col))
    every = sorted({b for _, t in TEMPLATES for b in bigrams_of(t)})

    def found(grams: Column) -> Column:
        placed = F.transform(grams, lambda g, i: F.struct(i.alias("at"), g.alias("gram")))
        both = F.struct(grams.alias("grams"), F.filter(placed, lambda p: p["gram"].isin(every)).alias("hits"))
        windows = let(both, lambda d: F.concat(*[_windows(d["grams"], d["hits"], i, threshold) for i in range(len(TEMPLATES))]))
        in_order = F.array_sort(F.transform(_apart(windows), lambda w: F.struct(w["at"].alias("at"), w["cost"].alias("cost"), w["number"].alias("number"))))
        return F.transform(in_order, lambda w: F.struct((-w["cost"]).alias("dice"), (-w["number"]).alias("template")))

    none = F.array().cast("array<struct<dice:double,template:int>>")
    return docs.withColumn(into, let(text, lambda t: F.when(t.rlike(_marker(threshold)), let(_pairs(t), found)).otherwise(none)))


def licence_name(template: Column) -> Column:
    """Licence of a (negated) template number."""
    return F.element_at(F.array(*[F.lit(name) for name, _ in TEMPLATES]), 1 - template)
