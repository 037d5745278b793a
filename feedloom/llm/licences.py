"""Licence notices in texts: MinHash of overlapping windows finds templates, exact containment of shingles confirms them.

A template is a notice. By its number of shingles it belongs to a class with its own window: one shingle for short
notices, four and sixteen for longer ones. Texts are cut into windows of each class that overlap by half, templates into
all windows there are. A window's signature is its least hash under each of four permutations, one band of one row each:
windows of similarity s share a band with probability 1 - (1 - s)^4, 0.998 at s = 0.8, and a notice has many windows. A
template that shares a band with the text is then compared exactly: at least 0.8 of its five-word shingles have to be in
the text. All of it is one projection, in which no row meets another one.

The templates are a parameter of the program; their shingles and bands are constants of the plan.

Defined cases: null texts and texts of fewer words than a shingle have no licences; repeated rows are judged each for
itself; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import let, whole

SHINGLE, CONTAINED, BANDS = 5, 0.8, 4
#: Window, and the least number of shingles of the templates it is for; any copy of one has a whole window inside.
CLASSES = ((1, 1), (4, 8), (16, 32))

# Notices as their licences word them. Where licences share most of a notice, the template is the passage
# that tells them apart, so short that a relative's notice has less than CONTAINED of it; words changed there hide it.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Distributed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    "GPL-2.0": (
        "under the GNU General Public License, version 2.",
        "terms of the GNU General Public License version 2 as published by the Free Software Foundation",
        "terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ),
    "GPL-3.0": (
        "under the GNU General Public License, version 3.",
        "terms of the GNU General Public License version 3 as published by the Free Software Foundation",
        "terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "LGPL-2.1": (
        "GNU Lesser General Public License, version 2.1.",
        "terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of "
        "the License",
    ),
    "LGPL-3.0": (
        "the GNU Lesser General Public License, version 3.",
        "terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of "
        "the License",
    ),
    "AGPL-3.0": (
        "the GNU Affero General Public License, version 3.",
        "terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of "
        "the License",
    ),
    "BSD-2-Clause": ("materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE",),
    "BSD-3-Clause": (
        "materials provided with the distribution. Neither the name of the",
        "materials provided with the distribution. 3. Neither the name of the",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
}


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(whole(text)), "[^a-z0-9]+"), lambda w: w != "")


def _at_shingles(w: Column, of) -> Column:
    """``of`` the five words at each place."""
    places = F.sequence(F.lit(0), F.size(w) - SHINGLE)
    return F.transform(places, lambda i: of(*[F.get(w, i + k) for k in range(SHINGLE)]))


def _hashes(w: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(F.size(w) < SHINGLE, none).otherwise(_at_shingles(w, F.xxhash64))


def _shingles(w: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.size(w) < SHINGLE, none).otherwise(_at_shingles(w, lambda *x: F.concat_ws(" ", *x)))


def _bands(h: Column, window: int, step: int) -> Column:
    """Signatures of all windows, each value marked by class and band as it was hashed with them."""
    if window == 1:
        return F.transform(h, lambda x: F.xxhash64(x, F.lit(window)))
    starts = F.when(
        F.size(h) >= window,
        F.concat(F.sequence(F.lit(1), F.size(h) - window + 1, F.lit(step)), F.array(F.size(h) - window + 1)),
    ).otherwise(F.array().cast("array<int>"))
    one = lambda band: let(
        F.transform(h, lambda x: F.xxhash64(x, F.lit(window), F.lit(band))),
        lambda p: F.transform(starts, lambda i: F.array_min(F.slice(p, i, window))),
    )
    return F.concat(*[one(band) for band in range(BANDS)])


def _prepared(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> list[dict]:
    """Templates with shingles and bands, as constants."""
    texts = [(name, text) for name, notices in sorted(templates.items()) for text in notices]
    frame = spark.createDataFrame(texts, "name string, text string").select("name", _words(F.col("text")).alias("w"))
    frame = frame.select("name", F.array_distinct(_shingles(F.col("w"))).alias("shingles"), _hashes(F.col("w")).alias("h"))
    bands = F.lit(None)
    for window, least in sorted(CLASSES, key=lambda c: c[1]):
        bands = F.when(F.size("h") >= least, _bands(F.col("h"), window, 1)).otherwise(bands)
    return [r.asDict() for r in frame.select("name", "shingles", F.array_distinct(bands).alias("bands")).collect()]


def find(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per document: doc_id, n_licences, licences (names in order, joined by commas)."""
    known = _prepared(docs.sparkSession, TEMPLATES if templates is None else templates)
    values = sorted({b for t in known for b in t["bands"] or ()})
    constant = F.array(
        *[F.struct(F.lit(t["name"]).alias("name"), F.lit(t["shingles"]).alias("shingles"), F.lit(t["bands"] or []).cast("array<bigint>").alias("bands")) for t in known]
    )
    none = F.array().cast("array<string>")

    def confirmed(w: Column, hits: Column) -> Column:
        enough = lambda t, s: F.size(F.array_intersect(t["shingles"], s)) >= CONTAINED * F.size(t["shingles"])
        names = let(
            _shingles(w),
            lambda s: F.transform(
                F.filter(F.filter(constant, lambda t: F.arrays_overlap(t["bands"], hits)), lambda t: enough(t, s)),
                lambda t: t["name"],
            ),
        )
        return F.when(F.size(hits) == 0, none).otherwise(names)

    def retrieved(h: Column) -> Column:
        everything = F.concat(*[_bands(h, window, max(1, window // 2)) for window, _ in CLASSES])
        return F.array_distinct(F.filter(everything, lambda v: v.isin(values)))

    names = let(_words(F.col("text")), lambda w: let(let(_hashes(w), retrieved), lambda hits: confirmed(w, hits)))
    rows = docs.select("doc_id", F.array_sort(F.array_distinct(names)).alias("names"))
    return rows.select("doc_id", F.size("names").cast("bigint").alias("n_licences"), F.array_join("names", ",").alias("licences"))
