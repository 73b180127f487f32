"""Licence notices in texts: MinHash over windows finds templates, shingles verify them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearling.sources.staging import staged

#: Words of a shingle, and the share of a template's shingles that must be found.
SHINGLE, CONTAINED = 5, 0.8

#: How a licence is named in one line, by SPDX id.
NAMES: list[tuple[str, str]] = [
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Apache 2.0 License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("Zlib", "zlib License"),
    ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("GPL-2.0-only", "GNU General Public License, version 2"),
    ("GPL-3.0-only", "GNU General Public License, version 3"),
    ("LGPL-2.1-only", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0-only", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0-only", "GNU Affero General Public License, version 3"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
    ("CC-BY-3.0", "CC BY 3.0"),
    ("CC-BY-SA-3.0", "CC BY-SA 3.0"),
]
#: What comes before such a name.
VERBS = ["Released under the", "Licensed under the", "Distributed under the", "Available under the"]

#: Names of the Creative Commons licences, by SPDX id.
COMMONS: list[tuple[str, str]] = [
    ("CC-BY", "Attribution"),
    ("CC-BY-SA", "Attribution-ShareAlike"),
    ("CC-BY-NC", "Attribution-NonCommercial"),
    ("CC-BY-ND", "Attribution-NoDerivatives"),
    ("CC-BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("CC-BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]

_GNU = (
    "{it} is free software: you can redistribute it and/or modify it under the terms of the "
    "{name} as published by the Free Software Foundation, either version {version} of the "
    "License, or (at your option) any later version."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source "
    "code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"'

#: Notices as licensors publish them, by name and SPDX id.
LONG: list[tuple[str, str, str]] = [
    (
        "mpl2",
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    *(
        (name, licence, _GNU.format(it=it, name=full, version=version))
        for name, licence, it, full, version in [
            ("gpl2_notice", "GPL-2.0-or-later", "This program", "GNU General Public License", "2"),
            ("gpl3_notice", "GPL-3.0-or-later", "This program", "GNU General Public License", "3"),
            ("lgpl21_notice", "LGPL-2.1-or-later", "This library", "GNU Lesser General Public License", "2.1"),
            ("lgpl3_notice", "LGPL-3.0-or-later", "This library", "GNU Lesser General Public License", "3"),
            ("agpl3_notice", "AGPL-3.0-or-later", "This program", "GNU Affero General Public License", "3"),
        ]
    ),
    (
        "apache_notice",
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
        "agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied.",
    ),
    (
        "mit_grant",
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the '
        "Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    ("bsd2_terms", "BSD-2-Clause", _BSD + _BSD_END),
    (
        "bsd3_terms",
        "BSD-3-Clause",
        _BSD + "3. Neither the name of the copyright holder nor the names of its contributors "
        "may be used to endorse or promote products derived from this software without "
        "specific prior written permission. " + _BSD_END,
    ),
    (
        "unlicense",
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is "
        "free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    (
        "zlib_grant",
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no "
        "event will the authors be held liable for any damages arising from the use of this "
        "software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions:",
    ),
    (
        "epl2_notice",
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of "
        "the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "isc_grant",
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose "
        "with or without fee is hereby granted, provided that the above copyright notice and "
        "this permission notice appear in all copies.",
    ),
]


def one_liners() -> list[tuple[str, str, str]]:
    """Every verb with every name, tags of SPDX ids, and the lines of Creative Commons."""
    found = [
        (f"{verb.split()[0].lower()} {name.lower()}", licence, f"{verb} {name}.")
        for licence, name in NAMES
        for verb in VERBS
    ]
    # "CC BY 4.0" goes without an article.
    found = [(n, i, x.replace("the CC", "CC")) for n, i, x in found]
    tags = {licence for _, licence, _ in [*LONG, *found]}
    for licence in sorted(tags):
        line = f"SPDX-License-Identifier: {licence}"
        if len(re.findall(r"[a-zA-Z0-9]+", line)) >= SHINGLE:
            found.append((f"spdx {licence.lower()}", licence, line))
    for short, full in COMMONS:
        for version, kind in [("4.0", "International"), ("3.0", "Unported")]:
            line = f"This work is licensed under a Creative Commons {full} {version} {kind} License."
            found.append((f"commons {full.lower()} {version}", f"{short}-{version}", line))
    return found


NOTICES = [*LONG, *one_liners()]

#: Shingles of templates up to which these go to every task, far more than all licences have.
SENT = 100_000

#: Bands of one MinHash each. A window that holds a template has a Jaccard similarity of
#: at least 1/3 with it, one that holds the least share that counts 1/4: no band is
#: shared with a chance of (2/3)^32, or 2 in 10^6, and (3/4)^32, or 1 in 10^4.
BANDS = 32


def shingles(text: Column) -> list[tuple[str, Column]]:
    """Projections, one after the other, that give the array `s` of shingle hashes.

    Words are runs of letters and digits in lower case. A text with fewer words than a
    shingle has none.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    steps = [("w", words), ("h", F.expr("transform(w, x -> xxhash64(x))"))]
    steps.append(("s", F.expr(f"if(size(h) < {SHINGLE}, cast(array() as array<bigint>), h)")))
    for k in range(1, SHINGLE):
        steps.append(
            (
                "s",
                F.expr(
                    "if(size(s) = 0, s, zip_with(slice(s, 1, size(s) - 1), "
                    f"slice(h, {k + 1}, size(h) - {k}), (x, y) -> xxhash64(x, y)))"
                ),
            )
        )
    return steps


def with_shingles(df: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    held: list[str] = []
    for name, column in shingles(text):
        needed = [c for c in held if c != name and (c == "h" or name == "h")]
        df = df.select(*keep, *needed, *(["_text"] if name == "w" else []), column.alias(name))
        held = [*needed, name]
    return df.select(*keep, "s")


def templates(spark: SparkSession, notices: list[tuple[str, str, str]]) -> DataFrame:
    """`template`, `licence`, `t` (distinct shingles), `tier` of each notice.

    The tier is the least power of two that is no less than the number of shingles.
    """
    rows = F.array(
        *(
            F.struct(F.lit(n).alias("template"), F.lit(i).alias("licence"), F.lit(x).alias("_text"))
            for n, i, x in notices
        )
    )
    df = spark.range(1).select(F.explode(rows).alias("r")).select("r.*")
    df = with_shingles(df, F.col("_text"), ["template", "licence"])
    return df.select("template", "licence", F.array_distinct("s").alias("t")).withColumn(
        "tier", F.expr("cast(power(2, ceil(log2(size(t)))) as int)")
    )


def with_rivals(known: DataFrame) -> DataFrame:
    """`telling`: for each template of another licence that holds the share `CONTAINED`
    of this one's shingles, the shingles that only this one has."""
    own = known.select("template", "licence", "t", F.explode("t").alias("g"))
    other = known.select(
        F.col("template").alias("rival"),
        F.col("licence").alias("other"),
        F.col("t").alias("u"),
        F.explode("t").alias("g"),
    )
    shared = own.join(other, "g").where("licence <> other")
    close = shared.groupBy("template", "rival").agg(
        F.count("*").alias("n"), F.first("t").alias("t"), F.first("u").alias("u")
    )
    telling = (
        close.where(F.col("n") >= CONTAINED * F.size("t"))
        .groupBy("template")
        .agg(F.collect_list(F.array_except("t", "u")).alias("telling"))
    )
    nothing = F.expr("cast(array() as array<array<bigint>>)")
    return known.join(telling, "template", "left").withColumn(
        "telling", F.coalesce("telling", nothing)
    )


def _band_keys(shingle_array: str) -> Column:
    """MinHash of an array for each band; the band is part of the key."""
    least = f"array_min(transform({shingle_array}, x -> xxhash64(x, band)))"
    return F.expr(f"transform(sequence(1, {BANDS}), band -> xxhash64({least}, band))")


def licence_matches(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: list[tuple[str, str, str]] = NOTICES,
) -> DataFrame:
    """Notices found in texts: `doc_id`, `template`, `licence`, `n_shingles` of the
    template, `n_matched`, `containment` and `window_start` (in words).

    One row for each document and notice of which one window holds the share
    `CONTAINED` of its distinct shingles; the window is the one with most of them, the
    first of equal ones. Where another licence's notice holds as much of the notice, as
    with another version, the window must also hold half of the shingles that only this
    notice has. Null, empty and short texts give no rows; repeated rows with one
    id give one row. Other columns are not read. A notice of fewer than `SHINGLE` words
    is an error.

    For each tier of template lengths, texts are cut into overlapping windows such that
    any run of a template's length lies in one. Windows that share a MinHash with a
    template are compared with its shingles. Windows without any shingle of a template
    can neither share one nor be verified and are left out before hashing. All tables
    but the documents come from the notices; nothing is shuffled but the matches.
    """
    spark = docs.sparkSession
    known = staged(with_rivals(templates(spark, notices)), "notices")
    rows = known.collect()
    short = [r["template"] for r in rows if not r["t"]]
    if short:
        raise ValueError(f"notices of fewer than {SHINGLE} words: {short}")
    everything = sorted({x for r in rows for x in r["t"]})
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")
    )
    # As a generator, not a filter: Spark would copy all steps of `s` into a filter.
    near = F.arrays_overlap("s", F.array(*map(F.lit, everything)))
    found = with_shingles(source, F.col("_text"), ["doc_id"]).select(
        "doc_id", F.explode(F.when(near, F.array("s"))).alias("s")
    )
    tiers = []
    for tier in sorted({r["tier"] for r in rows}):
        stride = max(1, tier // 2)
        own = sorted({x for r in rows if r["tier"] == tier for x in r["t"]})
        starts = f"sequence(0, size(s) - 1, {stride})"
        window = f"slice(s, start + 1, {tier + stride - 1})"
        literal = ", ".join(f"bigint('{x}')" for x in own)
        tiers.append(
            f"transform(filter({starts}, start -> arrays_overlap({window}, array({literal}))), "
            f"start -> struct({tier} as tier, start as start, {window} as w))"
        )
    windows = found.select("doc_id", F.expr(f"explode(concat({', '.join(tiers)}))").alias("r"))
    banded = windows.select("doc_id", "r.*").select(
        "doc_id", "tier", "start", "w", F.explode(_band_keys("w")).alias("key")
    )
    by_band = known.select(
        "template", "licence", "t", "telling", "tier", F.explode(_band_keys("t")).alias("key")
    )
    # The notices times the bands: as small as the list of notices. A longer list than
    # any there is would be joined by a shuffle of the windows that are left.
    if len(everything) <= SENT:
        by_band = F.broadcast(by_band)
    told = F.expr("forall(telling, x -> 2 * size(array_intersect(w, x)) >= size(x))")
    joined = banded.join(by_band, ["tier", "key"]).where(told)
    matched = joined.select(
        "doc_id",
        "template",
        "licence",
        F.size("t").cast("long").alias("n_shingles"),
        F.size(F.array_intersect("w", "t")).cast("long").alias("n_matched"),
        F.col("start").cast("long").alias("window_start"),
    )
    enough = F.col("n_matched") >= CONTAINED * F.col("n_shingles")
    best = F.max(F.struct("n_matched", (-F.col("window_start")).alias("back"))).alias("best")
    return (
        matched.where(enough)
        .groupBy("doc_id", "template", "licence", "n_shingles")
        .agg(best)
        .select(
            "doc_id",
            "template",
            "licence",
            "n_shingles",
            F.col("best.n_matched").alias("n_matched"),
            (F.col("best.n_matched") / F.col("n_shingles")).alias("containment"),
            (-F.col("best.back")).alias("window_start"),
        )
    )
