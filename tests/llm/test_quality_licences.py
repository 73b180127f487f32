from collections import Counter

import pytest
from conftest_llm import prose
from pyspark.sql import functions as F

from yearling.llm import quality
from yearling.llm.licences import LONG, NOTICES, licence_matches
from yearling.llm.quality import ablations, ledger, mask, verdict


def measured(text):
    raw = (text or "").encode()
    w = [x.decode() for x in raw.split()]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    inside = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(w),
        sum(map(len, w)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_measures_equal_brute_force(table):
    texts = {
        1: None,
        2: "a b c d e f g h a b c d e f g h",
        3: "a " * 9,
        4: "x" + " a b c d e f g h" * 3 + " tail",
        5: prose(1, 300),
        6: "l one\nl two\nl one\n \nl one",
        7: "Éé     # <> |\r\n\x0b\x0c &&",
        8: "a b c d e f g",
        9: "a b c d e f g h",
        10: " ".join("ab"[i % 2] for i in range(33)),
        11: prose(2, 40) + " " + prose(3, 9) + " " + prose(2, 40),
    }
    for r in ledger(table(texts)).collect():
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert found == measured(texts[r.doc_id]), r.doc_id


def test_bits_policies_and_ablations(table):
    good, capitals = prose(1, 60), prose(2, 60).upper()
    texts = {1: good, 2: "few", 3: good + " ### $$$ %%% &&&", 4: capitals, 5: "A B ###"}
    rows = ledger(table(texts))
    bits = {r.doc_id: r.failures for r in rows.collect()}
    assert bits[1] == 0 and bits[2] == mask(["few_words"])
    assert bits[3] == mask(["symbols"]) and bits[4] == mask(["capitals"])
    assert bits[5] & mask(["few_words", "symbols", "capitals"])
    kept = {v: {r[0] for r in rows.where(verdict(v)).select("doc_id").collect()} for v in (1, 2)}
    assert kept == {1: {1, 3, 4}, 2: {1}}
    found = {r.rule: r for r in ablations(rows, 2).collect()}
    for name, place in ((n, i) for i, (n, _) in enumerate(quality.RULES)):
        own = 1 << place
        assert found[name].failed == sum(1 for b in bits.values() if b & own)
        assert found[name].failed_alone == sum(1 for b in bits.values() if b == own)
        assert found[name].kept_without == sum(1 for b in bits.values() if not b & ~own)


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = ledger(docs).join(labels, "doc_id")
    good = rows.where("quality = 1 and n_words >= 20").agg(
        F.avg(verdict(2).cast("int")).alias("kept")
    )
    bad = rows.where("quality = 0").agg(F.avg(verdict(2).cast("int")).alias("kept"))
    assert good.first().kept > 0.99
    assert bad.first().kept < 0.1


def licences_of(table, texts):
    found = {i: set() for i in texts}
    for r in licence_matches(table(texts)).collect():
        found[r.doc_id].add(r.licence)
    return found


def test_every_template_tells_its_licence_only(table):
    texts = {i: f"{prose(i, 30)}. {n[2]} {prose(i + 500, 30)}" for i, n in enumerate(NOTICES)}
    found = licences_of(table, texts)
    assert found == {i: {n[1]} for i, n in enumerate(NOTICES)}
    assert len({n[0] for n in NOTICES}) == len(NOTICES)


PHRASES = {
    "Copyright 2020 Someone. Distributed under the MIT license.": "MIT",
    "This code is licensed under the MIT License.": "MIT",
    "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "All of it is licensed under CC BY 4.0.": "CC-BY-4.0",
    "Text is licensed under CC BY-NC 4.0 unless said otherwise": "CC-BY-NC-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
    "License.": "CC-BY-NC-4.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0-only",
    "This program is free software; you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation; either version "
    "2 of the License, or (at your option) any later version.": "GPL-2.0-or-later",
    "This file is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU Affero General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version.": "AGPL-3.0-or-later",
    "This library is free software; you can redistribute it and/or modify it under the terms of "
    "the GNU Lesser General Public License as published by the Free Software Foundation; either "
    "version 2.1 of the License, or (at your option) any later version.": "LGPL-2.1-or-later",
    "This is free and unencumbered software released into the public domain. Anyone is free to "
    "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
    "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
    "any means. In jurisdictions that recognize copyright laws": "Unlicense",
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: * Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. * Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT "
    'HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES': "BSD-2-Clause",
}


def test_other_phrasings_give_the_right_licence(table):
    texts = {i: f"{prose(i, 40)}\n{x}\n{prose(i + 99, 40)}" for i, x in enumerate(PHRASES)}
    assert licences_of(table, texts) == {i: {x} for i, x in enumerate(PHRASES.values())}


def test_two_versions_in_one_text(table):
    by_name = {n[0]: n[2] for n in NOTICES}
    both = f"{by_name['gpl2_notice']} {prose(1, 200)} {by_name['gpl3_notice']}"
    terms = f"{by_name['bsd3_terms']} {prose(2, 300)} {by_name['bsd2_terms']}"
    older = by_name["gpl3_notice"].replace("version 3", "version 1")
    found = licences_of(table, {1: both, 2: terms, 3: older})
    assert found == {
        1: {"GPL-2.0-or-later", "GPL-3.0-or-later"},
        2: {"BSD-2-Clause", "BSD-3-Clause"},
        3: set(),
    }


@pytest.mark.parametrize("name", [n[0] for n in LONG])
def test_each_notice_is_found(table, name):
    notice = dict((n[0], n[2]) for n in NOTICES)[name]
    w = notice.split()
    middle = len(w) // 2
    texts = {
        1: notice,
        2: prose(1, 333) + "\n" + notice.upper() + "\n" + prose(2, 50),
        3: prose(3, 7) + " " + " ".join(w[:middle]),
        4: prose(4, 100),
    }
    found = {(r.doc_id, r.template): r.containment for r in licence_matches(table(texts)).collect()}
    assert found[1, name] == found[2, name] == 1
    assert (4, name) not in found and not any(d == 4 for d, _ in found)
    assert found.get((3, name), 1) >= 0.8


def test_a_changed_word_in_a_long_notice(table):
    notice = dict((n[0], n[2]) for n in NOTICES)["apache_notice"]
    changed = notice.replace("compliance", "accordance")
    found = {r.template: r.containment for r in licence_matches(table({1: changed})).collect()}
    assert 0.8 <= found["apache_notice"] < 1


def test_short_notices_are_refused(table):
    with pytest.raises(ValueError, match="tiny"):
        licence_matches(table({1: "a"}), notices=[("tiny", "X", "too short")])


def test_no_python_on_the_main_path(table, plan):
    docs = table({1: "a b"})
    for found in (ledger(docs), licence_matches(docs)):
        text = plan(found)
        assert not any(k in text for k in ("Python", "Pandas", "Arrow"))
