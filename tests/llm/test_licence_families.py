"""Licence notices of one family are told apart; mentions are no notices; long texts and repeats hold."""

from __future__ import annotations

import random

import pytest

from gaugewise.llm.licences import GRAM, TEMPLATES, licence_words, scan_licences
from tests.llm.fixtures import prose

GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as "
    "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
CASES = [
    ("licensed under the GNU General Public License, version 3", "gpl-3"),
    ("licensed under the GNU General Public License, version 2", "gpl-2"),
    ("licensed under the GNU General Public License, version 1", "gpl-1"),
    ("licensed under the GNU Affero General Public License, version 3", "agpl-3"),
    ("licensed under the GNU Lesser General Public License, version 3", "lgpl-3"),
    ("licensed under the GNU Lesser General Public License, version 2.1", "lgpl-2.1"),
    ("licensed under the GNU GPL, version 2", "gpl-2"),
    ("licensed under the GNU LGPL version 3", "lgpl-3"),
    (GPL.format("General", "3"), "gpl-3"),
    (GPL.format("General", "2"), "gpl-2"),
    (GPL.format("General", "1"), "gpl-1"),
    (GPL.format("Affero General", "3"), "agpl-3"),
    (GPL.format("Lesser General", "2.1"), "lgpl-2.1"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("licensed under the Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "cc-by-nd"),
    ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", "cc-by-nc-sa"),
    ("licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "cc-by-nc-nd"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("Licensed under CC BY-ND 4.0", "cc-by-nd"),
    ("# SPDX-License-Identifier: MIT", "mit"),
    ("# SPDX-License-Identifier: MIT-0", "mit-0"),
    ("# SPDX-License-Identifier: Apache-2.0", "apache-2"),
    ("# SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3"),
    ("# SPDX-License-Identifier: LGPL-2.1-only", "lgpl-2.1"),
    ("# SPDX-License-Identifier: AGPL-3.0-only", "agpl-3"),
    ("# SPDX-License-Identifier: BSD-3-Clause", "bsd"),
    ("# SPDX-License-Identifier: ISC", "isc"),
    ("# SPDX-License-Identifier: CC-BY-SA-4.0", "cc-by-sa"),
    (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "isc",
    ),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("The author has waived all copyright and related or neighboring rights to this work.", "cc0"),
    ("made available under the terms of the Eclipse Public License v. 2.0", "epl-2"),
    ("© someone. All rights reserved.", "all-rights-reserved"),
    ("The GNU General Public License and the Mozilla Public License are both read by lawyers.", ""),
    ("In version 3 the general public may use this file; permission is granted by the office.", ""),
    ("Creative Commons is an organisation, and attribution is a courtesy.", ""),
]


@pytest.fixture(scope="module")
def labels_of(spark):
    rng = random.Random(3)
    rows = [(k, prose(rng, 30) + " — " + text + " — " + prose(rng, 30)) for k, (text, _) in enumerate(CASES)]
    rows += [(1000, "all rights reserved " * 30_000), (1001, " ".join(prose(rng, 40_000) for _ in range(2)) + CASES[3][0]), (1002, CASES[8][0] * 2)]
    rows += [(1003, CASES[0][0] + ". " + CASES[14][0])]
    return {r.doc_id: r.labels for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


@pytest.mark.parametrize("number", range(len(CASES)))
def test_family(labels_of, number):
    assert labels_of[number] == CASES[number][1]


def test_long_and_repeated(labels_of):
    assert labels_of[1000] == "all-rights-reserved"
    assert labels_of[1001] == "agpl-3"
    assert labels_of[1002] == "gpl-3"
    assert labels_of[1003] == "cc-by-sa,gpl-3"


def test_voting_against_brute_force(spark):
    """Every template, whole, with a word put in and with a word lost, is labelled as a plain search of its words says."""
    rng = random.Random(8)
    rows, want = [], {}
    for number, (label, text, must) in enumerate(TEMPLATES):
        words = text.split()
        place = rng.randrange(1, len(words))
        for k, kind in enumerate((words, [*words[:place], "zzz", *words[place:]], words[1:])):
            grams = {tuple(kind[i : i + GRAM]) for i in range(len(kind) - GRAM + 1)}
            size, best = len(words) - GRAM + 1, None
            for n, (name, other, needed) in enumerate(TEMPLATES):
                own = other.split()
                have = [tuple(own[i : i + GRAM]) in grams for i in range(len(own) - GRAM + 1)]
                # a phrase is said if a matched k-gram of the template holds it
                said = all(
                    any(h and phrase in " ".join(own[i : i + GRAM]) for i, h in enumerate(have)) for phrase in needed
                )
                if sum(have) / len(have) >= 0.7 and said:
                    found = (sum(have) / len(have), sum(have), -n, name)
                    best = found if best is None or found > best else best
            assert size > 0
            rows.append((3 * number + k, prose(rng, 12) + " " + " ".join(kind) + " " + prose(rng, 12)))
            want[3 * number + k] = best[3] if best else ""
        assert want[3 * number] == label and all(p in text for p in must)
    found = scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in found:
        # base labels are found beside those of the notices
        own = set(filter(None, r.labels.split(",")))
        assert own == set(filter(None, r.base_labels.split(","))) | {want[r.doc_id]} - {""}, (rows[r.doc_id], want[r.doc_id])


def test_words_of_null(spark):
    from pyspark.sql import functions as F

    assert spark.range(1).select(licence_words(F.lit(None).cast("string")).alias("w")).first().w == []
