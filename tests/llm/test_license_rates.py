"""Licence families of notices and of ordinary uses that training and calibration have not seen."""

from __future__ import annotations

import math
import random
from collections import Counter

from leafcut.llm import license_scan

#: Notices in forms of their own.
PLANTED = [
    ("License: MIT", "MIT"),
    ("Licence: GPLv3", "GPL-3.0"),
    ("Lizenziert unter der MIT-Lizenz.", "MIT"),
    ("Distributed under GPLv3", "GPL-3.0"),
    ("GPL v2 or later", "GPL-2.0"),
    ("Licensed under the GNU General Public License v2", "GPL-2.0"),
    ("Made available under the Eclipse Public License v2.0", "EPL-2.0"),
    ("You can redistribute it under the terms of the GNU Affero General Public License", "AGPL-3.0"),
    ("Code is under Apache License, Version 2.0", "Apache-2.0"),
    ("MPL 2.0", "MPL-2.0"),
    ("All rights reserved.", "all-rights-reserved"),
    ("Text and pictures: CC BY-SA 4.0", "CC-BY-SA"),
    ("released into the public domain under CC0", "public-domain"),
]
ORDINARY = ["Ich gehe mit dir.", "Mit.", "Nothing at all", "The licence was public", "He paid the licence fee with his own money.", "MIT was founded in 1861.", "An eclipse of the moon", "The general led them.", "Version 2 of it", "Free lunch for the public"]


def named(text):
    names, weights, bias = license_scan.trained()
    g = license_scan.ngrams(license_scan.words(text))
    z = [b + sum(weights[x][k] for x in g if x in weights) / max(1, len(g)) ** 0.5 for k, b in enumerate(bias)]
    p = [math.exp(x - max(z)) for x in z]
    return names[p.index(max(p))] if max(p) / sum(p) >= license_scan.CERTAIN else license_scan.UNKNOWN


def test_recall_and_false_alarms_by_family():
    _, apart = license_scan.uses(random.Random(99))
    right, every, wrong = Counter(), Counter(), 0
    for w, family in apart:
        got = named(" ".join(w))
        every[family] += 1
        right[family] += got == family
        wrong += family == license_scan.UNKNOWN != got
    families = [f for f in every if f != license_scan.UNKNOWN]
    assert sum(right[f] for f in families) / sum(every[f] for f in families) >= 0.88, (right, every)
    assert all(right[f] / every[f] >= 0.65 for f in families), (right, every)
    assert wrong <= 0.03 * every[license_scan.UNKNOWN]


def test_planted_notices_through_the_operator(spark):
    rows = [(i, t) for i, (t, _) in enumerate([*PLANTED, *((t, None) for t in ORDINARY)])]
    found = {r.doc_id: r.family for r in license_scan.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found.get(i) == f for i, (_, f) in enumerate(PLANTED)) >= len(PLANTED) - 1, found
    assert all(found.get(i, license_scan.UNKNOWN) == license_scan.UNKNOWN for i in range(len(PLANTED), len(rows))), found
    assert all(named(t) == (found.get(i) or license_scan.UNKNOWN) for i, t in rows)


def test_families_that_are_near_each_other(spark):
    rows = [(i, t) for i, t in enumerate(x for f in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL", "EPL-2.0", "MPL-2.0") for x in license_scan.TEMPLATES[f])]
    want = [f for f in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL", "EPL-2.0", "MPL-2.0") for _ in license_scan.TEMPLATES[f]]
    got = {}
    for r in license_scan.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r.family != license_scan.UNKNOWN:
            got[r.doc_id] = (r.family, r.confirmed)
    assert got == {i: (f, True) for i, f in enumerate(want)}


def test_the_plan_carries_a_bounded_number_of_weights():
    assert len(license_scan.trained()[1]) <= 2000
