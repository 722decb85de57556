"""Licence scans with DataFrame operations only: a trained paragraph classifier, confirmed by templates.

Texts are cut into paragraphs. Every paragraph that holds a known n-gram is scored by a sparse multinomial logistic
regression over word 1-grams and 2-grams, trained on licence notices and on ordinary uses of their words; `unknown` is a
class of its own. A temperature and the weight of unknown are calibrated on notices and ordinary uses kept out of training;
a family below the probability CERTAIN is unknown too. The paragraph's word 3-grams are then
compared with the family's templates: a prediction is confirmed if enough of some template, or of the paragraph, is covered.

Defined results: null and empty texts have no paragraphs; every paragraph with a family gives a row; an unknown one gives a
row if it has a cue, if its n-grams together speak for the families, or if a template confirms any family; equal
probabilities go to the first family by name; equal templates to the first by number; every copy of a document is reported,
fully repeated rows as one, and rows that share an identifier, or have none, by their own paragraphs; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import functools
import json
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
#: Opening words of public licence notices by family; fixed values.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "You should have received a copy of the GNU General Public License along with this program",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "You should have received a copy of the GNU Affero General Public License along with this program",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 2.1 or later.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "public-domain": ("This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"),
    "all-rights-reserved": ("All rights reserved.", "Copyright (c) 2021 The Authors.", "Copyright (c) 2020 The Authors. All rights reserved.", "All rights reserved. No part of this publication may be reproduced, distributed or transmitted in any form without the prior written permission of the publisher."),
}
#: What families are called in short notices, and the forms of these; fixed values.
SHORT = {
    "MIT": ("MIT", "Expat"), "Apache-2.0": ("Apache 2.0", "Apache-2.0", "Apache"), "GPL-3.0": ("GPLv3", "GPL-3.0", "GPL v3", "GPL 3", "GNU GPL version 3", "GNU General Public License v3"), "GPL-2.0": ("GPLv2", "GPL-2.0", "GPL v2", "GPL 2", "GNU GPL version 2", "GNU General Public License v2"),
    "AGPL-3.0": ("AGPLv3", "AGPL-3.0", "AGPL v3", "GNU AGPL", "GNU Affero General Public"), "LGPL": ("LGPL", "LGPL-2.1", "LGPLv3", "GNU Lesser General Public"), "EPL-2.0": ("EPL", "EPL-2.0", "Eclipse Public"),
    "BSD": ("BSD", "BSD 3-Clause", "BSD-2-Clause", "3-clause BSD"), "MPL-2.0": ("MPL", "MPL 2.0", "MPL-2.0", "Mozilla Public"), "CC-BY": ("CC BY 4.0", "CC-BY-4.0", "CC BY"), "CC-BY-SA": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "CC BY-SA"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "CC BY-NC"), "public-domain": ("CC0", "CC0-1.0", "Unlicense"),
}
NOTICES = ("License: {}", "Licence: {}", "License {}", "{} License", "{} licence", "Licensed under {}", "Licensed under the {} license.", "Released under {}.", "Distributed under the {} license", "SPDX-License-Identifier: {}", "This code is {} licensed.", "Lizenz: {}", "Lizenziert unter der {}-Lizenz.", "Licence : {}", "Licencia: {}", "(c) the authors, {} license")
#: Ordinary uses of the same words, for the unknown class; every fourth is kept out of training.
ORDINARY = (
    "A driving licence is needed to hire a car in this town.", "She had permission to leave early and went home.", "The warranty on the engine expired last winter.", "Copyright law was debated for three days in parliament.",
    "The version that was released in spring is faster.", "The general public was invited to the free concert.", "Fishing without a license is not permitted at the lake.", "The committee discussed the conditions of the agreement.",
    "He works for a foundation that gives away software and books.", "The court held that the license had been revoked.", "Apache helicopters flew over the valley.", "MIT is a university in Cambridge, Massachusetts.",
    "The author of this work lives near the sea.", "Commons are lands that all villagers share.", "The public domain of the palace includes the gardens.", "Attribution of the painting is disputed by experts.",
    "Redistribution of land was the promise of the new party.", "You may not use this entrance after ten.", "A copy of the report was sent to every person in the room.", "The rights of workers are reserved for the next session.",
    "The clause in the contract concerns the sale of goods.", "License plates must be visible from behind.", "The terms of the loan were published by the bank.", "Free entry for children under the age of six.",
    "An eclipse of the sun was seen by the public in the north.", "The general who led the army was a free man again.", "Wir fahren mit dem Zug und mit dem Bus in die Stadt.", "Sie kam mit ihrer Schwester und ging mit ihm nach Hause.",
    "Er hat den Brief mit der Hand geschrieben.", "Die Lizenz des Senders wurde nicht verlängert.", "La licence de chasse est valable un an.", "La licencia de obras fue negada por la ciudad.",
    "A licence: that was all he wanted.", "Version 3 of the plan was worse than version 2.", "The gnu is a large animal of the African plains.", "Mozilla was the name of a lizard in a drawing.",
    "Students of MIT and of other schools met by the river.", "Licensed premises close at eleven in this county.", "The Apache people lived in the mountains.", "The 2.0 litre engine burns more fuel than the 3.0 one.",
    "Mit.", "Mit der Zeit.",
)
#: An unknown paragraph with one of these gives a row in any case.
CUES = ("licens", "licenc", "copyright", "permission", "warrant", "redistribut", "public domain", "creative commons", "cc by", "cc-by", "cc0", "public license", "rights reserved", "spdx", "lizenz")
#: Below this probability, after calibration, a family is unknown; the share of ordinary uses kept out that calibration lets be named, or speak for families, at most; the share of a template or paragraph that confirms.
CERTAIN, WRONG, COVERED = 0.55, 0.01, 0.5
_WORD = r"[a-z0-9]+"


def words(text: str) -> list[str]:
    return re.findall(_WORD, text.lower())


def ngrams(w: list[str]) -> set[str]:
    return {*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))}


def uses(rng: random.Random) -> tuple[list[tuple[list[str], str]], list[tuple[list[str], str]]]:
    """(words, family) for training, and such kept out of it: notices cut short and with other words around, short notices, ordinary sentences and mixed words. What is kept out has forms or sentences of its own."""
    learn, apart = [], []
    plain = [words(t) for k, t in enumerate(ORDINARY) if k % 4 != 3]
    filler, every = [x for w in plain for x in w], [x for ts in TEMPLATES.values() for t in ts for x in words(t)]

    def around(w: list[str]) -> list[str]:
        noise = [rng.choice(filler) for _ in range(rng.choice((0, 0, 0, 3, 8)))]
        return w + noise if rng.random() < 0.5 else noise + w

    for name in sorted(TEMPLATES):
        for t in TEMPLATES[name]:
            w = words(t)
            for j in range(15):
                a = rng.randint(0, max(0, len(w) // 4)) if len(w) > 8 else 0
                b = rng.randint(min(len(w), max(5, len(w) // 2)), len(w))
                (apart if j >= 12 else learn).append((around(w[a:b]), name))
        for i, short in enumerate(SHORT.get(name, ())):
            for j, form in enumerate(NOTICES):
                (apart if (i + j) % 4 == 3 else learn).append((around(words(form.format(short))), name))
    for k, t in enumerate(ORDINARY):
        (apart if k % 4 == 3 else learn).extend([(words(t), UNKNOWN)] * (1 if k % 4 == 3 else 6))
    for k in range(500):
        w = [rng.choice(filler) if rng.random() < 0.7 else rng.choice(every) for _ in range(rng.choice((1, 2, *(rng.randint(3, 25) for _ in range(6)))))]
        (apart if k % 4 == 3 else learn).append((w, UNKNOWN))
    return learn, apart


@functools.cache
def trained(seed: int = 3, rounds: int = 250, decay: float = 0.002) -> tuple[tuple[str, ...], dict[str, tuple[float, ...]], tuple[float, ...]]:
    """Families, weights by n-gram, and biases, with the temperature and the weight of unknown that calibration finds: the temperature of greatest likelihood on what was kept out, then as little more for unknown as leaves at most WRONG of its ordinary uses a family."""
    names = (*sorted(TEMPLATES), UNKNOWN)
    learn, apart = uses(random.Random(seed))
    called = {x for ts in SHORT.values() for t in ts for x in words(t)}
    known = {g for t in TEMPLATES.values() for x in t for g in ngrams(words(x))}
    known |= {g for w, f in learn if f != UNKNOWN for g in ngrams(w) if any(x.startswith(("licen", "lizen")) or x in called for x in g.split()) and all(x.startswith(("licen", "lizen")) or x in called for x in g.split())}
    vocabulary = {g: i for i, g in enumerate(sorted(known))}

    def rows(uses: list[tuple[list[str], str]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(uses), len(vocabulary) + 1))
        for i, (w, _) in enumerate(uses):
            g = ngrams(w)
            x[i, [vocabulary[v] for v in g if v in vocabulary]] = 1 / max(1, len(g)) ** 0.5
            x[i, -1] = 1
        return x, np.eye(len(names))[[names.index(f) for _, f in uses]]

    def share(z: np.ndarray) -> np.ndarray:
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    x, y = rows(learn)
    w, scale = np.zeros((x.shape[1], len(names))), np.full((x.shape[1], len(names)), 1e-8)
    for _ in range(rounds):
        g = x.T @ (share(x @ w) - y) / len(learn) + decay * np.r_[w[:-1], np.zeros((1, len(names)))] / 100
        scale += g**2
        w -= 0.5 * g / np.sqrt(scale)
    x, y = rows(apart)
    w /= min((0.3 + 0.05 * k for k in range(40)), key=lambda t: -np.log((share(x @ w / t) * y).sum(1)).sum())
    plain = x[y[:, -1] == 1]
    while (share(plain @ w)[:, :-1].max(1) >= CERTAIN).mean() > WRONG:
        w[-1, -1] += 0.05
    return names, {v: tuple(w[i]) for v, i in vocabulary.items()}, tuple(w[-1])


@functools.cache
def speaking(seed: int = 3) -> float:
    """The share that all families together have in an unknown paragraph that speaks for them: more than all but WRONG of the ordinary uses kept out of training give them."""
    names, weights, bias = trained(seed)
    shares = []
    for w, family in uses(random.Random(seed))[1]:
        if family == UNKNOWN:
            g = ngrams(w)
            z = np.array(bias) + sum((np.array(weights[v]) for v in g if v in weights), np.zeros(len(names))) / max(1, len(g)) ** 0.5
            p = np.exp(z - z.max())
            shares.append(1 - float(p[-1] / p.sum()))
    return float(np.quantile(shares, 1 - WRONG))


def _constant(spark, rows: list, schema: str) -> DataFrame:
    """A table of fixed size that is part of the plan."""
    return spark.sql("SELECT 1 AS _one").select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _next(w: Column, grams: Column, n: int) -> Column:
    """Word n-grams from the words and their (n - 1)-grams, in order."""
    k = F.greatest(F.size(w) - (n - 1), F.lit(0))
    return F.zip_with(F.slice(grams, F.lit(1), k), F.slice(w, F.lit(n), k), lambda a, b: F.concat(a, F.lit(" "), b))


def paragraphs(docs: DataFrame, known: list[str], templates: list[str]) -> DataFrame:
    """(doc_id, par, a hash sig of the paragraph, cue, n n-grams, those known among them, m 3-grams, those of templates t3) of each paragraph with a cue or a known n-gram; par counts all paragraphs of a text from 0."""
    cut = docs.select("doc_id", F.posexplode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"\n+|(?<=[.!?])\s+(?=\p{Lu})")).alias("par", "p")).withColumn("sig", F.xxhash64("p"))
    low = F.lower("p")
    # Arrays of one row name what is used twice; exploding them keeps it from being made again.
    one = F.transform(F.array(F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))), lambda w: F.struct(w.alias("w"), _next(w, w, 2).alias("w2")))
    one = F.transform(one, lambda r: F.struct(r["w"].alias("w"), r["w2"].alias("w2"), F.array_distinct(F.concat(r["w"], r["w2"])).alias("own")))
    one = F.transform(one, lambda r: F.struct(r["w"].alias("w"), r["w2"].alias("w2"), F.size(r["own"]).alias("n"), F.filter(r["own"], lambda g: g.isin(known)).alias("known")))
    cue = functools.reduce(lambda a, b: a | b, (F.contains(low, F.lit(x)) for x in CUES))
    some = cut.select("doc_id", "par", "sig", cue.alias("cue"), F.explode(one).alias("r")).filter(F.col("cue") | (F.size("r.known") > 0))
    # The 2-grams of templates are all known, so no other paragraph has a 3-gram of theirs.
    t3 = F.when(F.exists("r.known", lambda g: F.contains(g, F.lit(" "))), F.array_distinct(_next(F.col("r.w"), F.col("r.w2"), 3))).otherwise(F.array().cast("array<string>"))
    return some.select("doc_id", "par", "sig", "cue", "r.n", "r.known", F.explode(F.transform(F.array(t3), lambda t: F.struct(F.size(t).alias("m"), F.filter(t, lambda g: g.isin(templates)).alias("t3")))).alias("s")).select("doc_id", "par", "sig", "cue", "n", "known", "s.m", "s.t3")


def find_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, par, family, probability, template, covered, confirmed for each paragraph that names a licence or may name one."""
    spark = docs.sparkSession
    names, weights, bias = trained()
    k = len(names)
    table = F.from_json(F.lit(json.dumps({g: [round(v, 6) for v in ws] for g, ws in weights.items()})), "map<string,array<double>>")
    shingles = [(f, i, words(t)) for i, (f, t) in enumerate((f, t) for f in sorted(TEMPLATES) for t in TEMPLATES[f])]
    rows = [{"t3": " ".join(w[j : j + 3]), "fam": f, "tid": i, "size": max(1, len({tuple(w[j : j + 3]) for j in range(len(w) - 2)}))} for f, i, w in shingles for j in range(max(1, len(w) - 2))]
    compare = _constant(spark, rows, "t3:string, fam:string, tid:int, size:int").distinct()
    found = paragraphs(docs, sorted(weights), sorted({r["t3"] for r in rows}))
    sums = F.aggregate("known", F.array(*[F.lit(0.0)] * k), lambda z, g: F.zip_with(z, F.element_at(table, g), lambda a, b: a + b))
    logits = F.zip_with(F.array(*(F.lit(float(b)) for b in bias)), sums, lambda b, x: b + x / F.sqrt(F.greatest(F.col("n"), F.lit(1)).cast("double")))
    each = found.select("doc_id", "par", "sig", "cue", "m", "t3", F.explode(F.array(logits)).alias("z")).withColumn("top", F.array_max("z"))
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    best = F.get(F.array(*map(F.lit, names)), (F.array_position("z", F.col("top")) - 1).cast("int"))
    told = each.select("doc_id", "par", "sig", "cue", "m", "t3", best.alias("best"), F.explode(F.array(total)).alias("total"), (F.get("z", F.lit(k - 1)) - F.col("top")).alias("un"))
    told = told.select("doc_id", "par", "sig", "m", "t3", F.when(1 / F.col("total") >= CERTAIN, F.col("best")).otherwise(UNKNOWN).alias("family"), (1 / F.col("total")).alias("probability"), (F.col("cue") | (1 - F.exp("un") / F.col("total") > speaking())).alias("speaks"))
    scored = told.filter((F.col("family") != UNKNOWN) | F.col("speaks") | (F.size("t3") > 0)).distinct()
    row = ["doc_id", "par", "sig", "family", "probability", "speaks"]
    hits = scored.select(*row, "m", F.explode_outer("t3").alias("t3")).join(F.broadcast(compare), "t3", "left").groupBy(*row, "m", "fam", "tid", "size").agg(F.count("*").alias("hit"))
    cover = F.greatest(F.col("hit") / F.col("size"), F.col("hit") / F.greatest(F.col("m"), F.lit(1)))
    near = F.when(F.col("fam").isNotNull(), F.struct(cover.alias("covered"), (-F.col("tid")).alias("t")))
    out = hits.withColumn("near", near).groupBy(*row).agg(F.max("near.covered").alias("any"), F.max(F.when(F.col("fam") == F.col("family"), F.col("near"))).alias("b"))
    out = out.filter((F.col("family") != UNKNOWN) | F.col("speaks") | (F.col("any") >= COVERED))
    return out.select("doc_id", "par", "family", "probability", (-F.col("b.t")).alias("template"), F.coalesce("b.covered", F.lit(0.0)).alias("covered"), (F.coalesce("b.covered", F.lit(0.0)) >= COVERED).alias("confirmed"))
