"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

A paragraph is the set of its words and word pairs. A sparse multinomial logistic regression
over the n-grams of licence templates gives each paragraph a family, or "unknown"; it is
fitted on templates with words dropped and added, and on a bounded sample of paragraphs of
the corpus and notices of licences that are not listed, which teach it the unknown class. A
temperature fitted on held-back examples calibrates the probabilities, and a family below the
threshold is unknown too. A prediction is confirmed when the paragraph contains enough of a
template of that family, names the family and doesn't deny the licence. What the
templates of a family explain is then taken out of the paragraph, and what is left is asked
again, so that a paragraph may carry several licences.

Paragraphs are the lines of a text, and besides windows over its words that don't stop at
line ends, for notices wrapped over lines. Two windows share as many words as the longest
template has, so each notice lies whole in one.

The fitting is numpy on the driver. The scan is DataFrame functions only: it needs no
shuffle, for a document is scanned inside its own row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlake.llm.common import free_name, sample_of_texts, text_of

#: Paragraphs of the corpus that teach the unknown class.
MAX_BACKGROUND = 4000
#: An n-gram in a larger share of the background paragraphs is no sign of a licence.
COMMON = 0.002
#: A paragraph that contains so much of a template confirms its family.
SIMILAR = 0.6
UNKNOWN = "unknown"
#: Words that say little; a text without any other word of the templates confirms none.
PLAIN = set("a all an and any are as be been by can following for has in is it may met no not of or part that the this to under use with without you".split())

# What licence notices say, by family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "This software is distributed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the GNU Lesser General Public License, version 3 or later.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-nc-sa": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc-nd": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "epl": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "zlib": [
        "Released under the zlib License.",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "SPDX-License-Identifier: Zlib",
    ],
    "artistic": [
        "Licensed under the Artistic License 2.0.",
        "SPDX-License-Identifier: Artistic-2.0",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "This software is proprietary and confidential.",
    ],
}
# N-grams that name a family; a paragraph with none of them doesn't confirm it.
NAMING = {
    "apache": ["apache license", "apache 2.0", "apache-2.0"],
    "mit": ["mit license", "granted free", "spdx-license-identifier mit"],
    "gpl": ["gnu general", "gpl", "gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later", "gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later"],
    "lgpl": ["lesser general", "lgpl", "lgpl-2.1", "lgpl-2.1-only", "lgpl-2.1-or-later", "lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later"],
    "bsd": ["binary forms", "bsd", "bsd-style", "bsd-2-clause", "bsd-3-clause"],
    "mpl": ["mozilla public", "mpl", "mpl-2.0"],
    "cc-by": ["cc by", "commons attribution", "cc-by-4.0"],
    "cc-by-nc": ["cc by-nc", "commons attribution-noncommercial", "cc-by-nc-4.0"],
    "cc-by-sa": ["cc by-sa", "commons attribution-sharealike", "cc-by-sa-4.0"],
    "cc-by-nd": ["cc by-nd", "commons attribution-noderivatives", "cc-by-nd-4.0"],
    "cc-by-nc-sa": ["cc by-nc-sa", "commons attribution-noncommercial-sharealike", "cc-by-nc-sa-4.0"],
    "cc-by-nc-nd": ["cc by-nc-nd", "commons attribution-noncommercial-noderivatives", "cc-by-nc-nd-4.0"],
    "agpl": ["affero general", "agpl", "agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later"],
    "isc": ["isc license", "without fee", "spdx-license-identifier isc"],
    "epl": ["eclipse public", "epl", "epl-2.0"],
    "boost": ["boost software", "bsl-1.0"],
    "unlicense": ["unencumbered software", "unlicense"],
    "zlib": ["zlib", "provided as-is"],
    "artistic": ["artistic license", "artistic-2.0"],
    "public-domain": ["public domain", "cc0", "waived all"],
    "proprietary": ["rights reserved", "is proprietary"],
}
# Word pairs by which a paragraph denies the licence that it names.
DENYING = ["not licensed", "not released", "not distributed", "not covered", "not available", "not published", "no longer", "never licensed", "never released"]
# Notices of licences that are no family here.
UNLISTED = [
    "Licensed under the European Union Public Licence, version 1.2.",
    "This file is subject to the terms of the Common Development and Distribution License, version 1.0.",
    "This software is licensed under the Microsoft Public License.",
    "Distributed under the Open Software License version 3.0.",
    "Released under the PostgreSQL License.",
    "Licensed under the Python Software Foundation License Version 2.",
    "This program is made available under the terms of the Common Public License 1.0.",
    "SPDX-License-Identifier: WTFPL",
]
# Sentences about licences that name none.
NOT_LICENCES = [
    "You need a driving license to rent a car.",
    "The council may grant a licence to sell alcohol.",
    "The software version was released last year under another name.",
    "A general public meeting on work and attribution was held.",
    "The project is free and open to any person.",
    "Copyright is a right of the author.",
    "The following conditions are met by the library.",
    "Permission is needed to use this source.",
]

_TOKEN = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"
_PY_TOKEN = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def grams_of(text: str) -> list[str]:
    """Distinct words and word pairs, as the scan sees them."""
    words = _PY_TOKEN.findall(text.lower())
    return list(dict.fromkeys(words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]))


def words_of(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(_TOKEN), F.lit(0))


def grams_column(paragraph: Column) -> Column:
    return grams_of_words(words_of(paragraph))


def grams_of_words(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.transform(
        F.arrays_zip(F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b")),
        lambda p: F.concat_ws(" ", p["a"], p["b"]),
    )
    return F.array_distinct(F.concat(words, pairs))


def template_grams(template: str) -> list[str]:
    """n-grams that confirm a template; of three words only the pairs, for two of the words say nothing."""
    grams = grams_of(template)
    return [g for g in grams if " " in g] if len(grams) == 5 else grams


@dataclass
class LicenceModel:
    families: list[str]  # the last is the unknown class
    features: list[str]
    weights: np.ndarray  # features by families
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, grams: list[str]) -> np.ndarray:
        at = {f: i for i, f in enumerate(self.features)}
        return self.bias + self.weights[[at[g] for g in grams if g in at]].sum(axis=0)

    def anchors(self) -> list[str]:
        """n-grams that speak for some family; without one, a paragraph is unknown."""
        speaks = (self.weights[:, :-1] - self.weights[:, -1:]).max(axis=1) > 0
        return [f for f, s in zip(self.features, speaks, strict=True) if s]


def _examples(seed: int) -> tuple[list[list[str]], list[str]]:
    """n-grams of templates, whole and with words dropped, doubled or put around."""
    rng = np.random.default_rng(seed)
    filler = [w for s in NOT_LICENCES for w in s.split()]
    texts, families = [], []
    cases = [(t, f) for f, own in TEMPLATES.items() for t in own] + [(t, UNKNOWN) for t in [*NOT_LICENCES, *UNLISTED]]
    for text, family in cases:
        words = text.split()
        for k in range(24):
            kept = [w for w in words if k == 0 or rng.random() > 0.12]
            around = list(rng.choice(filler, rng.integers(0, 6))) if k % 3 else []
            texts.append(grams_of(" ".join([*around, *kept])))
            families.append(family)
    # Paragraphs that say nothing are most of a corpus.
    texts += [[]] * len(texts)
    families += [UNKNOWN] * (len(texts) - len(families))
    return texts, families


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fit(x: np.ndarray, y: np.ndarray, k: int, penalty: float, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression with a lasso penalty, by proximal gradient."""
    target = np.eye(k)[y]
    # Classes weigh alike, however many examples they have.
    share = (1.0 / np.bincount(y, minlength=k).clip(1))[y]
    share /= share.sum()
    w, b = np.zeros((x.shape[1], k)), np.zeros(k)
    look, before = w.copy(), w.copy()
    step = 2.0 / ((share[:, None] * x * x).sum(axis=0).sum() + 1.0)
    for i in range(steps):
        slope = share[:, None] * (_softmax(x @ look + b) - target)
        moved = look - step * x.T @ slope
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0.0)
        b -= step * slope.sum(axis=0)
        look, before = w + i / (i + 3) * (w - before), w
    return w, b


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    tried = np.geomspace(0.1, 5.0, 60)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def fit_licences(docs: DataFrame | None = None, text: str = "text", penalty: float = 2e-4, seed: int = 3) -> LicenceModel:
    """Train on the templates and a bounded sample of the paragraphs of ``docs``.

    The sample is one paragraph, chosen by a hash, of about ``MAX_BACKGROUND`` distinct texts with
    small hashes; only the n-grams that templates know of it reach the driver. Every
    fourth example is held back to fit the temperature.
    """
    examples, names = _examples(seed)
    families = [*TEMPLATES, UNKNOWN]
    counts: dict[str, int] = {}
    for grams, name in zip(examples, names, strict=True):
        if name != UNKNOWN:
            for g in grams:
                counts[g] = counts.get(g, 0) + 1
    known = sorted((g for t in TEMPLATES.values() for s in t for g in grams_of(s)), key=lambda g: (-counts.get(g, 0), g))
    known = list(dict.fromkeys(known))
    background: list[list[str]] = []
    if docs is not None:
        sample = sample_of_texts(docs, text, MAX_BACKGROUND).where("text <> ''")
        paragraph = _let(
            F.filter(F.split("text", "\n"), lambda p: F.trim(p) != ""),
            lambda all_: F.try_element_at(all_, (F.pmod(F.xxhash64("text"), F.greatest(F.size(all_), F.lit(1))) + 1).cast("int")),
        )
        hits = F.array_intersect(grams_column(F.coalesce(paragraph, F.lit(""))), F.array(*map(F.lit, known)))
        # Paragraphs that are licences themselves don't teach what is none.
        own = [set(template_grams(t)) for texts in TEMPLATES.values() for t in texts]
        rows = [list(r["g"]) for r in sample.select(hits.alias("g")).collect()]
        background = [g for g in rows if max(len(t.intersection(g)) / len(t) for t in own) < SIMILAR]
        seen: dict[str, int] = {}
        for grams in background:
            for g in grams:
                seen[g] = seen.get(g, 0) + 1
        known = [g for g in known if seen.get(g, 0) <= max(2.0, COMMON * len(background))]
    features = known
    at = {f: i for i, f in enumerate(features)}
    examples += background
    names += [UNKNOWN] * len(background)
    x = np.zeros((len(examples), len(features)))
    for i, grams in enumerate(examples):
        x[i, [at[g] for g in grams if g in at]] = 1.0
    y = np.array([families.index(n) for n in names])
    held = np.arange(len(y)) % 4 == 3
    w, b = _fit(x[~held], y[~held], len(families), penalty)
    used = np.abs(w).max(axis=1) > 1e-6
    model = LicenceModel(families, [f for f, u in zip(features, used, strict=True) if u], w[used], b)
    model.temperature = _temperature(x[held][:, used] @ model.weights + b, y[held])
    return model


def template_words() -> int:
    """Words of the longest template."""
    return max(len(_PY_TOKEN.findall(t)) for own in TEMPLATES.values() for t in own)


def telling_words(similarity: float) -> list[str]:
    """Words of which a text must have one, or no template can be confirmed in it."""
    telling: set[str] = set()
    for template in (t for own in TEMPLATES.values() for t in own):
        grams = template_grams(template)
        words = sorted(set(_PY_TOKEN.findall(template.lower())), key=lambda w: (w in PLAIN, -len(w), w))
        for w in words:
            if sum(not telling.intersection(g.split()) for g in grams) < similarity * len(grams):
                break
            telling.add(w)
    return sorted(telling)


def _any_gram(grams: list[str]) -> str:
    """Matches where one of the words or word pairs stands; a pair's words may have anything but words between them."""
    by_first: dict[str, list[str]] = {}
    for g in grams:
        escaped = r"[^\p{L}\p{N}]+".join(re.escape(w).replace(r"\-", "-") for w in g.split())
        by_first.setdefault(g[0], []).append(escaped[1:])
    # Whole words, by their first character, so that the regular expression passes over other text quickly.
    tried = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_first.items())
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{tried})(?![\p{{L}}\p{{N}}])"


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _strings(values) -> Column:
    """A constant array as one literal, which keeps the plan small; no value holds a line end."""
    values = list(values)
    return F.split(F.lit("\n".join(values)), "\n") if values else F.array().cast("array<string>")


def scan(
    docs: DataFrame,
    model: LicenceModel,
    text: str = "text",
    threshold: float = 0.5,
    similarity: float = SIMILAR,
    found: str = "licences",
) -> DataFrame:
    """``docs`` with an array of the licence paragraphs of each whole text.

    Each is a struct: paragraph (number of the line, from 0), family, probability, similarity
    (largest share of a template of the family that the paragraph contains; 0 if it doesn't name
    the family, or denies a licence by one of ``DENYING``) and confirmed (similarity is enough). Paragraphs that are unknown, or whose probability is below
    ``threshold``, aren't listed. A line is listed once for each family that is confirmed in it;
    for a family after the first, and where families share the probability, it is enough that
    some licence is as probable as ``threshold``. A notice that runs over several lines is
    listed if it is confirmed and none of these lines confirms the family alone, with the line
    in which its window begins. Null and empty texts have none. Other columns stay.
    """
    anchors = model.anchors()
    quick = _any_gram(anchors)
    telling = telling_words(similarity)
    vocabulary = _strings(model.features)
    tables: list[Column | None] = []
    for k in range(len(model.families)):
        used = [(f, repr(float(v))) for f, v in zip(model.features, model.weights[:, k], strict=True) if abs(v) > 1e-9]
        values = _strings(v for _, v in used).cast("array<double>")
        tables.append(F.map_from_arrays(_strings(f for f, _ in used), values) if used else None)

    def logit(hits: Column, k: int) -> Column:
        if tables[k] is None:
            return F.lit(float(model.bias[k]) / model.temperature)
        total = F.aggregate(
            hits, F.lit(0.0), lambda acc, g: acc + F.coalesce(F.try_element_at(tables[k], g), F.lit(0.0))
        )
        return (total + float(model.bias[k])) / model.temperature

    def contained(grams: Column, family: Column) -> Column:
        out = F.lit(0.0)
        for name, own in TEMPLATES.items():
            shares = []
            for t in own:
                listed = template_grams(t)
                shares.append(F.size(F.array_intersect(grams, _strings(listed))) / F.lit(float(len(listed))))
            best = F.greatest(*shares) if len(shares) > 1 else shares[0]
            named = F.arrays_overlap(grams, _strings(NAMING[name]))
            out = F.when(family == name, F.when(named, best).otherwise(0.0)).otherwise(out)
        return F.when(F.arrays_overlap(grams, _strings(DENYING)), 0.0).otherwise(out)

    def explained(family: Column) -> Column:
        """n-grams of all templates of the family."""
        out = _strings([])
        for name, own in TEMPLATES.items():
            out = F.when(family == name, _strings(dict.fromkeys(g for t in own for g in grams_of(t)))).otherwise(out)
        return out

    def best(hits: Column, tried: Column) -> Column:
        """The best family not tried yet: its probability, and that of any licence."""
        scores = F.array(*[F.struct(logit(hits, k).alias("logit"), F.lit(f).alias("family")) for k, f in enumerate(model.families)])
        left = F.filter(scores, lambda c: ~F.array_contains(tried, c["family"]))

        def shares(scored: Column, top: Column) -> Column:
            parts = F.transform(scored, lambda c: F.struct(F.exp(c["logit"] - top["logit"]).alias("e"), c["family"].alias("family")))
            return _let(parts, lambda es: _let(
                F.aggregate(es, F.lit(0.0), lambda acc, c: acc + c["e"]),
                lambda total: F.struct(
                    top["family"].alias("family"),
                    (1.0 / total).alias("probability"),
                    (F.aggregate(es, F.lit(0.0), lambda acc, c: acc + F.when(c["family"] == UNKNOWN, 0.0).otherwise(c["e"])) / total).alias("any"),
                ),
            ))

        return _let(left, lambda scored: _let(F.array_max(scored), lambda top: shares(scored, top)))

    entry = "array<struct<family:string,probability:double,similarity:double>>"

    def families(grams: Column) -> Column:
        """The families of one paragraph; an unconfirmed one only as the first. Without hits it is unknown."""

        def step(state: Column, round_: Column, top: Column) -> Column:
            def after(share: Column) -> Column:
                confirmed = share >= similarity
                sure = (top["probability"] >= threshold) & ((round_ == 1) | confirmed) | (top["any"] >= threshold) & confirmed
                own = F.array(F.struct(top["family"].alias("family"), top["probability"].alias("probability"), share.alias("similarity")))
                return F.struct(
                    F.array_except(state["hits"], explained(top["family"])).alias("hits"),
                    F.concat(state["tried"], F.array(top["family"])).alias("tried"),
                    F.when(sure, F.concat(state["found"], own)).otherwise(state["found"]).alias("found"),
                    F.lit(True).alias("more"),
                )

            none = F.struct(state["hits"].alias("hits"), state["tried"].alias("tried"), state["found"].alias("found"), F.lit(False).alias("more"))
            over = (top["family"] == UNKNOWN) | (top["any"] < threshold)
            return F.when(over, none).otherwise(_let(contained(grams, top["family"]), after))

        start = F.struct(
            F.array_intersect(grams, vocabulary).alias("hits"), _strings([]).alias("tried"),
            F.array().cast(entry).alias("found"), F.lit(True).alias("more"),
        )
        return F.aggregate(
            F.array(*[F.lit(i + 1) for i in range(len(TEMPLATES))]), start,
            lambda state, round_: F.when(
                state["more"] & (F.size(state["hits"]) > 0), _let(best(state["hits"], state["tried"]), lambda top: step(state, round_, top))
            ).otherwise(state),
            lambda state: state["found"],
        )

    def spread(units: Column, *places: str) -> Column:
        """One struct for each family of each unit."""
        return F.flatten(F.transform(units, lambda u: F.transform(u["found"], lambda f: F.struct(
            *[u[c].alias(c) for c in places], f["family"].alias("family"), f["probability"].alias("probability"), f["similarity"].alias("similarity")
        ))))

    body = text_of(text)
    lines = F.transform(F.split(body, "\n"), lambda p, i: F.struct(i.alias("at"), p.alias("line")))
    possible = F.filter(lines, lambda p: p["line"].rlike(quick))
    of_lines = spread(
        F.transform(possible, lambda p: F.struct(p["at"].alias("at"), _let(grams_column(p["line"]), families).alias("found"))), "at"
    )

    # Windows over the words of all lines, each with its first and last line.
    span = template_words()

    def line_of(sizes: Column, place: Column) -> Column:
        """The line that holds the word at ``place``, from 0."""
        end = F.aggregate(
            sizes, F.struct(F.lit(0).alias("words"), F.lit(0).alias("line")),
            lambda acc, n: F.struct(
                (acc["words"] + n).alias("words"), (acc["line"] + F.when(acc["words"] + n <= place, 1).otherwise(0)).alias("line")
            ),
        )
        return end["line"]

    def windows(by_line: Column) -> Column:
        def listed(words: Column) -> Column:
            starts = F.sequence(F.lit(0), F.greatest(F.size(words) - span - 1, F.lit(0)), F.lit(span))
            own = F.transform(starts, lambda s: F.struct(s.alias("start"), F.slice(words, s + 1, 2 * span).alias("words")))
            own = F.filter(own, lambda w: F.arrays_overlap(w["words"], _strings(telling)))
            out = spread(F.transform(own, lambda w: F.struct(w["start"].alias("start"), _let(grams_of_words(w["words"]), families).alias("found"))), "start")
            out = F.filter(out, lambda w: w["similarity"] >= similarity)
            sizes = F.transform(by_line, F.size)
            return _let(sizes, lambda n: _let(F.size(words), lambda all_: F.transform(out, lambda w: F.struct(
                line_of(n, w["start"]).alias("at"),
                line_of(n, F.least(w["start"] + 2 * span, all_) - 1).alias("until"),
                *[w[c].alias(c) for c in ("start", "family", "probability", "similarity")],
            ))))

        return _let(F.flatten(by_line), listed)

    none = "array<struct<at:int,until:int,start:int,family:string,probability:double,similarity:double>>"
    of_windows = F.when(
        body.rlike(_any_gram(telling)), _let(F.transform(F.split(body, "\n"), words_of), windows)
    ).otherwise(F.array().cast(none))

    # Each step is an array of its own, so that nothing is computed twice.
    names = free_name([*docs.columns, found], "of_lines"), free_name([*docs.columns, found], "of_windows")
    rows = docs.withColumn(names[0], of_lines).withColumn(names[1], of_windows)
    own, wide = F.col(names[0]), F.col(names[1])
    # The window before has the family already, or a line of this one confirms it.
    new = F.filter(wide, lambda w: ~F.exists(wide, lambda v: (v["start"] == w["start"] - span) & (v["family"] == w["family"])) & ~F.exists(
        own, lambda p: (p["family"] == w["family"]) & (p["similarity"] >= similarity) & p["at"].between(w["at"], w["until"])
    ))
    both = F.concat(*[
        F.transform(part, lambda p: F.struct(
            p["at"].alias("paragraph"), p["family"].alias("family"), p["probability"].alias("probability"),
            p["similarity"].alias("similarity"), (p["similarity"] >= similarity).alias("confirmed"),
        ))
        for part in (own, new)
    ])
    return rows.withColumn(found, both).drop(*names)
