"""Licence families that look alike, denied licences, and families that are not listed."""

import re

import pytest

from harvestlake.llm import licences

# (notice, families that must be confirmed)
NOTICES = [
    ("This project is licensed under the Eclipse Public License, version 2.0.", {"epl"}),
    ("Distributed under the Boost Software License, Version 1.0.", {"boost"}),
    ("This work is licensed under the GNU Affero General Public License, version 3.", {"agpl"}),
    ("SPDX-License-Identifier: AGPL-3.0-or-later", {"agpl"}),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", {"cc-by-nd"}),
    ("Licensed under CC BY-NC-SA 4.0.", {"cc-by-nc-sa"}),
    ("Licensed under CC BY-NC-ND 4.0.", {"cc-by-nc-nd"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc"}),
    ("Licensed under CC BY 4.0.", {"cc-by"}),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", {"isc"}),
    ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
    ("Licensed under the Artistic License 2.0.", {"artistic"}),
    ("Released under the zlib License.", {"zlib"}),
    ("Released under the MIT License.", {"mit"}),
    ("Licensed under the Apache License, Version 2.0.", {"apache"}),
    ("This software is not licensed under the MIT License", set()),
    ("This work is no longer licensed under CC BY 4.0.", set()),
]
# Notices of families that are neither listed nor taught as unlisted.
FOREIGN = [
    "Licensed under the Academic Free License version 3.0.",
    "This file is licensed under the SIL Open Font License, Version 1.1.",
    "Released under the Educational Community License, version 2.0.",
    "Distributed under the terms of the Q Public License.",
    "This program is released under the CeCILL license.",
    "Licensed under the Mulan Permissive Software License, version 2.",
]


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return licences.fit_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.fixture(scope="module")
def found(spark, model):
    texts = [n for n, _ in NOTICES] + FOREIGN
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    return [r["licences"] for r in licences.scan(rows, model).orderBy("doc_id").select("licences").collect()]


def test_look_alikes_are_told_apart(found):
    got = [{p["family"] for p in listed if p["confirmed"]} for listed in found[: len(NOTICES)]]
    wrong = [(n, g, w) for (n, w), g in zip(NOTICES, got, strict=True) if g != w]
    assert wrong == []


def test_families_left_out_are_not_confirmed(found):
    assert [p for listed in found[len(NOTICES) :] for p in listed if p["confirmed"]] == []


def test_every_family_has_names_that_its_templates_carry():
    assert set(licences.NAMING) == set(licences.TEMPLATES)
    for family, own in licences.TEMPLATES.items():
        unnamed = [t for t in own if not set(licences.grams_of(t)) & set(licences.NAMING[family])]
        assert unnamed == [], family


def brute_force(text: str, model: licences.LicenceModel) -> set[str]:
    """Families that a text's lines confirm, straight from the definition."""
    import numpy as np

    out = set()
    for line in text.split("\n"):
        grams = licences.grams_of(line)
        hits, tried = [g for g in grams if g in set(model.features)], set()
        while hits:
            z = model.logits(hits) / model.temperature
            left = [i for i, f in enumerate(model.families) if f not in tried]
            p = np.exp(z[left] - z[left].max())
            p /= p.sum()
            top = left[int(np.argmax(p))]
            family = model.families[top]
            licensed = sum(q for q, i in zip(p, left, strict=True) if model.families[i] != licences.UNKNOWN)
            if family == licences.UNKNOWN or licensed < 0.5:
                break
            shares = [len(set(t) & set(grams)) / len(t) for t in map(licences.template_grams, licences.TEMPLATES[family])]
            named = set(grams) & set(licences.NAMING[family]) and not set(grams) & set(licences.DENYING)
            if named and max(shares) >= licences.SIMILAR:
                out.add(family)
            explained = {g for t in licences.TEMPLATES[family] for g in licences.grams_of(t)}
            hits = [g for g in hits if g not in explained]
            tried.add(family)
    return out


def test_scan_of_lines_is_the_brute_force_scan(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    planted = [(-1 - i, f"{n}\nAll in all, a text.\n{m[0]}") for i, ((n, _), m) in enumerate(zip(NOTICES, NOTICES[1:], strict=False))]
    both = docs.unionByName(spark.createDataFrame(planted, "doc_id BIGINT, text STRING"))
    rows = licences.scan(both, model).select("doc_id", "text", "licences").collect()
    for r in rows:
        want = brute_force(r["text"] or "", model)
        got = {p["family"] for p in r["licences"] if p["confirmed"]}
        # Windows may confirm more, over line ends.
        assert want <= got, (r["doc_id"], want, got)
        if not re.search("\n", r["text"] or "") and len((r["text"] or "").split()) < 60:
            assert want == got, (r["doc_id"], want, got)
