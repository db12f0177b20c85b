"""Licence normalisation and the open-licence test."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestlake.functions.text import strip_blank, text
from harvestlake.refdata import OPEN_LICENCE_PREFIXES

# Display names that mean CC0.
CC0_NAMES = ["cc0", "cc-zero", "public-domain"]
# Free-text marks, tested in this order.
CC0_MARKS = ["cc0", "cc-0", "public domain", "dedicate"]
ATTRIBUTION_MARKS = ["cc-by", "cc by"]
ATTRIBUTION_VERSIONS = ["4.0", "3.0", "2.5", "2.0"]
ODC_MARKS = ["odc-by", "odc by"]
PDDL_MARKS = ["pddl"]
OPEN_ACCESS = "Open"
# Clauses that restrict reuse although the prefix test admits them.
RESTRICTIVE_CLAUSES = ["-nc", "-nd", "-sa"]


def _has_any(column: Column, marks: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(column, F.lit(m)) for m in marks])


def spdx_licence(raw: Column) -> Column:
    """Short lower-case id from an SPDX licence URL; other text is lower-cased."""
    tail = F.substring_index(raw, "/licenses/", -1)
    return (
        F.when(
            F.contains(raw, F.lit("spdx.org/licenses/")),
            F.lower(F.replace(tail, F.lit(".html"), F.lit(""))),
        ).otherwise(F.lower(text(raw)))
    )


def display_name_licence(name: Column) -> Column:
    """Short id from a display name such as ``CC BY 4.0``."""
    short = F.translate(F.lower(strip_blank(text(name))), " /", "--")
    return F.when(short.isin(CC0_NAMES), F.lit("cc0")).otherwise(short)


def inferred_licence(access: Column, free_texts: Column) -> Column:
    """Licence guessed from an access status and free-text conditions.

    First match wins: CC0 marks, attribution with its version, the two open-data
    licences, and plain attribution for everything else that is open.
    """
    notes = F.lower(F.coalesce(F.array_join(free_texts, " "), F.lit("")))
    versioned = F
    for version in ATTRIBUTION_VERSIONS:
        versioned = versioned.when(F.contains(notes, F.lit(version)), F.lit(f"cc-by-{version}"))
    return (
        F.when(~F.equal_null(access, F.lit(OPEN_ACCESS)), F.lit(""))
        .when(_has_any(notes, CC0_MARKS), F.lit("cc0"))
        .when(_has_any(notes, ATTRIBUTION_MARKS), versioned.otherwise(F.lit("cc-by")))
        .when(_has_any(notes, ODC_MARKS), F.lit("odc-by"))
        .when(_has_any(notes, PDDL_MARKS), F.lit("pddl"))
        .otherwise(F.lit("cc-by"))
    )


def is_open_licence(licence: Column, exclude_restrictive: bool = False) -> Column:
    """True when the licence starts with an accepted prefix, ignoring case.

    The plain prefix rule also admits the non-commercial, no-derivatives and
    share-alike variants; ``exclude_restrictive`` leaves those out.
    """
    low = F.lower(licence)
    accepted = reduce(
        lambda a, b: a | b, [F.startswith(low, F.lit(p)) for p in OPEN_LICENCE_PREFIXES]
    )
    if exclude_restrictive:
        accepted = accepted & ~_has_any(low, RESTRICTIVE_CLAUSES)
    return F.coalesce(accepted, F.lit(False))
