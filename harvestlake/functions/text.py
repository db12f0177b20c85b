"""String and date column expressions. All stay inside Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as blank when a name is stripped (Unicode separators,
# the usual white space, and the four ASCII information separators plus NEL).
BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"
NON_BLANK = r"[^\s\p{Z}\x1c-\x1f\x85]"


def text(column: Column) -> Column:
    """NULL becomes the empty string; anything else is cast to text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def null_if_empty(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def file_extension(name: Column) -> Column:
    """Lower-cased text after the last dot; empty when there is no dot."""
    return F.when(
        F.contains(name, F.lit(".")), F.lower(F.substring_index(name, ".", -1))
    ).otherwise(F.lit(""))


def strip_blank(column: Column) -> Column:
    """Remove blanks at both ends, counting Unicode blanks too."""
    return F.regexp_replace(column, f"^{BLANK}+|{BLANK}+$", "")


def is_not_blank(column: Column) -> Column:
    """True when something is left after stripping; NULL counts as blank."""
    return F.coalesce(F.rlike(column, F.lit(NON_BLANK)), F.lit(False))


def prefixed_url(prefix: str, part: Column, suffix: str = "") -> Column:
    """``prefix + part + suffix``, or empty when the part is missing or empty."""
    return F.when(part != "", F.concat(F.lit(prefix), part, F.lit(suffix))).otherwise(F.lit(""))


def storage_path(root: str, *parts: Column) -> Column:
    """Join path parts under ``root``; missing and empty parts are left out."""
    return F.concat_ws("/", F.lit(root), *[null_if_empty(p) for p in parts])


def iso_day(column: Column) -> Column:
    """First ten characters of an ISO timestamp."""
    return F.substring(text(column), 1, 10)


def partial_date(column: Column) -> Column:
    """DATE from ``yyyy-MM-dd``, ``yyyy-MM`` or ``yyyy``; NULL for anything else."""
    return F.coalesce(
        F.try_to_date(column, "yyyy-MM-dd"),
        F.try_to_date(column, "yyyy-MM"),
        F.try_to_date(column, "yyyy"),
    )


def doi_from_identifiers(identifiers: Column) -> Column:
    """Text of the first identifier whose agency is DOI, without ``doi:``, lower-cased.

    The first match counts even when its text is empty; the prefix is removed
    before lower-casing, so an upper-case prefix survives in lower case.
    """
    first = F.try_element_at(F.filter(identifiers, lambda p: p["agency"] == "DOI"), F.lit(1))
    return F.coalesce(
        F.lower(F.replace(first["pid"], F.lit("doi:"), F.lit(""))), F.lit("")
    )
