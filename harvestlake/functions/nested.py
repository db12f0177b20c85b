"""Expressions over the array columns of a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestlake.functions.text import file_extension, text
from harvestlake.refdata import CODE_EXTENSIONS, TEXT_EXTENSIONS, TOOL_EXTENSIONS
from harvestlake.schemas import FILES


def or_empty(array: Column, element: str = "STRING") -> Column:
    return F.coalesce(array, F.array().cast(f"ARRAY<{element}>"))


def no_files() -> Column:
    return F.array().cast(FILES)


def file_entry(name: Column, url: Column) -> Column:
    """One file: name, download URL and the extension taken from the name."""
    return F.struct(
        text(name).alias("name"),
        text(url).alias("download_url"),
        file_extension(text(name)).alias("extension"),
    )


def names_of(array: Column, *fields: str) -> Column:
    """The first non-empty of ``fields`` from each element; empties are dropped."""
    picked = F.transform(
        array, lambda x: F.coalesce(*[F.nullif(x[f], F.lit("")) for f in fields], F.lit(""))
    )
    return or_empty(F.filter(picked, lambda name: name != ""))


def first_filled(first: Column, second: Column) -> Column:
    """``first`` unless it is missing or empty, else ``second``."""
    return F.when(F.size(first) > 0, first).otherwise(or_empty(second))


def file_count(files: Column) -> Column:
    return F.size(F.coalesce(files, no_files()))


def file_names(files: Column) -> Column:
    return F.transform(files, lambda f: f["name"])


def file_types(files: Column) -> Column:
    """Sorted distinct non-empty extensions."""
    extensions = F.filter(F.transform(files, lambda f: f["extension"]), lambda e: e != "")
    return F.sort_array(F.array_distinct(extensions))


def has_extension(files: Column, extensions: list[str]) -> Column:
    return F.coalesce(F.exists(files, lambda f: f["extension"].isin(extensions)), F.lit(False))


def has_tool_export(files: Column) -> Column:
    return has_extension(files, TOOL_EXTENSIONS)


def has_text_file(files: Column) -> Column:
    return has_extension(files, TEXT_EXTENSIONS)


def has_zip(files: Column) -> Column:
    return has_extension(files, ["zip"])


def is_all_code(files: Column) -> Column:
    """At least one file, and every extension is a code extension."""
    every = F.forall(files, lambda f: f["extension"].isin(CODE_EXTENSIONS))
    return F.coalesce((F.size(files) > 0) & every, F.lit(False))
