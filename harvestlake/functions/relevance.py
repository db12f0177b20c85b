"""Relevance score of a record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestlake.functions.nested import has_text_file, has_tool_export, is_all_code
from harvestlake.functions.text import text
from harvestlake.refdata import (
    CODE_ONLY_PENALTY,
    TEXT_FILE_BONUS,
    TITLE_KEYWORDS,
    TOOL_FILE_BONUS,
)


def _points(condition: Column, points: int) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0))


def lower_title(title: Column) -> Column:
    return F.lower(text(title))


def title_score(title: Column, keywords: list[str] | None = None) -> Column:
    """One point per keyword that occurs in the title, however often."""
    return keyword_points(lower_title(title), keywords)


def keyword_points(low: Column, keywords: list[str] | None = None) -> Column:
    """``title_score`` of a title in lower case."""
    return reduce(
        lambda a, b: a + b,
        [_points(F.contains(low, F.lit(k)), 1) for k in keywords or TITLE_KEYWORDS],
    )


def file_score(tool_export: Column, text_file: Column, all_code: Column) -> Column:
    """The file bonuses, less the code-only penalty."""
    return (
        _points(tool_export, TOOL_FILE_BONUS)
        + _points(text_file, TEXT_FILE_BONUS)
        - _points(all_code, CODE_ONLY_PENALTY)
    )


def record_score(title: Column, files: Column) -> Column:
    """Score of a nested record."""
    return lowered_record_score(lower_title(title), files)


def lowered_record_score(low: Column, files: Column) -> Column:
    """``record_score`` by the title in lower case."""
    return keyword_points(low) + file_score(
        has_tool_export(files), has_text_file(files), is_all_code(files)
    )
