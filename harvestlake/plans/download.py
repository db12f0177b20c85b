"""A whole download round over landed outcomes: plan, decide, record, tally."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.operators.worklist import Selection, classify, plan_all, run_tally


def download_round(
    files: DataFrame,
    projects: DataFrame,
    inventory: DataFrame,
    heads: DataFrame,
    outcomes: DataFrame,
    choice: Selection = Selection(),
    strict: bool = False,
    key: str = "id",
) -> DataFrame:
    """Every file with the status it has after the round, in ``new_status``."""
    decided = classify(
        plan_all(files, projects, choice, strict), inventory, heads, outcomes, key
    ).select(key, F.col("new_status").alias("_decided"))
    return files.join(decided, key, "left").select(
        *files.columns, F.coalesce("_decided", "status").alias("new_status")
    )


def round_tally(after: DataFrame, projects: DataFrame, choice: Selection = Selection()) -> DataFrame:
    """Tally of a round from the frame ``download_round`` returned."""
    return run_tally(after, projects, choice)
