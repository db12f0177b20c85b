"""Keeping the first or the newest row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN_ORDER = ["query_idx", "repo_idx", "page", "pos", "fetched_at"]


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    exchange as well, so each task sends at most one row per key. A key that holds
    a third of all rows therefore reaches its final task with one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")
    )


def dedup_records(records: DataFrame, dedup: bool = True) -> DataFrame:
    """First occurrence of each (source, record id) in query, catalog, page, position order.

    ``dedup=False`` keeps every occurrence.
    """
    if not dedup:
        return records
    return first_per_key(records, ["source", "record_id"], RUN_ORDER)


def count_unique(records: DataFrame) -> DataFrame:
    """Number of distinct (source, record id): only the keys are exchanged."""
    keys = records.select("source", "record_id").distinct()
    return keys.agg(F.count("*").alias("n_unique"))
