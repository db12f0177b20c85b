"""Landed response pages and follow-up documents as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harvestlake.schemas import LANDING, SIDE_DOCUMENTS


def _read(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All landed pages below ``path`` (Parquet or JSON lines), schema fixed.

    Landing folders may be partitioned by ``repo``; each catalog format then
    reads only its own folder.
    """
    return _read(spark, path, LANDING, fmt)


def read_side_documents(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed file lists and record details."""
    return _read(spark, path, SIDE_DOCUMENTS, fmt)


def write_landing(pages: DataFrame, path: str) -> None:
    """Append pages to a landing folder, one sub-folder per repository.

    ``rebalance`` splits a repository that holds much of the data over several
    tasks instead of sending each repository to one.
    """
    (
        pages.hint("rebalance", "repo")
        .write.mode("append")
        .partitionBy("repo")
        .parquet(path)
    )
