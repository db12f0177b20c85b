"""Catalog tables bucketed by project, so that children join their project in place.

All tables of one set have the same number of buckets, by project id and sorted by it: joins and
groupings by project need no exchange on either side. A bucket is read by one task, so a project
that holds a large part of all rows makes one long task; where that is too much, join the plain
tables, whose exchange adaptive execution can split. Writing has no such limit: a bucket that
holds much is written by several tasks, as several files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlake.session import delete_folder

#: Bytes of the largest table, as its compressed files, that a bucket should hold. The task that joins
#: a bucket sorts its rows unpacked, which takes some twenty times as much memory.
BUCKET_BYTES = 16 * 1024 * 1024


def project_key(table: str) -> str:
    return "id" if table == "projects" else "project_id"


def buckets_for(table_bytes: int) -> int:
    """Buckets of a set whose largest table takes so many bytes; a power of two, so sets can be compared."""
    wanted = max(1, -(-table_bytes // BUCKET_BYTES))
    return 1 << (wanted - 1).bit_length()


class BucketedTables:
    """One set of bucketed tables below a folder, named ``<prefix>_<table>`` in the session's catalog."""

    def __init__(self, spark: SparkSession, base: str, prefix: str, buckets: int):
        if buckets < 1:
            raise ValueError("at least one bucket")
        self.spark, self.base, self.prefix, self.buckets = spark, base.rstrip("/"), prefix, buckets

    def name(self, table: str) -> str:
        return f"{self.prefix}_{table}"

    def save(self, table: str, rows: DataFrame) -> None:
        """Write a table in place of what is stored; rows without a project are kept in a bucket of their own hash."""
        key = project_key(table)
        self.drop(table)
        # Dealt by bucket, so a task writes few files. Adaptive execution splits a partition of one
        # hot project and merges small ones.
        dealt = rows.hint("rebalance", self.buckets, F.col(key))
        (
            dealt.write.format("parquet")
            .bucketBy(self.buckets, key)
            .sortBy(key)
            .option("path", f"{self.base}/{table}")
            .saveAsTable(self.name(table))
        )

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def drop(self, table: str) -> None:
        """Forget a table and delete its files."""
        self.spark.sql(f"drop table if exists `{self.name(table)}`")
        delete_folder(self.spark, f"{self.base}/{table}")
