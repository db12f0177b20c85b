"""Helpers shared by the operators: tables, staged frames, names, shared-folder files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlake.session import scratch_path, stage

__all__ = [
    "fold", "free_name", "row_tie", "sample_of_ids", "sample_of_texts", "scratch_path", "small_batches",
    "stage", "stage_rows", "stop_if_missing", "table", "text_of",
]

#: Rows in one Arrow batch of the operators that hand whole texts to Python.
BATCH_ROWS = 256
#: Rows of narrow columns that a task puts together, whatever the number of shuffle partitions.
ROWS_A_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_rows(df: DataFrame, rows: int, name: str) -> DataFrame:
    """``stage`` for narrow rows, ``rows`` of them at most: in as many tasks as these ask for.

    What many tasks would leave as very small files costs more to write and read than to work out.
    """
    return stage(df.coalesce(max(1, -(-rows // ROWS_A_TASK))), name)


def text_of(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def free_name(columns: Iterable[str], wish: str) -> str:
    """``wish``, lengthened until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def row_tie(df: DataFrame) -> Column:
    """A hash over all columns of the row, to order rows that tie otherwise.

    Rows that differ in nothing tie for good, and either may stand for the other.
    """
    return F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))


def fold(id_column: str, modulus: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``modulus``; null ids get null."""
    return F.crc32(F.col(id_column).cast("string")) % modulus


def stop_if_missing(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {', '.join(df.columns)}")


def sample_of_ids(df: DataFrame, id_column: str, n: int) -> DataFrame:
    """The ``n`` ids with the smallest hashes, as a small written table; only ids are sorted."""
    ids = df.select(id_column).where(F.col(id_column).isNotNull()).distinct()
    return stage(ids.orderBy(F.xxhash64(id_column), id_column).limit(n), "sample-ids")


def sample_of_texts(df: DataFrame, text: str, n: int) -> DataFrame:
    """About ``n`` distinct texts of ``df``, those with small hashes, the same on every run.

    The share is worked out from the number of rows; copies of a text count once, so no text
    that very many rows repeat can swell the sample.
    """
    share = min(1.0, n / max(1, df.count()))
    rows = df.select(text_of(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    if share < 1.0:
        rows = rows.where(F.col("hash") < int(-(1 << 63) + share * (1 << 64)))
    return rows.dropDuplicates(["hash"]).select("text")


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of whole texts stay small, however long the texts are on average."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
