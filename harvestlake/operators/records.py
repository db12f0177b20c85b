"""Record-level predicates, scores and repository lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlake.functions.licences import is_open_licence
from harvestlake.functions.relevance import file_score, lower_title, lowered_record_score, title_score
from harvestlake.refdata import (
    CODE_EXTENSIONS,
    DEFAULT_METHOD,
    TEXT_EXTENSIONS,
    TOOL_EXTENSIONS,
    repositories,
    repository_names,
)


def score(records: DataFrame) -> DataFrame:
    """Add ``relevance_score`` to nested records.

    The score comes out of a generator: a filter on it stays above and doesn't score
    again, while filters on other columns still pass down to the scan. Inside a generator
    Spark repeats equal parts of an expression, so the title is put in lower case below it,
    once and not for every keyword.
    """
    points = lowered_record_score(F.col("_low"), F.col("files"))
    others = [c for c in records.columns if c != "relevance_score"]
    lowered = records.withColumn("_low", lower_title(F.col("title")))
    return lowered.select(*others, F.explode(F.array(points)).alias("relevance_score"))


def is_relevant(
    records: DataFrame, min_score: int = 1, exclude_restrictive: bool = False
) -> DataFrame:
    """Open licence and a score of at least ``min_score``; expects a scored frame."""
    return records.where(
        is_open_licence(F.col("license"), exclude_restrictive)
        & (F.col("relevance_score") >= min_score)
    )


def open_licensed(records: DataFrame, exclude_restrictive: bool = False) -> DataFrame:
    """The licence half of the relevance test; put before scoring it spares the scores."""
    return records.where(is_open_licence(F.col("license"), exclude_restrictive))


def open_access_only(records: DataFrame, column: str = "access_right") -> DataFrame:
    """Records whose access right is open (the Zenodo search condition)."""
    return records.where(F.col(column) == "open")


def datasets_only(records: DataFrame, column: str = "item_type", dataset_type: int = 3) -> DataFrame:
    """Records of the dataset item type (the Figshare search condition)."""
    return records.where(F.col(column) == dataset_type)


def file_facts(files: DataFrame, key: str = "project_id", file_type: str = "file_type") -> DataFrame:
    """File count and the extension tests per project, from file rows.

    All of these are partial aggregates, so a project with very many files is
    reduced to one row per task before the exchange.
    """
    kind = F.col(file_type)
    return files.groupBy(key).agg(
        F.count("*").alias("files_count"),
        F.bool_or(kind.isin(TOOL_EXTENSIONS)).alias("has_tool_export"),
        F.bool_or(kind.isin(TEXT_EXTENSIONS)).alias("has_text_file"),
        F.bool_or(kind == "zip").alias("has_zip"),
        F.bool_and(kind.isin(CODE_EXTENSIONS)).alias("all_code"),
    )


def score_projects(projects: DataFrame, files: DataFrame) -> DataFrame:
    """Composite score of projects whose files are rows of their own table.

    The title is scored below the join, so a filter on the score does not repeat it.
    """
    facts = file_facts(files).select(
        F.col("project_id").alias("id"), "has_tool_export", "has_text_file", "all_code"
    )
    points = file_score(F.col("has_tool_export"), F.col("has_text_file"), F.col("all_code"))
    return (
        projects.withColumn("_title_score", title_score(F.col("title")))
        .join(facts, "id", "left")
        .select(*projects.columns, (F.col("_title_score") + points).alias("relevance_score"))
    )


def source_name(client_name: Column) -> Column:
    """Repository name from a client class name."""
    return F.replace(F.lower(client_name), F.lit("client"), F.lit(""))


def attach_repository(df: DataFrame, name: str, fallback: str | None = None) -> DataFrame:
    """Add repository id, base URL and acquisition method by repository name.

    The id is looked up by ``name``, then by ``fallback``, else 0; the URL and the
    method depend on ``name`` only. Both lookup tables are constants of at most
    eight rows, so broadcasting them is safe at any data size.
    """
    spark = df.sparkSession
    names = repository_names(spark)
    details = repositories(spark).select(
        F.col("repo").alias("_repo"), "repository_url", "download_method"
    )

    def ids(column: str, alias: str) -> DataFrame:
        return names.select(F.col("name").alias(column), F.col("repository_id").alias(alias))

    joined = df.join(F.broadcast(ids("_n1", "_id1")), F.col(name) == F.col("_n1"), "left")
    found = [F.col("_id1")]
    if fallback:
        joined = joined.join(
            F.broadcast(ids("_n2", "_id2")), F.col(fallback) == F.col("_n2"), "left"
        )
        found.append(F.col("_id2"))
    joined = joined.join(F.broadcast(details), F.lower(name) == F.col("_repo"), "left")
    return joined.select(
        *df.columns,
        F.coalesce(*found, F.lit(0)).alias("repository_id"),
        F.coalesce("repository_url", F.lit("")).alias("repository_url"),
        F.coalesce("download_method", F.lit(DEFAULT_METHOD)).alias("download_method"),
    )


def known_repository(df: DataFrame) -> DataFrame:
    return df.where(F.col("repository_id") != 0)


def unknown_repository(df: DataFrame) -> DataFrame:
    """The rows a load leaves out because their repository is not known."""
    return df.where(F.col("repository_id") == 0)
