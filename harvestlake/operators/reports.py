"""Catalog reads: lookups, joins, counts and ordered listings.

Every ordered listing ends in the row id. That fixes the order of ties and lets
Spark's range partitioning split a sort value shared by very many rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestlake.operators.joins import join_to_one

# Each child table's own order within a project.
CHILD_ORDER = {
    "files": "id",
    "keywords": "keyword",
    "person_role": "name",
    "licenses": "license",
}
LISTING_LIMIT = 50


# ---- filters and lookups ------------------------------------------------------


def files_by_status(files: DataFrame, status: str, tie: str = "id") -> DataFrame:
    return files.where(F.col("status") == status).orderBy("project_id", "file_name", tie)


def with_extension(files: DataFrame, extensions: list[str]) -> DataFrame:
    return files.where(F.col("file_type").isin(extensions))


def with_url(files: DataFrame) -> DataFrame:
    return files.where(F.col("download_url").isNotNull() & (F.col("download_url") != ""))


def project_by_id(projects: DataFrame, project_id) -> DataFrame:
    return projects.where(F.col("id") == F.lit(project_id))


def children_of(child: DataFrame, table: str, keys: DataFrame | int, tie: str = "id") -> DataFrame:
    """Child rows of one project id, or of every project in a table of keys.

    Ordered by project, then by the table's own order.
    """
    if isinstance(keys, DataFrame):
        wanted = keys.select("project_id").distinct()
        rows = join_to_one(child, wanted, ["project_id"], "left_semi")
    else:
        rows = child.where(F.col("project_id") == keys)
    own = CHILD_ORDER.get(table, tie)
    return rows.orderBy("project_id", own, *([] if own == tie else [tie]))


# ---- projects -----------------------------------------------------------------


def projects_newest_first(projects: DataFrame) -> DataFrame:
    return projects.orderBy(F.desc("download_date"), "id")


def projects_with_status(projects: DataFrame, files: DataFrame, status: str) -> DataFrame:
    """Projects that have at least one file of the status, newest first.

    The file side is reduced to distinct project ids first; that aggregation leaves
    its rows partitioned the way the semi join needs them.
    """
    having = (
        files.where(F.col("status") == status)
        .select(F.col("project_id").alias("id"))
        .distinct()
    )
    return projects_newest_first(projects.join(having, "id", "left_semi"))


def projects_by_relevance(projects: DataFrame, scores: DataFrame, min_score: int = 0) -> DataFrame:
    """Projects scored at least ``min_score``, best first; a missing score counts as 0."""
    score = F.coalesce("relevance_score", F.lit(0))
    own = scores.select(F.col("project_id").alias("id"), "relevance_score")
    return (
        projects.join(own, "id", "left")
        .where(score >= min_score)
        .orderBy(score.desc(), F.desc("download_date"), "id")
    )


def relevance_of(keys: DataFrame, scores: DataFrame) -> DataFrame:
    """Score and description per requested project id; 0 and empty when unscored."""
    found = scores.select("project_id", "relevance_score", "description")
    return keys.join(found, "project_id", "left").select(
        *keys.columns,
        F.coalesce("relevance_score", F.lit(0)).alias("relevance_score"),
        F.coalesce("description", F.lit("")).alias("description"),
    )


def files_with_projects(files: DataFrame, projects: DataFrame, tie: str = "id") -> DataFrame:
    """File list with title and URL of its project, newest project first."""
    parents = projects.select(
        F.col("id").alias("project_id"), "title", "project_url", "download_date"
    )
    return (
        files.select(tie, "project_id", "file_name", "file_type", "status")
        .join(parents, "project_id")
        .orderBy(F.desc("download_date"), "file_name", tie)
        .select(tie, "title", "project_url", "file_name", "file_type", "status")
    )


def first_with_status(
    files: DataFrame, status: str, limit: int = LISTING_LIMIT, tie: str = "id"
) -> DataFrame:
    """The first files of a status; a top-k, so no full sort takes place."""
    return (
        files.where(F.col("status") == status)
        .orderBy("project_id", "file_name", tie)
        .limit(limit)
        .select(tie, "file_name", "file_type", "download_url")
    )


# ---- counts -------------------------------------------------------------------


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table as (metric, value)."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")
            for name, df in tables.items()
        ],
    )


def status_counts(files: DataFrame) -> DataFrame:
    return files.groupBy("status").agg(F.count("*").alias("n"))


def status_shares(files: DataFrame) -> DataFrame:
    """Files per status with their share of the total in percent.

    The window runs over the counts, one row per status of a fixed vocabulary, not
    over the files.
    """
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return status_counts(files).select(
        "status", "n", (F.lit(100.0).cast("double") * F.col("n") / total).alias("pct")
    )


def report_group(status: Column) -> Column:
    """Documented status of a stored one: every ``skipped_*`` is ``skipped``."""
    return F.when(F.startswith(status, F.lit("skipped")), F.lit("skipped")).otherwise(status)


def score_summary(scores: DataFrame) -> DataFrame:
    """Lowest, highest and mean score; zeros for an empty table."""
    return scores.agg(
        F.coalesce(F.min("relevance_score"), F.lit(0)).alias("score_min"),
        F.coalesce(F.max("relevance_score"), F.lit(0)).alias("score_max"),
        F.coalesce(F.avg("relevance_score"), F.lit(0.0)).alias("score_avg"),
    )


def stats(tables: dict[str, DataFrame]) -> DataFrame:
    """The overview report in long form: (metric, key, value)."""
    counted = {n: tables[n] for n in ("projects", "files", "keywords", "person_role", "licenses")}
    totals = table_counts(counted).select(
        F.lit("rows").alias("metric"), F.col("metric").alias("key"), F.col("value").cast("double")
    )
    by_status = status_counts(tables["files"]).select(
        F.lit("files_by_status").alias("metric"),
        F.col("status").alias("key"),
        F.col("n").cast("double").alias("value"),
    )
    summary = score_summary(tables["relevance_scores"]).select(
        F.lit("relevance_score").alias("metric"),
        F.expr(
            "stack(3, 'min', cast(score_min as double), 'max', cast(score_max as double),"
            " 'avg', score_avg) as (key, value)"
        ),
    )
    return totals.unionByName(by_status).unionByName(summary)


def distinct_projects(files: DataFrame) -> DataFrame:
    return files.select("project_id").distinct()
