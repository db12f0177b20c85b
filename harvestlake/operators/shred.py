"""Nested records to the six catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlake.functions.text import is_not_blank, null_if_empty, partial_date, text
from harvestlake.operators.ids import with_run_offsets
from harvestlake.operators.records import attach_repository, known_repository
from harvestlake.refdata import PENDING
from harvestlake.schemas import COLUMN_DEFAULTS, TABLES

AUTHOR = "AUTHOR"


def table_columns(table: str) -> list[str]:
    return [part.split()[0] for part in TABLES[table].split(", ")]


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Cast to the table's columns; missing columns and NULLs take the defaults."""
    defaults = COLUMN_DEFAULTS.get(table, {})
    columns = []
    for part in TABLES[table].split(", "):
        name, kind = part.split()
        column = F.col(name) if name in df.columns else F.lit(None)
        if name in defaults:
            column = F.coalesce(column, F.lit(defaults[name]))
        elif name == "download_date":
            column = F.coalesce(column, F.current_timestamp())
        columns.append(column.cast(kind).alias(name))
    return df.select(*columns)


def catalog_parents(
    records: DataFrame, start_ids: dict[str, Column] | None = None
) -> DataFrame:
    """One row per stored project with its id and the first id of each child table.

    Expects scored records. Ids are dense and follow the insertion order, and child
    ids are ``start + position``: one pass over the parents numbers all six
    tables, and no child row is ever exchanged. Records of unknown repositories
    are left out. ``start_ids`` holds the highest id used so far per table.
    """
    known = known_repository(attach_repository(records, "repo", "source"))
    prepared = known.withColumns(
        {
            "creators": F.filter("creators", is_not_blank),
            "keywords": F.filter("keywords", is_not_blank),
            "licenses": F.when(text(F.col("license")) != "", F.array("license")).otherwise(
                F.array().cast("ARRAY<STRING>")
            ),
        }
    )
    numbered = with_run_offsets(
        prepared,
        {
            "_projects": F.lit(1),
            "_files": F.size("files"),
            "_keywords": F.size("keywords"),
            "_person_role": F.size("creators"),
            "_licenses": F.size("licenses"),
            "_relevance_scores": F.lit(1),
        },
    )
    start_ids = start_ids or {}
    shifted = {
        f"_{table}": F.col(f"_{table}") + 1 + start_ids.get(table, F.lit(0)) for table in TABLES
    }
    return numbered.withColumns(shifted)


def shred(parents: DataFrame) -> dict[str, DataFrame]:
    """The six tables from numbered parents.

    Each child table explodes its own array from the parent; the explodes are never
    chained, which would multiply rows.
    """
    projects = parents.select(
        F.col("_projects").alias("id"),
        F.col("query").alias("query_string"),
        "repository_id",
        "repository_url",
        F.col("record_page").alias("project_url"),
        "title",
        text(F.col("description")).alias("description"),
        null_if_empty(F.col("doi")).alias("doi"),
        null_if_empty(F.col("publication_date")).alias("upload_date_raw"),
        partial_date(F.substring("publication_date", 1, 10)).alias("upload_date"),
        F.col("fetched_at").alias("download_date"),
        F.col("repo").alias("download_repository_folder"),
        F.col("record_id").alias("download_project_folder"),
        "download_method",
    )
    scores = parents.select(
        F.col("_relevance_scores").alias("id"),
        F.col("_projects").alias("project_id"),
        "relevance_score",
        text(F.col("description")).alias("description"),
    )

    def children(array: str, start: str) -> DataFrame:
        return parents.select(
            F.col("_projects").alias("project_id"),
            F.col(start).alias("_start"),
            F.posexplode(array).alias("_pos", "item"),
        ).withColumn("id", F.col("_start") + F.col("_pos"))

    tables = {
        "projects": projects,
        "files": children("files", "_files").select(
            "id",
            "project_id",
            F.col("item.name").alias("file_name"),
            F.col("item.extension").alias("file_type"),
            F.col("item.download_url").alias("download_url"),
            F.lit(PENDING).alias("status"),
        ),
        "keywords": children("keywords", "_keywords").select(
            "id", "project_id", F.col("item").alias("keyword")
        ),
        "person_role": children("creators", "_person_role").select(
            "id", "project_id", F.col("item").alias("name"), F.lit(AUTHOR).alias("role")
        ),
        "licenses": children("licenses", "_licenses").select(
            "id", "project_id", F.col("item").alias("license")
        ),
        "relevance_scores": scores,
    }
    return {name: with_defaults(df, name) for name, df in tables.items()}
