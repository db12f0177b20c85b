"""CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from harvestlake.operators.reports import files_with_projects, projects_newest_first

_CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}


def _write(df: DataFrame, path: str) -> None:
    """Many part files; their names follow the global order of the rows."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


def export_projects(projects: DataFrame, path: str) -> None:
    """All project columns, newest download first."""
    _write(projects_newest_first(projects), path)


def export_files(files: DataFrame, projects: DataFrame, path: str, tie: str = "id") -> None:
    """File list with project title and URL, newest project first."""
    _write(files_with_projects(files, projects, tie), path)


def read_export(spark, path: str, schema: str) -> DataFrame:
    """An export read back; empty cells are NULL."""
    return (
        spark.read.schema(schema)
        .options(**_CSV, multiLine=True)
        .csv(path)
    )
