"""Checks of the declared table rules; each returns violations as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.operators.joins import join_to_one
from harvestlake.refdata import METHODS
from harvestlake.schemas import CHILD_TABLES, NOT_NULL


def _violations(df: DataFrame, table: str, rule: str, key: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.col(key).cast("string").alias("key"),
    )


def duplicate_scores(scores: DataFrame) -> DataFrame:
    doubled = scores.groupBy("project_id").count().where("count > 1")
    return _violations(doubled, "relevance_scores", "unique: project_id", "project_id")


def with_broken_rules(df: DataFrame, table: str, projects: DataFrame | None = None, name: str = "broken") -> DataFrame:
    """``df`` with the rules that a row alone, or with its project, breaks, as an array.

    Children are joined with one narrow row per project, the children on the side that may
    hold very many rows per project.
    """
    columns = [c for c in NOT_NULL[table] if c in df.columns]
    rules = {f"not null: {c}": F.col(c).isNull() for c in columns}
    kept = df.columns
    if table == "projects":
        rules["check: download_method"] = ~F.col("download_method").isin(METHODS)
    elif projects is not None and table in CHILD_TABLES:
        parents = projects.select(F.col("id").alias("project_id"), F.lit(True).alias("_known"))
        df = join_to_one(df, parents, ["project_id"])
        rules["foreign key: project_id"] = F.col("_known").isNull()
    broken = F.array_compact(F.array(*[F.when(test, F.lit(rule)) for rule, test in rules.items()]))
    return df.select(*kept, broken.alias(name))


def row_violations(
    df: DataFrame, table: str, projects: DataFrame | None = None, key: str = "id"
) -> DataFrame:
    """All rules that a row alone, or with its project, can break, in one scan of the table."""
    # Outer, as Spark would evaluate all rules again to test the size of an inner one.
    return with_broken_rules(df, table, projects).select(
        F.lit(table).alias("table_name"),
        F.explode_outer("broken").alias("rule"),
        F.col(key).cast("string").alias("key"),
    ).where(F.col("rule").isNotNull())


def with_repeated_scores(scores: DataFrame, stored: DataFrame, name: str = "broken") -> DataFrame:
    """``scores`` with the uniqueness rule added to ``name`` where a project has one already.

    Of several new scores of a project the one with the smallest id stands; a score that is
    ``stored`` stands before all new ones. Minima combine before the exchange, so a project with
    very many scores is no hot group.
    """
    first = scores.groupBy("project_id").agg(F.min("id").alias("_first"))
    held = stored.select("project_id").distinct().withColumn("_held", F.lit(True))
    marked = join_to_one(scores, first.join(held, "project_id", "left"), ["project_id"])
    repeated = F.col("project_id").isNotNull() & (F.col("_held").isNotNull() | (F.col("id") > F.col("_first")))
    rule = F.when(repeated, F.array(F.lit("unique: project_id"))).otherwise(F.array().cast("array<string>"))
    return marked.select(*[c for c in scores.columns if c != name], F.concat(name, rule).alias(name))


def check_catalog(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    """All violations in the given tables: (table_name, rule, key)."""
    keys = keys or {}
    projects = tables.get("projects")
    parts = [row_violations(df, name, projects, keys.get(name, "id")) for name, df in tables.items()]
    if "relevance_scores" in tables:
        parts.append(duplicate_scores(tables["relevance_scores"]))
    return reduce(DataFrame.unionByName, parts)


def violation_counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("table_name", "rule").agg(F.count("*").alias("n"))
