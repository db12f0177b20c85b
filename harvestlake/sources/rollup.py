"""The overview report from partial counts per batch.

Beside the tables, ``<base>/report/`` holds one partition per (table, batch): the rows of that
batch counted by file status, by score, or as a whole. All of it adds up, so the report is a sum
over these few rows and reads no table. A rewrite drops the partials of the partitions it
touches before it changes them; the next report counts only what has none: new batches and
rewritten ones. A partial that a crash has lost is counted again, never missed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.schemas import TABLES
from harvestlake.session import folder_names
from harvestlake.sources.catalog import REPORT, Catalog

#: What the rows of a table are counted by; tables not named are counted as a whole.
_COUNTED_BY = {"files": "status", "relevance_scores": "relevance_score"}
_COUNTED = ("projects", "files", "keywords", "person_role", "licenses")
_SCHEMA = "key STRING, n BIGINT, table_name STRING, batch STRING"


def partials(rows: DataFrame, table: str, batches: DataFrame) -> DataFrame:
    """Counts per batch and key of rows that carry ``batch``.

    Every batch also has a row without key that counts nothing: it shows that the batch was counted.
    """
    key = F.col(_COUNTED_BY[table]).cast("string") if table in _COUNTED_BY else F.lit(None).cast("string")
    counted = rows.select("batch", key.alias("key")).groupBy("batch", "key").agg(F.count("*").alias("n"))
    seen = batches.select("batch", F.lit(None).cast("string").alias("key"), F.lit(0).cast("bigint").alias("n"))
    return counted.unionByName(seen).withColumn("table_name", F.lit(table))


def _stored(store: Catalog) -> DataFrame:
    path = f"{store.base}/{REPORT}"
    if not folder_names(store.spark, path, "table_name="):
        return store.spark.createDataFrame([], _SCHEMA)
    return store.spark.read.schema(_SCHEMA).parquet(path)


def uncounted(store: Catalog) -> dict[str, list[str]]:
    """Finished batches without partials, by table; only names reach the driver."""
    done = {(r["table_name"], r["batch"]) for r in _stored(store).select("table_name", "batch").distinct().collect()}
    batches = sorted(r["batch"] for r in store.batches().select("batch").collect())
    left = {table: [b for b in batches if (table, b) not in done] for table in TABLES}
    return {table: names for table, names in left.items() if names}


def refresh(store: Catalog) -> dict[str, list[str]]:
    """Count the batches that have no partials, all tables in one job; which ones, by table."""
    left = uncounted(store)
    if left:
        new = [
            partials(store.rows(t).where(F.col("batch").isin(names)), t, store.batches().where(F.col("batch").isin(names)))
            for t, names in left.items()
        ]
        (
            # A few rows per batch, so one task can write them.
            reduce(DataFrame.unionByName, new).coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("table_name", "batch")
            .parquet(f"{store.base}/{REPORT}")
        )
    return left


def report(store: Catalog) -> DataFrame:
    """``reports.stats`` of the stored tables, from their partials: (metric, key, value)."""
    refresh(store)
    # A batch that is being written again counts when it is finished.
    known = _stored(store).join(store.batches().select("batch"), "batch", "left_semi")
    totals = known.groupBy("table_name", "key").agg(F.sum("n").alias("n"))
    names = store.spark.createDataFrame([(t,) for t in _COUNTED], "table_name STRING")
    sizes = names.join(totals, "table_name", "left").groupBy("table_name").agg(F.sum("n").alias("n"))
    parts = [
        sizes.select(F.lit("rows").alias("metric"), F.col("table_name").alias("key"), F.coalesce("n", F.lit(0)).cast("double").alias("value")),
        totals.where("table_name = 'files' and n > 0").select(F.lit("files_by_status").alias("metric"), "key", F.col("n").cast("double").alias("value")),
    ]
    scores = totals.where("table_name = 'relevance_scores' and n > 0").select(F.col("key").cast("double").alias("score"), "n")
    summary = scores.agg(
        F.min("score").alias("low"),
        F.max("score").alias("high"),
        (F.sum(F.col("score") * F.col("n")) / F.sum(F.when(F.col("score").isNotNull(), F.col("n")))).alias("mean"),
    ).select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("low", "high", "mean")])
    parts.append(summary.selectExpr("'relevance_score' as metric", "stack(3, 'min', low, 'max', high, 'avg', mean) as (key, value)"))
    return reduce(DataFrame.unionByName, parts)
