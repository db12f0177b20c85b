"""Keys that hold a third of all rows: same results, and work that is split."""

import pytest
from pyspark.sql import functions as F

from harvestlake.operators import reports
from harvestlake.operators import worklist as wl
from harvestlake.operators.dedup import dedup_records
from harvestlake.operators.pagination import counted_pages, stop_pages

ROWS = 120_000


@pytest.fixture
def small_limits(spark):
    """Limits at which the test data counts as large."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # What a session that was not made by build_session has.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    old = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(column: str, cold: int = 3000):
    """Every third row has key 0."""
    return F.when(F.col("i") % 3 == 0, F.lit(0)).otherwise(F.col("i") % cold).alias(column)


@pytest.fixture(scope="module")
def files(spark):
    return spark.range(0, ROWS, 1, 8).withColumnRenamed("id", "i").select(
        F.col("i").alias("id"),
        hot("project_id"),
        F.concat(F.lit("file number "), F.col("i").cast("string")).alias("file_name"),
        F.when(F.col("i") % 2 == 0, "pdf").otherwise("py").alias("file_type"),
        F.sha2(F.col("i").cast("string"), 256).alias("download_url"),
        F.when(F.col("i") % 5 == 0, "failed").otherwise("pending").alias("status"),
    )


@pytest.fixture(scope="module")
def projects(spark):
    return spark.range(0, 3000, 1, 4).select(
        "id",
        F.lit("zenodo").alias("download_repository_folder"),
        F.col("id").cast("string").alias("download_project_folder"),
        F.lit(None).cast("string").alias("download_version_folder"),
        F.lit("t").alias("title"),
        F.lit("u").alias("project_url"),
        F.lit("2024-01-01").alias("download_date"),
    )


def executed(df) -> tuple[list, str]:
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan.split("== Initial Plan ==")[0]


def test_plan_of_a_hot_project(spark, small_limits, files, projects):
    rows, plan = executed(wl.plan_all(files, projects, wl.selection("retry_failed")))
    key = [0 if i % 3 == 0 else i % 3000 for i in range(ROWS)]
    chosen = {key[i] for i in range(ROWS) if i % 10 == 0}
    assert len(rows) == sum(i % 2 == 0 and key[i] in chosen for i in range(ROWS))
    assert "skew=true" in plan


def test_decisions_on_a_hot_path(spark, small_limits, files):
    plan = files.select(
        "id",
        "project_id",
        "download_url",
        F.when(F.col("project_id") == 0, F.lit("hot")).otherwise(F.col("download_url")).alias("path"),
    )
    inventory = spark.createDataFrame([], "path STRING")
    heads = files.select("id", F.lit(1).alias("content_length"))
    outcomes = files.select("id", (F.col("id") > 10).alias("fetched"))
    rows, executed_plan = executed(wl.classify(plan, inventory, heads, outcomes))
    assert len(rows) == ROWS
    shared = sorted((r["id"], r["new_status"]) for r in rows if r["path"] == "hot")
    # 0, 3, 6 and 9 fail; 12 is fetched; all later copies are present by then.
    assert [s for _, s in shared[:6]] == ["failed"] * 4 + ["success", "skipped_exists"]
    assert {s for _, s in shared[5:]} == {"skipped_exists"}
    assert "skew=true" in executed_plan


def test_export_of_a_hot_project(spark, small_limits, files, projects):
    rows, plan = executed(reports.files_with_projects(files, projects))
    assert len(rows) == ROWS
    assert [r["file_name"] for r in rows] == sorted(r["file_name"] for r in rows)
    assert "skew=true" in plan


def test_hot_record_reaches_its_final_task_with_few_rows(spark, small_limits):
    seen = spark.range(0, ROWS, 1, 8).withColumnRenamed("id", "i").select(
        F.lit("zenodo").alias("source"), hot("record_id"), F.col("i").alias("query_idx"),
        F.lit(0).alias("repo_idx"), F.lit(1).alias("page"), F.lit(0).alias("pos"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )
    first = dedup_records(seen)
    rows, _ = executed(first)
    assert {r["record_id"]: r["query_idx"] for r in rows}[0] == 0
    assert len(rows) == len({r["record_id"] for r in rows})
    final = first._jdf.queryExecution().executedPlan().executedPlan()
    leaves = final.plan().collectLeaves()
    stages = [leaves.apply(i) for i in range(leaves.size())]
    exchanged = [
        stage.getRuntimeStatistics().rowCount().get()
        for stage in stages
        if stage.getClass().getSimpleName() == "ShuffleQueryStageExec"
    ]
    # Eight tasks send at most one row per key each, far less than the 40,000 of key 0.
    assert len(exchanged) == 1 and len(rows) <= exchanged[0] <= 8 * len(rows)


def test_lookups_of_a_hot_project(spark, small_limits, files, projects):
    keys = projects.select(F.col("id").alias("project_id"))
    rows, plan = executed(reports.children_of(files, "files", keys))
    assert len(rows) == ROWS
    assert "skew=true" in plan


def test_pages_of_a_hot_query(spark, small_limits):
    pages = spark.range(0, ROWS, 1, 8).withColumnRenamed("id", "i").select(
        F.lit("zenodo").alias("repo"), hot("query_idx"),
        F.concat(F.lit("q"), hot("query_idx").cast("string")).alias("query"),
        F.col("i").cast("int").alias("page"), F.lit(25).alias("page_size"), F.lit(False).alias("failed"),
        F.when(F.col("i") == 60_000, 0).otherwise(25).alias("n_records"), F.lit(0).cast("bigint").alias("total"),
        F.sha2(F.col("i").cast("string"), 256).alias("payload"),
    )
    rows, plan = executed(counted_pages(pages, stop_pages(pages)))
    kept = [r for r in rows if r["query_idx"] == 0]
    # Key 0 also takes the rows whose remainder is 0, all of them multiples of three.
    assert max(r["page"] for r in kept) == 59_997
    assert len(rows) == ROWS - (ROWS - 60_000) // 3
    assert "skew=true" in plan
