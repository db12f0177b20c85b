"""Planning, decisions and tallies against hand-written cases."""

import pytest
from pyspark.sql import functions as F

from harvestlake.operators import ledger, reports
from harvestlake.operators import worklist as wl
from harvestlake.plans.download import download_round, round_tally

FILES = "id INT, project_id INT, file_name STRING, file_type STRING, download_url STRING, status STRING"
PROJECTS = (
    "id INT, download_repository_folder STRING, download_project_folder STRING, "
    "download_version_folder STRING"
)


@pytest.fixture(scope="module")
def catalog(spark):
    files = spark.createDataFrame(
        [
            (1, 1, "a.pdf", "pdf", "u1", "pending"),
            (2, 1, "b.pdf", "pdf", "u2", "success"),
            (3, 1, "c.py", "py", "u3", "pending"),
            (4, 2, "d.pdf", "pdf", "", "pending"),
            (5, 2, "e.zip", "zip", None, "failed"),
            (6, 3, "f.csv", "csv", "u6", "failed"),
            (7, 9, "g.pdf", "pdf", "u7", "pending"),
        ],
        FILES,
    )
    projects = spark.createDataFrame(
        [(1, "zenodo", "p1", None), (2, "zenodo", "p2", ""), (3, "dryad", "p3", "v2")], PROJECTS
    )
    return files, projects


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize(
    "choice, strict, expected",
    [
        (wl.selection(), False, [1, 2]),
        (wl.selection(), True, [1]),
        (wl.selection("retry_failed"), False, [6]),
        (wl.selection("by_status", "success"), False, [1, 2]),
        (wl.selection("zip"), False, []),
        (wl.selection("by_type", "CSV"), False, []),
        (wl.selection("everything"), False, [1, 2, 6]),
    ],
)
def test_plan_all(catalog, choice, strict, expected):
    assert ids(wl.plan_all(*catalog, choice, strict)) == expected


def test_paths(catalog):
    plan = wl.plan_projects(*catalog)
    assert {r["id"]: r["path"] for r in plan.collect()} == {
        1: "downloads/zenodo/p1/a.pdf", 2: "downloads/zenodo/p1/b.pdf", 6: "downloads/dryad/p3/v2/f.csv",
    }


def test_unknown_preset():
    with pytest.raises(ValueError):
        wl.selection("nothing")


def test_decisions(spark):
    plan = spark.createDataFrame(
        [(1, 1, "present"), (2, 1, "large"), (3, 1, "unknown"), (4, 1, "bad"), (5, 1, "later"), (6, 1, "zero")],
        "id INT, project_id INT, path STRING",
    )
    inventory = spark.createDataFrame([("present",), ("present",)], "path STRING")
    limit = 500 * 1024 * 1024
    heads = spark.createDataFrame(
        [(1, limit + 1), (2, limit + 1), (3, None), (4, limit), (6, 0)], "id INT, content_length BIGINT"
    )
    outcomes = spark.createDataFrame(
        [(1, True), (2, True), (3, True), (4, False), (6, True)], "id INT, fetched BOOLEAN"
    )
    got = {r["id"]: r["new_status"] for r in wl.classify(plan, inventory, heads, outcomes).collect()}
    assert got == {
        1: "skipped_exists", 2: "skipped_size", 3: "success", 4: "failed", 5: "pending", 6: "success",
    }


def test_a_retried_file_has_one_decision(spark):
    plan = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id INT, project_id INT, path STRING")
    nothing = spark.createDataFrame([], "path STRING")
    heads = spark.createDataFrame([(1, 5), (1, None), (1, 7)], "id INT, content_length BIGINT")
    outcomes = spark.createDataFrame([(1, False), (1, True), (2, False), (2, False)], "id INT, fetched BOOLEAN")
    got = sorted((r["id"], r["new_status"]) for r in wl.classify(plan, nothing, heads, outcomes).collect())
    assert got == [(1, "success"), (2, "failed")]


def test_copies_of_a_record_share_a_path(spark):
    plan = spark.createDataFrame(
        [(5, 1, "p"), (6, 2, "p"), (7, 3, "p"), (8, 4, "q")], "id INT, project_id INT, path STRING"
    )
    nothing = spark.createDataFrame([], "path STRING")
    heads = spark.createDataFrame([], "id INT, content_length BIGINT")
    outcomes = spark.createDataFrame(
        [(5, False), (6, True), (7, True), (8, True)], "id INT, fetched BOOLEAN"
    )
    got = {r["id"]: r["new_status"] for r in wl.classify(plan, nothing, heads, outcomes).collect()}
    assert got == {5: "failed", 6: "success", 7: "skipped_exists", 8: "success"}
    alone = wl.classify(plan, nothing, heads, outcomes, shared_paths=False)
    assert {r["id"]: r["new_status"] for r in alone.collect()}[7] == "success"


def test_skip_accounting(spark, catalog):
    files, projects = catalog
    after = files.withColumn(
        "new_status", F.when(F.col("id") == 1, "success").otherwise(F.col("status"))
    )
    per = {r["project_id"]: (r["success"], r["failed"], r["skipped"]) for r in wl.project_tallies(after, projects).collect()}
    assert per == {1: (2, 0, 0), 2: (0, 0, 2), 3: (0, 1, 0), 9: (0, 0, 1)}
    assert tuple(wl.run_tally(after, projects).first()) == (2, 0, 2)
    # No pending file is a docx: every pending file counts as skipped.
    none = wl.run_tally(after, projects, wl.selection("by_type", "docx"))
    assert tuple(none.first()) == (0, 0, 4)
    empty = wl.run_tally(after, projects, wl.selection("by_status", "skipped"))
    assert tuple(empty.first()) == (0, 0, 0)


def test_round_and_tally_agree(spark, catalog):
    files, projects = catalog
    inventory = spark.createDataFrame([("downloads/zenodo/p1/b.pdf",)], "path STRING")
    heads = spark.createDataFrame([(1, 10)], "id INT, content_length BIGINT")
    outcomes = spark.createDataFrame([(1, True), (2, True)], "id INT, fetched BOOLEAN")
    after = download_round(files, projects, inventory, heads, outcomes)
    assert {r["id"]: r["new_status"] for r in after.collect()} == {
        1: "success", 2: "skipped_exists", 3: "pending", 4: "pending", 5: "failed", 6: "failed", 7: "pending",
    }
    assert tuple(round_tally(after, projects).first()) == (1, 0, 3)


def test_outcome_tally_sums_to_rows(catalog):
    row = wl.outcome_tally(catalog[0]).first()
    assert sum(row) == catalog[0].count() and tuple(row) == (1, 2, 4)


def test_report_group(spark):
    df = spark.createDataFrame([("skipped_size",), ("skipped_no_url",), ("failed",)], "status STRING")
    got = [r[0] for r in df.select(reports.report_group(F.col("status"))).collect()]
    assert got == ["skipped", "skipped", "failed"]


# ---- status and score changes -------------------------------------------------


def test_apply_status(spark):
    files = spark.createDataFrame([(1, "pending", "a"), (2, "failed", "b")], "id INT, status STRING, file_name STRING")
    updates = spark.createDataFrame(
        [(1, "success", 2), (1, "failed", 1), (7, "success", 1)], "id INT, status STRING, updated_at INT"
    )
    got = ledger.apply_status(files, updates)
    assert got.columns == files.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, "success", "a"), (2, "failed", "b")]


SCORES = "id BIGINT, project_id BIGINT, relevance_score INT, description STRING"


def test_upsert_scores(spark):
    current = spark.createDataFrame([(1, 10, 3, "a"), (2, 20, 4, "b")], SCORES)
    new = spark.createDataFrame(
        [(10, 7, "x", 5), (10, 8, "y", 6), (30, 1, None, 1)],
        "project_id BIGINT, relevance_score INT, description STRING, arrived BIGINT",
    )
    got = sorted(tuple(r) for r in ledger.upsert_scores(current, new, "arrived").collect())
    assert got == [(2, 20, 4, "b"), (3, 30, 1, None), (4, 10, 8, "y")]
    # without an order the highest score of a project is stored, once
    got = sorted(tuple(r) for r in ledger.upsert_scores(current, new).collect())
    assert got == [(2, 20, 4, "b"), (3, 10, 8, "y"), (4, 30, 1, None)]


def test_update_scores(spark):
    current = spark.createDataFrame([(1, 10, 3, "a"), (2, 20, 4, None)], SCORES)
    new = spark.createDataFrame([(10, 9), (99, 1)], "project_id BIGINT, relevance_score INT")
    got = sorted(tuple(r) for r in ledger.update_scores(current, new).collect())
    assert got == [(1, 10, 9, "a"), (2, 20, 4, None)]
    twice = spark.createDataFrame([(10, 5, 2), (10, 6, 1)], "project_id BIGINT, relevance_score INT, at INT")
    assert [r["relevance_score"] for r in ledger.update_scores(current, twice).orderBy("id").collect()] == [6, 4]
    assert [r["relevance_score"] for r in ledger.update_scores(current, twice, "at").orderBy("id").collect()] == [5, 4]


def test_ties_of_status_updates_have_one_result(spark):
    updates = spark.createDataFrame(
        [(1, "failed", 3), (1, "success", 3), (1, "pending", 2), (2, "failed", None), (2, "pending", 1)],
        "id INT, status STRING, updated_at INT",
    )
    got = sorted(tuple(r) for r in ledger.latest_status(updates.repartition(3)).collect())
    assert got == [(1, "success"), (2, "pending")]


def test_children_of_one_project(spark, catalog):
    files, _ = catalog
    assert [r["id"] for r in reports.children_of(files, "files", 1).collect()] == [1, 2, 3]
    keys = spark.createDataFrame([(3,), (3,), (2,)], "project_id INT")
    assert [r["id"] for r in reports.children_of(files, "files", keys).collect()] == [4, 5, 6]
