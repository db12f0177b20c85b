"""Shredding, the stored tables, checks, exports and SQL."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from harvestlake import schemas
from harvestlake.operators import integrity, reports
from harvestlake.operators.records import attach_repository, score, source_name
from harvestlake.operators.shred import catalog_parents, shred, with_defaults
from harvestlake.plans.collect import collect, load_catalog, relevant_records
from harvestlake.session import stage
from harvestlake.sources.catalog import Catalog
from harvestlake.sources.export import export_files, export_projects, read_export
from workload.payloads import landing_pages, side_documents
from workload.tables import stored_files

RECORDS = (
    "repo STRING, query STRING, query_idx INT, repo_idx INT, page INT, pos INT, fetched_at TIMESTAMP, "
    "source STRING, record_id STRING, title STRING, publication_date STRING, doi STRING, "
    "license STRING, record_page STRING, archive_download_link STRING, description STRING, "
    f"files {schemas.FILES}, creators ARRAY<STRING>, keywords ARRAY<STRING>"
)


def records(spark):
    day = datetime.datetime(2024, 5, 6)

    def row(repo, query_idx, page, pos, record_id, **more):
        fields = {
            "title": "Interview", "publication_date": "", "doi": "", "license": "cc0",
            "record_page": "P", "archive_download_link": "", "description": "D",
            "files": [], "creators": [], "keywords": [],
        } | more
        return (repo, f"q{query_idx}", query_idx, 0, page, pos, day, repo, record_id, *fields.values())

    return score(
        spark.createDataFrame(
            [
                row("zenodo", 0, 1, 0, "1", files=[("a.qdpx", "u", "qdpx"), ("b", None, "")],
                    creators=["A", " ", "B "], keywords=["k", "\t", ""], doi="10.1/x",
                    publication_date="2021-02"),
                row("zenodo", 0, 1, 1, "2", license=""),
                row("elsewhere", 0, 2, 0, "3"),
                row("cessda", 1, 1, 0, "4", creators=["C"], files=[("c.pdf", "u", "pdf")]),
                row("zenodo", 1, 1, 0, "1", keywords=["again"]),
            ],
            RECORDS,
        )
    )


@pytest.fixture(scope="module")
def staged(spark):
    return stage(records(spark))


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy("id").collect()]


def test_shred(staged):
    tables = shred(stage(catalog_parents(staged)))
    assert list(tables) == list(schemas.TABLES)
    projects = tables["projects"]
    order = rows(projects, "id", "query_string", "download_repository_folder", "download_project_folder")
    assert [o[0] for o in order] == [1, 2, 3, 4]
    assert order[0][1:] == ("q0", "zenodo", "1") and order[1][1:] == ("q0", "zenodo", "2")
    assert {o[1:] for o in order[2:]} == {("q1", "cessda", "4"), ("q1", "zenodo", "1")}
    first = projects.where("id = 1").first()
    assert first["upload_date"] == datetime.date(2021, 2, 1) and first["doi"] == "10.1/x"
    assert first["version"] is None and first["language"] is None
    assert rows(tables["files"].where("project_id = 1"), "id", "file_name", "file_type", "status") == [
        (1, "a.qdpx", "qdpx", "pending"), (2, "b", "", "pending"),
    ]
    assert rows(tables["person_role"].where("project_id = 1"), "id", "name", "role") == [
        (1, "A", "AUTHOR"), (2, "B ", "AUTHOR"),
    ]
    assert rows(tables["keywords"], "id", "keyword") == [(1, "k"), (2, "again")]
    assert tables["licenses"].count() == 3, "an empty licence is not stored"
    assert tables["relevance_scores"].where("project_id = 1").first()["relevance_score"] == 11


def test_shred_and_reassemble(spark, sf_dir):
    found = relevant_records(
        landing_pages(spark, sf_dir), side_documents(spark, sf_dir), cut_off=False
    )
    parents = stage(catalog_parents(stage(found)))
    tables = shred(parents)
    names = (
        tables["files"].groupBy("project_id")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "file_name"))),
                                      lambda s: s["file_name"]), "|").alias("names"))
    )
    expected = parents.where(F.size("files") > 0).select(
        F.col("_projects").alias("project_id"),
        F.array_join(F.transform("files", lambda f: f["name"]), "|").alias("names"),
    )
    assert sorted(names.collect()) == sorted(expected.collect())
    assert integrity.check_catalog(tables).count() == 0
    for df in tables.values():
        n, distinct, top = df.agg(F.count("*"), F.count_distinct("id"), F.max("id")).first()
        assert n == distinct == top


def test_defaults_fill_missing_columns(spark):
    df = with_defaults(spark.createDataFrame([(1, 2, "f")], "id INT, project_id INT, file_name STRING"), "files")
    assert df.first()["status"] == "pending" and df.columns == [
        "id", "project_id", "file_name", "file_type", "download_url", "status",
    ]
    people = with_defaults(spark.createDataFrame([(1, 2, "n", None)], "id INT, project_id INT, name STRING, role STRING"), "person_role")
    assert people.first()["role"] == "UNKNOWN"
    project = with_defaults(spark.createDataFrame([(1,)], "id INT"), "projects")
    assert project.first()["download_date"] is not None


def test_repository_lookup(spark):
    names = ["ZenodoClient", "CESSDAClient", "zenodo", "OtherClient", "OtherClient"]
    sources = ["x", "x", "x", "figshare", "nobody"]
    df = spark.createDataFrame(list(zip(range(5), names, sources)), "i INT, client STRING, source STRING")
    found = attach_repository(df.withColumn("client", source_name(F.col("client"))), "client", "source")
    got = [tuple(r)[3:] for r in found.orderBy("i").collect()]
    assert got == [
        (1, "https://zenodo.org", "API-CALL"),
        (3, "https://datacatalogue.cessda.eu", "SCRAPING"),
        (1, "https://zenodo.org", "API-CALL"),
        (4, "", "API-CALL"),
        (0, "", "API-CALL"),
    ]


def test_append_rewrite_reset(spark, staged, tmp_path):
    store = Catalog(spark, str(tmp_path / "catalog"))
    assert store.read("projects").count() == 0
    load_catalog(store, staged, "0", staged=False)
    load_catalog(store, staged, "1")
    load_catalog(store, staged, "1")  # a repeated batch is stored once
    counts = {n: df.count() for n, df in store.tables().items()}
    assert counts["projects"] == 8 and counts["relevance_scores"] == 8
    assert store.read("projects").select("id").distinct().count() == 8
    assert integrity.check_catalog(store.tables()).count() == 0

    store.rewrite("files", lambda rows: rows.withColumn("status", F.lit("success")))
    assert [r[0] for r in store.read("files").select("status").distinct().collect()] == ["success"]
    load_catalog(store, staged, "2")
    assert store.read("files").count() == counts["files"] // 2 * 3
    before = sorted(store.read("projects").collect())
    store.compact("projects")
    assert sorted(store.read("projects").collect()) == before

    found = store.sql("select count(*) as n from projects where repository_id = ?", [3])
    assert found.first()["n"] == 3
    store.rewrite("keywords", lambda rows: rows.where("batch <> '1'"))
    assert store.read("keywords").count() == 4, "a partition that has no rows any more is gone"
    store.reset()
    assert all(df.count() == 0 for df in store.tables().values())
    load_catalog(store, staged, "0")
    assert store.read("projects").agg(F.min("id")).first()[0] == 1, "ids restart after a reset"


def test_stored_records_are_not_staged_again(spark, sf_dir, tmp_path, monkeypatch):
    pages, side = landing_pages(spark, sf_dir), side_documents(spark, sf_dir)
    records = stage(relevant_records(pages, side), "records")
    tables, written = [], []
    monkeypatch.setattr("harvestlake.session.stage", lambda df, name, path: written.append(name) or stage(df, name, path))
    for stored in (False, True):
        store = Catalog(spark, str(tmp_path / str(stored)))
        load_catalog(store, records, "0", stored=stored)
        tables.append({t: df.drop("download_date").collect() for t, df in store.tables().items()})
    assert written == ["records", "parents", "parents"]
    assert tables[0]["files"] and all(sorted(tables[0][t], key=str) == sorted(tables[1][t], key=str) for t in tables[0])


def test_a_write_that_dies_half_way(spark, staged, tmp_path, monkeypatch):
    """Its rows aren't seen, its ids aren't taken, others may write, and a repetition completes it."""
    store = Catalog(spark, str(tmp_path / "catalog"))
    load_catalog(store, staged, "0")
    before = {n: sorted(df.collect()) for n, df in store.tables().items()}
    write = Catalog._write

    def dies(self, df, table, batch):
        if table == "keywords":
            raise OSError("the driver is gone")
        return write(self, df, table, batch)

    monkeypatch.setattr(Catalog, "_write", dies)
    with pytest.raises(OSError):
        load_catalog(store, staged, "1")
    monkeypatch.undo()
    assert (tmp_path / "catalog" / "projects" / "batch=1").exists()
    assert {n: sorted(df.collect()) for n, df in store.tables().items()} == before
    load_catalog(store, staged.where("record_id = '4'"), "2")
    assert store.read("projects").agg(F.max("id")).first()[0] == 5
    load_catalog(store, staged, "1")
    for name, df in store.tables().items():
        n, distinct = df.agg(F.count("*"), F.count_distinct("id")).first()
        assert n == distinct, name
    assert store.read("projects").count() == 9
    assert integrity.check_catalog(store.tables()).count() == 0


def test_rows_that_break_a_rule_are_set_apart(spark, staged, tmp_path):
    store = Catalog(spark, str(tmp_path / "catalog"))
    load_catalog(store, staged.where("query_idx = 1"), "0")
    held = {r["id"] for r in store.read("projects").collect()}
    tables = shred(stage(catalog_parents(staged, store.highest_ids())))
    bad = tables["projects"].agg(F.min("id")).first()[0]
    tables["projects"] = tables["projects"].withColumn("title", F.when(F.col("id") != bad, F.col("title")))
    old = tables["relevance_scores"].limit(1).select(
        F.lit(900).cast("bigint").alias("id"), F.lit(min(held)).cast("bigint").alias("project_id"), "relevance_score", "description")
    twice = tables["relevance_scores"].withColumn("id", F.col("id") + 500)
    tables["relevance_scores"] = tables["relevance_scores"].unionByName(old).unionByName(twice)
    counts = store.append_checked(tables, "1")
    assert counts["projects"] == {"stored": 3, "not null: title": 1}
    assert counts["files"]["foreign key: project_id"] == 2 and counts["files"]["stored"] == 1
    assert counts["relevance_scores"] == {"stored": 3, "foreign key: project_id": 2, "unique: project_id": 5}
    assert store.append_checked(tables, "1") == {}
    assert integrity.check_catalog(store.tables()).count() == 0
    assert [tuple(r) for r in store.rejected("projects").select("id", "broken").collect()] == [(bad, ["not null: title"])]
    assert sorted(len(r["broken"]) for r in store.rejected("relevance_scores").collect()) == [1] * 5 + [2]
    assert store.rejected("keywords").count() == 1 and store.read("projects").count() == 5
    assert store.highest_ids().keys() == set(schemas.TABLES)


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("part-*")}


def test_changes_rewrite_only_the_partitions_they_touch(spark, staged, tmp_path):
    store = Catalog(spark, str(tmp_path / "catalog"))
    for batch in "0123":
        load_catalog(store, staged, batch)
    folder = tmp_path / "catalog"
    before = files_of(folder)
    file_id = store.rows("files").where("batch = '2'").first()["id"]
    updates = spark.createDataFrame(
        [(file_id, "failed", 1), (file_id, "success", 2), (999, "failed", 1)], "id INT, status STRING, updated_at INT"
    )
    store.apply_status(updates)
    after = files_of(folder)
    moved = {p for p in before.keys() ^ after.keys()} | {p for p in before if after.get(p, before[p]) != before[p]}
    assert moved and all("/files/batch=2/" in p for p in moved)
    assert [r["id"] for r in store.read("files").where("status = 'success'").collect()] == [file_id]

    scored = store.rows("relevance_scores")
    project = scored.where("batch = '1'").first()["project_id"]
    new = spark.createDataFrame([(project, 77, "d", 1), (project, 78, "d", 2), (5000, 1, "n", 3)],
                                "project_id INT, relevance_score INT, description STRING, arrived LONG")
    top = scored.agg(F.max("id")).first()[0]
    before = files_of(folder)
    store.upsert_scores(new, "scores", "arrived")
    store.upsert_scores(new, "scores", "arrived")
    moved = before.keys() - files_of(folder).keys()
    assert moved and all("/relevance_scores/batch=1/" in p for p in moved)
    got = {r["project_id"]: (r["id"], r["relevance_score"]) for r in store.read("relevance_scores").where(f"id > {top}").collect()}
    assert got == {project: (top + 1, 78), 5000: (top + 2, 1)}
    assert store.read("relevance_scores").count() == 17


def test_compacted_tables_are_clustered(spark, staged, tmp_path):
    store = Catalog(spark, str(tmp_path / "catalog"))
    many = staged.crossJoin(spark.range(8).withColumnRenamed("id", "k")).withColumn("page", F.expr("page * 10 + k")).drop("k")
    load_catalog(store, many.repartition(8), "0")
    before = sorted(store.read("files").collect())
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # the few rows of a test would end in one file
    try:
        store.compact("files")
    finally:
        spark.conf.set(merge, "true")
    assert sorted(store.read("files").collect()) == before
    files = spark.read.parquet(f"{store.base}/files").groupBy(F.input_file_name().alias("file")).agg(
        F.min(F.struct("project_id", "id")).alias("lo"), F.max(F.struct("project_id", "id")).alias("hi")
    )
    ranges = sorted((tuple(r["lo"]), tuple(r["hi"])) for r in files.collect())
    assert len(ranges) > 1
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_refetched_pages_give_their_records_once(spark, sf_dir):
    """Copies landed twice, failed copies fetched again, and stale copies change nothing."""
    pages, side = stage(landing_pages(spark, sf_dir)), side_documents(spark, sf_dir)
    failed = pages.where("page = 2").withColumns({"failed": F.lit(True), "payload": F.lit(None).cast("string")})
    later = F.col("fetched_at") + F.expr("interval 1 day")
    earlier = F.col("fetched_at") - F.expr("interval 1 day")
    landed = (
        pages.unionByName(failed.withColumn("fetched_at", earlier))
        .unionByName(failed.withColumn("fetched_at", later))
        .unionByName(pages.where("page = 3"))
        .unionByName(pages.where("page = 4").withColumns({"fetched_at": earlier, "payload": F.lit("{}")}))
    )
    columns = ["repo", "query_idx", "page", "pos", "record_id", "title", "relevance_score"]
    want = relevant_records(pages, side).select(*columns)
    assert sorted(relevant_records(landed, side).select(*columns).collect()) == sorted(want.collect())


def test_collect_keeps_first_hits(spark, sf_dir):
    pages, side = landing_pages(spark, sf_dir), side_documents(spark, sf_dir)
    again = pages.withColumn("query_idx", F.col("query_idx") + 50)
    once = collect(pages, side)
    twice = collect(pages.unionByName(again), side)
    assert once.count() == twice.count() > 0
    assert twice.agg(F.max("query_idx")).first()[0] < 50
    assert collect(pages.unionByName(again), side, dedup=False).count() == 2 * once.count()


def test_check_catalog_finds_each_kind(staged):
    tables = shred(stage(catalog_parents(staged)))
    tables["projects"] = tables["projects"].withColumns(
        {"title": F.when(F.col("id") != 2, F.col("title")),
         "download_method": F.when(F.col("id") == 3, "FTP").otherwise(F.col("download_method"))}
    )
    tables["files"] = tables["files"].withColumn("project_id", F.lit(77))
    tables["relevance_scores"] = tables["relevance_scores"].unionByName(tables["relevance_scores"])
    found = {(r["table_name"], r["rule"]): r["n"] for r in integrity.violation_counts(integrity.check_catalog(tables)).collect()}
    assert found == {
        ("projects", "not null: title"): 1,
        ("projects", "check: download_method"): 1,
        ("files", "foreign key: project_id"): 3,
        ("relevance_scores", "unique: project_id"): 4,
    }


def test_exports_keep_order_and_odd_text(spark, tmp_path):
    projects = spark.createDataFrame(
        [(1, 'say "hi", ok', "u", "2020-01-01"), (2, "two\nlines", "u", "2022-01-01"), (3, "", "u", "2021-01-01")],
        "id INT, title STRING, project_url STRING, download_date STRING",
    )
    export_projects(projects, str(tmp_path / "p"))
    back = read_export(spark, str(tmp_path / "p"), "id STRING, title STRING, project_url STRING, download_date STRING")
    assert {r["id"]: r["title"] for r in back.collect()} == {"1": 'say "hi", ok', "2": "two\nlines", "3": None}
    parts = sorted((tmp_path / "p").glob("part-*.csv"))
    text = "".join(p.read_text().split("\n", 1)[1] for p in parts if p.stat().st_size)
    assert text.index("2022") < text.index("2021") < text.index("2020")
    assert parts[0].read_text().splitlines()[0] == "id,title,project_url,download_date"

    files = spark.createDataFrame(
        [(10, 1, "b", "", "pending"), (11, 1, "a", "pdf", "failed"), (12, 2, "z", "zip", "pending"), (13, 9, "x", "", "failed")],
        "id INT, project_id INT, file_name STRING, file_type STRING, status STRING",
    )
    export_files(files, projects, str(tmp_path / "f"))
    lines = [
        line for p in sorted((tmp_path / "f").glob("part-*.csv"))
        for line in p.read_text().splitlines() if line[:2] in ("10", "11", "12", "13")
    ]
    assert [line[:2] for line in lines] == ["12", "11", "10"], "orphans are left out"


@pytest.mark.parametrize("listing, key", [
    (lambda s, d: reports.projects_newest_first(_v(s, d, "projects")), lambda r: (_desc(r["download_date"]), r["id"])),
    (lambda s, d: reports.files_by_status(_v(s, d, "files"), "pending"), lambda r: (r["project_id"], r["file_name"], r["id"])),
    (lambda s, d: reports.projects_by_relevance(_v(s, d, "projects"), _v(s, d, "relevance_scores")),
     lambda r: (-(r["relevance_score"] or 0), _desc(r["download_date"]), r["id"])),
])
def test_listings_are_ordered(spark, sf_dir, listing, key):
    found = [r.asDict() for r in listing(spark, sf_dir).collect()]
    assert found and found == sorted(found, key=key)


def _v(spark, sf_dir, name):
    from workload.projections import view

    return view(spark, sf_dir, name)


def _desc(day):
    return -int(day.replace("-", ""))


def test_reports_on_empty_tables(spark):
    empty = {n: spark.createDataFrame([], ddl) for n, ddl in schemas.TABLES.items()}
    assert tuple(reports.score_summary(empty["relevance_scores"]).first()) == (0, 0, 0.0)
    assert reports.status_shares(empty["files"]).count() == 0
    report = {(r["metric"], r["key"]): r["value"] for r in reports.stats(empty).collect()}
    assert report[("rows", "projects")] == 0 and report[("relevance_score", "avg")] == 0.0


def test_filters_reach_the_stored_files(spark, staged, tmp_path):
    store = Catalog(spark, str(tmp_path / "catalog"))
    load_catalog(store, staged, "0")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    pending = plan(reports.files_by_status(store.read("files"), "pending").select("file_name"))
    assert "EqualTo(status,pending)" in pending and "download_url" not in pending
    zenodo = plan(store.read("projects").where("repository_id = 1").select("title"))
    assert "EqualTo(repository_id,1)" in zenodo and "description" not in zenodo
    assert "dynamicpruning" in zenodo or "BroadcastHashJoin" in zenodo


def test_block_staging_leaves_nothing_behind(spark, tmp_path):
    from pathlib import Path

    from harvestlake.session import scratch_root, staging

    root = Path(scratch_root(spark)) / "harvestlake"
    root.mkdir(parents=True, exist_ok=True)
    before = {p.name for p in root.glob("*/block")} | {str(p) for p in root.glob("*/block/*")}
    with staging(spark) as put:
        assert put(spark.range(5), "numbers").count() == 5
    assert {p.name for p in root.glob("*/block")} | {str(p) for p in root.glob("*/block/*")} == before


def test_status_changes_deal_whole_rows_once(spark, tmp_path, monkeypatch):
    store = Catalog(spark, str(tmp_path / "catalog"))
    files = spark.createDataFrame(
        [(i, i % 3, f"f{i}", "csv", None, "pending") for i in range(9)], schemas.TABLES["files"]
    )
    for batch in (0, 1):
        store.append({"files": files.where(F.col("id") % 2 == batch)}, str(batch))
    plans = []
    overwrite = Catalog._overwrite

    def spied(self, table, rows, settle=None):
        dealt = rows.repartitionByRange("batch", "project_id", "id").sortWithinPartitions("batch", "project_id", "id")
        plans.append(settle(dealt)._jdf.queryExecution().executedPlan().toString())
        overwrite(self, table, rows, settle)

    monkeypatch.setattr(Catalog, "_overwrite", spied)
    updates = [(1, "failed", 1), (1, "success", 2), (4, None, 9), (7, "failed", 1), (99, "failed", 1)]
    store.apply_status(spark.createDataFrame(updates, "id BIGINT, status STRING, updated_at BIGINT"))
    assert [re.findall(r"\bExchange (\w+)", plan) for plan in plans] == [["rangepartitioning"]]
    changed = {r["id"]: r["status"] for r in store.read("files").where("status <> 'pending'").collect()}
    assert changed == {1: "success", 7: "failed"} and store.read("files").count() == 9


def test_stored_files_of_one_name_are_stored_once_each(spark, tmp_path):
    kind = (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE, l_linestatus STRING"
    )
    rows = [(1, 5, 4, 1, 1.0, "O"), (1, 5, 4, 1, 1.0, "F"), (2, 7, 4, 1, 1.0, "F"), (1, 5, 4, 2, 1.0, "O")]
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "lineitem.parquet"))
    files, updates = stored_files(spark, str(tmp_path))
    assert sorted((r["id"], r["name"], r["status"]) for r in files.collect()) == [
        (1, "1_1_5_4", "success"), (2, "1_1_5_4", "pending"), (3, "1_2_5_4", "pending"), (4, "2_1_7_4", "success")
    ]
    # Three rows of a changed part, in two steps each; those of one name are changes of both files of that name.
    assert sorted(r["id"] for r in updates.collect()) == [1] * 4 + [2] * 4 + [3] * 2


def test_a_title_is_put_in_lower_case_once(spark):
    plan = records(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
