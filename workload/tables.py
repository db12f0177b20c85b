"""Queries over the catalog tables as stored: scans, SQL, exports, checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from harvestlake.operators.integrity import check_catalog, violation_counts
from harvestlake.operators.shred import table_columns
from harvestlake.session import scratch_path, stage
from harvestlake.sources.catalog import Catalog, catalog_sql
from harvestlake.sources.export import export_files, export_projects, read_export
from workload.history import _NEW, _last
from workload.projections import VIEWS, catalog, cte, view
from workload.registry import query


@query("a2_scan_projects", cte("projects") + "select * from projects_")
def scan_projects(spark, sf_dir):
    return view(spark, sf_dir, "projects")


@query("a2_scan_files", cte("files") + "select * from files_")
def scan_files(spark, sf_dir):
    return view(spark, sf_dir, "files")


@query(
    "a2_stored_table",
    cte("relevance_scores") + "select * from relevance_scores_",
)
def stored_table(spark, sf_dir):
    """A table written to the catalog folder and scanned from there."""
    store = Catalog(spark, scratch_path(spark, "catalog"))
    store.append({"relevance_scores": view(spark, sf_dir, "relevance_scores")})
    return store.read("relevance_scores")


def _stored_in_two(spark, sf_dir, table):
    """The table's rows appended in two batches."""
    store = Catalog(spark, scratch_path(spark, "catalog"))
    rows = view(spark, sf_dir, table)
    key = "id" if table == "projects" else "project_id"
    for batch, half in (("even", 0), ("odd", 1)):
        store.append({table: rows.where(F.col(key) % 2 == half)}, batch)
    return store


_STORED_PROJECTS = [c for c in table_columns("projects") if c in dict(VIEWS["projects"][2]) and c != "download_date"]


@query(
    "a2_stored_projects",
    cte("projects") + f"select {', '.join(_STORED_PROJECTS)} from projects_",
)
def stored_projects(spark, sf_dir):
    """Projects of two batches, read in full through the catalog."""
    return _stored_in_two(spark, sf_dir, "projects").read("projects").select(*_STORED_PROJECTS)


@query(
    "m2_stored_status",
    cte("files", "updates")
    + _last("updates")
    + "select f.id, f.project_id, coalesce(l.new_status, f.status) as status from "
    "(select row_number() over (order by id) as id, id as name, project_id, status from files_) f "
    "left join last_ l on f.name = l.id",
)
def stored_status(spark, sf_dir):
    """Status changes stored in the partitions that hold the changed files."""
    store = Catalog(spark, scratch_path(spark, "catalog"))
    files, updates = stored_files(spark, sf_dir)
    for batch in range(4):
        store.append({"files": files.where(F.col("project_id") % 4 == batch)}, str(batch))
    store.apply_status(stage(updates, "updates"))
    return store.read("files").select("id", "project_id", "status")


def stored_files(spark, sf_dir):
    """Files and status changes with ids as they are stored."""
    files = view(spark, sf_dir, "files").withColumnRenamed("id", "name")
    # Stored ids are numbers: places in the order of the names.
    files = _numbered(files.select("name", *[c for c in table_columns("files") if c != "id"]))
    named = view(spark, sf_dir, "updates").withColumnRenamed("id", "name")
    updates = named.join(files.select("name", "id"), "name")
    return files, updates.select("id", "status", "updated_at")


def _numbered(files):
    """The files staged with their dense place in the order of the names (``id``); files without a name drop out.

    Whole rows are dealt once, in ranges, and written with their place in the range. Of files of one
    name that with the greatest status comes first.
    """
    order = ["name", F.desc_nulls_last("status"), *[c for c in files.columns if c not in ("name", "status")]]
    ranged = files.repartitionByRange(*order).sortWithinPartitions(*order)
    # Of a task's sorted rows: its number and the place in it.
    placed = ranged.withColumn("place", F.monotonically_increasing_id())
    placed = stage(
        placed.withColumns({"part": F.shiftright("place", 33), "k": F.col("place").bitwiseAND(F.lit((1 << 33) - 1))})
        .drop("place"),
        "files",
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("n")  # a row per part
    starts = sizes.select("part", before.alias("before"))
    return (
        placed.where("name is not null")
        .join(F.broadcast(starts), "part")
        .select((F.col("before") + F.col("k") + 1).alias("id"), *files.columns)
    )


@query(
    "m3_stored_upsert",
    cte("relevance_scores", "new_scores")
    + _NEW
    + "select id, project_id, relevance_score, description from relevance_scores_ where project_id "
    "not in (select project_id from new_scores_) union all select (select max(id) from "
    "relevance_scores_) + row_number() over (order by arrived) as id, project_id, relevance_score, "
    "description from newest_",
)
def stored_upsert(spark, sf_dir):
    """Scores of two stored batches replaced by a third, which rewrites what it touches."""
    store = _stored_in_two(spark, sf_dir, "relevance_scores")
    store.upsert_scores(view(spark, sf_dir, "new_scores"), "new", "arrived")
    return store.read("relevance_scores")


@query(
    "a3_catalog_sql",
    cte("projects", "files")
    + "select p.query_string, f.file_type, count(*) as n from files_ f join projects_ p "
    "on f.project_id = p.id where f.status = 'failed' and f.content_length >= 100000000 "
    "group by p.query_string, f.file_type",
)
def parameterised_sql(spark, sf_dir):
    return catalog_sql(
        spark,
        {n: view(spark, sf_dir, n) for n in ("projects", "files")},
        "select p.query_string, f.file_type, count(*) as n from files f join projects p "
        "on f.project_id = p.id where f.status = ? and f.content_length >= ? "
        "group by p.query_string, f.file_type",
        ["failed", 100_000_000],
    )


_PROJECT_COLUMNS = [c for c, _ in VIEWS["projects"][2]]


@query(
    "a4_export_projects",
    cte("projects")
    + "select "
    + ", ".join(f"nullif(cast({c} as string), '') as {c}" for c in _PROJECT_COLUMNS)
    + " from projects_",
)
def exported_projects(spark, sf_dir):
    """CSV export read back as text; empty cells are NULL."""
    path = scratch_path(spark, "projects_csv")
    export_projects(view(spark, sf_dir, "projects"), path)
    return read_export(spark, path, ", ".join(f"{c} STRING" for c in _PROJECT_COLUMNS))


@query(
    "a5_export_files",
    cte("projects", "files")
    + "select f.id, nullif(p.title, '') as title, p.project_url, f.file_name, "
    "nullif(f.file_type, '') as file_type, f.status from files_ f join projects_ p "
    "on f.project_id = p.id",
)
def exported_files(spark, sf_dir):
    path = scratch_path(spark, "files_csv")
    export_files(view(spark, sf_dir, "files"), view(spark, sf_dir, "projects"), path)
    return read_export(
        spark,
        path,
        "id STRING, title STRING, project_url STRING, file_name STRING, file_type STRING, "
        "status STRING",
    )


@query(
    "a8_integrity_violations",
    cte("projects", "files", "relevance_scores")
    + ", bad_projects_ as (select * replace (case when id % 97 = 0 then null else title end as title, "
    "case when id % 89 = 0 then 'FTP' else download_method end as download_method) from projects_), "
    "bad_files_ as (select * replace (case when suppkey % 50 = 7 then project_id + 1000000000 else "
    "project_id end as project_id, case when partkey % 31 = 0 then null else file_name end as "
    "file_name) from files_), bad_scores_ as (select * from relevance_scores_ union all "
    "select * from relevance_scores_ where project_id % 101 = 0), found_ as ("
    "select 'projects' as table_name, 'not null: title' as rule from bad_projects_ where title is null "
    "union all select 'projects', 'not null: description' from bad_projects_ where description is null "
    "union all select 'projects', 'check: download_method' from bad_projects_ "
    "where download_method not in ('SCRAPING', 'API-CALL') "
    "union all select 'files', 'not null: file_name' from bad_files_ where file_name is null "
    "union all select 'files', 'foreign key: project_id' from bad_files_ f "
    "where not exists (select 1 from projects_ p where p.id = f.project_id) "
    "union all select 'relevance_scores', 'unique: project_id' from (select project_id from "
    "bad_scores_ group by project_id having count(*) > 1)) "
    "select table_name, rule, count(*) as n from found_ group by table_name, rule",
)
def integrity(spark, sf_dir):
    """The tables with broken rows put in; every declared rule is checked."""
    tables = catalog(spark, sf_dir)
    tables["projects"] = tables["projects"].withColumns(
        {
            "title": F.expr("case when id % 97 = 0 then null else title end"),
            "download_method": F.expr("case when id % 89 = 0 then 'FTP' else download_method end"),
        }
    )
    tables["files"] = tables["files"].withColumns(
        {
            "project_id": F.expr(
                "case when suppkey % 50 = 7 then project_id + 1000000000 else project_id end"
            ),
            "file_name": F.expr("case when partkey % 31 = 0 then null else file_name end"),
        }
    )
    scores = tables["relevance_scores"]
    tables["relevance_scores"] = scores.unionByName(scores.where("project_id % 101 = 0"))
    return violation_counts(check_catalog(tables))


_GATED = (
    cte("projects", "files", "relevance_scores")
    + ", p_ as (select id, title is null or id % 97 = 0 as t, description is null as d, "
    "id % 89 = 0 as m from projects_), good_ as (select id from p_ where not t and not d and not m), "
    "f_ as (select case when suppkey % 50 = 7 then project_id + 1000000000 else project_id end as project_id, "
    "partkey % 31 = 0 as n from files_), fk_ as (select n, project_id not in (select id from good_) as k from f_), "
    "s_ as (select project_id, false as u from relevance_scores_ union all "
    "select project_id, true from relevance_scores_ where project_id % 101 = 0), "
    "sk_ as (select u, project_id not in (select id from good_) as k from s_) "
)


def _gated_counts() -> str:
    tests = [
        ("projects", "stored", "p_ where not t and not d and not m"),
        ("projects", "not null: title", "p_ where t"),
        ("projects", "not null: description", "p_ where d"),
        ("projects", "check: download_method", "p_ where m"),
        ("files", "stored", "fk_ where not n and not k"),
        ("files", "not null: file_name", "fk_ where n"),
        ("files", "foreign key: project_id", "fk_ where k"),
        ("relevance_scores", "stored", "sk_ where not u and not k"),
        ("relevance_scores", "foreign key: project_id", "sk_ where k"),
        ("relevance_scores", "unique: project_id", "sk_ where u"),
    ]
    parts = [f"select '{t}' as table_name, '{r}' as rule, count(*) as n from {rows}" for t, r, rows in tests]
    return _GATED + " union all ".join(parts)


@query("a8_gated_batch", _gated_counts())
def gated_batch(spark, sf_dir):
    """A batch with broken rows: the rest is stored, the others are listed with their rules."""
    tables = catalog(spark, sf_dir)
    tables["projects"] = tables["projects"].withColumns(
        {
            "title": F.expr("case when id % 97 = 0 then null else title end"),
            "download_method": F.expr("case when id % 89 = 0 then 'FTP' else download_method end"),
            "repository_url": F.lit("https://repo.invalid"),
        }
    )
    tables["files"] = tables["files"].withColumns(
        {
            "id": F.xxhash64("id"),
            "project_id": F.expr("case when suppkey % 50 = 7 then project_id + 1000000000 else project_id end"),
            "file_name": F.expr("case when partkey % 31 = 0 then null else file_name end"),
        }
    )
    scores = tables["relevance_scores"]
    again = scores.where("project_id % 101 = 0").withColumn("id", F.col("id") + 1_000_000_000)
    tables["relevance_scores"] = scores.unionByName(again)
    store = Catalog(spark, scratch_path(spark, "catalog"))
    store.append_checked({t: tables[t] for t in ("files", "relevance_scores", "projects")}, "0")
    found = None
    for table in ("projects", "files", "relevance_scores"):
        stored = store.read(table).agg(F.count("*").alias("n")).select(
            F.lit(table).alias("table_name"), F.lit("stored").alias("rule"), "n"
        )
        broken = store.rejected(table).select(F.lit(table).alias("table_name"), F.explode("broken").alias("rule"))
        part = stored.unionByName(broken.groupBy("table_name", "rule").agg(F.count("*").alias("n")))
        found = part if found is None else found.unionByName(part)
    return found
