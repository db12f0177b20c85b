"""Queries for download planning: work lists, decisions and tallies."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlake.operators import worklist as wl
from harvestlake.operators.joins import join_to_one
from harvestlake.plans.download import download_round, round_tally
from harvestlake.refdata import DEFAULT_EXTENSIONS
from harvestlake.session import scratch_path
from harvestlake.sources.inventory import read_inventory
from workload.projections import cte, view
from workload.registry import query, sql_list

_FILE_COLUMNS = ["id", "project_id", "file_name", "file_type", "download_url", "status"]
_FOLDERS = [
    "id", "download_repository_folder", "download_project_folder", "download_version_folder",
]
_PATH = (
    "'downloads/' || p.download_repository_folder || '/' || p.download_project_folder || "
    "case when coalesce(p.download_version_folder, '') = '' then '' else '/' || "
    "p.download_version_folder end || '/' || f.file_name"
)
_HAS_URL = "coalesce(f.download_url, '') <> ''"


def _files(spark, sf_dir):
    return view(spark, sf_dir, "files", *_FILE_COLUMNS)


def _projects(spark, sf_dir):
    return view(spark, sf_dir, "projects", *_FOLDERS)


def plan_sql(status: str | None, extensions: list[str], strict: bool = False) -> str:
    wanted = f"file_type in {sql_list(extensions)}"
    state = f"status = '{status}'" if status else "true"
    chosen = (
        f"f.{state}" if strict else
        f"f.project_id in (select project_id from files_ where {state} and {wanted})"
    )
    return (
        f"select f.id, {_PATH} as path from files_ f join projects_ p on f.project_id = p.id "
        f"where f.{wanted} and {_HAS_URL} and {chosen}"
    )


@query(
    "n1_plan_for_projects",
    cte("projects", "files")
    + f"select f.id, {_PATH} as path from files_ f join projects_ p on f.project_id = p.id "
    f"where f.file_type in {sql_list(DEFAULT_EXTENSIONS)} and {_HAS_URL} and f.project_id in "
    "(select id from projects_ where repository_id = 1)",
)
def plan_for_projects(spark, sf_dir):
    """Work list for the projects of one repository."""
    keys = view(spark, sf_dir, "projects", "id", "repository_id").where("repository_id = 1")
    return wl.plan_projects(
        _files(spark, sf_dir), _projects(spark, sf_dir), keys.select(F.col("id").alias("project_id"))
    ).select("id", "path")


def _plan(name: str, choice: wl.Selection, strict: bool = False):
    sql = cte("projects", "files") + plan_sql(choice.status_filter, list(choice.extensions), strict)

    @query(name, sql)
    def run(spark, sf_dir):
        return wl.plan_all(
            _files(spark, sf_dir), _projects(spark, sf_dir), choice, strict
        ).select("id", "path")


_plan("n2_plan_pending", wl.selection())
_plan("n2_plan_retry_failed", wl.selection("retry_failed"))
_plan("n2_plan_retry_failed_strict", wl.selection("retry_failed"), strict=True)
_plan("n2_plan_zip", wl.selection("zip"))
_plan("n2_plan_by_type", wl.selection("by_type", "PDF"))
_plan("n2_plan_by_status", wl.selection("by_status", "success"))
_plan("n2_plan_everything", wl.selection("everything"))

# ---- decisions ----------------------------------------------------------------

# File names are made coarse, so that many files of a record share one path.
_COARSE = "'f' || cast(partkey % 5 as string) || '.' || file_type"
_COARSE_FILES = f"coarse_ as (select * replace ({_COARSE} as file_name) from files_)"
_INVENTORY = "suppkey % 13 = 0"

_CHOSEN = (
    "project_id in (select project_id from coarse_ where status = 'pending' and "
    f"file_type in {sql_list(DEFAULT_EXTENSIONS)})"
)


def _decided_sql(taking_part: str = "true") -> str:
    return (
        cte("projects", "files", "outcomes")
        + f", {_COARSE_FILES}, every_ as (select f.*, {_PATH} as path from coarse_ f join projects_ p "
        f"on f.project_id = p.id where f.file_type in {sql_list(DEFAULT_EXTENSIONS)} and {_HAS_URL}), "
        f"plan_ as (select * from every_ where {taking_part}), "
        "first_ as (select l.*, case when l.path in (select path from every_ where "
        f"{_INVENTORY}) then 'skipped_exists' when coalesce(l.content_length, 0) > 524288000 "
        "then 'skipped_size' when o.fetched then 'success' when not o.fetched then 'failed' "
        "else 'pending' end as s, row_number() over (order by l.project_id, l.id) as n from plan_ l "
        "left join outcomes_ o on o.id = l.id), decided_ as (select *, case when n > min(case when s = "
        "'success' then n end) over (partition by path) then 'skipped_exists' else s end as new_status "
        "from first_)"
    )


def _round_inputs(spark, sf_dir):
    files = view(spark, sf_dir, "files").withColumn("file_name", F.expr(_COARSE))
    projects = _projects(spark, sf_dir)
    plan = wl.plan_projects(files, projects)
    inventory = plan.where(_INVENTORY).select("path")
    heads = view(spark, sf_dir, "files", "id", "content_length")
    outcomes = view(spark, sf_dir, "outcomes")
    return files, projects, plan, inventory, heads, outcomes


@query(
    "n4_file_decisions",
    _decided_sql() + " select id, path, new_status from decided_",
)
def decisions(spark, sf_dir):
    _, _, plan, inventory, heads, outcomes = _round_inputs(spark, sf_dir)
    return wl.classify(plan.select("id", "project_id", "path"), inventory, heads, outcomes).select(
        "id", "path", "new_status"
    )


@query(
    "download_round",
    _decided_sql(_CHOSEN)
    + " select coalesce(d.new_status, f.status) as new_status, count(*) as n from coarse_ f "
    "left join decided_ d on f.id = d.id group by 1",
)
def whole_round(spark, sf_dir):
    """Statuses after a round over every project with a pending file."""
    files, projects, _, inventory, heads, outcomes = _round_inputs(spark, sf_dir)
    after = download_round(files, projects, inventory, heads, outcomes)
    return after.groupBy("new_status").agg(F.count("*").alias("n"))


# ---- decisions by the files that a folder holds -----------------------------------

# Folders are made coarse too, so that the number of files written doesn't grow with the tables.
_FEW_FOLDERS = {
    "download_project_folder": "cast(cast(download_project_folder as bigint) % 10 as string)",
    "download_version_folder": "''",
}
_STORED = "path like '%/f1.%' and path not like 'downloads/zenodo/%'"


def write_files(paths, root: str) -> None:
    """A file at each of the distinct paths below ``root``, holding its own path; a repeated task writes it again."""

    def write(rows):
        from pyarrow import fs

        uri = root if "://" in root else "file://" + root.removeprefix("file:")
        store, base = fs.FileSystem.from_uri(uri)
        for row in rows:
            store.create_dir(f"{base}/{row.path}".rpartition("/")[0])
            with store.open_output_stream(f"{base}/{row.path}") as out:
                out.write(row.path.encode())

    paths.foreachPartition(write)


@query(
    "n4_listed_files",
    _decided_sql()
    .replace(_INVENTORY, _STORED)
    .replace("join projects_ p", "join few_ p")
    .replace(
        ", coarse_ as",
        ", few_ as (select * replace (" + ", ".join(f"{e} as {c}" for c, e in _FEW_FOLDERS.items())
        + ") from projects_), coarse_ as",
    )
    + f" select id, path, new_status, case when {_STORED} then length(path) end as length from decided_",
)
def listed_files(spark, sf_dir):
    """Decisions by a listing of files that were written before, with the length of what is there."""
    files = view(spark, sf_dir, "files").withColumn("file_name", F.expr(_COARSE))
    projects = _projects(spark, sf_dir).withColumns({c: F.expr(e) for c, e in _FEW_FOLDERS.items()})
    plan = wl.plan_projects(files, projects).select("id", "project_id", "path")
    root = scratch_path(spark, "files")
    write_files(plan.where(_STORED).select("path").distinct(), root)
    inventory = read_inventory(spark, f"{root}/downloads")
    heads = view(spark, sf_dir, "files", "id", "content_length")
    decided = wl.classify(plan, inventory, heads, view(spark, sf_dir, "outcomes"))
    return join_to_one(decided, inventory.select("path", "length"), ["path"]).select("id", "path", "new_status", "length")


# ---- tallies ------------------------------------------------------------------


@query(
    "h7_outcome_tally",
    cte("files")
    + "select cast(count_if(status = 'success') as bigint) as success, "
    "cast(count_if(status = 'failed') as bigint) as failed, "
    "cast(count_if(status not in ('success', 'failed')) as bigint) as skipped from files_",
)
def tally(spark, sf_dir):
    return wl.outcome_tally(view(spark, sf_dir, "files", "status"))


def _per_project_sql(extensions: list[str], state: str, stored: str = "true") -> str:
    wanted = f"file_type in {sql_list(extensions)}"
    planned = f"{wanted} and coalesce(download_url, '') <> ''"
    return (
        f", stored_ as (select id from projects_ where {stored}), sums_ as (select project_id, "
        f"count(*) as n_files, count_if({state}) as n_status, count_if({state} and {wanted}) as "
        f"n_matching, count_if({planned}) as n_planned, count_if({planned} and status = 'success') "
        f"as s, count_if({planned} and status = 'failed') as f from files_ group by project_id), "
        "tallies_ as (select m.*, p.id is not null as known, case when p.id is null then 0 else s end "
        "as success, case when p.id is null then 0 else f end as failed, case when p.id is null then 1 "
        "when n_planned = 0 then n_files else n_planned - s - f end as skipped from sums_ m "
        "left join stored_ p on p.id = m.project_id) "
    )


_OPEN_STORED = "license is not null"


@query(
    "h8_tally_per_project",
    cte("projects", "files")
    + _per_project_sql(DEFAULT_EXTENSIONS, "status = 'pending'", _OPEN_STORED)
    + "select project_id, cast(success as bigint) as success, cast(failed as bigint) as failed, "
    "cast(skipped as bigint) as skipped from tallies_",
)
def per_project(spark, sf_dir):
    """Tally per project; projects without a licence are taken as not stored."""
    stored = view(spark, sf_dir, "projects", "id", "license").where(_OPEN_STORED)
    return wl.project_tallies(_files(spark, sf_dir), stored, status="status").select(
        "project_id", "success", "failed", "skipped"
    )


def _run_tally(name: str, choice: wl.Selection):
    state = f"status = '{choice.status_filter}'" if choice.status_filter else "true"
    sql = (
        cte("projects", "files")
        + _per_project_sql(list(choice.extensions), state, _OPEN_STORED)
        + "select cast(coalesce(sum(success) filter (known and n_matching > 0), 0) as bigint) as "
        "success, cast(coalesce(sum(failed) filter (known and n_matching > 0), 0) as bigint) as "
        "failed, cast(case when sum(n_matching) = 0 then sum(n_status) else "
        "coalesce(sum(skipped) filter (known and n_matching > 0), 0) end as bigint) as skipped "
        "from tallies_"
    )

    @query(name, sql)
    def run(spark, sf_dir):
        stored = view(spark, sf_dir, "projects", "id", "license").where(_OPEN_STORED)
        return wl.run_tally(_files(spark, sf_dir), stored, choice, status="status")


_run_tally("h9_skip_accounting", wl.selection())
_run_tally("h9_skip_accounting_zip", wl.selection("zip"))
_run_tally("h9_skip_accounting_no_match", wl.selection("by_type", "docx"))
_run_tally("h9_skip_accounting_everything", wl.selection("everything"))


@query(
    "download_round_tally",
    _decided_sql(_CHOSEN)
    + f", after_ as (select f.project_id, f.file_type in {sql_list(DEFAULT_EXTENSIONS)} and {_HAS_URL} "
    f"as planned, d.new_status from coarse_ f left join decided_ d on f.id = d.id where f.{_CHOSEN}), "
    "sums_ as (select count(*) as n, count_if(planned) as p, "
    "count_if(planned and new_status = 'success') as s, count_if(planned and new_status = 'failed') "
    "as e from after_ group by project_id) select cast(sum(s) as bigint) as success, cast(sum(e) as "
    "bigint) as failed, cast(sum(case when p = 0 then n else p - s - e end) as bigint) as skipped "
    "from sums_",
)
def whole_round_tally(spark, sf_dir):
    files, projects, _, inventory, heads, outcomes = _round_inputs(spark, sf_dir)
    return round_tally(download_round(files, projects, inventory, heads, outcomes), projects)
