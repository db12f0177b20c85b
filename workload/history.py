"""Queries that need an order over rows: dedup, page cut-off, ids, last status."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlake.operators.dedup import count_unique, dedup_records
from harvestlake.operators.ids import with_dense_id, with_offsets
from harvestlake.operators.ledger import apply_status, latest_status, update_scores, upsert_scores
from harvestlake.operators.pagination import counted_pages, effective_pages, stop_pages
from harvestlake.operators.records import is_relevant
from workload.projections import cte, view
from workload.records import sql_is_open
from workload.registry import query
from workload.relational import event_pages, event_pages_sql
from workload.scalars import _SCORED, scored



def _last(updates: str) -> str:
    """``last_``: the newest status per file, of equally new ones the greatest."""
    return (
        ", last_ as (select id, status as new_status from (select *, row_number() over (partition by id "
        f"order by updated_at desc, status desc) as n from {updates}_) where n = 1) "
    )


_NEW = (
    ", newest_ as (select * from (select *, row_number() over (partition by project_id order by "
    "arrived desc, relevance_score desc) as n from new_scores_) where n = 1) "
)


def _occurrences(spark, sf_dir):
    """Projects as record occurrences: query, then repository, then id."""
    return view(
        spark, sf_dir, "projects", "id", "source", "record_id", "query_idx", "repository_id"
    ).select(
        "id",
        "source",
        "record_id",
        "query_idx",
        F.col("repository_id").alias("repo_idx"),
        F.col("id").alias("page"),
        F.lit(0).alias("pos"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )


@query(
    "i1_first_occurrence",
    cte("projects")
    + "select id, source, record_id from (select *, row_number() over (partition by source, record_id "
    "order by query_idx, repository_id, id) as n from projects_) where n = 1",
)
def first_occurrence(spark, sf_dir):
    return dedup_records(_occurrences(spark, sf_dir)).select("id", "source", "record_id")


@query("i2_every_occurrence", cte("projects") + "select id, source, record_id from projects_")
def every_occurrence(spark, sf_dir):
    return dedup_records(_occurrences(spark, sf_dir), dedup=False).select(
        "id", "source", "record_id"
    )


@query(
    "h10_unique_relevant_projects",
    _SCORED + "select count(distinct (source, record_id)) as n_unique from scored_ "
    f"where {sql_is_open('license')} and relevance_score >= 1",
)
def unique_relevant_projects(spark, sf_dir):
    return count_unique(
        is_relevant(scored(spark, sf_dir, "license", "source", "record_id"))
    )


@query(
    "j1_counted_pages",
    "with "
    + event_pages_sql()
    + "select p.repo, p.query, p.page, p.n_records from pages_ p join stops_ s on p.repo = s.repo "
    "and p.query = s.query where (s.hard is null or p.page < s.hard) and (s.soft is null or "
    "p.page <= s.soft)",
)
def pages_reached(spark, sf_dir):
    facts = event_pages(spark, sf_dir)
    kept = counted_pages(effective_pages(facts), stop_pages(facts))
    return kept.select("repo", "query", "page", "n_records")


_SPARSE_KEY = "id * 1000 + cast(record_id as bigint) % 1000"


@query(
    "j3_dense_ids",
    cte("projects")
    + f"select id as project, row_number() over (order by {_SPARSE_KEY}) as dense_id from projects_",
)
def dense_ids(spark, sf_dir):
    projects = view(spark, sf_dir, "projects", "id", "record_id").select(
        F.col("id").alias("project"), F.expr(_SPARSE_KEY).alias("place")
    )
    return with_dense_id(projects, "place", "dense_id").select("project", "dense_id")


@query(
    "j3_child_offsets",
    cte("projects")
    + f"select id as project, cast(coalesce(sum(length(title)) over (order by {_SPARSE_KEY} rows "
    "between unbounded preceding and 1 preceding), 0) as bigint) as first_child from projects_",
)
def child_offsets(spark, sf_dir):
    """First child number of every project when it has as many children as title letters."""
    projects = view(spark, sf_dir, "projects", "id", "record_id", "title").select(
        F.col("id").alias("project"), F.expr(_SPARSE_KEY).alias("place"), "title"
    )
    return with_offsets(projects, "place", {"first_child": F.length("title")}).select(
        "project", "first_child"
    )


@query(
    "j2_latest_status",
    cte("all_updates") + _last("all_updates") + "select id, new_status from last_",
)
def newest_status(spark, sf_dir):
    return latest_status(view(spark, sf_dir, "all_updates"))


@query(
    "m2_apply_status",
    cte("files", "updates")
    + _last("updates")
    + "select f.id, f.project_id, coalesce(l.new_status, f.status) as status from files_ f "
    "left join last_ l on f.id = l.id",
)
def status_applied(spark, sf_dir):
    return apply_status(
        view(spark, sf_dir, "files", "id", "project_id", "status"), view(spark, sf_dir, "updates")
    )


@query(
    "m3_upsert_scores",
    cte("relevance_scores", "new_scores")
    + _NEW
    + "select id, project_id, relevance_score, description from relevance_scores_ where project_id "
    "not in (select project_id from new_scores_) union all select (select max(id) from "
    "relevance_scores_) + row_number() over (order by arrived) as id, project_id, relevance_score, "
    "description from newest_",
)
def upserted(spark, sf_dir):
    return upsert_scores(
        view(spark, sf_dir, "relevance_scores"), view(spark, sf_dir, "new_scores"), "arrived"
    )


@query(
    "m4_update_scores",
    cte("relevance_scores", "new_scores")
    + _NEW
    + "select s.id, s.project_id, coalesce(n.relevance_score, s.relevance_score) as relevance_score, "
    "s.description from relevance_scores_ s left join newest_ n on s.project_id = n.project_id",
)
def updated(spark, sf_dir):
    return update_scores(
        view(spark, sf_dir, "relevance_scores"), view(spark, sf_dir, "new_scores"), "arrived"
    )
