"""Queries over tables stored for a purpose: bucketed by project, partial counts, a query index."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from harvestlake.operators import reports as rep
from harvestlake.operators import worklist as wl
from harvestlake.operators.matching import match_query_table
from harvestlake.session import scratch_path, stage
from harvestlake.sources.bucketed import BucketedTables, buckets_for
from harvestlake.sources.catalog import Catalog
from harvestlake.sources.rollup import refresh, report
from workload.history import _NEW, _last
from workload.planning import plan_sql
from workload.projections import catalog, cte, view
from workload.registry import query
from workload.tables import stored_files

# ---- bucketed by project --------------------------------------------------------


def bucketed(spark, sf_dir, **columns: list[str]) -> BucketedTables:
    """The named views as one set of bucketed tables."""
    views = {name: view(spark, sf_dir, name, *wanted) for name, wanted in columns.items()}
    size = max(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in views.values())
    store = BucketedTables(spark, scratch_path(spark, "bucketed"), f"b{uuid.uuid4().hex}", max(8, buckets_for(size)))
    for name, df in views.items():
        store.save(name, df)
    return store


@query(
    "g2_bucketed_files",
    cte("projects", "files")
    + "select f.id, p.title, p.project_url, f.file_name, f.file_type, f.status from files_ f "
    "join projects_ p on f.project_id = p.id order by p.download_date desc, f.file_name, f.id",
)
def bucketed_files(spark, sf_dir):
    """Files with their projects, joined in place; only the listing's order moves rows."""
    store = bucketed(
        spark, sf_dir, files=["id", "project_id", "file_name", "file_type", "status"],
        projects=["id", "title", "project_url", "download_date"],
    )
    return rep.files_with_projects(store.read("files"), store.read("projects"))


_CHOICE = wl.selection("retry_failed")


@query(
    "n2_bucketed_plan",
    cte("projects", "files") + plan_sql(_CHOICE.status_filter, list(_CHOICE.extensions)),
)
def bucketed_plan(spark, sf_dir):
    """The retry work list from bucketed tables: project selection and folders without an exchange."""
    store = bucketed(
        spark, sf_dir, files=["id", "project_id", "file_name", "file_type", "download_url", "status"],
        projects=["id", "download_repository_folder", "download_project_folder", "download_version_folder"],
    )
    return wl.plan_all(store.read("files"), store.read("projects"), _CHOICE, colocated=True).select("id", "path")


# ---- the report from partial counts ---------------------------------------------

_TABLES = ["projects", "files", "keywords", "person_role", "licenses"]


@query(
    "h4_incremental_report",
    cte(*_TABLES, "relevance_scores", "updates", "new_scores")
    + _last("updates").rstrip()
    + _NEW
    + ", now_ as (select coalesce(l.new_status, f.status) as status from files_ f left join last_ l on f.id = l.id), "
    "scores_ as (select relevance_score as s from relevance_scores_ where project_id not in "
    "(select project_id from new_scores_) union all select relevance_score from newest_) "
    + " union all ".join(
        f"select 'rows' as metric, '{t}' as key, cast(count(*) as double) as value from {t}_" for t in _TABLES
    )
    + " union all select 'files_by_status', status, cast(count(*) as double) from now_ group by status "
    "union all select 'relevance_score', 'min', cast(min(s) as double) from scores_ "
    "union all select 'relevance_score', 'max', cast(max(s) as double) from scores_ "
    "union all select 'relevance_score', 'avg', avg(s) from scores_",
)
def incremental_report(spark, sf_dir):
    """The overview after two batches, status changes and new scores, from partial counts only."""
    store = Catalog(spark, scratch_path(spark, "catalog"))
    files, updates = stored_files(spark, sf_dir)
    tables = {**catalog(spark, sf_dir), "files": files}
    tables["projects"] = tables["projects"].withColumn("repository_url", F.lit("https://repo.invalid"))
    tables["keywords"] = tables["keywords"].withColumn("id", F.xxhash64("id"))
    for batch in range(2):
        own = {t: df.where(F.col("id" if t == "projects" else "project_id") % 2 == batch) for t, df in tables.items()}
        store.append(own, str(batch))
        refresh(store)
    store.apply_status(stage(updates, "updates"))
    store.upsert_scores(view(spark, sf_dir, "new_scores"), "new", "arrived")
    return report(store)


# ---- a table of queries -----------------------------------------------------------

_PHRASE = "[A-Za-z]{3,} [A-Za-z]{3,} [A-Za-z]{3,}"


@query(
    "g10_query_table",
    f"with p_ as (select distinct regexp_extract(text, '{_PHRASE}') as phrase from documents), "
    "q_ as (select phrase, split_part(phrase, ' ', 2) as word from p_ where phrase <> '') "
    "select d.doc_id, '\"' || phrase || '\" ' || word as query from (select doc_id, "
    "lower(source || chr(10) || text) as t from documents) d join q_ on contains(d.t, lower(phrase)) "
    "and contains(d.t, lower(word))",
)
def query_table(spark, sf_dir):
    """As many search queries as there are different first phrases in the texts, against all texts."""
    docs = view(spark, sf_dir, "documents", "doc_id", "source", "text")
    phrases = docs.select(F.regexp_extract("text", _PHRASE, 0).alias("phrase")).where("phrase <> ''").distinct()
    queries = phrases.select(
        F.xxhash64("phrase").alias("query_idx"),
        F.concat(F.lit('"'), "phrase", F.lit('" '), F.split_part("phrase", F.lit(" "), F.lit(2))).alias("query"),
    )
    return match_query_table(docs, queries, "doc_id", "source", "text").select("doc_id", "query")
