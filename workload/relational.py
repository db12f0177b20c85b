"""Queries for filters, lookups, joins, counts and ordered listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlake.functions.licences import is_open_licence
from harvestlake.operators import reports as rep
from harvestlake.operators.matching import match_queries
from harvestlake.operators.pagination import expected_pages, missing_pages
from harvestlake.operators.records import is_relevant
from harvestlake.operators import worklist as wl
from harvestlake.refdata import DEFAULT_EXTENSIONS, all_queries, query_terms
from workload.projections import catalog, cte, view
from workload.records import sql_is_open
from workload.registry import query, sql_list
from workload.scalars import _SCORED, scored

# ---- E: filters and lookups ---------------------------------------------------


@query(
    "e5_wanted_extensions",
    cte("files")
    + f"select id, file_type from files_ where file_type in {sql_list(DEFAULT_EXTENSIONS)}",
)
def wanted_extensions(spark, sf_dir):
    return rep.with_extension(view(spark, sf_dir, "files", "id", "file_type"), DEFAULT_EXTENSIONS)


@query(
    "e6_files_with_url",
    cte("files") + "select id, download_url from files_ where coalesce(download_url, '') <> ''",
)
def files_with_url(spark, sf_dir):
    return rep.with_url(view(spark, sf_dir, "files", "id", "download_url"))


_FILE_COLUMNS = ["id", "project_id", "file_name", "file_type", "download_url", "status"]


@query(
    "e7_files_by_status",
    cte("files") + f"select {', '.join(_FILE_COLUMNS)} from files_ where status = 'failed' "
    "order by project_id, file_name, id",
)
def files_by_status(spark, sf_dir):
    return rep.files_by_status(view(spark, sf_dir, "files", *_FILE_COLUMNS), "failed")


@query(
    "e8_project_by_id",
    cte("projects") + "select id, title, doi from projects_ where id = 77",
)
def project_by_id(spark, sf_dir):
    return rep.project_by_id(view(spark, sf_dir, "projects", "id", "title", "doi"), 77)


_OPEN_KEYS = f", keys_ as (select id as project_id from projects_ where {sql_is_open('license')}) "


def _open_keys(spark, sf_dir):
    """Ids of the open-licensed projects."""
    return (
        view(spark, sf_dir, "projects", "id", "license")
        .where(is_open_licence(F.col("license")))
        .select(F.col("id").alias("project_id"))
    )


def _lookup(name: str, table: str, columns: str, order: str):
    sql = (
        cte("projects", table) + _OPEN_KEYS + f"select {columns} from {table}_ "
        f"where project_id in (select project_id from keys_) order by {order}"
    )

    @query(name, sql)
    def run(spark, sf_dir):
        child = view(spark, sf_dir, table, *columns.split(", "))
        return rep.children_of(child, table, _open_keys(spark, sf_dir))


_lookup("e8_files_of_projects", "files", ", ".join(_FILE_COLUMNS), "project_id, id")
_lookup("e8_keywords_of_projects", "keywords", "id, project_id, keyword", "project_id, keyword, id")
_lookup("e8_people_of_projects", "person_role", "id, project_id, name, role", "project_id, name, id")
_lookup("e8_licences_of_projects", "licenses", "id, project_id, license", "project_id, license, id")

# ---- G: joins -----------------------------------------------------------------

_RELEVANCE_COLUMNS = "id, title, download_date"


def _by_relevance(name: str, minimum: int):
    sql = (
        cte("projects", "relevance_scores")
        + "select p.id, p.title, p.download_date, s.relevance_score from projects_ p "
        f"left join relevance_scores_ s on p.id = s.project_id where coalesce(s.relevance_score, 0) "
        f">= {minimum} order by coalesce(s.relevance_score, 0) desc, p.download_date desc, p.id"
    )

    @query(name, sql)
    def run(spark, sf_dir):
        return rep.projects_by_relevance(
            view(spark, sf_dir, "projects", *_RELEVANCE_COLUMNS.split(", ")),
            view(spark, sf_dir, "relevance_scores"),
            minimum,
        )


_by_relevance("g1_projects_by_relevance_all", 0)
_by_relevance("g1_projects_by_relevance_min3", 3)


@query(
    "g2_files_with_projects",
    cte("projects", "files")
    + "select f.id, p.title, p.project_url, f.file_name, f.file_type, f.status from files_ f "
    "join projects_ p on f.project_id = p.id order by p.download_date desc, f.file_name, f.id",
)
def files_with_projects(spark, sf_dir):
    return rep.files_with_projects(
        view(spark, sf_dir, "files"), view(spark, sf_dir, "projects")
    )


@query(
    "g3_projects_with_failed_files",
    cte("projects", "files")
    + "select id, title, download_date from projects_ where id in (select distinct project_id "
    "from files_ where status = 'failed') order by download_date desc, id",
)
def with_failed_files(spark, sf_dir):
    return rep.projects_with_status(
        view(spark, sf_dir, "projects", "id", "title", "download_date"),
        view(spark, sf_dir, "files", "project_id", "status"),
        "failed",
    )


_KNOWN = f"(select id from projects_ where {sql_is_open('license')})"


@query(
    "g4_groups_with_a_project",
    cte("projects", "files")
    + f"select distinct project_id from files_ where status = 'pending' and file_type in "
    f"{sql_list(DEFAULT_EXTENSIONS)} and project_id in {_KNOWN}",
)
def existing_groups(spark, sf_dir):
    """Work-list groups, where only open-licensed projects are stored."""
    stored = view(spark, sf_dir, "projects", "id", "license").where(
        is_open_licence(F.col("license"))
    )
    groups = wl.selected_projects(
        view(spark, sf_dir, "files", "project_id", "status", "file_type"), wl.selection()
    )
    return wl.existing_projects(groups, stored)


# Landed pages: every event is one copy of a page, computed from its own row. Pages are
# landed up to several times, a fifth of the copies as failed.
_EVENT_PAGES = (
    "select event_type || '-' || cast(cast(floor(event_id / 240) as bigint) as string) as query, "
    "cast(floor(event_id / 240) as int) as query_idx, "
    "case user_id % 4 when 0 then 'zenodo' when 1 then 'dryad' when 2 then 'cessda' "
    "else 'figshare' end as repo, cast(1 + floor((event_id % 240) / 20) as int) as page, "
    "25 as page_size, event_id, event_id as fetched_at, event_id % 5 = 0 as failed, "
    "cast(event_id % 7 as int) as n_records, "
    "case when event_id % 3 = 0 then 0 else 25 * (event_id % 24) end as total from events"
)


def event_pages(spark, sf_dir):
    """Facts of all landed copies of pages, derived from ``events``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.createOrReplaceTempView("events_source")
    columns = _EVENT_PAGES.removeprefix("select ").removesuffix(" from events")
    return spark.sql(f"select {columns} from events_source")


def event_pages_sql(where: str = "true") -> str:
    """``pages_`` (one copy of each page: success first, then the newest) and ``stops_``."""
    return (
        f"pages_ as (select * from (select *, row_number() over (partition by repo, query, page "
        f"order by failed, event_id desc) as copy from ({_EVENT_PAGES}) where {where}) where copy = 1), "
        "stops_ as (select repo, query, min(case when failed or n_records = 0 then page end) as hard, "
        "min(case when total <> 0 and page * page_size >= total then page end) as soft "
        "from pages_ group by repo, query) "
    )


@query(
    "g8_missing_pages",
    "with "
    + event_pages_sql("event_id % 11 <> 0")
    + f", queries_ as (select distinct query, query_idx from ({_EVENT_PAGES})), repos_ as (select * "
    "from (values ('zenodo', 25), ('dryad', 40), ('cessda', 40), ('figshare', 40)) as r(repo, cap)) "
    "select q.query, r.repo, cast(n.page as int) as page, cast(least(40, r.cap) as int) as size, "
    'cast((n.page - 1) * 40 as bigint) as "offset" from queries_ q cross join repos_ r cross join '
    "(select unnest(range(1, 13)) as page) n left join stops_ s on s.repo = r.repo and "
    "s.query = q.query where (least(s.soft, s.hard) is null or n.page <= least(s.soft, s.hard)) "
    "and not exists (select 1 from pages_ l where l.repo = r.repo and l.query = q.query and "
    "l.page = n.page and not l.failed)",
)
def pages_to_fetch(spark, sf_dir):
    """Expected pages that have not been landed, or as failed only; a part is missing."""
    facts = event_pages(spark, sf_dir)
    queries = facts.select("query_idx", "query").distinct()
    expected = expected_pages(queries, max_pages=12, page_size=40, with_token=False)
    landed = facts.where("event_id % 11 <> 0")
    return missing_pages(expected, landed, refetch_failed=True).select(
        "query", "repo", "page", "size", "offset"
    )


_MATCH_QUERIES = all_queries() + [
    "the", '"of the"', "eaux la", '"is he" of', "der die", "worthless", "ING tion", "QUE los",
]


def _match_sql(queries: list[str]) -> str:
    rows = ", ".join(
        "({}, '{}', [{}])".format(
            i,
            q.replace("'", "''"),
            ", ".join("'" + t.lower().replace("'", "''") + "'" for t in query_terms(q)),
        )
        for i, q in enumerate(queries)
    )
    return (
        f"with q_ as (select * from (values {rows}) as v(query_idx, query, terms)), d_ as materialized "
        "(select doc_id, lower(source || chr(10) || text) as t from documents) "
        "select doc_id, cast(query_idx as int) as query_idx, query from d_, q_ "
        "where list_bool_and([contains(t, x) for x in terms])"
    )


@query("g10_query_term_match", _match_sql(_MATCH_QUERIES))
def term_match(spark, sf_dir):
    """All fixed search queries and a few that occur in the texts, against whole texts."""
    docs = view(spark, sf_dir, "documents", "doc_id", "source", "text")
    return match_queries(docs, _MATCH_QUERIES, "source", "text").select(
        "doc_id", "query_idx", "query"
    )


# Every document gets the terms of one of the fixed queries, so that each of them has hits.
_PLANTED = [" ".join(query_terms(q)).replace("'", "''") for q in all_queries()]


def _planted_sql(array: str) -> str:
    terms = ", ".join(f"'{t}'" for t in _PLANTED)
    return f"text || ' ' || {array.format(terms)}[cast(doc_id % {len(_PLANTED)} as int) + {{}}]"


@query(
    "g10_planted_terms",
    _match_sql(all_queries()).replace(
        "from documents", f"from (select doc_id, source, {_planted_sql('([{}])').format(1)} as text from documents)"
    ),
)
def planted_match(spark, sf_dir):
    """The 67 fixed queries against whole texts that carry the terms of one of them."""
    docs = view(spark, sf_dir, "documents", "doc_id", "source", "text").withColumn(
        "text", F.expr(_planted_sql("array({})").format(0))
    )
    return match_queries(docs, all_queries(), "source", "text").select("doc_id", "query_idx", "query")


@query(
    "g9_files_not_present",
    cte("projects", "files")
    + ", plan_ as (select f.id, p.download_project_folder || '/' || f.file_name as path, f.suppkey "
    "from files_ f join projects_ p on f.project_id = p.id) select id, path from plan_ "
    "where path not in (select path from plan_ where suppkey % 13 = 0)",
)
def files_not_present(spark, sf_dir):
    plan, inventory = _plan_and_inventory(spark, sf_dir)
    return wl.not_present(plan, inventory).select("id", "path")


@query(
    "g9_files_present",
    cte("projects", "files")
    + ", plan_ as (select f.id, p.download_project_folder || '/' || f.file_name as path, f.suppkey "
    "from files_ f join projects_ p on f.project_id = p.id) select id, path from plan_ "
    "where path in (select path from plan_ where suppkey % 13 = 0)",
)
def files_present(spark, sf_dir):
    plan, inventory = _plan_and_inventory(spark, sf_dir)
    return wl.already_present(plan, inventory).select("id", "path")


def _plan_and_inventory(spark, sf_dir):
    files = view(spark, sf_dir, "files", "id", "project_id", "file_name", "suppkey")
    projects = view(spark, sf_dir, "projects", "id", "download_project_folder")
    plan = files.join(projects.withColumnRenamed("id", "project_id"), "project_id").select(
        "id", F.concat_ws("/", "download_project_folder", "file_name").alias("path"), "suppkey"
    )
    return plan.drop("suppkey"), plan.where("suppkey % 13 = 0").select("path")


# ---- H: counts ----------------------------------------------------------------

_TABLES = ["projects", "files", "keywords", "person_role", "licenses"]


@query(
    "h1_table_counts",
    cte(*_TABLES)
    + " union all ".join(f"select '{t}' as metric, count(*) as value from {t}_" for t in _TABLES),
)
def table_counts(spark, sf_dir):
    tables = catalog(spark, sf_dir)
    return rep.table_counts({t: tables[t] for t in _TABLES})


@query(
    "h2_files_by_status",
    cte("files") + "select status, count(*) as n from files_ group by status",
)
def status_counts(spark, sf_dir):
    return rep.status_counts(view(spark, sf_dir, "files", "status"))


@query(
    "h3_score_summary",
    cte("relevance_scores")
    + "select coalesce(min(relevance_score), 0) as score_min, coalesce(max(relevance_score), 0) "
    "as score_max, coalesce(avg(relevance_score), 0.0) as score_avg from relevance_scores_",
)
def score_summary(spark, sf_dir):
    return rep.score_summary(view(spark, sf_dir, "relevance_scores"))


@query(
    "h4_stats_report",
    cte(*_TABLES, "relevance_scores")
    + " union all ".join(
        f"select 'rows' as metric, '{t}' as key, cast(count(*) as double) as value from {t}_"
        for t in _TABLES
    )
    + " union all select 'files_by_status', status, cast(count(*) as double) from files_ "
    "group by status union all select 'relevance_score', 'min', cast(min(relevance_score) as double) "
    "from relevance_scores_ union all select 'relevance_score', 'max', "
    "cast(max(relevance_score) as double) from relevance_scores_ union all "
    "select 'relevance_score', 'avg', avg(relevance_score) from relevance_scores_",
)
def stats(spark, sf_dir):
    return rep.stats(catalog(spark, sf_dir))


@query("h5_distinct_projects", cte("files") + "select distinct project_id from files_")
def distinct_projects(spark, sf_dir):
    return rep.distinct_projects(view(spark, sf_dir, "files", "project_id"))


@query(
    "h6_status_shares",
    cte("files")
    + "select status, count(*) as n, cast(100.0 as double) * count(*) / (select count(*) from files_) "
    "as pct from files_ group by status",
)
def status_shares(spark, sf_dir):
    return rep.status_shares(view(spark, sf_dir, "files", "status"))


@query(
    "n5_report_groups",
    cte("files")
    + "select case when starts_with(status, 'skipped') then 'skipped' else status end as "
    "report_status, count(*) as n from files_ group by 1",
)
def report_groups(spark, sf_dir):
    files = view(spark, sf_dir, "files", "status")
    return files.groupBy(rep.report_group(F.col("status")).alias("report_status")).agg(
        F.count("*").alias("n")
    )


@query(
    "h2_score_distribution",
    _SCORED + f"select relevance_score, count(*) as n from scored_ where {sql_is_open('license')} "
    "and relevance_score >= -100 group by relevance_score",
)
def score_distribution(spark, sf_dir):
    everything = is_relevant(scored(spark, sf_dir, "license"), min_score=-100)
    return everything.groupBy("relevance_score").agg(F.count("*").alias("n"))


# ---- K: order and limit -------------------------------------------------------


@query(
    "k1_projects_newest_first",
    cte("projects") + "select id, title, download_date from projects_ order by download_date desc, id",
)
def newest_first(spark, sf_dir):
    return rep.projects_newest_first(view(spark, sf_dir, "projects", "id", "title", "download_date"))


@query(
    "k5_best_scored_first",
    cte("projects", "relevance_scores")
    + "select p.id, p.download_date, s.relevance_score from projects_ p left join relevance_scores_ "
    "s on p.id = s.project_id order by coalesce(s.relevance_score, 0) desc, p.download_date desc, p.id",
)
def best_first(spark, sf_dir):
    return rep.projects_by_relevance(
        view(spark, sf_dir, "projects", "id", "download_date"),
        view(spark, sf_dir, "relevance_scores"),
    )


def _listing(name: str, status: str):
    @query(
        name,
        cte("files") + f"select id, file_name, file_type, download_url from files_ "
        f"where status = '{status}' order by project_id, file_name, id limit 50",
    )
    def run(spark, sf_dir):
        return rep.first_with_status(view(spark, sf_dir, "files"), status)


_listing("k7_first_pending", "pending")
_listing("k7_first_failed", "failed")
