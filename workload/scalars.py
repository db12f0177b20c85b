"""Queries for column normalisation, array facts, predicates and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlake.functions import licences, nested, text
from harvestlake.functions.relevance import record_score, title_score
from harvestlake.operators import records as r
from harvestlake.operators.reports import relevance_of
from harvestlake.operators.worklist import exceeds_size
from harvestlake.refdata import CODE_EXTENSIONS, TEXT_EXTENSIONS, TOOL_EXTENSIONS
from workload.payloads import hits, landing_pages
from workload.projections import cte, view
from workload.records import sql_is_open, sql_title_score
from workload.registry import query, sql_list

# ---- C: normalisation ---------------------------------------------------------

_ODD_NAME = (
    "case suppkey % 6 when 0 then file_name when 1 then upper(file_name) "
    "when 2 then 'noext' when 3 then file_name || '.' when 4 then '.' || file_type "
    "else 'a.b/' || file_name || '.tar.GZ' end"
)


@query(
    "c1_file_extension",
    cte("files")
    + f"select id, name, case when contains(name, '.') then lower(string_split(name, '.')[-1]) "
    f"else '' end as extension from (select id, {_ODD_NAME} as name from files_)",
)
def file_extension(spark, sf_dir):
    files = view(spark, sf_dir, "files").select("id", F.expr(_ODD_NAME).alias("name"))
    return files.withColumn("extension", text.file_extension(F.col("name")))


_SPDX = (
    "case when license is null then null when license = '' then '' when id % 2 = 0 "
    "then 'https://spdx.org/licenses/' || upper(license) || '.html' when id % 5 = 0 "
    "then 'http://x/licenses/' || upper(license) || '.html' else upper(license) end"
)


@query(
    "c2_spdx_licence",
    cte("projects")
    + "select id, case when raw is null or raw = '' then '' when contains(raw, 'spdx.org/licenses/') "
    "then lower(replace(string_split(raw, '/licenses/')[-1], '.html', '')) else lower(raw) end "
    f"as short from (select id, {_SPDX} as raw from projects_)",
)
def spdx(spark, sf_dir):
    projects = view(spark, sf_dir, "projects").select("id", F.expr(_SPDX).alias("raw"))
    return projects.select("id", licences.spdx_licence(F.col("raw")).alias("short"))


_DISPLAY = (
    "case id % 8 when 0 then 'CC BY 4.0' when 1 then 'CC0' when 2 then 'CC Zero' "
    "when 3 then ' Public Domain ' when 4 then '\t MIT' when 5 then 'A/B c' when 6 then '   ' "
    "else license end"
)


@query(
    "c3_display_name_licence",
    cte("projects")
    + "select id, case when short in ('cc0', 'cc-zero', 'public-domain') then 'cc0' else short end "
    "as short from (select id, replace(replace(lower(trim(coalesce(raw, ''), ' \t')), ' ', '-'), "
    f"'/', '-') as short from (select id, {_DISPLAY} as raw from projects_))",
)
def display_name(spark, sf_dir):
    projects = view(spark, sf_dir, "projects").select("id", F.expr(_DISPLAY).alias("raw"))
    return projects.select("id", licences.display_name_licence(F.col("raw")).alias("short"))


_ACCESS = "case when id % 5 = 0 then 'Restricted' when id % 17 = 0 then null else 'Open' end"
_NOTE1 = (
    "case id % 12 when 0 then 'CC BY-NC 3.0' when 1 then 'CC BY' when 2 then 'ODC-BY 1.0' "
    "when 3 then 'PDDL' when 4 then 'all rights reserved' when 5 then 'CC-BY 2.5' "
    "when 6 then 'Dedicated' when 7 then 'odc by' when 8 then 'cc-by 2.0' when 9 then '' "
    "when 10 then 'CC-0' else null end"
)
_NOTE2 = "case id % 7 when 0 then 'version 4.0' when 1 then 'public domain' else 'n/a' end"


@query(
    "c4_inferred_licence",
    cte("projects")
    + "select id, case when access is null or access <> 'Open' then '' when contains(t, 'cc0') or "
    "contains(t, 'cc-0') or contains(t, 'public domain') or contains(t, 'dedicate') then 'cc0' "
    "when contains(t, 'cc-by') or contains(t, 'cc by') then case when contains(t, '4.0') then "
    "'cc-by-4.0' when contains(t, '3.0') then 'cc-by-3.0' when contains(t, '2.5') then 'cc-by-2.5' "
    "when contains(t, '2.0') then 'cc-by-2.0' else 'cc-by' end when contains(t, 'odc-by') or "
    "contains(t, 'odc by') then 'odc-by' when contains(t, 'pddl') then 'pddl' else 'cc-by' end "
    f"as licence from (select id, {_ACCESS} as access, case when id % 3 = 0 then '' else "
    f"lower(concat_ws(' ', {_NOTE1}, {_NOTE2})) end as t from projects_)",
)
def inferred(spark, sf_dir):
    projects = view(spark, sf_dir, "projects").select(
        "id",
        F.expr(_ACCESS).alias("access"),
        F.expr(f"case when id % 3 <> 0 then array({_NOTE1}, {_NOTE2}) end").alias("notes"),
    )
    return projects.select(
        "id", licences.inferred_licence(F.col("access"), F.col("notes")).alias("licence")
    )


_PID = (
    "case id % 4 when 0 then 'doi:10.1/ABC' || cast(id as string) when 1 then "
    "'DOI:10.2/A' || cast(id as string) when 2 then '' else null end"
)


@query(
    "c5_doi_from_identifiers",
    cte("projects")
    + "select id, case when id % 5 = 0 then '' else coalesce(lower(replace(pid, 'doi:', '')), '') "
    f"end as doi from (select id, {_PID} as pid from projects_)",
)
def doi(spark, sf_dir):
    projects = view(spark, sf_dir, "projects").select(
        "id",
        F.expr(
            f"case when id % 10 = 0 then null when id % 5 = 0 then array() else array("
            f"named_struct('agency', 'URN', 'pid', 'u'), named_struct('agency', 'DOI', 'pid', {_PID}), "
            "named_struct('agency', 'DOI', 'pid', 'doi:second')) end"
        ).alias("pids"),
    )
    return projects.select("id", text.doi_from_identifiers(F.col("pids")).alias("doi"))


@query(
    "c6_publication_date",
    cte("projects")
    + "select id, nullif(upload_date_raw, '') as raw, substr(download_date || 'T00:00:00Z', 1, 10) "
    "as iso_day, case length(upload_date_raw) when 4 then upload_date_raw || '-01-01' when 7 then "
    "upload_date_raw || '-01' when 10 then upload_date_raw end as parsed from projects_",
)
def publication_date(spark, sf_dir):
    projects = view(spark, sf_dir, "projects", "id", "upload_date_raw", "download_date")
    stamp = F.concat("download_date", F.lit("T00:00:00Z"))
    return projects.select(
        "id",
        text.null_if_empty(F.col("upload_date_raw")).alias("raw"),
        text.iso_day(stamp).alias("iso_day"),
        text.partial_date(F.col("upload_date_raw")).cast("string").alias("parsed"),
    )


@query(
    "c7_url_composition",
    cte("projects")
    + "select id, case when doi = '' then '' else 'https://datadryad.org/stash/dataset/' || doi end "
    "as landing, case when license is null or license = '' then '' else "
    "'https://datacatalogue.cessda.eu/detail/' || license || '/?lang=en' end as detail from projects_",
)
def urls(spark, sf_dir):
    projects = view(spark, sf_dir, "projects", "id", "doi", "license")
    return projects.select(
        "id",
        text.prefixed_url("https://datadryad.org/stash/dataset/", F.col("doi")).alias("landing"),
        text.prefixed_url(
            "https://datacatalogue.cessda.eu/detail/", F.col("license"), "/?lang=en"
        ).alias("detail"),
    )


def _people(column: str) -> str:
    """Two people of a document; either name may be missing or empty."""
    return (
        f"case when {column} % 5 = 0 then array() when {column} % 5 = 1 then null else "
        f"array(named_struct('full', case when {column} % 3 = 0 then '' else 'F' || lang end, "
        f"'short', case when {column} % 4 = 0 then null else 'S' || source end)) end"
    )


@query(
    "c8_creator_list",
    "select doc_id, case when doc_id % 5 in (0, 1) then 'X' || lang else "
    "case when doc_id % 3 <> 0 then 'F' || lang when doc_id % 4 <> 0 then 'S' || source "
    "else 'X' || lang end end as creators from documents",
)
def creators(spark, sf_dir):
    docs = view(spark, sf_dir, "documents", "doc_id", "lang", "source").select(
        "doc_id",
        F.expr(_people("doc_id")).alias("people"),
        F.expr("array(named_struct('full', 'X' || lang), named_struct('full', ''))").alias("others"),
    )
    names = nested.first_filled(
        nested.names_of(F.col("people"), "full", "short"), nested.names_of(F.col("others"), "full")
    )
    return docs.select("doc_id", F.array_join(names, "|").alias("creators"))


@query(
    "c9_keyword_list",
    "select doc_id, case when doc_id % 4 in (0, 1) then 'T' || lang else lang || '|' || '|' || source "
    "end as keywords from documents",
)
def keywords(spark, sf_dir):
    """Verbatim keywords keep their empties; the ``term`` form drops them."""
    docs = view(spark, sf_dir, "documents", "doc_id", "lang", "source").select(
        "doc_id",
        F.expr(
            "case doc_id % 4 when 0 then array() when 1 then null else array(lang, '', source) end"
        ).alias("keywords"),
        F.expr("array(named_struct('term', ''), named_struct('term', 'T' || lang))").alias("terms"),
    )
    words = nested.first_filled(F.col("keywords"), nested.names_of(F.col("terms"), "term"))
    return docs.select("doc_id", F.array_join(words, "|").alias("keywords"))


@query(
    "c10_empty_and_null",
    cte("projects")
    + "select id, nullif(doi, '') as doi, nullif(upload_date_raw, '') as upload_date, "
    "coalesce(description, '') as description from projects_",
)
def empties(spark, sf_dir):
    return view(spark, sf_dir, "projects").select(
        "id",
        text.null_if_empty(F.col("doi")).alias("doi"),
        text.null_if_empty(F.col("upload_date_raw")).alias("upload_date"),
        text.text(F.col("description")).alias("description"),
    )


_CLIENT = (
    "case when id % 6 = 0 then 'unknownclient' when source = 'elsewhere' then 'ElsewhereClient' "
    "else upper(source) || 'Client' end"
)


def _with_repository(spark, sf_dir):
    projects = view(spark, sf_dir, "projects", "id", "source").withColumn(
        "client", r.source_name(F.expr(_CLIENT))
    )
    return r.attach_repository(projects, "client", "source")


_REPOSITORY_SQL = (
    cte("projects")
    + ", named_ as (select id, source, replace(lower("
    + _CLIENT
    + "), 'client', '') as client from projects_), looked_up_ as (select id, client, cast(coalesce("
    "case client when 'zenodo' then 1 when 'dryad' then 2 when 'cessda' then 3 when 'figshare' "
    "then 4 end, case source when 'zenodo' then 1 when 'dryad' then 2 when 'cessda' then 3 "
    "when 'figshare' then 4 end, 0) as int) as repository_id, case client when 'zenodo' then "
    "'https://zenodo.org' when 'dryad' then 'https://datadryad.org' when 'cessda' then "
    "'https://datacatalogue.cessda.eu' when 'figshare' then 'https://figshare.com' else '' end "
    "as repository_url, case client when 'cessda' then 'SCRAPING' else 'API-CALL' end "
    "as download_method from named_) "
)


@query(
    "c11_repository_lookup",
    _REPOSITORY_SQL
    + "select id, client, repository_id, repository_url from looked_up_ where repository_id <> 0",
)
def repository(spark, sf_dir):
    return r.known_repository(_with_repository(spark, sf_dir)).select(
        "id", "client", "repository_id", "repository_url"
    )


@query(
    "c11_unknown_repository",
    _REPOSITORY_SQL + "select id, client from looked_up_ where repository_id = 0",
)
def unknown(spark, sf_dir):
    return r.unknown_repository(_with_repository(spark, sf_dir)).select("id", "client")


@query(
    "c12_storage_path",
    cte("projects", "files")
    + "select f.id, 'downloads/' || p.download_repository_folder || '/' || "
    "p.download_project_folder || case when coalesce(p.download_version_folder, '') = '' then '' "
    "else '/' || p.download_version_folder end || '/' || f.file_name as path from files_ f join "
    "projects_ p on f.project_id = p.id",
)
def paths(spark, sf_dir):
    files = view(spark, sf_dir, "files", "id", "project_id", "file_name")
    projects = view(
        spark, sf_dir, "projects", "id", "download_repository_folder", "download_project_folder",
        "download_version_folder",
    ).withColumnRenamed("id", "project_id")
    return files.join(projects, "project_id").select(
        "id",
        text.storage_path(
            "downloads",
            F.col("download_repository_folder"),
            F.col("download_project_folder"),
            F.col("download_version_folder"),
            F.col("file_name"),
        ).alias("path"),
    )


@query("c13_acquisition_method", _REPOSITORY_SQL + "select id, download_method from looked_up_")
def method(spark, sf_dir):
    return _with_repository(spark, sf_dir).select("id", "download_method")


# ---- D: array facts -----------------------------------------------------------


def _nested(spark, sf_dir):
    """Every document with the file array its catalog page would carry."""
    return hits(spark, sf_dir).select(
        "doc_id",
        F.expr(
            "case when doc_id % 6 = 5 then null else transform(slice(array('a.PDF', 'b.qdpx', "
            "'c.csv', 'd.py', 'e', 'f.zip', 'g.pdf', 'h.r', 'i.py'), cast(1 + doc_id % 9 as int), "
            "cast(k % 4 as int)), n -> n) end"
        ).alias("names"),
    ).select(
        "doc_id",
        F.transform("names", lambda n: nested.file_entry(n, F.lit(""))).alias("files"),
    )


_NESTED_SQL = (
    "with f_ as (select doc_id, case when doc_id % 6 = 5 then null else (['a.PDF', 'b.qdpx', "
    "'c.csv', 'd.py', 'e', 'f.zip', 'g.pdf', 'h.r', 'i.py'])"
    "[(1 + doc_id % 9):(doc_id % 9 + cast(floor(doc_id / 4) as bigint) % 4)] end as names "
    "from documents), e_ as (select doc_id, names, [case when contains(n, '.') then "
    "lower(string_split(n, '.')[-1]) else '' end for n in names] as exts from f_) "
)


@query(
    "d1_file_count",
    _NESTED_SQL + "select doc_id, cast(coalesce(len(names), 0) as int) as files_count from e_",
)
def file_count(spark, sf_dir):
    return _nested(spark, sf_dir).select(
        "doc_id", nested.file_count(F.col("files")).alias("files_count")
    )


@query(
    "d2_file_names",
    _NESTED_SQL
    + "select doc_id, case when names is null then null else array_to_string(names, '|') end "
    "as file_names from e_",
)
def file_names(spark, sf_dir):
    return _nested(spark, sf_dir).select(
        "doc_id", F.array_join(nested.file_names(F.col("files")), "|").alias("file_names")
    )


@query(
    "d3_file_types",
    _NESTED_SQL
    + "select doc_id, case when names is null then null else array_to_string(list_sort("
    "list_distinct([e for e in exts if e <> ''])), '|') end as file_types from e_",
)
def file_types(spark, sf_dir):
    return _nested(spark, sf_dir).select(
        "doc_id", F.array_join(nested.file_types(F.col("files")), "|").alias("file_types")
    )


def _any_of(extensions: list[str]) -> str:
    return f"coalesce(len([e for e in exts if e in {sql_list(extensions)}]) > 0, false)"


@query(
    "d4_has_tool_export",
    _NESTED_SQL + f"select doc_id, {_any_of(TOOL_EXTENSIONS)} as has_tool_export from e_",
)
def tool_export(spark, sf_dir):
    return _nested(spark, sf_dir).select(
        "doc_id", nested.has_tool_export(F.col("files")).alias("has_tool_export")
    )


@query(
    "d5_has_text_file",
    _NESTED_SQL + f"select doc_id, {_any_of(TEXT_EXTENSIONS)} as has_text_file from e_",
)
def text_file(spark, sf_dir):
    return _nested(spark, sf_dir).select(
        "doc_id", nested.has_text_file(F.col("files")).alias("has_text_file")
    )


@query("d6_has_zip", _NESTED_SQL + f"select doc_id, {_any_of(['zip'])} as has_zip from e_")
def zipped(spark, sf_dir):
    return _nested(spark, sf_dir).select("doc_id", nested.has_zip(F.col("files")).alias("has_zip"))


_ALL_CODE = (
    f"coalesce(len(exts) > 0 and len([e for e in exts if e not in {sql_list(CODE_EXTENSIONS)}]) = 0,"
    " false)"
)


@query("d7_all_code", _NESTED_SQL + f"select doc_id, {_ALL_CODE} as all_code from e_")
def all_code(spark, sf_dir):
    return _nested(spark, sf_dir).select(
        "doc_id", nested.is_all_code(F.col("files")).alias("all_code")
    )


_FACTS = (
    "select project_id, count(*) as files_count, "
    f"bool_or(file_type in {sql_list(TOOL_EXTENSIONS)}) as has_tool_export, "
    f"bool_or(file_type in {sql_list(TEXT_EXTENSIONS)}) as has_text_file, "
    "bool_or(file_type = 'zip') as has_zip, "
    f"bool_and(file_type in {sql_list(CODE_EXTENSIONS)}) as all_code from files_ group by project_id"
)


@query("d8_file_facts_per_project", cte("files") + _FACTS)
def facts_per_project(spark, sf_dir):
    return r.file_facts(view(spark, sf_dir, "files", "project_id", "file_type"))


# ---- E: predicates ------------------------------------------------------------


@query(
    "e1_open_licence",
    cte("projects") + f"select id, {sql_is_open('license')} as is_open from projects_",
)
def open_licence(spark, sf_dir):
    return view(spark, sf_dir, "projects", "id", "license").select(
        "id", licences.is_open_licence(F.col("license")).alias("is_open")
    )


@query(
    "e1_open_without_restrictions",
    cte("projects")
    + f"select id, {sql_is_open('license')} and not contains(lower(license), '-nc') and not "
    "contains(lower(license), '-nd') and not contains(lower(license), '-sa') as is_open "
    "from projects_ where license is not null union all select id, false from projects_ "
    "where license is null",
)
def strictly_open(spark, sf_dir):
    return view(spark, sf_dir, "projects", "id", "license").select(
        "id", licences.is_open_licence(F.col("license"), True).alias("is_open")
    )


_SCORED = (
    cte("projects", "files")
    + f", facts_ as ({_FACTS}), scored_ as (select p.*, cast({sql_title_score('p.title')} "
    "+ case when f.has_tool_export then 10 else 0 end + case when f.has_text_file then 2 else 0 end "
    "- case when f.all_code then 5 else 0 end as int) as relevance_score from projects_ p "
    "left join facts_ f on p.id = f.project_id) "
)


def scored(spark, sf_dir, *columns):
    return r.score_projects(
        view(spark, sf_dir, "projects", "id", "title", *columns),
        view(spark, sf_dir, "files", "project_id", "file_type"),
    )


@query(
    "e2_relevant_projects",
    _SCORED + f"select id, license, relevance_score from scored_ where {sql_is_open('license')} "
    "and relevance_score >= 1",
)
def relevant(spark, sf_dir):
    return r.is_relevant(scored(spark, sf_dir, "license")).select(
        "id", "license", "relevance_score"
    )


@query(
    "most_relevant_projects",
    _SCORED + "select id, title, license, download_date, relevance_score from scored_ "
    f"where {sql_is_open('license')} and relevance_score >= 1 "
    "order by relevance_score desc, download_date desc, id",
)
def most_relevant(spark, sf_dir):
    """Open-licensed projects by relevance: file facts, score, filter, order."""
    found = r.is_relevant(scored(spark, sf_dir, "license", "download_date"))
    return found.select("id", "title", "license", "download_date", "relevance_score").orderBy(
        F.desc("relevance_score"), F.desc("download_date"), "id"
    )


@query(
    "e4_source_side_filters",
    cte("documents") + "select doc_id, published from documents_ where access_right = 'open' "
    "and item_type = 3 order by published desc, doc_id",
)
def source_side(spark, sf_dir):
    docs = view(spark, sf_dir, "documents")
    return (
        r.datasets_only(r.open_access_only(docs))
        .select("doc_id", "published")
        .orderBy(F.desc("published"), "doc_id")
    )


@query(
    "e4_open_access_on_pages",
    "select cast(doc_id as string) as record_id from documents where doc_id % 4 = 0 "
    "and cast(floor(doc_id / 4) as bigint) % 5 <> 0",
)
def open_access_on_pages(spark, sf_dir):
    """The open-access condition on landed search hits, before extraction."""
    from harvestlake.operators.extract import FORMATS, search_hits

    found = search_hits(landing_pages(spark, sf_dir, "zenodo"), FORMATS["zenodo"])
    named = found.select(
        F.col("hit.id").alias("record_id"), F.col("hit.metadata.access_right").alias("access_right")
    )
    return r.open_access_only(named).select("record_id")


@query(
    "e9_non_blank_names",
    cte("person_role") + "select id, name from person_role_ where trim(name, ' ' || chr(9) || chr(160)) <> ''",
)
def non_blank(spark, sf_dir):
    people = view(spark, sf_dir, "person_role")
    return people.where(text.is_not_blank(F.col("name"))).select("id", "name")


@query(
    "e10_size_limit",
    cte("files")
    + "select id, coalesce(content_length, 0) > 524288000 as too_large from files_",
)
def size_limit(spark, sf_dir):
    return view(spark, sf_dir, "files", "id", "content_length").select(
        "id", exceeds_size(F.col("content_length")).alias("too_large")
    )


# ---- F: scores ----------------------------------------------------------------


@query(
    "f1_title_score",
    cte("projects") + f"select id, cast({sql_title_score('title')} as int) as title_score from projects_",
)
def title_scores(spark, sf_dir):
    return view(spark, sf_dir, "projects", "id", "title").select(
        "id", title_score(F.col("title")).alias("title_score")
    )


@query("f2_composite_score", _SCORED + "select id, relevance_score from scored_")
def composite(spark, sf_dir):
    return scored(spark, sf_dir).select("id", "relevance_score")


@query(
    "f2_nested_record_score",
    _NESTED_SQL
    + f"select e.doc_id, cast({sql_title_score('d.text')} + case when "
    f"{_any_of(TOOL_EXTENSIONS)} then 10 else 0 end + case when {_any_of(TEXT_EXTENSIONS)} then 2 "
    f"else 0 end - case when {_ALL_CODE} then 5 else 0 end as int) as relevance_score "
    "from e_ e join documents d on e.doc_id = d.doc_id",
)
def nested_score(spark, sf_dir):
    """The whole text stands in for the title."""
    titles = view(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", F.col("text").alias("title")
    )
    return _nested(spark, sf_dir).join(titles, "doc_id").select(
        "doc_id", record_score(F.col("title"), F.col("files")).alias("relevance_score")
    )


@query(
    "f3_score_lookup",
    cte("projects", "relevance_scores")
    + "select p.id as project_id, coalesce(s.relevance_score, 0) as relevance_score, "
    "coalesce(s.description, '') as description from projects_ p left join relevance_scores_ s "
    "on p.id = s.project_id",
)
def score_lookup(spark, sf_dir):
    keys = view(spark, sf_dir, "projects", "id").withColumnRenamed("id", "project_id")
    return relevance_of(keys, view(spark, sf_dir, "relevance_scores"))
