"""Queries over landed pages: sources, extraction, collection and shredding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.operators import extract as x
from harvestlake.operators.dedup import count_unique
from harvestlake.operators.pagination import counted_pages, stop_pages
from harvestlake.operators.shred import catalog_parents, shred
from harvestlake.plans.collect import load_catalog, relevant_records
from harvestlake.refdata import OPEN_LICENCE_PREFIXES, TITLE_KEYWORDS
from harvestlake.session import scratch_path, stage
from harvestlake.sources.catalog import Catalog
from workload.payloads import landed, landing_pages, records_sql, side_documents
from workload.registry import query

FIELDS = [
    "source", "record_id", "title", "publication_date", "doi", "license", "record_page",
    "archive_download_link", "description",
]
_PLACE = "repo, query, query_idx, page, pos"
_FLAT = f"{_PLACE}, {', '.join(FIELDS)}, files, creators, keywords"


def flat(records: DataFrame) -> DataFrame:
    """Arrays rendered as joined text, so that every engine compares them alike."""
    listing = F.transform(
        "files",
        lambda f: F.concat(f["name"], F.lit("<"), f["download_url"], F.lit(">"), f["extension"]),
    )
    return records.select(
        "repo", "query", "query_idx", "page", "pos", *FIELDS,
        F.array_join(listing, "|").alias("files"),
        F.array_join("creators", "|").alias("creators"),
        F.array_join("keywords", "|").alias("keywords"),
    )


# ---- landing and extraction ---------------------------------------------------


@query(
    "a1_landing_pages",
    records_sql().split(", records_ as")[0]
    + " select repo, query, query_idx, page, cast(5 as int) as page_size, false as failed, "
    "case when repo = 'figshare' and query_idx % 3 <> 0 then cast(50 + query_idx % 5 as bigint) end "
    "as total from docs_ group by repo, query, query_idx, page",
)
def landing_source(spark, sf_dir):
    pages, _ = landed(spark, sf_dir)
    return pages.select("repo", "query", "query_idx", "page", "page_size", "failed", "total")


@query("b1_extract_zenodo", records_sql("zenodo") + f"select {_FLAT} from records_")
def zenodo(spark, sf_dir):
    return flat(x.extract_zenodo(landing_pages(spark, sf_dir, "zenodo")))


@query("b2_extract_dryad", records_sql("dryad") + f"select {_FLAT} from records_")
def dryad(spark, sf_dir):
    return flat(
        x.extract_dryad(landing_pages(spark, sf_dir, "dryad"), side_documents(spark, sf_dir))
    )


@query(
    "b3_dryad_file_lists",
    records_sql("dryad")
    + "select record_id, files from records_ where files <> '' order by 1",
)
def dryad_file_lists(spark, sf_dir):
    records = x.extract_dryad(landing_pages(spark, sf_dir, "dryad"), side_documents(spark, sf_dir))
    return flat(records.where(F.size("files") > 0)).select("record_id", "files")


@query("b4_extract_figshare", records_sql("figshare") + f"select {_FLAT} from records_")
def figshare(spark, sf_dir):
    return flat(
        x.extract_figshare(landing_pages(spark, sf_dir, "figshare"), side_documents(spark, sf_dir))
    )


@query(
    "b5_detail_over_search_row",
    records_sql("figshare") + "select record_id, title, license, creators from records_",
)
def figshare_details(spark, sf_dir):
    records = x.extract_figshare(
        landing_pages(spark, sf_dir, "figshare"), side_documents(spark, sf_dir)
    )
    return flat(records).select("record_id", "title", "license", "creators")


@query(
    "b6_figshare_file_lists",
    records_sql("figshare") + "select record_id, files from records_",
)
def figshare_file_lists(spark, sf_dir):
    side = side_documents(spark, sf_dir).where("kind = 'files'")
    return flat(x.extract_figshare(landing_pages(spark, sf_dir, "figshare"), side)).select(
        "record_id", "files"
    )


@query("b7_extract_cessda", records_sql("cessda") + f"select {_FLAT} from records_")
def cessda(spark, sf_dir):
    return flat(x.extract_cessda(landing_pages(spark, sf_dir, "cessda")))


_FACTS_SQL = (
    records_sql().split(", records_ as")[0]
    + " select repo, query, query_idx, page, cast(count_if(repo <> 'cessda' or doc_id % 3 <> 0) "
    "as bigint) as n_records, case when query_idx % 3 <> 0 then cast(50 + query_idx % 5 as bigint) "
    "else 0 end as total from docs_ group by repo, query, query_idx, page"
)


@query("b8_result_totals", _FACTS_SQL)
def result_totals(spark, sf_dir):
    facts = x.page_facts(landing_pages(spark, sf_dir))
    return facts.select(
        "repo", "query", "query_idx", "page", F.col("n_records").cast("bigint").alias("n_records"),
        "total",
    )


@query("b9_combine_repositories", records_sql() + f"select {_FLAT} from records_")
def combined(spark, sf_dir):
    pages, side = landed(spark, sf_dir)
    return flat(x.extract_all(pages, side))


@query(
    "b_rejected_pages",
    records_sql().split(", records_ as")[0]
    + " select distinct repo, query, page from docs_ where page % 4 = 1",
)
def rejected(spark, sf_dir):
    """Every fourth page is cut in half while landing; those pages are rejects."""
    pages = landing_pages(spark, sf_dir).withColumn(
        "payload",
        F.when(
            F.col("page") % 4 == 1, F.expr("substr(payload, 1, cast(length(payload) / 2 as int))")
        ).otherwise(F.col("payload")),
    )
    return x.rejected_pages(pages).select("repo", "query", "page")


@query(
    "e3_open_access_rows",
    records_sql("cessda") + "select record_id, publication_date from records_",
)
def open_access_rows(spark, sf_dir):
    records = x.extract_cessda(landing_pages(spark, sf_dir, "cessda"))
    return records.select("record_id", "publication_date")


@query(
    "g6_attach_file_lists",
    records_sql("dryad", "figshare")
    + "select repo, record_id, cast(case when files = '' then 0 else "
    "len(string_split(files, '|')) end as int) as n_files from records_",
)
def attached_lists(spark, sf_dir):
    pages = landing_pages(spark, sf_dir, "dryad", "figshare")
    side = side_documents(spark, sf_dir)
    both = x.extract_dryad(pages, side).unionByName(x.extract_figshare(pages, side))
    return both.select("repo", "record_id", F.size("files").alias("n_files"))


# ---- whole collection runs ----------------------------------------------------


def sql_title_score(title: str) -> str:
    return " + ".join(
        f"case when contains(lower({title}), '{k}') then 1 else 0 end" for k in TITLE_KEYWORDS
    )


def sql_is_open(licence: str) -> str:
    tests = " or ".join(f"starts_with(lower({licence}), '{p}')" for p in OPEN_LICENCE_PREFIXES)
    return f"coalesce({tests}, false)"


_ORDER = "query_idx, repo_idx, page, pos"
_RELEVANT = (
    records_sql()
    + f", scored_ as (select *, cast({sql_title_score('title')} "
    "+ case when contains(files, '>qdpx') then 10 else 0 end "
    "+ case when contains(files, '>pdf') or contains(files, '>csv') then 2 else 0 end as int) "
    "as relevance_score, case repo when 'zenodo' then 0 when 'dryad' then 1 when 'cessda' then 2 "
    "else 3 end as repo_idx, case repo when 'zenodo' then 1 when 'dryad' then 2 when 'cessda' "
    "then 3 else 4 end as repository_id from records_)"
    f", relevant_ as (select *, row_number() over (order by {_ORDER}) as id from scored_ "
    f"where {sql_is_open('license')} and relevance_score >= 1) "
)


def _relevant(spark, sf_dir, cut_off=False) -> DataFrame:
    pages, side = landed(spark, sf_dir)
    return relevant_records(pages, side, cut_off=cut_off)


@query(
    "collection_run",
    _RELEVANT
    + "select repo, query, page, pos, record_id, relevance_score from relevant_ r "
    # The reported total is reached on the last page, so no page is cut here.
    "order by 1, 2, 3, 4",
)
def collection_run(spark, sf_dir):
    """Landing, page cut-off, extraction, score and filter in one plan."""
    return _relevant(spark, sf_dir, cut_off=True).select(
        "repo", "query", "page", "pos", "record_id", "relevance_score"
    )


@query(
    "j1_pages_cut_by_total",
    records_sql()
    + "select repo, query, page, record_id from records_ where page <= case when query_idx % 3 = 0 "
    "then 10 else 5 end",
)
def pages_cut(spark, sf_dir):
    """Twice the real page size is asked for: the run stops at half of the total."""
    pages = landing_pages(spark, sf_dir).withColumn("page_size", F.lit(11))
    kept = counted_pages(pages, stop_pages(x.page_facts(pages)))
    return x.extract_all(kept, side_documents(spark, sf_dir)).select(
        "repo", "query", "page", "record_id"
    )


@query(
    "h10_unique_relevant_records",
    _RELEVANT + "select cast(count(distinct (source, record_id)) as bigint) as n_unique from relevant_",
)
def unique_relevant(spark, sf_dir):
    """The run's pages are landed under a second query as well; each record counts once."""
    pages = landing_pages(spark, sf_dir)
    again = pages.withColumn("query_idx", F.col("query_idx") + 5000).withColumn(
        "query", F.concat("query", F.lit(" again"))
    )
    records = relevant_records(
        pages.unionByName(again), side_documents(spark, sf_dir), cut_off=False
    )
    return count_unique(records)


# ---- shredding ----------------------------------------------------------------

_BASE_URL = (
    "case repo when 'zenodo' then 'https://zenodo.org' when 'dryad' then 'https://datadryad.org' "
    "when 'cessda' then 'https://datacatalogue.cessda.eu' else 'https://figshare.com' end"
)


def _shredded(spark, sf_dir) -> dict[str, DataFrame]:
    return shred(catalog_parents(stage(_relevant(spark, sf_dir), "records")))


@query(
    "m1_shred_projects",
    _RELEVANT
    + f"select id, query as query_string, cast(repository_id as int) as repository_id, {_BASE_URL} "
    "as repository_url, record_page as project_url, title, description, nullif(doi, '') as doi, "
    "publication_date as upload_date_raw, case when length(publication_date) = 4 then "
    "publication_date || '-01-01' else publication_date end as upload_date, "
    "repo as download_repository_folder, record_id as download_project_folder, "
    "case when repo = 'cessda' then 'SCRAPING' else 'API-CALL' end as download_method from relevant_",
)
def shred_projects(spark, sf_dir):
    return (
        _shredded(spark, sf_dir)["projects"]
        .drop("version", "language", "download_version_folder", "download_date")
        .withColumn("upload_date", F.col("upload_date").cast("string"))
    )


def _children_sql(array: str, columns: str, blank: str = "item <> ''") -> str:
    """Children with their dense id: order of the parent, then position."""
    return (
        _RELEVANT
        + f", items_ as (select id as project_id, unnest(string_split({array}, '|')) as item, "
        f"generate_subscripts(string_split({array}, '|'), 1) as i from relevant_ where {array} <> '') "
        f"select row_number() over (order by project_id, i) as id, project_id, {columns} "
        f"from items_ where {blank}"
    )


@query(
    "m1_shred_files",
    _children_sql(
        "files",
        "split_part(item, '<', 1) as file_name, split_part(item, '>', 2) as file_type, "
        "split_part(split_part(item, '<', 2), '>', 1) as download_url, 'pending' as status",
    ),
)
def shred_files(spark, sf_dir):
    return _shredded(spark, sf_dir)["files"]


@query("m1_shred_keywords", _children_sql("keywords", "item as keyword"))
def shred_keywords(spark, sf_dir):
    return _shredded(spark, sf_dir)["keywords"]


@query("m1_shred_people", _children_sql("creators", "item as name, 'AUTHOR' as role"))
def shred_people(spark, sf_dir):
    return _shredded(spark, sf_dir)["person_role"]


@query("m1_shred_licences", _children_sql("license", "item as license"))
def shred_licences(spark, sf_dir):
    return _shredded(spark, sf_dir)["licenses"]


@query(
    "m1_shred_scores",
    _RELEVANT + "select id, id as project_id, relevance_score, description from relevant_",
)
def shred_scores(spark, sf_dir):
    return _shredded(spark, sf_dir)["relevance_scores"]


def _count_words(column: str) -> str:
    return f"case when {column} = '' then 0 else len(string_split({column}, '|')) end"


def _table_totals_sql(times: int) -> str:
    """Rows, distinct ids and highest id of each table when the run is stored ``times`` times."""
    return (
        _RELEVANT
        + ", n_ as (select count(*) as p, sum("
        + _count_words("files")
        + ") as f, sum("
        + _count_words("keywords")
        + ") as k, sum("
        + _count_words("creators")
        + ") as c, sum(case when license <> '' then 1 else 0 end) as l from relevant_) "
        f"select t as table_name, cast({times} * n as bigint) as n_rows, cast({times} * n as bigint) "
        f"as n_ids, cast({times} * n as bigint) as highest_id from n_, lateral (values ('projects', p), "
        "('files', f), ('keywords', k), ('person_role', c), ('licenses', l), ('relevance_scores', p)) "
        "as v(t, n)"
    )


def _table_totals(store: Catalog) -> DataFrame:
    frames = [
        df.agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("id").alias("n_ids"),
            F.max("id").alias("highest_id"),
        ).select(F.lit(name).alias("table_name"), "n_rows", "n_ids", "highest_id")
        for name, df in store.tables().items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query("a6_append_catalog", _table_totals_sql(2))
def append_catalog(spark, sf_dir):
    """The same run stored twice: ids of the second batch continue after the first."""
    store = Catalog(spark, scratch_path(spark, "catalog"))
    records = _relevant(spark, sf_dir)
    load_catalog(store, records, "0")
    load_catalog(store, records, "1")
    load_catalog(store, records, "1")
    return _table_totals(store)


@query("a9_reset_catalog", _table_totals_sql(1))
def reset_catalog(spark, sf_dir):
    """A run stored, all tables emptied, and the same batch stored again: ids restart."""
    store = Catalog(spark, scratch_path(spark, "catalog"))
    records = stage(_relevant(spark, sf_dir), "records")
    load_catalog(store, records, "0", stored=True)
    store.reset()
    load_catalog(store, records, "0", stored=True)
    return _table_totals(store)
