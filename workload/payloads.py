"""Catalog response pages built from the ``documents`` table.

Every document becomes one search hit of the catalog ``doc_id % 4``. Pages hold the
five documents of that catalog among 20 consecutive ids; ten pages form a query. The
round trip (build, land, extract) must give back what SQL computes from
``documents`` directly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlake.session import scratch_path
from harvestlake.sources.landing import (
    read_landing,
    read_side_documents,
    write_landing,
)
from workload.projections import table

REPOS = ["zenodo", "dryad", "figshare", "cessda"]
DAY = (
    "cast(2000 + doc_id % 20 as string) || '-0' || cast(1 + doc_id % 9 as string) "
    "|| '-' || cast(10 + doc_id % 18 as string)"
)
TITLE = (
    "case doc_id % 3 when 0 then 'Interview ' || text else text end"
)

# Shared by Spark and DuckDB: position of a document in the run.
POSITION = [
    (
        "repo",
        "case doc_id % 4 when 0 then 'zenodo' when 1 then 'dryad' "
        "when 2 then 'figshare' else 'cessda' end",
    ),
    ("query_idx", "cast(floor(doc_id / 200) as int)"),
    ("query", "'q' || cast(cast(floor(doc_id / 200) as int) as string)"),
    ("page", "cast(1 + floor(doc_id / 20) % 10 as int)"),
    ("pos", "cast(floor((doc_id % 20) / 4) as int)"),
    ("k", "cast(floor(doc_id / 4) as bigint)"),
]


def hits(spark: SparkSession, sf_dir: str, dealt: list[str] | None = None) -> DataFrame:
    """Documents with their position and the pieces of their records; ``dealt`` puts those alike in it together."""
    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "lang", "source as doc_source", *[f"{e} as `{c}`" for c, e in POSITION]
    )
    docs = docs.repartition(*dealt) if dealt else docs
    return docs.withColumns({"title": F.expr(TITLE), "day": F.expr(DAY), "sid": F.expr("cast(doc_id as string)")})


def _named(absent: str, *fields: str) -> Column:
    """An array with one struct of ``fields``; missing where ``absent`` holds."""
    return F.when(~F.expr(absent), F.array(F.struct(*[F.expr(f) for f in fields])))


def _extension() -> str:
    return "element_at(array('PDF', 'qdpx', 'csv'), i)"


def _files(name: str, link: str) -> Column:
    """``k % 4`` files, numbered from 1; absent when there are none."""
    return F.expr(
        f"case when k % 4 > 0 then transform(sequence(1, cast(k % 4 as int)), i -> "
        f"named_struct('{name}', 'd' || sid || '_' || i || '.' || {_extension()}, {link})) end"
    )


def _zenodo_hit() -> Column:
    return F.struct(
        F.col("doc_id").alias("id"),
        F.struct(
            F.expr("'https://zenodo.invalid/' || sid").alias("self_html"),
            F.expr("case when doc_id % 8 = 0 then 'https://zenodo.invalid/a/' || sid end").alias(
                "archive"
            ),
        ).alias("links"),
        _files(
            "key", "'links', named_struct('self', 'https://zenodo.invalid/f/' || sid || '/' || i)"
        ).alias("files"),
        F.struct(
            "title",
            F.col("day").alias("publication_date"),
            F.expr("'10.5281/' || sid").alias("doi"),
            F.col("text").alias("description"),
            F.expr("case when k % 5 = 0 then null else 'open' end").alias("access_right"),
            F.expr(
                "case k % 4 when 0 then named_struct('id', 'cc-by-4.0') "
                "when 1 then named_struct('id', 'CC0-1.0') when 2 then named_struct('id', 'mit') end"
            ).alias("license"),
            _named("doc_id % 5 = 0", "'A' || sid as name").alias("creators"),
            F.expr("array(named_struct('name', 'C' || sid), named_struct('name', ''))").alias(
                "contributors"
            ),
            F.expr("case when doc_id % 6 <> 0 then array(lang, doc_source) else array() end").alias(
                "keywords"
            ),
            F.expr("array(named_struct('term', 'S' || lang), named_struct('term', ''))").alias(
                "subjects"
            ),
        ).alias("metadata"),
    )


def _dryad_hit() -> Column:
    return F.struct(
        F.col("doc_id").alias("id"),
        F.expr("case when k % 9 <> 0 then 'doi:10.5061/' || sid end").alias("identifier"),
        "title",
        F.col("text").alias("abstract"),
        F.expr(
            "case k % 4 when 0 then 'https://spdx.org/licenses/CC0-1.0.html' "
            "when 1 then 'https://spdx.org/licenses/CC-BY-4.0.html' when 2 then 'MIT' end"
        ).alias("license"),
        F.col("day").alias("publicationDate"),
        F.expr(
            "array(named_struct('fullName', case when doc_id % 5 <> 0 then 'A' || sid end, "
            "'name', 'N' || sid), named_struct('fullName', '', 'name', ''))"
        ).alias("authors"),
        F.expr("case when doc_id % 6 <> 1 then array(lang, doc_source) end").alias("keywords"),
        F.expr("array('S' || lang)").alias("subjects"),
        F.struct(
            F.expr(
                "case when k % 8 <> 0 then named_struct('href', '/download/' || sid) end"
            ).alias("stash:download"),
            F.expr(
                "case when k % 7 <> 0 then named_struct('href', '/api/v2/versions/' || sid) end"
            ).alias("stash:version"),
        ).alias("_links"),
    )


def _figshare_article(title: Column) -> list[Column]:
    return [
        F.col("doc_id").alias("id"),
        title.alias("title"),
        F.expr("'10.6084/' || sid").alias("doi"),
        F.expr("day || 'T01:02:03Z'").alias("published_date"),
        F.expr("'https://figshare.invalid/' || sid").alias("url_public_html"),
        F.lit(3).alias("item_type"),
    ]


def _figshare_detail() -> Column:
    return F.struct(
        *_figshare_article(F.concat(F.lit("D "), "title")),
        F.col("text").alias("description"),
        F.expr("case when doc_id % 6 <> 0 then array(lang, doc_source) end").alias("tags"),
        _named("doc_id % 5 = 0", "'A' || sid as full_name").alias("authors"),
        F.expr(
            "case k % 4 when 0 then named_struct('value', 1, 'name', ' CC BY 4.0 ') "
            "when 1 then named_struct('value', 2, 'name', 'Public Domain') "
            "when 2 then named_struct('value', 3, 'name', 'A/B c') end"
        ).alias("license"),
    )


def _cessda_hit() -> Column:
    return F.struct(
        F.expr("'c' || sid").alias("id"),
        F.col("title").alias("titleStudy"),
        F.col("text").alias("abstract"),
        F.expr("'https://study.invalid/' || sid").alias("studyUrl"),
        F.expr("cast(2000 + doc_id % 20 as int)").alias("publicationYear"),
        F.expr("case when doc_id % 3 = 0 then 'Restricted' else 'Open' end").alias("dataAccess"),
        F.expr(
            "case k % 5 when 0 then array('CC BY 4.0') when 1 then array('CC BY', 'public domain') "
            "when 2 then array('ODC-BY 1.0') when 3 then array('all rights reserved') end"
        ).alias("dataAccessFreeTexts"),
        F.expr(
            "array(named_struct('agency', 'URN', 'pid', 'u' || sid), "
            "named_struct('agency', case when k % 6 = 0 then 'ARK' else 'DOI' end, "
            "'pid', 'doi:10.9/X' || sid))"
        ).alias("pidStudies"),
        F.expr(
            "array(named_struct('name', 'A' || sid, 'affiliation', 'U'), "
            "named_struct('name', '', 'affiliation', 'U'))"
        ).alias("creators"),
        F.expr(
            "array(named_struct('vocab', 'v', 'term', lang), named_struct('vocab', 'v', 'term', ''))"
        ).alias("keywords"),
    )


def _wrap(repo: str, items: Column, total: Column) -> Column:
    """The page object of a catalog."""
    if repo == "zenodo":
        return F.struct(F.struct(total.alias("total"), items.alias("hits")).alias("hits"))
    if repo == "dryad":
        found = F.struct(items.alias("stash:datasets")).alias("_embedded")
        return F.struct(total.alias("total"), found)
    if repo == "figshare":
        return items
    count = F.struct(total.alias("available")).alias("ResultsCount")
    return F.struct(count, items.alias("Results"))


def _hit(repo: str) -> Column:
    if repo == "figshare":
        return F.struct(*_figshare_article(F.col("title")))
    return {"zenodo": _zenodo_hit, "dryad": _dryad_hit, "cessda": _cessda_hit}[repo]()


def landing_pages(spark: SparkSession, sf_dir: str, *repos: str) -> DataFrame:
    """The response pages of some or all catalogs: their (at most five) hits in order, wrapped.

    The documents are read and dealt once, before hits are made of them, so that a text
    travels once and not as title and description.
    """
    keys, repos = ["repo", "query", "query_idx", "page"], repos or REPOS
    docs = hits(spark, sf_dir, keys).where(F.col("repo").isin(*repos))

    def own(repo: str) -> Column:
        return F.col("repo") == repo

    grouped = docs.groupBy(*keys).agg(
        *[F.collect_list(F.when(own(r), F.struct("pos", _hit(r).alias("hit")))).alias(f"_{r}") for r in repos]
    )
    # Every third query reports no total.
    total = F.expr("case when query_idx % 3 <> 0 then cast(50 + query_idx % 5 as bigint) end")

    def payload(repo: str) -> Column:
        return F.to_json(_wrap(repo, F.transform(F.sort_array(f"_{repo}"), lambda h: h["hit"]), total))

    return grouped.select(
        *keys,
        F.lit(5).alias("page_size"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page")).alias("fetched_at"),
        F.lit(False).alias("failed"),
        F.when(own("figshare"), total).alias("total"),
        F.coalesce(*[F.when(own(r), payload(r)) for r in repos]).alias("payload"),
    )


def side_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File lists of two catalogs and details of one, one per document.

    An older, different copy of every file list is landed too; the newest counts.
    """
    docs = hits(spark, sf_dir)
    newest = F.timestamp_seconds(F.lit(1_700_000_500))

    def rows(df: DataFrame, repo: str, kind: str, key: str, payload: Column, at=newest) -> DataFrame:
        return df.select(
            F.lit(repo).alias("repo"),
            F.lit(kind).alias("kind"),
            F.expr(key).alias("key"),
            at.alias("fetched_at"),
            F.lit(False).alias("failed"),
            payload.alias("payload"),
        )

    dryad = docs.where("repo = 'dryad'")
    dryad_key = "'/api/v2/versions/' || sid"
    dryad_list = F.to_json(
        F.struct(
            F.struct(
                _files(
                    "path",
                    "'_links', named_struct('stash:download', named_struct('href', "
                    "case when i < 3 then '/f/' || sid || '/' || i end))",
                ).alias("stash:files")
            ).alias("_embedded")
        )
    )
    figshare = docs.where("repo = 'figshare'")
    figshare_list = F.when(
        F.expr("doc_id % 9 <> 0"),
        F.to_json(
            F.coalesce(
                _files("name", "'download_url', 'https://figshare.invalid/f/' || sid || '/' || i"),
                F.expr("cast(array() as array<struct<name: string, download_url: string>>)"),
            )
        ),
    ).otherwise(F.lit('{"message": "not found"}'))
    detail = F.when(F.expr("doc_id % 7 = 0"), F.lit("{}")).otherwise(
        F.to_json(_figshare_detail())
    )
    old = F.timestamp_seconds(F.lit(1_600_000_000))
    stale = F.lit('{"_embedded": {"stash:files": [{"path": "stale.txt"}]}}')
    return (
        rows(dryad, "dryad", "files", dryad_key, dryad_list)
        .unionByName(rows(dryad, "dryad", "files", dryad_key, stale, old))
        .unionByName(rows(figshare, "figshare", "files", "sid", figshare_list))
        .unionByName(
            rows(figshare.where("doc_id % 7 <> 0 or k % 2 = 0"), "figshare", "detail", "sid", detail)
        )
    )


def landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Write pages and side documents to the shared scratch folder and read them back."""
    pages_path = scratch_path(spark, "landing")
    side_path = scratch_path(spark, "side")
    write_landing(landing_pages(spark, sf_dir), pages_path)
    side_documents(spark, sf_dir).write.parquet(side_path)
    return read_landing(spark, pages_path), read_side_documents(spark, side_path)


# ---- the same records, computed by SQL straight from ``documents`` ----------------

_POS = ", ".join(f"{e} as {c}" for c, e in POSITION)

# Files of a document as 'name<url>extension' joined by '|'.


def _sql_files(url: str, present: str = "true") -> str:
    def one(i: int) -> str:
        ext = ["PDF", "qdpx", "csv"][i - 1]
        return (
            f"case when k % 4 >= {i} then 'd' || sid || '_{i}.{ext}<' || {url.format(i=i)} || "
            f"'>{ext.lower()}' end"
        )

    return f"case when {present} then concat_ws('|', {one(1)}, {one(2)}, {one(3)}) else '' end"


_SQL_RECORDS = {
    "zenodo": {
        "record_id": "sid",
        "title": "title",
        "publication_date": "day",
        "doi": "'10.5281/' || sid",
        "license": "case k % 4 when 0 then 'cc-by-4.0' when 1 then 'CC0-1.0' when 2 then 'mit' else '' end",
        "record_page": "'https://zenodo.invalid/' || sid",
        "archive_download_link": "case when doc_id % 8 = 0 then 'https://zenodo.invalid/a/' || sid else '' end",
        "description": "text",
        "files": _sql_files("'https://zenodo.invalid/f/' || sid || '/{i}'"),
        "creators": "case when doc_id % 5 = 0 then 'C' || sid else 'A' || sid end",
        "keywords": "case when doc_id % 6 <> 0 then lang || '|' || doc_source else 'S' || lang end",
    },
    "dryad": {
        "record_id": "sid",
        "title": "title",
        "publication_date": "day",
        "doi": "case when k % 9 <> 0 then 'doi:10.5061/' || sid else '' end",
        "license": "case k % 4 when 0 then 'cc0-1.0' when 1 then 'cc-by-4.0' when 2 then 'mit' else '' end",
        "record_page": "case when k % 9 <> 0 then 'https://datadryad.org/stash/dataset/doi:10.5061/' || sid else '' end",
        "archive_download_link": "case when k % 8 <> 0 then 'https://datadryad.org/download/' || sid else '' end",
        "description": "text",
        "files": _sql_files(
            "case when {i} < 3 then 'https://datadryad.org/f/' || sid || '/{i}' else '' end",
            "k % 7 <> 0",
        ),
        "creators": "case when doc_id % 5 <> 0 then 'A' || sid else 'N' || sid end",
        "keywords": "case when doc_id % 6 <> 1 then lang || '|' || doc_source else 'S' || lang end",
    },
    "figshare": {
        "record_id": "sid",
        "title": "case when detailed then 'D ' || title else title end",
        "publication_date": "day",
        "doi": "'10.6084/' || sid",
        "license": "case when not detailed then '' else case k % 4 when 0 then 'cc-by-4.0' "
        "when 1 then 'cc0' when 2 then 'a-b-c' else '' end end",
        "record_page": "'https://figshare.invalid/' || sid",
        "archive_download_link": "''",
        "description": "case when detailed then text else '' end",
        "files": _sql_files("'https://figshare.invalid/f/' || sid || '/{i}'", "doc_id % 9 <> 0"),
        "creators": "case when detailed and doc_id % 5 <> 0 then 'A' || sid else '' end",
        "keywords": "case when detailed and doc_id % 6 <> 0 then lang || '|' || doc_source else '' end",
    },
    "cessda": {
        "record_id": "'c' || sid",
        "title": "title",
        "publication_date": "cast(2000 + doc_id % 20 as string)",
        "doi": "case when k % 6 = 0 then '' else '10.9/x' || sid end",
        "license": "case k % 5 when 0 then 'cc-by-4.0' when 1 then 'cc0' when 2 then 'odc-by' else 'cc-by' end",
        "record_page": "'https://datacatalogue.cessda.eu/detail/c' || sid || '/?lang=en'",
        "archive_download_link": "'https://study.invalid/' || sid",
        "description": "text",
        "files": "''",
        "creators": "'A' || sid",
        "keywords": "lang",
    },
}


def records_sql(*repos: str) -> str:
    """``with records_ as (...)`` holding the expected records of the catalogs."""
    base = (
        f"docs_ as (select *, {TITLE} as title, {DAY} as day, cast(doc_id as string) as sid, "
        f"doc_id % 7 <> 0 as detailed, source as doc_source, {_POS} from documents)"
    )
    parts = []
    for repo in repos or _SQL_RECORDS:
        fields = ", ".join(f"{e} as {c}" for c, e in _SQL_RECORDS[repo].items())
        kept = " and doc_id % 3 <> 0" if repo == "cessda" else ""
        parts.append(
            f"select repo, query, query_idx, page, pos, k, '{repo}' as source, {fields} "
            f"from (select * exclude (source) from docs_) where repo = '{repo}'{kept}"
        )
    return f"with {base}, records_ as ({' union all '.join(parts)}) "
