"""Landed pages to flat records, one format per catalog.

A format is a payload schema plus column expressions; a further catalog is one more
entry in ``FORMATS``. Pages are parsed and exploded where they are read. The only
exchange is the join that attaches follow-up documents (file lists, details).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlake import schemas
from harvestlake.functions.licences import (
    OPEN_ACCESS,
    display_name_licence,
    inferred_licence,
    spdx_licence,
)
from harvestlake.functions.nested import (
    file_entry,
    first_filled,
    names_of,
    no_files,
    or_empty,
)
from harvestlake.functions.text import doi_from_identifiers, iso_day, prefixed_url, text
from harvestlake.operators.dedup import first_per_key
from harvestlake.operators.joins import join_to_one, perhaps_in
from harvestlake.refdata import REPOSITORY_ORDER
from harvestlake.session import stage

# Named so that from_json keeps the whole schema and with it the corrupt-record field.
_PERMISSIVE = {"mode": "PERMISSIVE"}
_DRYAD = "https://datadryad.org"
_CESSDA = "https://datacatalogue.cessda.eu"


@dataclass(frozen=True)
class CatalogFormat:
    """How one catalog's pages become records."""

    name: str
    payload: str
    facts: str
    hits: Callable[[Column], Column]
    record: Callable[[Column], dict[str, Column]]
    total: Callable[[Column, Column], Column]
    is_object: bool = True
    keep: Callable[[Column], Column] | None = None
    side_key: Callable[[Column], Column] | None = None
    side_detail: Callable[[Column], Column] | None = None
    side_files: Callable[[Column], Column] | None = None


# ---- Zenodo -------------------------------------------------------------------


def _zenodo_record(hit: Column) -> dict[str, Column]:
    md = hit["metadata"]
    return {
        "record_id": text(hit["id"]),
        "title": text(md["title"]),
        "publication_date": text(md["publication_date"]),
        "doi": text(md["doi"]),
        "license": text(md["license"]["id"]),
        "record_page": text(hit["links"]["self_html"]),
        "archive_download_link": text(hit["links"]["archive"]),
        "description": text(md["description"]),
        "files": F.coalesce(
            F.transform(hit["files"], lambda f: file_entry(f["key"], f["links"]["self"])),
            no_files(),
        ),
        "creators": first_filled(
            names_of(md["creators"], "name"), names_of(md["contributors"], "name")
        ),
        "keywords": first_filled(md["keywords"], names_of(md["subjects"], "term")),
    }


# ---- Dryad --------------------------------------------------------------------


def _dryad_record(hit: Column) -> dict[str, Column]:
    return {
        "record_id": text(hit["id"]),
        "title": text(hit["title"]),
        "publication_date": text(hit["publicationDate"]),
        "doi": text(hit["identifier"]),
        "license": spdx_licence(hit["license"]),
        "record_page": prefixed_url(f"{_DRYAD}/stash/dataset/", hit["identifier"]),
        "archive_download_link": prefixed_url(_DRYAD, hit["_links"]["stash:download"]["href"]),
        "description": text(hit["abstract"]),
        "creators": names_of(hit["authors"], "fullName", "name"),
        "keywords": first_filled(hit["keywords"], hit["subjects"]),
    }


def _dryad_files(payload: Column) -> Column:
    listing = F.from_json(payload, schemas.DRYAD_FILES, _PERMISSIVE)
    return F.transform(
        listing["_embedded"]["stash:files"],
        lambda f: file_entry(
            f["path"], prefixed_url(_DRYAD, f["_links"]["stash:download"]["href"])
        ),
    )


# ---- Figshare -----------------------------------------------------------------


def _figshare_record(hit: Column) -> dict[str, Column]:
    return {
        "title": text(hit["title"]),
        "publication_date": iso_day(hit["published_date"]),
        "doi": text(hit["doi"]),
        "license": display_name_licence(hit["license"]["name"]),
        "record_page": text(hit["url_public_html"]),
        "archive_download_link": F.lit(""),
        "description": text(hit["description"]),
        "creators": names_of(hit["authors"], "full_name"),
        "keywords": or_empty(hit["tags"]),
    }


def _figshare_detail(payload: Column) -> Column:
    """The detail of an article; NULL for an empty object or unreadable text."""
    detail = F.from_json(payload, schemas.FIGSHARE_ARTICLE, _PERMISSIVE)
    return F.when(F.size(F.json_object_keys(payload)) > 0, detail)


def _figshare_files(payload: Column) -> Column:
    """Payloads that are not lists hold no files."""
    listing = F.when(
        F.startswith(F.ltrim(payload), F.lit("[")),
        F.from_json(payload, schemas.FIGSHARE_FILES, _PERMISSIVE),
    )
    return F.transform(listing, lambda f: file_entry(f["name"], f["download_url"]))


# ---- CESSDA -------------------------------------------------------------------


def _cessda_record(hit: Column, language: str = "en") -> dict[str, Column]:
    return {
        "record_id": text(hit["id"]),
        "title": text(hit["titleStudy"]),
        "publication_date": text(hit["publicationYear"]),
        "doi": doi_from_identifiers(hit["pidStudies"]),
        "license": inferred_licence(hit["dataAccess"], hit["dataAccessFreeTexts"]),
        "record_page": prefixed_url(f"{_CESSDA}/detail/", hit["id"], f"/?lang={language}"),
        "archive_download_link": text(hit["studyUrl"]),
        "description": text(hit["abstract"]),
        "files": no_files(),
        "creators": names_of(hit["creators"], "name"),
        "keywords": names_of(hit["keywords"], "term"),
    }


FORMATS: dict[str, CatalogFormat] = {
    "zenodo": CatalogFormat(
        name="zenodo",
        payload=schemas.ZENODO_PAGE,
        facts=schemas.ZENODO_FACTS,
        hits=lambda page: page["hits"]["hits"],
        record=_zenodo_record,
        total=lambda page, landed: page["hits"]["total"],
    ),
    "dryad": CatalogFormat(
        name="dryad",
        payload=schemas.DRYAD_PAGE,
        facts=schemas.DRYAD_FACTS,
        hits=lambda page: page["_embedded"]["stash:datasets"],
        record=_dryad_record,
        total=lambda page, landed: page["total"],
        side_key=lambda hit: hit["_links"]["stash:version"]["href"],
        side_files=_dryad_files,
    ),
    "cessda": CatalogFormat(
        name="cessda",
        payload=schemas.CESSDA_PAGE,
        facts=schemas.CESSDA_FACTS,
        hits=lambda page: page["Results"],
        record=_cessda_record,
        total=lambda page, landed: page["ResultsCount"]["available"],
        keep=lambda hit: F.equal_null(hit["dataAccess"], F.lit(OPEN_ACCESS)),
    ),
    "figshare": CatalogFormat(
        name="figshare",
        payload=schemas.FIGSHARE_PAGE,
        facts=schemas.FIGSHARE_FACTS,
        hits=lambda page: page,
        record=_figshare_record,
        total=lambda page, landed: landed,
        is_object=False,
        side_key=lambda hit: hit["id"],
        side_detail=_figshare_detail,
        side_files=_figshare_files,
    ),
}


def _usable(landing: DataFrame, fmt: CatalogFormat) -> DataFrame:
    """This catalog's pages that were fetched without failure."""
    return landing.where(
        (F.col("repo") == fmt.name) & ~F.coalesce(F.col("failed"), F.lit(False))
    )


def search_hits(landing: DataFrame, fmt: CatalogFormat) -> DataFrame:
    """One row per search hit, with its position in the collection run."""
    pages = _usable(landing, fmt).withColumn(
        "doc", F.from_json("payload", fmt.payload, _PERMISSIVE)
    )
    hits = pages.select(
        "repo",
        "query",
        "query_idx",
        F.lit(REPOSITORY_ORDER.get(fmt.name, len(REPOSITORY_ORDER))).alias("repo_idx"),
        "page",
        "fetched_at",
        # Outer, as Spark would test the size of an inner one below, parsing again.
        F.posexplode_outer(fmt.hits(F.col("doc"))).alias("pos", "hit"),
    ).where(F.col("hit").isNotNull())
    return hits.where(fmt.keep(F.col("hit"))) if fmt.keep else hits


def side_documents_by_key(
    side: DataFrame, fmt: CatalogFormat, wanted: DataFrame | None = None
) -> DataFrame:
    """One row per key: the newest detail and the newest file list, parsed.

    Of equally new ones that with the greatest hash. The newest per key and kind is
    picked before the exchange too, so a key that was fetched very often shrinks there;
    what is left are two rows per key at most. The texts are parsed on this side of the
    join, once per key; after it they would be parsed again wherever a filter on a
    record's files is pushed down to. ``wanted`` restricts the documents to the keys of
    a small set of hits, by a bitmap before anything is exchanged: a few others may come
    through, which no hit asks for.
    """
    usable = side.where(
        (F.col("repo") == fmt.name) & ~F.coalesce(F.col("failed"), F.lit(False))
    )
    if wanted is not None:
        keys = stage(wanted.select(F.col("side_key").alias("key")).distinct(), "side-keys")
        usable = perhaps_in(usable, keys, "key", "_wanted").where("_wanted").drop("_wanted")

    newest_first = [F.desc_nulls_last("fetched_at"), F.xxhash64("payload").desc()]

    def newest(kind: str, parsed: Column, name: str) -> DataFrame:
        own = first_per_key(usable.where(F.col("kind") == kind), ["key"], newest_first)
        return own.select(F.col("key").alias("side_key"), parsed.alias(name))

    files = newest("files", fmt.side_files(F.col("payload")), "side_files")
    if not fmt.side_detail:
        return files
    detail = newest("detail", fmt.side_detail(F.col("payload")), "detail")
    return detail.join(files, "side_key", "full")


def _spread_missing(key: Column) -> Column:
    """Give hits without a key distinct fillers that match nothing.

    Otherwise all of them would meet in the one partition of the empty key.
    """
    filler = F.concat_ws("\x00", F.lit(""), "repo", "query_idx", "page", "pos")
    return F.coalesce(F.nullif(key, F.lit("")), filler)


def attach_side_documents(
    hits: DataFrame, side: DataFrame | None, fmt: CatalogFormat, few_hits: bool = False
) -> DataFrame:
    """Replace hits by their details and add the ``files`` array.

    ``few_hits`` is for increments: the side documents, which cover the whole past,
    are first reduced to the keys of these hits.
    """
    if fmt.side_key is None:
        return hits
    if side is None:
        return hits.withColumn("search_hit", F.col("hit")).withColumn("files", no_files())
    keyed = hits.withColumn("side_key", _spread_missing(fmt.side_key(F.col("hit"))))
    documents = side_documents_by_key(side, fmt, keyed if few_hits else None)
    joined = join_to_one(keyed, documents, ["side_key"])
    joined = joined.withColumns(
        {"search_hit": F.col("hit"), "files": F.coalesce("side_files", no_files())}
    )
    if fmt.side_detail:
        joined = joined.withColumn("hit", F.coalesce("detail", "hit"))
    return joined


def extract(
    landing: DataFrame,
    fmt: CatalogFormat,
    side: DataFrame | None = None,
    few_hits: bool = False,
) -> DataFrame:
    """Records of one catalog in the flat schema, with their run position."""
    hits = attach_side_documents(search_hits(landing, fmt), side, fmt, few_hits)
    columns = {"source": F.lit(fmt.name)} | fmt.record(F.col("hit"))
    if fmt.side_key is not None:
        columns["files"] = F.col("files")
    # The id of the search row stays even where a detail replaced the rest.
    columns.setdefault("record_id", text(F.col("search_hit")["id"]) if fmt.side_key else F.lit(""))
    return hits.select(
        *schemas.POSITION_FIELDS, *[columns[f].alias(f) for f in schemas.RECORD_FIELDS]
    )


def extract_zenodo(landing: DataFrame) -> DataFrame:
    return extract(landing, FORMATS["zenodo"])


def extract_dryad(landing: DataFrame, side: DataFrame | None = None) -> DataFrame:
    return extract(landing, FORMATS["dryad"], side)


def extract_cessda(landing: DataFrame) -> DataFrame:
    return extract(landing, FORMATS["cessda"])


def extract_figshare(landing: DataFrame, side: DataFrame | None = None) -> DataFrame:
    return extract(landing, FORMATS["figshare"], side)


def extract_all(
    landing: DataFrame,
    side: DataFrame | None = None,
    formats: dict[str, CatalogFormat] | None = None,
    few_hits: bool = False,
) -> DataFrame:
    """Records of every catalog in one frame."""
    frames = [extract(landing, fmt, side, few_hits) for fmt in (formats or FORMATS).values()]
    return reduce(DataFrame.unionByName, frames)


def _page_facts(landing: DataFrame, fmt: CatalogFormat) -> DataFrame:
    pages = landing.where(F.col("repo") == fmt.name).withColumn(
        "doc", F.from_json("payload", fmt.facts, _PERMISSIVE)
    )
    hits = fmt.hits(F.col("doc"))
    kept = F.filter(hits, fmt.keep) if fmt.keep else hits
    return pages.select(
        "repo",
        "query",
        "query_idx",
        "page",
        "page_size",
        "fetched_at",
        F.xxhash64("payload").alias("payload_hash"),
        (F.coalesce(F.col("failed"), F.lit(False)) | F.col("payload").isNull()).alias("failed"),
        F.coalesce(F.size(kept), F.lit(0)).alias("n_records"),
        F.coalesce(fmt.total(F.col("doc"), F.col("total")), F.lit(0))
        .cast("bigint")
        .alias("total"),
    )


def page_facts(
    landing: DataFrame, formats: dict[str, CatalogFormat] | None = None
) -> DataFrame:
    """Per landed page: did it fail, how many records it gave, the reported total."""
    frames = [_page_facts(landing, fmt) for fmt in (formats or FORMATS).values()]
    return reduce(DataFrame.unionByName, frames)


def rejected_pages(
    landing: DataFrame, formats: dict[str, CatalogFormat] | None = None
) -> DataFrame:
    """Pages that were fetched but cannot be read as this catalog's format."""
    frames = []
    for fmt in (formats or FORMATS).values():
        pages = _usable(landing, fmt).withColumn(
            "doc", F.from_json("payload", fmt.payload, _PERMISSIVE)
        )
        unreadable = F.col("doc").isNull()
        if fmt.is_object:
            unreadable |= F.col("doc._corrupt_record").isNotNull() & fmt.hits(F.col("doc")).isNull()
        frames.append(pages.where(unreadable).select("repo", "query", "query_idx", "page", "payload"))
    return reduce(DataFrame.unionByName, frames)
