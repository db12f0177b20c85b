"""Explicit schemas: landed pages, side documents, payloads, catalog tables.

No schema is ever inferred; payloads are typed by ``from_json`` with the DDL below.
"""

from __future__ import annotations

# One landed response page per row.
LANDING = (
    "repo STRING, query STRING, query_idx INT, page INT, page_size INT, "
    "fetched_at TIMESTAMP, failed BOOLEAN, total BIGINT, payload STRING"
)

# One follow-up document per row: a file list (kind 'files') or a record detail
# (kind 'detail'), addressed by the key the search hit carries.
SIDE_DOCUMENTS = (
    "repo STRING, kind STRING, key STRING, fetched_at TIMESTAMP, failed BOOLEAN, payload STRING"
)

ZENODO_PAGE = """
hits STRUCT<total: BIGINT, hits: ARRAY<STRUCT<
  id: STRING, links: STRUCT<self_html: STRING, archive: STRING>,
  files: ARRAY<STRUCT<key: STRING, links: STRUCT<self: STRING>>>,
  metadata: STRUCT<title: STRING, publication_date: STRING, doi: STRING, description: STRING,
    access_right: STRING, license: STRUCT<id: STRING>,
    creators: ARRAY<STRUCT<name: STRING>>, contributors: ARRAY<STRUCT<name: STRING>>,
    keywords: ARRAY<STRING>, subjects: ARRAY<STRUCT<term: STRING>>>>>>,
_corrupt_record STRING"""

DRYAD_PAGE = """
total BIGINT, _embedded STRUCT<`stash:datasets`: ARRAY<STRUCT<
  id: STRING, identifier: STRING, title: STRING, abstract: STRING, license: STRING,
  publicationDate: STRING, authors: ARRAY<STRUCT<fullName: STRING, name: STRING>>,
  keywords: ARRAY<STRING>, subjects: ARRAY<STRING>,
  _links: STRUCT<`stash:download`: STRUCT<href: STRING>, `stash:version`: STRUCT<href: STRING>>>>>,
_corrupt_record STRING"""

DRYAD_FILES = """
_embedded STRUCT<`stash:files`: ARRAY<STRUCT<
  path: STRING, _links: STRUCT<`stash:download`: STRUCT<href: STRING>>>>>"""

FIGSHARE_ARTICLE = (
    "STRUCT<id: STRING, title: STRING, description: STRING, doi: STRING, published_date: STRING, "
    "url_public_html: STRING, item_type: INT, tags: ARRAY<STRING>, "
    "authors: ARRAY<STRUCT<full_name: STRING>>, "
    "license: STRUCT<value: INT, name: STRING, url: STRING>>"
)
FIGSHARE_PAGE = f"ARRAY<{FIGSHARE_ARTICLE}>"
FIGSHARE_FILES = "ARRAY<STRUCT<name: STRING, download_url: STRING>>"

CESSDA_PAGE = """
ResultsCount STRUCT<available: BIGINT>,
Results ARRAY<STRUCT<id: STRING, titleStudy: STRING, abstract: STRING, studyUrl: STRING,
  publicationYear: STRING, dataAccess: STRING, dataAccessFreeTexts: ARRAY<STRING>,
  pidStudies: ARRAY<STRUCT<agency: STRING, pid: STRING>>,
  creators: ARRAY<STRUCT<name: STRING>>, keywords: ARRAY<STRUCT<term: STRING>>>>,
_corrupt_record STRING"""

# Narrow forms used where only a page's record count and total are wanted: the
# JSON reader skips every field that is not named.
ZENODO_FACTS = "hits STRUCT<total: BIGINT, hits: ARRAY<STRUCT<id: STRING>>>"
DRYAD_FACTS = "total BIGINT, _embedded STRUCT<`stash:datasets`: ARRAY<STRUCT<id: STRING>>>"
FIGSHARE_FACTS = "ARRAY<STRUCT<id: STRING>>"
CESSDA_FACTS = "ResultsCount STRUCT<available: BIGINT>, Results ARRAY<STRUCT<dataAccess: STRING>>"

FILE_STRUCT = "STRUCT<name: STRING, download_url: STRING, extension: STRING>"
FILES = f"ARRAY<{FILE_STRUCT}>"

# The flat record every catalog format ends in.
RECORD_FIELDS = [
    "source", "record_id", "title", "publication_date", "doi", "license", "record_page",
    "archive_download_link", "description", "files", "creators", "keywords",
]
# Where a record was found; together these give the insertion order.
POSITION_FIELDS = ["repo", "query", "query_idx", "repo_idx", "page", "pos", "fetched_at"]

TABLES = {
    "projects": (
        "id BIGINT, query_string STRING, repository_id INT, repository_url STRING, "
        "project_url STRING, version STRING, title STRING, description STRING, language STRING, "
        "doi STRING, upload_date_raw STRING, upload_date DATE, download_date TIMESTAMP, "
        "download_repository_folder STRING, download_project_folder STRING, "
        "download_version_folder STRING, download_method STRING"
    ),
    "files": (
        "id BIGINT, project_id BIGINT, file_name STRING, file_type STRING, "
        "download_url STRING, status STRING"
    ),
    "keywords": "id BIGINT, project_id BIGINT, keyword STRING",
    "person_role": "id BIGINT, project_id BIGINT, name STRING, role STRING",
    "licenses": "id BIGINT, project_id BIGINT, license STRING",
    "relevance_scores": (
        "id BIGINT, project_id BIGINT, relevance_score INT, description STRING"
    ),
}

NOT_NULL = {
    "projects": [
        "repository_id", "repository_url", "project_url", "title", "description",
        "download_date", "download_repository_folder", "download_project_folder",
        "download_method",
    ],
    "files": ["project_id", "file_name", "file_type", "status"],
    "keywords": ["project_id", "keyword"],
    "person_role": ["project_id", "name", "role"],
    "licenses": ["project_id", "license"],
    "relevance_scores": ["project_id", "relevance_score"],
}
CHILD_TABLES = ["files", "keywords", "person_role", "licenses", "relevance_scores"]

COLUMN_DEFAULTS = {
    "files": {"status": "pending"},
    "person_role": {"role": "UNKNOWN"},
    "relevance_scores": {"relevance_score": 0},
}
