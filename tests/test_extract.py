"""Hand-written payloads: missing, null, empty and malformed parts."""

import datetime
import json

import pytest

from harvestlake.operators import extract as x
from harvestlake.schemas import LANDING, SIDE_DOCUMENTS

WHEN = datetime.datetime(2024, 1, 1)


def page(spark, repo, payload, failed=False, total=None, page=1):
    body = payload if isinstance(payload, str) else json.dumps(payload)
    return spark.createDataFrame(
        [(repo, "q", 0, page, 25, WHEN, failed, total, body)], LANDING
    )


def side(spark, *rows):
    return spark.createDataFrame(
        [
            (repo, kind, key, WHEN + datetime.timedelta(days=age), failed,
             body if isinstance(body, str) else json.dumps(body))
            for repo, kind, key, age, failed, body in rows
        ],
        SIDE_DOCUMENTS,
    )


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict(recursive=True)


def test_zenodo_full_and_bare(spark):
    hits = [
        {
            "id": 12, "links": {"self_html": "H", "archive": "A"},
            "files": [{"key": "a.PDF", "links": {"self": "u"}}, {"key": "noext"}, {"links": None}],
            "metadata": {
                "title": "T", "publication_date": "2024", "doi": "10.1/x", "description": None,
                "license": {"id": "CC-BY-4.0"}, "creators": [{"name": ""}, {}],
                "contributors": [{"name": "C"}, {"name": ""}], "keywords": [],
                "subjects": [{"term": "s"}, {"term": ""}, {}],
            },
        },
        {"id": 13, "metadata": None},
        {"id": "14", "metadata": {"keywords": ["", "k"], "creators": [{"name": "B"}]}},
    ]
    rows = (
        x.extract_zenodo(page(spark, "zenodo", {"hits": {"total": 3, "hits": hits}}))
        .orderBy("pos")
        .collect()
    )
    full, bare, third = [r.asDict(recursive=True) for r in rows]
    assert full["record_id"] == "12" and full["license"] == "CC-BY-4.0"
    assert full["description"] == "" and full["record_page"] == "H"
    assert [(f["name"], f["download_url"], f["extension"]) for f in full["files"]] == [
        ("a.PDF", "u", "pdf"), ("noext", "", ""), ("", "", ""),
    ]
    assert full["creators"] == ["C"] and full["keywords"] == ["s"]
    assert bare["record_id"] == "13" and bare["title"] == "" and bare["files"] == []
    assert bare["creators"] == [] and bare["keywords"] == []
    assert third["keywords"] == ["", "k"] and third["creators"] == ["B"]


def test_dryad_links_and_lists(spark):
    datasets = [
        {
            "id": 5, "identifier": "doi:10.5061/x", "title": "T", "abstract": "D",
            "license": "https://spdx.org/licenses/CC0-1.0.html",
            "authors": [{"fullName": "", "name": "N"}, {"fullName": "F", "name": "M"}, {}],
            "keywords": [], "subjects": ["s"],
            "_links": {"stash:download": {"href": "/d"}, "stash:version": {"href": "/v/5"}},
        },
        {"id": 6, "_links": {"stash:version": {"href": "/v/6"}}},
        {"id": 7},
    ]
    lists = side(
        spark,
        ("dryad", "files", "/v/5", 0, False, {"_embedded": {"stash:files": [{"path": "old.txt"}]}}),
        ("dryad", "files", "/v/5", 1, False, {
            "_embedded": {"stash:files": [
                {"path": "a.TAR.gz", "_links": {"stash:download": {"href": "/f/1"}}}, {"path": "b"},
            ]}
        }),
        ("dryad", "files", "/v/5", 2, True, "oops"),
        ("dryad", "files", "/v/6", 0, False, "not json"),
    )
    rows = (
        x.extract_dryad(page(spark, "dryad", {"total": 3, "_embedded": {"stash:datasets": datasets}}), lists)
        .orderBy("pos")
        .collect()
    )
    first, second, third = [r.asDict(recursive=True) for r in rows]
    assert first["doi"] == "doi:10.5061/x" and first["license"] == "cc0-1.0"
    assert first["record_page"] == "https://datadryad.org/stash/dataset/doi:10.5061/x"
    assert first["archive_download_link"] == "https://datadryad.org/d"
    assert first["creators"] == ["N", "F"] and first["keywords"] == ["s"]
    assert [(f["name"], f["download_url"], f["extension"]) for f in first["files"]] == [
        ("a.TAR.gz", "https://datadryad.org/f/1", "gz"), ("b", "", ""),
    ]
    assert second["files"] == [] and third["files"] == []
    assert third["record_page"] == "" and third["license"] == ""


def test_figshare_detail_replaces_whole_row(spark):
    articles = [{"id": i, "title": f"S{i}", "doi": f"d{i}", "tags": ["st"]} for i in (1, 2, 3, 4)]
    docs = side(
        spark,
        ("figshare", "detail", "1", 0, False, {
            "id": 99, "title": "D1", "published_date": "2020-01-02T00:00:00Z",
            "license": {"name": "CC BY 4.0"}, "authors": [{"full_name": "A"}, {"full_name": ""}],
        }),
        ("figshare", "detail", "2", 0, False, {}),
        ("figshare", "detail", "3", 0, False, "broken {"),
        ("figshare", "files", "1", 0, False, [{"name": "f.CSV", "download_url": "u"}]),
        ("figshare", "files", "2", 0, False, {"message": "no"}),
    )
    rows = x.extract_figshare(page(spark, "figshare", articles), docs).orderBy("pos").collect()
    first, *rest = [r.asDict(recursive=True) for r in rows]
    assert first["record_id"] == "1", "the search id stays"
    assert first["title"] == "D1" and first["doi"] == "" and first["keywords"] == []
    assert first["publication_date"] == "2020-01-02" and first["license"] == "cc-by-4.0"
    assert first["creators"] == ["A"] and first["archive_download_link"] == ""
    assert [f["extension"] for f in first["files"]] == ["csv"]
    for row, number in zip(rest, (2, 3, 4)):
        assert row["title"] == f"S{number}" and row["keywords"] == ["st"] and row["files"] == []


def test_cessda_keeps_open_only(spark):
    results = [
        {"id": "a", "titleStudy": "T", "publicationYear": 2021, "dataAccess": "Open",
         "studyUrl": "U", "pidStudies": [{"agency": "DOI", "pid": "doi:10.1/A"}],
         "creators": [{"name": "N"}, {"name": None}], "keywords": [{"term": "k"}, {}]},
        {"id": "b", "dataAccess": "Restricted"},
        {"id": "c"},
    ]
    got = one(x.extract_cessda(page(spark, "cessda", {"Results": results})))
    assert got["record_id"] == "a" and got["publication_date"] == "2021" and got["doi"] == "10.1/a"
    assert got["record_page"] == "https://datacatalogue.cessda.eu/detail/a/?lang=en"
    assert got["license"] == "cc-by" and got["files"] == [] and got["keywords"] == ["k"]


@pytest.mark.parametrize(
    "repo, payload, landed, expected",
    [
        ("zenodo", {"hits": {"total": 7, "hits": [{"id": 1}]}}, None, (1, 7)),
        ("zenodo", {}, None, (0, 0)),
        ("dryad", {"total": 8, "_embedded": {"stash:datasets": []}}, None, (0, 8)),
        ("figshare", [{"id": 1}, {"id": 2}], 9, (2, 9)),
        ("cessda", {"ResultsCount": {"available": 4},
                    "Results": [{"dataAccess": "Open"}, {"dataAccess": "X"}]}, None, (1, 4)),
    ],
)
def test_page_facts(spark, repo, payload, landed, expected):
    row = one(x.page_facts(page(spark, repo, payload, total=landed)))
    assert (row["n_records"], row["total"]) == expected
    assert row["failed"] is False


def test_rejects_and_failed_pages(spark):
    good = page(spark, "zenodo", {"hits": {"hits": []}})
    bad = page(spark, "zenodo", '{"hits": {"hits": [', page=2)
    broken_list = page(spark, "figshare", "[{", page=3)
    failed = page(spark, "zenodo", {"hits": {"hits": [{"id": 1}]}}, failed=True, page=4)
    landing = good.unionByName(bad).unionByName(broken_list).unionByName(failed)
    assert sorted(r["page"] for r in x.rejected_pages(landing).collect()) == [2, 3]
    assert x.extract_all(landing).count() == 0


def test_one_more_catalog_is_one_entry(spark):
    from harvestlake.operators.extract import CatalogFormat
    from harvestlake.functions.nested import no_files, or_empty
    from harvestlake.functions.text import text
    from pyspark.sql import functions as F

    blank = {f: F.lit("") for f in (
        "publication_date", "doi", "license", "record_page", "archive_download_link", "description")}
    extra = CatalogFormat(
        name="extra",
        payload="items ARRAY<STRUCT<id: STRING, name: STRING>>",
        facts="items ARRAY<STRUCT<id: STRING>>",
        hits=lambda doc: doc["items"],
        record=lambda hit: {
            "record_id": text(hit["id"]), "title": text(hit["name"]), "files": no_files(),
            "creators": or_empty(F.lit(None)), "keywords": or_empty(F.lit(None)), **blank,
        },
        total=lambda doc, landed: landed,
        is_object=False,
    )
    landing = page(spark, "extra", {"items": [{"id": 1, "name": "n"}]})
    got = one(x.extract_all(landing, formats={**x.FORMATS, "extra": extra}))
    assert (got["source"], got["record_id"], got["title"], got["repo_idx"]) == ("extra", "1", "n", 4)
