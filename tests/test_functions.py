"""Hand-written inputs and expected values for the column expressions."""

import datetime

from pyspark.sql import functions as F

from harvestlake import refdata
from harvestlake.functions import licences, nested, relevance, text


def test_file_extension(column):
    names = ["a.PDF", "noext", "archive.", ".gitignore", "a.b/c", "x.tar.gz", "", None]
    assert column(text.file_extension, names) == [
        "pdf", "", "", "gitignore", "b/c", "gz", "", "",
    ]


def test_spdx_licence(column):
    raw = [
        "", None, "https://spdx.org/licenses/CC0-1.0.html", "https://spdx.org/licenses/CC-BY-4.0.html",
        "CC-BY", "http://x/licenses/MIT.html",
    ]
    assert column(licences.spdx_licence, raw) == [
        "", "", "cc0-1.0", "cc-by-4.0", "cc-by", "http://x/licenses/mit.html",
    ]


def test_display_name_licence(column):
    names = [
        "CC BY 4.0", "CC0", "CC Zero", "Public Domain", " MIT ", "A/B c", "CC0 1.0", None, "  ",
        " CC BY　",
    ]
    assert column(licences.display_name_licence, names) == [
        "cc-by-4.0", "cc0", "cc0", "cc0", "mit", "a-b-c", "cc0-1.0", "", "", "cc-by",
    ]


def test_inferred_licence(spark):
    cases = [
        ("Open", [], "cc-by"),
        ("Open", None, "cc-by"),
        ("Open", ["CC BY-NC 3.0"], "cc-by-3.0"),
        ("Open", ["CC BY 4.0", "public domain"], "cc0"),
        ("Open", ["cc-by", "2.5 or 3.0"], "cc-by-3.0"),
        ("Open", ["CC BY"], "cc-by"),
        ("Open", ["ODC-BY 1.0"], "odc-by"),
        ("Open", ["PDDL"], "pddl"),
        ("Open", ["all rights reserved"], "cc-by"),
        ("Restricted", ["CC0"], ""),
        (None, ["CC0"], ""),
    ]
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)],
        "i INT, access STRING, notes ARRAY<STRING>, expected STRING",
    )
    found = df.select("i", "expected", licences.inferred_licence(F.col("access"), F.col("notes")))
    assert [r for r in found.collect() if r[1] != r[2]] == []


def test_doi_from_identifiers(column):
    kind = "ARRAY<STRUCT<agency: STRING, pid: STRING>>"
    values = [
        [("URN", "x"), ("DOI", "doi:10.1/ABC")],
        [("DOI", "DOI:10.1/A")],
        [("DOI", ""), ("DOI", "10.2/b")],
        [("DOI", None)],
        [],
        None,
    ]
    assert column(text.doi_from_identifiers, values, kind) == [
        "10.1/abc", "doi:10.1/a", "", "", "", "",
    ]


def test_dates(column):
    assert column(text.iso_day, ["2024-05-06T00:00:00Z", "2021", None]) == ["2024-05-06", "2021", ""]
    parsed = column(text.partial_date, ["2024-05-06", "2021", "2021-05", "", "soon", None])
    day = datetime.date
    assert parsed == [day(2024, 5, 6), day(2021, 1, 1), day(2021, 5, 1), None, None, None]


def test_urls_and_paths(spark, column):
    assert column(lambda c: text.prefixed_url("https://x", c, "/y"), ["/a", "", None]) == [
        "https://x/a/y", "", "",
    ]
    path = spark.range(1).select(
        text.storage_path("out", F.lit("repo"), F.lit("p"), F.lit(""), F.lit("f.pdf")),
        text.storage_path("out", F.lit("repo"), F.lit("p"), F.lit("v1"), F.lit("f.pdf")),
        text.storage_path("out", F.lit("repo"), F.lit("p"), F.lit(None).cast("string"), F.lit("f")),
    )
    assert tuple(path.first()) == ("out/repo/p/f.pdf", "out/repo/p/v1/f.pdf", "out/repo/p/f")


def test_open_licence(column):
    values = [
        "cc-by-4.0", "CC0-1.0", "cc-by-nc-4.0", "odc-by", "cc-zero", "cc-pddc", "pddl",
        "mit", "", None, "restricted",
    ]
    assert column(licences.is_open_licence, values) == [True] * 7 + [False] * 4
    strict = column(lambda c: licences.is_open_licence(c, exclude_restrictive=True), values)
    assert strict == [True, True, False, True, True, True, True] + [False] * 4


def test_blank_names(column):
    kept = ["  a ", "​", "x"]
    dropped = ["\t\n", " ", "\x1c", "\x85", "　", "", None]
    assert column(text.is_not_blank, kept + dropped) == [True] * 3 + [False] * 7


def test_array_facts(spark):
    cases = {
        "none": [], "tool": ["a.qdpx", "b.R"], "code": ["a.py", "b.r"], "mixed": ["a.py", "noext"],
        "zip": ["z.ZIP", "d.docx", "e.docx"],
    }
    rows = [(k, [(n, "u", n.rsplit(".", 1)[-1].lower() if "." in n else "") for n in v]) for k, v in cases.items()]
    rows.append(("missing", None))
    df = spark.createDataFrame(
        rows, "k STRING, files ARRAY<STRUCT<name: STRING, download_url: STRING, extension: STRING>>"
    )
    files = F.col("files")
    got = {
        r[0]: tuple(r)[1:]
        for r in df.select(
            "k",
            nested.file_count(files),
            nested.has_tool_export(files),
            nested.has_text_file(files),
            nested.has_zip(files),
            nested.is_all_code(files),
            nested.file_types(files),
        ).collect()
    }
    assert got["none"] == (0, False, False, False, False, [])
    assert got["tool"] == (2, True, False, False, False, ["qdpx", "r"])
    assert got["code"] == (2, False, False, False, True, ["py", "r"])
    assert got["mixed"] == (2, False, False, False, False, ["py"])
    assert got["zip"] == (3, False, True, True, False, ["docx", "zip"])
    assert got["missing"][:5] == (0, False, False, False, False)


def test_scores(spark, column):
    titles = ["Interview interview INTERVIEWS", "Ethnographic field notes", "", None, "ATLAS.ti coded"]
    assert column(relevance.title_score, titles) == [1, 2, 0, 0, 2]
    kind = "ARRAY<STRUCT<name: STRING, download_url: STRING, extension: STRING>>"
    files = [[("a", "", "qdpx"), ("b", "", "pdf")], [("a", "", "py")], [], None]
    scores = column(lambda c: relevance.record_score(F.lit("Narrative"), c), files, kind)
    assert scores == [13, -4, 1, 1]


def test_query_terms():
    assert refdata.query_terms('"action research" qualitative') == ["action research", "qualitative"]
    assert refdata.query_terms("NVivo") == ["NVivo"]
    assert refdata.query_terms('"REFI-QDA"') == ["REFI-QDA"]


def test_reference_tables(spark):
    tables = refdata.refdata(spark)
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {
        "queries": 67, "licence_prefixes": 6, "extensions": 36, "title_keywords": 20,
        "repositories": 4, "repository_names": 8,
    }
    assert tables["queries"].select("query").distinct().count() == 66
    groups = {r[0]: r[1] for r in tables["queries"].groupBy("query_group").count().collect()}
    assert groups == {"tool": 16, "en": 22, "de": 7, "nl": 5, "no": 4, "es": 5, "fr": 4, "pt": 4}
    kinds = {r[0]: r[1] for r in tables["extensions"].groupBy("kind").count().collect()}
    assert kinds == {"tool": 12, "text": 11, "code": 12, "archive": 1}
    assert len(set(refdata.DEFAULT_EXTENSIONS)) == 24
    assert len(refdata.all_queries(multilingual=False)) == 38
