"""Reference data: search terms, licence prefixes, extension sets, repositories.

Everything here is a fixed value that decides results; nothing is computed from
data, and every list has a constant size (the largest has 67 entries).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: licence prefixes that count as open -----------------------
OPEN_LICENCE_PREFIXES = ["cc-by", "cc0", "cc-zero", "odc-by", "pddl", "cc-pddc"]

# ---- fixed values: file extensions -------------------------------------------
TOOL_EXTENSIONS = [
    "qdpx", "nvpx", "nvp", "atlproj", "mx", "mx22",
    "hpr", "f4p", "mx20", "atlproj9", "mx24", "atlasti",
]
TEXT_EXTENSIONS = [
    "docx", "doc", "txt", "rtf", "odt", "xlsx", "csv", "tsv", "xml", "json", "pdf",
]
CODE_EXTENSIONS = [
    "r", "py", "java", "cpp", "c", "h", "js", "ts", "html", "css", "sh", "ipynb",
]
ARCHIVE_EXTENSIONS = ["zip"]
DEFAULT_EXTENSIONS = TOOL_EXTENSIONS + TEXT_EXTENSIONS + ARCHIVE_EXTENSIONS

# ---- fixed values: words in a title that raise the relevance score -----------
TITLE_KEYWORDS = [
    "interview", "transcript", "focus group", "ethnograph", "qualitative",
    "nvivo", "atlas.ti", "maxqda", "qdpx", "coded", "thematic",
    "grounded theory", "oral history", "field note", "fieldnote", "narrative",
    "discourse", "phenomenolog", "participant observation", "refi-qda",
]

# ---- fixed values: score weights ---------------------------------------------
TOOL_FILE_BONUS = 10
TEXT_FILE_BONUS = 2
CODE_ONLY_PENALTY = 5

# ---- fixed values: search queries --------------------------------------------
TOOL_QUERIES = [
    "qdpx", "nvpx", "atlproj", "mx22", '"REFI-QDA"', "NVivo", '"ATLAS.ti"', "MaxQDA",
    "Dedoose", "QDAcity", '"QDA Miner"', "Transana", "f4analyse", "CAQDAS",
    '"qualitative data analysis"', '"coded transcript"',
]
ENGLISH_QUERIES = [
    '"interview transcript"', '"qualitative research"', '"qualitative data"',
    '"focus group"', "ethnography", '"grounded theory"', '"semi-structured interview"',
    '"thematic analysis"', '"narrative analysis"', '"case study research"',
    '"participant observation"', '"qualitative coding"', '"open-ended responses"',
    '"open-ended questions"', '"biographical interview"', '"life history interview"',
    '"action research" qualitative', '"interpretive research"',
    '"interpretative phenomenological"', "QualCoder", '"mixed methods" qualitative',
    '"codebook" qualitative',
]
LANGUAGE_QUERIES = {
    "de": [
        '"qualitative Forschung"', '"qualitatives Interview"', "Leitfadeninterview",
        "Gruppendiskussion", "Biografieforschung", '"qualitative Inhaltsanalyse"',
        '"Transkript Interview"',
    ],
    "nl": [
        '"kwalitatief onderzoek"', '"kwalitatief interview"', "focusgroep",
        '"diepte-interview"', '"transcriptie interview"',
    ],
    "no": [
        '"kvalitativ forskning"', '"kvalitativt intervju"', "fokusgruppe", "dybdeintervju",
    ],
    "es": [
        '"investigación cualitativa"', '"entrevista cualitativa"', '"grupo focal"',
        '"análisis temático"', '"transcripción entrevista"',
    ],
    "fr": [
        '"recherche qualitative"', '"entretien qualitatif"', '"groupe de discussion"',
        '"analyse thématique"',
    ],
    "pt": [
        '"pesquisa qualitativa"', '"entrevista qualitativa"', '"grupo focal"',
        '"análise temática"',
    ],
}

# ---- fixed values: repositories ----------------------------------------------
# id, name, other name, base URL, API root, method, page cap without / with token,
# position in a full collection run
REPOSITORIES = [
    (1, "zenodo", "ZenodoClient", "https://zenodo.org",
     "https://zenodo.org/api/records", "API-CALL", 25, 100, 0),
    (2, "dryad", "DryadClient", "https://datadryad.org",
     "https://datadryad.org/api/v2", "API-CALL", None, None, 1),
    (3, "cessda", "CESSDAClient", "https://datacatalogue.cessda.eu",
     "https://datacatalogue.cessda.eu/api/DataSets/v2/search", "SCRAPING", 200, 200, 2),
    (4, "figshare", "FigshareClient", "https://figshare.com",
     "https://api.figshare.com/v2", "API-CALL", None, None, 3),
]
REPOSITORY_ORDER = {row[1]: row[8] for row in REPOSITORIES}
DEFAULT_METHOD = "API-CALL"
METHODS = ["SCRAPING", "API-CALL"]

# ---- fixed values: file statuses ---------------------------------------------
PENDING = "pending"
SUCCESS = "success"
FAILED = "failed"
SKIPPED_SIZE = "skipped_size"
SKIPPED_EXTENSION = "skipped_ext"
SKIPPED_EXISTS = "skipped_exists"
SKIPPED_NO_URL = "skipped_no_url"

DEFAULT_MAX_SIZE_MB = 500.0


def multilingual_queries() -> list[str]:
    return [q for queries in LANGUAGE_QUERIES.values() for q in queries]


def all_queries(multilingual: bool = True) -> list[str]:
    """Tool queries, then English, then the other languages; duplicates stay."""
    extra = multilingual_queries() if multilingual else []
    return TOOL_QUERIES + ENGLISH_QUERIES + extra


def query_terms(query: str) -> list[str]:
    """Split a search string: a quoted part is one phrase, a bare word one term."""
    parts = query.split('"')
    terms = []
    for position, part in enumerate(parts):
        terms += [part] if position % 2 else part.split()
    return [t for t in terms if t]


def _lookup(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows; unlike a table made of a list they start no Python worker in each query."""
    fields = [part.split() for part in schema.split(", ")]
    text = json.dumps([{name: value for (name, _), value in zip(fields, row, strict=True)} for row in rows])
    kind = f"ARRAY<STRUCT<{', '.join(f'{name}: {kind}' for name, kind in fields)}>>"
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), kind)))


def repositories(spark: SparkSession) -> DataFrame:
    """The four repositories; size fixed by ``REPOSITORIES``."""
    return _lookup(
        spark,
        REPOSITORIES,
        "repository_id INT, repo STRING, alias STRING, repository_url STRING, api_root STRING,"
        " download_method STRING, page_cap INT, page_cap_with_token INT, repo_idx INT",
    )


def repository_names(spark: SparkSession) -> DataFrame:
    """Every name a repository is known by (8 rows) with its id."""
    rows = [(name, r[0]) for r in REPOSITORIES for name in (r[1], r[2])]
    return _lookup(spark, rows, "name STRING, repository_id INT")


def queries_table(spark: SparkSession, queries: list[str] | None = None) -> DataFrame:
    """Search strings with their ordinal; duplicates keep separate ordinals."""
    rows = list(enumerate(all_queries() if queries is None else queries))
    return spark.createDataFrame(rows, "query_idx INT, query STRING")


def refdata(spark: SparkSession) -> dict[str, DataFrame]:
    """All reference lists as small tables, keyed by table name."""
    groups = (
        [("tool", q) for q in TOOL_QUERIES]
        + [("en", q) for q in ENGLISH_QUERIES]
        + [(lang, q) for lang, qs in LANGUAGE_QUERIES.items() for q in qs]
    )
    extensions = (
        [("tool", e) for e in TOOL_EXTENSIONS]
        + [("text", e) for e in TEXT_EXTENSIONS]
        + [("code", e) for e in CODE_EXTENSIONS]
        + [("archive", e) for e in ARCHIVE_EXTENSIONS]
    )
    return {
        "queries": spark.createDataFrame(
            [(i, g, q) for i, (g, q) in enumerate(groups)],
            "query_idx INT, query_group STRING, query STRING",
        ),
        "licence_prefixes": spark.createDataFrame(
            [(p,) for p in OPEN_LICENCE_PREFIXES], "prefix STRING"
        ),
        "extensions": spark.createDataFrame(extensions, "kind STRING, extension STRING"),
        "title_keywords": spark.createDataFrame([(k,) for k in TITLE_KEYWORDS], "keyword STRING"),
        "repositories": repositories(spark),
        "repository_names": repository_names(spark),
    }
