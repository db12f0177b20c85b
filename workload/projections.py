"""Catalog-shaped views of the test tables.

Each view is one test table, a condition and a list of (column, expression), written in the SQL
that Spark and DuckDB share. Spark reads them through ``view`` and the reference SQL
through ``cte``, so both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DAY = "cast(cast(o_orderdate as date) as string)"
_REPO = "1 + o_custkey % 5"
_KEY = (
    "cast(l_orderkey as string) || '_' || cast(l_linenumber as string) || '_' || "
    "cast(l_partkey as string) || '_' || cast(l_suppkey as string)"
)
_TYPE = (
    "case when l_orderkey % 4 = 0 then case l_partkey % 3 when 0 then 'py' when 1 then 'r' "
    "else 'ipynb' end else case l_partkey % 10 when 0 then 'pdf' when 1 then 'qdpx' "
    "when 2 then 'py' when 3 then 'zip' when 4 then 'csv' when 5 then '' when 6 then 'r' "
    "when 7 then 'png' when 8 then 'nvpx' else 'sav' end end"
)
_STEM = "'f' || cast(l_partkey as string) || '_' || cast(l_suppkey as string)"

# In every third row both changes have the same time.
_UPDATES = [
    ("id", _KEY),
    ("status", "case (step + l_suppkey) % 2 when 1 then 'failed' else 'success' end"),
    ("updated_at", "cast(case when l_orderkey % 3 = 0 then 1 else step end as bigint)"),
]

VIEWS: dict[str, tuple[str, str | None, list[tuple[str, str]]]] = {
    "projects": (
        "orders",
        None,
        [
            ("id", "o_orderkey"),
            ("query_string", "o_orderpriority"),
            (
                "query_idx",
                "case substr(o_orderpriority, 1, 1) when '1' then 0 when '2' then 1 "
                "when '3' then 2 when '4' then 3 else 4 end",
            ),
            ("repository_id", f"cast({_REPO} as int)"),
            (
                "source",
                f"case {_REPO} when 1 then 'zenodo' when 2 then 'dryad' when 3 then 'cessda' "
                "when 4 then 'figshare' else 'elsewhere' end",
            ),
            ("record_id", "cast(o_custkey as string)"),
            (
                "title",
                "case o_orderkey % 7 when 0 then 'Interview transcripts and focus group notes' "
                "when 1 then 'Ethnographic field notes' when 2 then 'Sensor logs' "
                "when 3 then 'THEMATIC narrative discourse' when 4 then '' "
                "when 5 then 'Grounded theory NVivo export' else 'Soil samples' end",
            ),
            (
                "description",
                "case when o_orderkey % 11 = 0 then null "
                "else o_orderpriority || ' ' || o_orderstatus end",
            ),
            (
                "license",
                "case o_orderkey % 9 when 0 then 'cc-by-4.0' when 1 then 'CC0-1.0' "
                "when 2 then 'cc-by-nc-4.0' when 3 then 'mit' when 4 then '' when 5 then null "
                "when 6 then 'odc-by' when 7 then 'cc-zero' else 'restricted' end",
            ),
            (
                "doi",
                "case when o_orderkey % 6 = 0 then '' "
                "else 'doi:10.5/' || cast(o_orderkey as string) end",
            ),
            (
                "upload_date_raw",
                f"case o_orderkey % 4 when 0 then substr({_DAY}, 1, 4) "
                f"when 1 then substr({_DAY}, 1, 7) when 2 then {_DAY} else '' end",
            ),
            ("project_url", "'https://repo.invalid/' || cast(o_custkey as string)"),
            ("download_date", _DAY),
            ("download_method", "case when o_custkey % 5 = 2 then 'SCRAPING' else 'API-CALL' end"),
            (
                "download_repository_folder",
                f"case {_REPO} when 1 then 'zenodo' when 2 then 'dryad' when 3 then 'cessda' "
                "when 4 then 'figshare' else 'elsewhere' end",
            ),
            ("download_project_folder", "cast(o_custkey as string)"),
            (
                "download_version_folder",
                "case o_orderkey % 3 when 0 then 'v' || cast(o_orderkey % 5 as string) "
                "when 1 then '' else null end",
            ),
        ],
    ),
    "files": (
        "lineitem",
        None,
        [
            ("id", _KEY),
            ("project_id", "l_orderkey"),
            (
                "file_name",
                f"{_STEM} || case when ({_TYPE}) = '' then '' else '.' || ({_TYPE}) end",
            ),
            ("file_type", _TYPE),
            (
                "download_url",
                "case l_suppkey % 11 when 0 then null when 1 then '' "
                "else 'https://files.invalid/' || cast(l_partkey as string) end",
            ),
            (
                "status",
                "case when l_linestatus = 'O' then 'pending' else case l_suppkey % 4 "
                "when 0 then 'success' when 1 then 'failed' when 2 then 'skipped_size' "
                "else 'skipped_exists' end end",
            ),
            (
                "content_length",
                "case when l_suppkey % 7 = 0 then null "
                "else cast(floor(l_extendedprice * 10000) as bigint) end",
            ),
            ("partkey", "l_partkey"),
            ("suppkey", "l_suppkey"),
        ],
    ),
    "relevance_scores": (
        "orders",
        "o_orderkey % 3 <> 0",
        [
            ("id", "o_orderkey + 1"),
            ("project_id", "o_orderkey"),
            ("relevance_score", "cast(o_custkey % 7 as int)"),
            ("description", "case when o_orderkey % 5 = 0 then null else o_orderpriority end"),
        ],
    ),
    "licenses": (
        "orders",
        "o_orderkey % 9 not in (4, 5)",
        [
            ("id", "o_orderkey"),
            ("project_id", "o_orderkey"),
            (
                "license",
                "case o_orderkey % 9 when 0 then 'cc-by-4.0' when 1 then 'CC0-1.0' "
                "when 2 then 'cc-by-nc-4.0' when 3 then 'mit' when 6 then 'odc-by' "
                "when 7 then 'cc-zero' else 'restricted' end",
            ),
        ],
    ),
    "person_role": (
        "orders",
        None,
        [
            ("id", "o_orderkey"),
            ("project_id", "o_orderkey"),
            (
                "name",
                "case o_orderkey % 13 when 0 then '   ' when 5 then '\u00a0\t' "
                "else ' Author ' || cast(o_custkey as string) end",
            ),
            ("role", "'AUTHOR'"),
        ],
    ),
    "keywords": (
        "lineitem",
        None,
        [
            ("id", _KEY),
            ("project_id", "l_orderkey"),
            ("keyword", "l_returnflag || l_linestatus"),
        ],
    ),
    # Outcomes of fetching a file: the head length and whether the transfer worked.
    "outcomes": (
        "lineitem",
        "l_partkey % 17 <> 0",
        [("id", _KEY), ("fetched", "l_suppkey % 3 <> 0")],
    ),
    # Two status changes for a fifth of the files, and for all files.
    "updates": ("lineitem", "l_partkey % 5 = 0", _UPDATES),
    "all_updates": ("lineitem", None, _UPDATES),
    "new_scores": (
        "orders",
        "o_orderkey % 10 = 0",
        [
            ("project_id", "o_orderkey"),
            ("relevance_score", "cast(90 + step * (o_orderkey % 3 - 1) as int)"),
            ("description", "'rescored'"),
            ("arrived", "cast(o_orderkey * 2 + step * (1 - 2 * (o_custkey % 2)) as bigint)"),
        ],
    ),
    "documents": (
        "documents",
        None,
        [
            ("doc_id", "doc_id"),
            ("text", "text"),
            ("lang", "lang"),
            ("source", "source"),
            ("access_right", "case when doc_id % 4 = 0 then 'restricted' else 'open' end"),
            ("item_type", "cast(1 + doc_id % 5 as int)"),
            (
                "published",
                "cast(2000 + doc_id % 20 as string) || '-0' || cast(1 + doc_id % 9 as string) "
                "|| '-' || cast(10 + doc_id % 18 as string)",
            ),
        ],
    ),
}


# Views in which every table row occurs once per step 1..n.
STEPS = {"updates": 2, "all_updates": 2, "new_scores": 2}


def view_sql(name: str) -> str:
    source, condition, columns = VIEWS[name]
    sql = f"select {', '.join(f'{e} as {c}' for c, e in columns)} from {source}"
    if name in STEPS:
        sql += f" cross join (select unnest(range(1, {STEPS[name] + 1})) as step)"
    return f"{sql} where {condition}" if condition else sql


def cte(*names: str) -> str:
    """``with a_ as (...), b_ as (...)`` for the reference SQL."""
    return "with " + ", ".join(f"{n}_ as ({view_sql(n)})" for n in names) + " "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One of ``VIEWS`` as a DataFrame, optionally with some columns only."""
    source, condition, exprs = VIEWS[name]
    df = table(spark, sf_dir, source)
    if condition:
        df = df.where(condition)
    if name in STEPS:
        df = df.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(STEPS[name]))))
    wanted = [(c, e) for c, e in exprs if not columns or c in columns]
    return df.selectExpr(*[f"{e} as `{c}`" for c, e in wanted])


def catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six catalog tables as views of the test tables."""
    names = ["projects", "files", "keywords", "person_role", "licenses", "relevance_scores"]
    return {n: view(spark, sf_dir, n) for n in names}
