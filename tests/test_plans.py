"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from harvestlake.operators.extract import FORMATS, extract
from harvestlake.operators.ids import with_dense_id
from harvestlake.operators.records import score
from harvestlake.plans.collect import relevant_records
from harvestlake.session import stage
from workload import load_all
from workload.payloads import landing_pages, side_documents
from workload.registry import QUERIES

load_all()

# Queries that run jobs of their own while they are being built.
EAGER = (
    "a1_", "a2_stored", "a4_", "a5_", "a6_", "a8_gated", "a9_", "b9_", "collection_run", "m1_", "m2_stored", "m3_stored", "o1_", "o2_", "o3_",
    "g2_bucketed", "d8_bucketed", "n2_bucketed", "g10_query_table", "h4_incremental", "n4_listed",
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Physical plans with broadcasts by size switched off, as for large tables."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {
            name: plan_of(run(spark, sf_dir))
            for name, run in QUERIES.items()
            if not name.startswith(EAGER)
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("node", ["BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "Scan ExistingRDD[project"])
def test_never(plans, node):
    assert [name for name, plan in plans.items() if node in plan] == []


def test_broadcasts_are_constant_lookups_only(plans):
    """With size-based broadcasts off, only the fixed repository tables are broadcast."""
    allowed = {"c11_repository_lookup", "c11_unknown_repository", "c13_acquisition_method"}
    assert {n for n, p in plans.items() if "BroadcastHashJoin" in p} == allowed


def test_semi_and_anti_joins(plans):
    assert "LeftSemi" in plans["g3_projects_with_failed_files"]
    assert "LeftSemi" in plans["n2_plan_retry_failed"]
    assert "LeftSemi" not in plans["n2_plan_retry_failed_strict"]
    assert "LeftAnti" in plans["g8_missing_pages"]
    assert "LeftAnti" in plans["g9_files_not_present"]


def test_outer_join_becomes_inner_when_unscored_projects_drop_out(plans):
    assert "LeftOuter" in plans["g1_projects_by_relevance_all"]
    assert "LeftOuter" not in plans["g1_projects_by_relevance_min3"]


def test_listing_is_a_top_k(plans):
    assert "TakeOrderedAndProject" in plans["k7_first_pending"]


def test_only_needed_columns_are_read(plans):
    assert "ReadSchema: struct<l_suppkey:bigint,l_linestatus:string>" in plans["h2_files_by_status"]
    assert "l_extendedprice" not in plans["n2_plan_pending"]


def test_first_occurrence_is_limited_before_the_exchange(plans):
    plan = plans["i1_first_occurrence"]
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.fixture(scope="module")
def extraction(spark, sf_dir):
    """Staged pages and side documents, as tables whose scans show in plans."""
    return stage(landing_pages(spark, sf_dir)), stage(side_documents(spark, sf_dir))


@pytest.mark.parametrize("name", ["zenodo", "dryad", "cessda", "figshare"])
def test_payloads_are_parsed_once(extraction, name):
    pages, side = extraction
    fmt = FORMATS[name]
    plan = plan_of(score(extract(pages, fmt, side)).where("relevance_score >= 1"))
    kinds = 1 + (fmt.side_files is not None) + (fmt.side_detail is not None)
    # Spark writes a parser of a payload column as from_json(schema, ..., payload#id, ...)
    assert len(re.findall(r"from_json\(", plan)) == kinds
    assert "SortAggregate" not in plan


def test_filters_pass_the_score(extraction):
    pages, side = extraction
    found = relevant_records(pages, side, cut_off=False).where("page = 3 and query_idx = 1")
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", plan_of(found))
    assert sum("EqualTo(page,3)" in s for s in scans) == 4


def test_offsets_read_their_input_twice_only(spark):
    df = spark.range(0, 100_000, 1, 4).select((F.col("id") * 7919).alias("k"))
    numbered = with_dense_id(df, "k")
    assert numbered.agg(F.count_distinct("id"), F.max("id")).first() == (100_000, 100_000)
    numbered.collect()
    final = plan_of(numbered)
    executed = final.split("== Initial Plan ==")[0]
    assert executed.count("ReusedExchange") >= 2
