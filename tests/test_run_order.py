"""Page cut-off, planning of requests, first occurrences and dense ids."""

import random

import pytest
from pyspark.sql import functions as F

from harvestlake.operators import ids, pagination
from harvestlake.operators.dedup import dedup_records
from harvestlake.refdata import queries_table

FACTS = (
    "repo STRING, query_idx INT, query STRING, page INT, page_size INT, failed BOOLEAN, "
    "n_records INT, total BIGINT"
)


def facts(spark, *pages, repo="zenodo"):
    """Pages given as (records, total, failed)."""
    rows = [
        (repo, 0, "q", i + 1, 25, failed, n, total)
        for i, (n, total, failed) in enumerate(pages)
    ]
    return spark.createDataFrame(rows, FACTS)


@pytest.mark.parametrize(
    "pages, expected",
    [
        ([(3, 0, False), (0, 0, False), (5, 0, False)], [1]),
        ([(25, 50, False)] * 3, [1, 2]),
        ([(25, 0, True), (25, 0, False)], []),
        ([(25, 0, False)] * 2, [1, 2]),
        ([(25, 60, False), (25, 60, False), (10, 60, False), (25, 60, False)], [1, 2, 3]),
        ([(25, 60, False), (25, 60, True), (10, 60, False)], [1]),
    ],
)
def test_counted_pages(spark, pages, expected):
    frame = facts(spark, *pages)
    kept = pagination.counted_pages(frame, pagination.stop_pages(frame))
    assert sorted(r["page"] for r in kept.collect()) == expected


def test_counted_pages_within_limit(spark):
    frame = facts(spark, *[(25, 0, False)] * 5)
    assert pagination.counted_pages(frame, pagination.stop_pages(frame), max_pages=2).count() == 2


def copies(spark, *rows):
    """Copies of pages given as (page, fetched_at, records, total, failed)."""
    made = [("zenodo", 0, "q", p, 25, failed, n, total, at) for p, at, n, total, failed in rows]
    return spark.createDataFrame(made, FACTS + ", fetched_at INT")


def test_a_page_fetched_again_after_a_failure_counts(spark):
    landed = [(1, 1, 25, 100, False), (2, 2, 0, 0, True), (3, 3, 25, 100, False), (4, 4, 25, 100, False)]
    queries = queries_table(spark, ["q"])
    expected = pagination.expected_pages(queries, max_pages=4, repositories=["zenodo"])

    def state(rows):
        frame = copies(spark, *rows)
        kept = pagination.counted_pages(pagination.effective_pages(frame), pagination.stop_pages(frame))
        due = pagination.missing_pages(expected, frame, refetch_failed=True)
        return sorted(r["page"] for r in kept.collect()), sorted(r["page"] for r in due.collect())

    assert state(landed) == ([1], [2])
    assert state([*landed, (2, 9, 25, 100, False)]) == ([1, 2, 3, 4], [])
    # a failure after a success changes nothing, nor does another copy of the same page
    assert state([*landed, (2, 9, 25, 100, False), (2, 10, 0, 0, True), (1, 1, 25, 100, False)]) == ([1, 2, 3, 4], [])


def test_the_newest_success_is_the_effective_copy(spark):
    frame = copies(spark, (1, 1, 5, 0, False), (1, 3, 7, 0, False), (1, 9, 0, 0, True), (2, 4, 0, 0, True), (2, 4, 1, 0, True))
    got = pagination.effective_pages(frame).orderBy("page").collect()
    assert [(r["page"], r["fetched_at"], r["n_records"]) for r in got] == [(1, 3, 7), (2, 4, 1)]


def test_expected_pages(spark):
    plan = pagination.expected_pages(queries_table(spark), max_pages=3, page_size=250)
    assert plan.count() == 67 * 4 * 3
    sizes = {r["repo"]: r["size"] for r in plan.select("repo", "size").distinct().collect()}
    assert sizes == {"zenodo": 100, "dryad": 250, "cessda": 200, "figshare": 250}
    assert plan.agg(F.max("offset")).first()[0] == 500
    anonymous = pagination.expected_pages(queries_table(spark), page_size=50, with_token=False)
    assert anonymous.where("repo = 'zenodo'").agg(F.max("size")).first()[0] == 25


def test_missing_pages(spark):
    queries = queries_table(spark, ["q"])
    expected = pagination.expected_pages(queries, max_pages=4, repositories=["zenodo", "dryad"])
    landed = facts(spark, (25, 60, False), (25, 60, True)).where("page = 1")
    landed = landed.unionByName(facts(spark, (25, 25, False), repo="dryad"))

    def due(**options):
        rows = pagination.missing_pages(expected, landed, **options).collect()
        return sorted((r["repo"], r["page"]) for r in rows)

    assert due() == [("zenodo", 2), ("zenodo", 3), ("zenodo", 4)]
    landed = facts(spark, (25, 60, False), (25, 60, True))
    assert ("zenodo", 2) not in due() and ("zenodo", 2) in due(refetch_failed=True)


def test_first_occurrence_wins_and_is_idempotent(spark):
    rows = [
        ("zenodo", "1", 2, 0, 1, 0, "late query"),
        ("zenodo", "1", 0, 0, 2, 0, "later page"),
        ("zenodo", "1", 0, 0, 1, 9, "first"),
        ("zenodo", "1", 0, 1, 1, 0, "other client"),
        ("dryad", "1", 5, 1, 1, 0, "own source"),
    ]
    df = spark.createDataFrame(
        rows, "source STRING, record_id STRING, query_idx INT, repo_idx INT, page INT, pos INT, note STRING"
    ).withColumn("fetched_at", F.lit(None).cast("timestamp"))
    once = dedup_records(df)
    assert sorted(r["note"] for r in once.collect()) == ["first", "own source"]
    assert sorted(once.collect()) == sorted(dedup_records(once).collect())
    assert dedup_records(df, dedup=False).count() == 5


def test_run_offsets_of_any_place(spark):
    """Queries, repositories, pages and positions far beyond what one number could hold."""
    rng = random.Random(5)
    big = (1 << 31) - 1
    places = {tuple(rng.choice([rng.randrange(4), rng.randrange(big)]) for _ in range(4)) for _ in range(500)}
    rows = [(*p, rng.randrange(5)) for p in places]
    df = spark.createDataFrame(rows, "query_idx INT, repo_idx INT, page INT, pos INT, w INT").repartition(7)
    got = ids.with_run_offsets(df, {"id": F.lit(1), "before": F.col("w")})
    expected, total = [], 0
    for n, row in enumerate(sorted(rows)):
        expected.append((*row, n, total))
        total += row[-1]
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_a_record_without_a_place_is_an_error(spark):
    df = spark.createDataFrame([(0, 0, None, 0)], "query_idx INT, repo_idx INT, page INT, pos INT")
    with pytest.raises(Exception, match="no place in the run"):
        ids.with_run_offsets(df, {"id": F.lit(1)}).collect()


def test_dense_ids_over_scattered_keys(spark):
    """Keys from all over the 63-bit range, with clusters around radix borders."""
    rng = random.Random(9)
    keys = {rng.randrange(1 << 63) for _ in range(300)}
    keys |= {(1 << b) + d for b in (16, 17, 32, 33, 48, 49, 62) for d in (-2, -1, 0, 1)}
    keys |= set(range(40))
    weights = {k: rng.randrange(4) for k in keys}
    df = spark.createDataFrame(list(weights.items()), "k BIGINT, w INT").repartition(5)
    got = ids.with_offsets(ids.with_dense_id(df, "k"), "k", {"before": F.col("w")})
    expected, total = [], 0
    for n, k in enumerate(sorted(keys), 1):
        expected.append((n, k, weights[k], total))
        total += weights[k]
    assert [tuple(r) for r in got.orderBy("k").collect()] == expected
    shifted = ids.with_dense_id(df, "k", start=F.lit(1000))
    assert shifted.agg(F.min("id"), F.max("id")).first() == (1001, 1000 + len(keys))
