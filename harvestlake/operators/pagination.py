"""Which landed pages count, and which pages are still missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.operators.dedup import first_per_key
from harvestlake.operators.joins import join_to_one
from harvestlake.refdata import REPOSITORIES
from harvestlake.session import stage

SEQUENCE = ["repo", "query_idx", "query"]
PAGE = [*SEQUENCE, "page"]


def effective_pages(facts: DataFrame) -> DataFrame:
    """One landed copy per page: a successful one before a failed one, then the newest.

    A page that failed and was fetched again counts with its success. Copies of the same
    time are told apart by their contents, so the choice doesn't depend on the run.
    """
    order = [F.col("failed").asc()]
    order += [F.desc_nulls_last(c) for c in ("fetched_at", "payload_hash", "n_records", "total") if c in facts.columns]
    return first_per_key(facts, PAGE, order)


def effective_copies(landing: DataFrame, facts: DataFrame) -> DataFrame:
    """The landed pages less the copies that don't count.

    ``facts`` is the staged ``page_facts`` of ``landing``. Only pages landed more than
    once take part in the choice, a small table that Spark can broadcast by its size.
    """
    often = facts.groupBy(*PAGE).agg(F.count("*").alias("copies")).where("copies > 1")
    chosen = stage(
        effective_pages(facts.join(often.select(*PAGE), PAGE, "left_semi")).select(
            *PAGE, F.col("fetched_at").alias("_at"), F.col("payload_hash").alias("_hash")
        ),
        "copies",
    )
    if chosen.isEmpty():
        return landing
    marked = join_to_one(landing, chosen.withColumn("_often", F.lit(True)), PAGE)
    counts = F.col("fetched_at").eqNullSafe(F.col("_at")) & F.xxhash64("payload").eqNullSafe(F.col("_hash"))
    single = marked.where(F.col("_often").isNull())
    # Copies alike in time and contents are one.
    several = marked.where(F.col("_often") & counts)
    several = first_per_key(several, PAGE, [F.coalesce("failed", F.lit(False)).asc()])
    return single.unionByName(several).select(*landing.columns)


def stop_pages(facts: DataFrame) -> DataFrame:
    """Where each (repository, query) page sequence ends.

    ``hard_stop`` is the first page that failed or gave no records (itself left
    out); ``soft_stop`` the first page that reaches the reported total (itself
    kept). The requested page size counts, and a total of 0 means unknown. Of pages
    landed more than once, the effective copy counts. Two minima per sequence: they
    combine before the exchange, however long one sequence is.
    """
    facts = effective_pages(facts)
    ended = F.col("failed") | (F.col("n_records") == 0)
    reached = (F.col("total") != 0) & (
        F.col("page").cast("bigint") * F.col("page_size") >= F.col("total")
    )
    return facts.groupBy(*SEQUENCE).agg(
        F.min(F.when(ended, F.col("page"))).alias("hard_stop"),
        F.min(F.when(reached, F.col("page"))).alias("soft_stop"),
    )


def within_stops():
    """Condition that a page lies inside its sequence's stops."""
    return (F.col("hard_stop").isNull() | (F.col("page") < F.col("hard_stop"))) & (
        F.col("soft_stop").isNull() | (F.col("page") <= F.col("soft_stop"))
    )


def counted_pages(pages: DataFrame, stops: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Rows of ``pages`` that the sequential page loop would have reached.

    ``pages`` is any frame with the sequence columns and ``page``; ``stops`` comes
    from ``stop_pages``. The pages stay on the left, where adaptive execution can
    split a sequence with very many rows. Staged stops let Spark see their real size
    and choose between a broadcast and a shuffled join by its own threshold.
    """
    kept = (
        join_to_one(pages, stops, SEQUENCE)
        .where(within_stops())
        .drop("hard_stop", "soft_stop")
    )
    return kept.where(F.col("page") <= max_pages) if max_pages else kept


def expected_pages(
    queries: DataFrame,
    max_pages: int = 3,
    page_size: int = 25,
    with_token: bool = True,
    repositories: list[str] | None = None,
) -> DataFrame:
    """Every page request of a run: query, repository, page, effective size, offset.

    The repositories are a fixed list of four, so they are unrolled from an array
    in the query's own row; no join is needed.
    """
    wanted = [r for r in REPOSITORIES if repositories is None or r[1] in repositories]
    options = F.array(
        *[
            F.struct(
                F.lit(r[1]).alias("repo"),
                F.lit(r[8]).alias("repo_idx"),
                F.lit(r[7] if with_token else r[6]).cast("int").alias("page_cap"),
            )
            for r in wanted
        ]
    )
    return (
        queries.select("query_idx", "query", F.explode(options).alias("r"))
        .select(
            "r.repo",
            "r.repo_idx",
            "query_idx",
            "query",
            F.explode(F.sequence(F.lit(1), F.lit(max_pages))).alias("page"),
            F.least(F.lit(page_size), F.col("r.page_cap")).alias("size"),
        )
        .withColumn("offset", (F.col("page").cast("bigint") - 1) * page_size)
    )


def missing_pages(expected: DataFrame, facts: DataFrame, refetch_failed: bool = False) -> DataFrame:
    """Expected pages that are neither landed nor beyond the end of their sequence.

    ``refetch_failed`` also asks again for pages that were landed as failed and not
    fetched since.
    """
    facts = effective_pages(facts)
    landed = facts.where(~F.col("failed")) if refetch_failed else facts
    due = F.least(F.col("soft_stop"), F.col("hard_stop"))
    open_pages = (
        expected.join(stop_pages(facts), SEQUENCE, "left")
        .where(due.isNull() | (F.col("page") <= due))
        .drop("hard_stop", "soft_stop")
    )
    return open_pages.join(landed.select(*PAGE), PAGE, "left_anti")
