"""Surrogate ids without a global sort or a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestlake.session import stage

# The pages of a collection run, in order.
RUN_PAGE = ["query_idx", "repo_idx", "page"]
# Rows below one offset bucket: 2**16 at most, as keys are unique.
RADIX_BITS = 16


def _before(name: str, window) -> Column:
    frame = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(name).over(frame), F.lit(0).cast("bigint"))


def with_offsets(df: DataFrame, key: str, weights: dict[str, Column]) -> DataFrame:
    """Add, per weight, its sum over all rows with a smaller ``key``.

    ``key`` is a unique non-negative BIGINT. Sums are taken per 2**16 keys, then per
    2**32, then per 2**48. Every running window therefore covers at most 65,536 rows,
    whatever the distribution of the keys, and no window ranges over the whole table.
    """
    names = list(weights)
    weighted = df.select(
        "*",
        # Never NULL, so that no join adds a null test of its own and the three uses
        # of the first-level sums share one exchange.
        F.coalesce(F.shiftright(key, RADIX_BITS), F.lit(0)).alias("_p1"),
        *[w.cast("bigint").alias(f"_w_{n}") for n, w in weights.items()],
    )

    def totals(frame: DataFrame, prefix: str) -> DataFrame:
        return frame.groupBy(prefix).agg(*[F.sum(f"_w_{n}").alias(f"_w_{n}") for n in names])

    level1 = totals(weighted, "_p1").withColumn("_p2", F.shiftright("_p1", RADIX_BITS))
    level2 = totals(level1, "_p2").withColumn("_p3", F.shiftright("_p2", RADIX_BITS))
    level3 = totals(level2, "_p3")

    # At most 2**15 rows in all: the keys have 63 bits.
    window3 = Window.partitionBy(F.lit(0)).orderBy("_p3")
    offsets3 = level3.select("_p3", *[_before(f"_w_{n}", window3).alias(f"_o_{n}") for n in names])

    def below(frame: DataFrame, offsets: DataFrame, parent: str, own: str) -> DataFrame:
        window = Window.partitionBy(parent).orderBy(own)
        return frame.join(offsets, parent).select(
            own, *[(F.col(f"_o_{n}") + _before(f"_w_{n}", window)).alias(f"_o_{n}") for n in names]
        )

    offsets2 = below(level2, offsets3, "_p3", "_p2")
    offsets1 = below(level1, offsets2, "_p2", "_p1")
    rows = weighted.join(offsets1, "_p1")
    window = Window.partitionBy("_p1").orderBy(key)
    return rows.select(
        *df.columns, *[(F.col(f"_o_{n}") + _before(f"_w_{n}", window)).alias(n) for n in names]
    )


def with_run_offsets(df: DataFrame, weights: dict[str, Column]) -> DataFrame:
    """Add, per weight, its sum over all records that come earlier in the collection run.

    The run's order is query, repository, page, position; the values may be of any size.
    Pages are summed up first and sorted in ranges, narrow rows that are written once, so
    that the ranges read are those that were made; the ends of the ranges, one row each,
    are put together by one window. The records themselves are dealt once, by page, and
    running sums inside a page cover what one response held. A record without a place in
    the run is an error.
    """
    names = list(weights)

    def placed(name: str) -> Column:
        lost = F.raise_error(F.lit(f"a record without {name} has no place in the run"))
        return F.coalesce(F.col(name), lost.cast("int"))

    keyed = df.withColumns({c: placed(c) for c in [*RUN_PAGE, "pos"]})
    weighted = keyed.select("*", *[w.cast("bigint").alias(f"_w_{n}") for n, w in weights.items()])
    sums = [F.sum(f"_w_{n}").alias(f"_w_{n}") for n in names]
    ranged = stage(
        weighted.groupBy(*RUN_PAGE)
        .agg(*sums)
        .repartitionByRange(*RUN_PAGE)
        .sortWithinPartitions(*RUN_PAGE)
        .withColumn("_part", F.spark_partition_id()),
        "page-order",
    )
    whole = Window.partitionBy(F.lit(0)).orderBy("_part")
    parts = ranged.groupBy("_part").agg(*sums)
    parts = parts.select("_part", *[_before(f"_w_{n}", whole).alias(f"_p_{n}") for n in names])
    inside = Window.partitionBy("_part").orderBy(*RUN_PAGE)
    pages = ranged.join(parts, "_part").select(
        *RUN_PAGE, *[(F.col(f"_p_{n}") + _before(f"_w_{n}", inside)).alias(f"_o_{n}") for n in names]
    )
    rows = weighted.join(pages, RUN_PAGE)
    page = Window.partitionBy(*RUN_PAGE).orderBy("pos")
    return rows.select(
        *df.columns, *[(F.col(f"_o_{n}") + _before(f"_w_{n}", page)).alias(n) for n in names]
    )


def with_dense_id(
    df: DataFrame, key: str, name: str = "id", start: Column | None = None
) -> DataFrame:
    """Dense ids 1, 2, 3 ... in ``key`` order, continuing after ``start``."""
    base = F.lit(0) if start is None else start
    numbered = with_offsets(df, key, {"_offset": F.lit(1)})
    return numbered.select(
        (F.col("_offset") + base + 1).cast("bigint").alias(name),
        *[c for c in df.columns if c != name],
    )
