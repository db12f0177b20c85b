"""First hits across micro-batches: a streaming minimum over the place in the run.

The first occurrence of a record is the least (query, repository, page, position), whenever it
arrives. The stream keeps that minimum per (source, record id) as state, so state rows are
narrow, and hands on keys whose minimum has changed. With a watermark the minima are kept per
span of fetching time and forgotten once the watermark has passed the span; the log of
minima puts the spans together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harvestlake.operators.dedup import RUN_ORDER
from harvestlake.operators.joins import join_to_one
from harvestlake.streaming.log import FoldedLog

KEYS = ["source", "record_id"]
HITS = (
    "source STRING, record_id STRING, query_idx INT, repo_idx INT, page INT, pos INT, fetched_at TIMESTAMP"
)
#: Micro-batches between two snapshots of the minima.
FOLD_EVERY = 100


def hit_log(spark: SparkSession, path: str) -> FoldedLog:
    return FoldedLog(spark, path, HITS, KEYS, [F.col(c).asc() for c in RUN_ORDER])


def first_hits(records: DataFrame, watermark: str | None = None, span: str = "7 days") -> DataFrame:
    """Per key of a record stream the first place in the run so far, for update mode.

    With a ``watermark`` on ``fetched_at`` there is one row per key and ``span``, and records
    that come later than the watermark allows are left out.
    """
    place = F.min(F.struct(*RUN_ORDER)).alias("first")
    places = records.select(*KEYS, *RUN_ORDER)
    if watermark is None:
        return places.groupBy(*KEYS).agg(place)
    timed = places.withColumn("at", F.col("fetched_at")).withWatermark("at", watermark)
    return timed.groupBy(F.window("at", span), *KEYS).agg(place)


def keep_first_hits(
    records: DataFrame, path: str, checkpoint: str, watermark: str | None = None, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Store the changed minima of each micro-batch; a repeated one replaces itself."""

    def write(changed: DataFrame, batch_id: int) -> None:
        log = hit_log(changed.sparkSession, path)
        log.append(batch_id, changed.select(*KEYS, "first.*"))
        if batch_id and batch_id % fold_every == 0:
            log.fold(batch_id - 1)

    return (
        first_hits(records, watermark)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_first_hits(spark: SparkSession, path: str) -> DataFrame:
    """The first place in the run of every key seen, one row per key."""
    return hit_log(spark, path).read()


def first_records(records: DataFrame, hits: DataFrame) -> DataFrame:
    """The stored ``records`` that are first hits, whole rows; a hot key's rows can be split."""
    firsts = hits.select(*KEYS, F.struct(*RUN_ORDER).alias("_first"))
    marked = join_to_one(records, firsts, KEYS, "inner")
    return marked.where(F.struct(*RUN_ORDER).eqNullSafe(F.col("_first"))).select(*records.columns)
