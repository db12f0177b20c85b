"""Incremental jobs: the landing folder and the status ledger as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestlake.session import scratch_path, stage
from harvestlake.sources.catalog import Catalog
from harvestlake.sources.landing import write_landing
from harvestlake.streaming.first_hits import keep_first_hits, read_first_hits
from harvestlake.streaming.ingest import ingest, landing_stream, relevant_stream, unique_record_stream
from harvestlake.streaming.status import UPDATES, current_files, read_ledger, record_outcomes
from workload.history import _last
from workload.payloads import landing_pages, side_documents
from workload.projections import cte, view
from workload.records import _RELEVANT
from workload.registry import query


@query(
    "o1_incremental_ingest",
    _RELEVANT + "select repo as download_repository_folder, record_id as download_project_folder, "
    "query as query_string, title from relevant_",
)
def incremental_ingest(spark, sf_dir):
    """Pages landed in two halves; the stream is run after each half."""
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "catalog")
    checkpoint = scratch_path(spark, "checkpoint")
    pages = landing_pages(spark, sf_dir)
    side = side_documents(spark, sf_dir)
    for half in ("page <= 5", "page > 5"):
        write_landing(pages.where(half), landing)
        ingest(spark, landing, base, checkpoint, side).awaitTermination()
    return Catalog(spark, base).read("projects").select(
        "download_repository_folder", "download_project_folder", "query_string", "title"
    )


_LAST_PAGE = "case when query_idx % 3 = 0 then 10 else 5 end"


@query(
    "o1_page_stops",
    _RELEVANT + "select repo as download_repository_folder, record_id as download_project_folder, "
    f"query as query_string, title from relevant_ where page <= {_LAST_PAGE} "
    "and not (query_idx % 4 = 2 and page >= 3)",
)
def streamed_page_stops(spark, sf_dir):
    """Pages land last first; some fail, of these some are fetched again in the last micro-batch.

    Twice the real page size is asked for, so the total is reached half-way.
    """
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "catalog")
    checkpoint = scratch_path(spark, "checkpoint")
    pages = landing_pages(spark, sf_dir).withColumn("page_size", F.lit(11))
    side = stage(side_documents(spark, sf_dir), "side")
    fails = "(query_idx % 4 = 2 and page = 3) or (query_idx % 4 = 1 and page = 2)"
    failed = F.expr(fails)
    first = pages.withColumns({"failed": failed, "payload": F.when(~failed, F.col("payload"))})
    again = pages.where("query_idx % 4 = 1 and page = 2").withColumn(
        "fetched_at", F.col("fetched_at") + F.expr("interval 1 hour")
    )
    for step in (first.where("page > 2"), first.where("page <= 2"), again):
        write_landing(step, landing)
        ingest(spark, landing, base, checkpoint, side).awaitTermination()
    return Catalog(spark, base).read("projects").select(
        "download_repository_folder", "download_project_folder", "query_string", "title"
    )


@query(
    "o2_streaming_first_hits",
    _RELEVANT + "select source, record_id, query_idx, repo_idx, page, pos from (select *, row_number() over "
    "(partition by source, record_id order by query_idx, repo_idx, page, pos) as n from relevant_) where n = 1",
)
def streaming_first_hits(spark, sf_dir):
    """Later hits of every record land before its first; the first of the run is kept."""
    landing, hits = scratch_path(spark, "landing"), scratch_path(spark, "hits")
    checkpoint = scratch_path(spark, "checkpoint")
    pages = stage(landing_pages(spark, sf_dir), "pages")
    side = stage(side_documents(spark, sf_dir), "side")
    for step in (pages.withColumn("query_idx", F.col("query_idx") + 5000), pages):
        write_landing(step, landing)
        records = relevant_stream(landing_stream(spark, landing), side)
        keep_first_hits(records, hits, checkpoint, watermark="10000 days").awaitTermination()
    return read_first_hits(spark, hits).drop("fetched_at")


@query(
    "o2_streaming_dedup",
    _RELEVANT + "select distinct source, record_id from relevant_",
)
def streaming_dedup(spark, sf_dir):
    """Every page is landed under two queries; each record key comes out once."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "unique")
    pages = landing_pages(spark, sf_dir)
    again = pages.withColumn("query_idx", F.col("query_idx") + 5000)
    write_landing(pages.unionByName(again), landing)
    side = stage(side_documents(spark, sf_dir), "side")
    records = unique_record_stream(landing_stream(spark, landing), side, watermark="1 day")
    (
        records.select("source", "record_id")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema("source STRING, record_id STRING").parquet(out)


@query(
    "o3_streaming_status_ledger",
    cte("files", "updates")
    + _last("updates")
    + "select f.id, coalesce(l.new_status, f.status) as status from files_ f left join last_ l "
    "on f.id = l.id",
)
def status_ledger(spark, sf_dir):
    """Status changes arrive in two steps; the ledger keeps the last per file."""
    incoming, ledger = scratch_path(spark, "updates"), scratch_path(spark, "ledger")
    checkpoint = scratch_path(spark, "checkpoint")
    updates = view(spark, sf_dir, "updates")
    for step in (1, 2):
        updates.where(F.col("updated_at") == step).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(UPDATES).parquet(incoming)
        record_outcomes(stream, ledger, checkpoint, fold_every=1).awaitTermination()
    return current_files(view(spark, sf_dir, "files", "id", "status"), read_ledger(spark, ledger))
