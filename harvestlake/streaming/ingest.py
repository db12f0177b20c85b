"""Incremental collection: a stream over the landing folder.

Pages may land in any order, fail, and be fetched again. What a page sequence counts up to is
known from all its pages landed so far, so a later page can take pages out (it is empty, failed,
or reaches the total) or let them in again (a failed page was fetched). Per micro-batch the
stream keeps two things: the narrow facts of its pages, in a log that is folded, and its
relevant records, parsed and numbered once. The catalog holds the records of the pages that
count now; a change rewrites the partitions of the batches that its pages landed in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from harvestlake.operators.extract import extract_all, page_facts
from harvestlake.operators.joins import join_to_one
from harvestlake.operators.pagination import PAGE, SEQUENCE, effective_copies, stop_pages, within_stops
from harvestlake.operators.records import open_licensed, score
from harvestlake.operators.shred import catalog_parents, shred
from harvestlake.plans.collect import relevant_records
from harvestlake.schemas import LANDING, TABLES
from harvestlake.session import staging
from harvestlake.sources.catalog import Catalog
from harvestlake.streaming.log import FoldedLog

FACTS = (
    "repo STRING, query_idx INT, query STRING, page INT, page_size INT, fetched_at TIMESTAMP, "
    "payload_hash BIGINT, failed BOOLEAN, n_records INT, total BIGINT, landed_in BIGINT"
)
#: Micro-batches between two snapshots of the page facts.
FOLD_EVERY = 100


def landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New landed pages as a stream."""
    reader = spark.readStream.schema(LANDING)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def page_log(spark: SparkSession, base: str) -> FoldedLog:
    """Of several landed copies of a page the one that ``effective_pages`` would choose; of equal
    copies the one that landed first, so that landing a page again changes nothing."""
    order = [F.col("failed").asc()]
    order += [F.desc_nulls_last(c) for c in ("fetched_at", "payload_hash", "n_records", "total")]
    return FoldedLog(spark, f"{base}/page_facts", FACTS, PAGE, [*order, F.col("landed_in").asc()])


def counted(facts: DataFrame) -> DataFrame:
    """The pages inside their sequence's stops and the batch of the copy that counts."""
    kept = join_to_one(facts, stop_pages(facts), SEQUENCE).where(within_stops() & ~F.col("failed"))
    return kept.select(*PAGE, "landed_in")


class PageLedger:
    """Applies micro-batches of pages to a catalog."""

    def __init__(self, spark: SparkSession, base: str, side: DataFrame | None, min_score: int, fold_every: int):
        self.spark, self.base = spark, base.rstrip("/")
        self.side, self.min_score, self.fold_every = side, min_score, fold_every
        self.store, self.log = Catalog(spark, base), page_log(spark, base)

    def _parents(self, batches: list[int]) -> DataFrame:
        """Numbered relevant records of whole batches, whether their pages count or not."""
        paths = [f"{self.base}/page_records/batch={b:09d}" for b in batches]
        frames = self.spark.read.schema(self.schema).option("basePath", f"{self.base}/page_records")
        return frames.parquet(*paths).withColumn("landed_in", F.col("batch").cast("bigint"))

    def land(self, pages: DataFrame, number: int) -> None:
        """Add a micro-batch; one that was finished before is left alone.

        What a stream hands over reads all its columns and catalogs at every use, so it is
        written once in a folder per catalog, from which each format reads its own pages.
        """
        name = f"{number:09d}"
        if self.store.has(name):
            return
        with staging(self.spark) as put:
            with staging(self.spark) as put_pages:
                pages = put_pages(pages, "pages", by="repo")
                facts = put(page_facts(pages).withColumn("landed_in", F.lit(number).cast("bigint")), "facts")
                self.log.append(number, facts)
                records = self._records(pages, facts, put)
            self._store_records(records, name)
            changed = self._changes(facts, number, put)
            older = [r["landed_in"] for r in changed.select("landed_in").distinct().collect() if r["landed_in"] != number]
            if older:
                self._apply(changed, sorted(older), put)
            self._finish(changed, number, name)
        if number and number % self.fold_every == 0:
            self.log.fold(number - 1)

    def _records(self, pages: DataFrame, facts: DataFrame, put) -> DataFrame:
        landed = effective_copies(pages, facts)
        return put(relevant_records(landed, self.side, self.min_score, cut_off=False, few_hits=True), "records")

    def _store_records(self, records: DataFrame, name: str) -> None:
        parents = catalog_parents(records, self.store.highest_ids())
        parents.write.mode("overwrite").parquet(f"{self.base}/page_records/batch={name}")
        self.schema = T.StructType([*parents.schema.fields, T.StructField("batch", T.StringType())])

    def _changes(self, facts: DataFrame, number: int, put) -> DataFrame:
        """Pages of the batch's sequences that count from now on, or no longer do (``gone``)."""
        touched = facts.select(*SEQUENCE).distinct()

        def at(upto: int) -> DataFrame:
            known = self.log.read(upto)
            return counted(known.join(touched, SEQUENCE, "left_semi"))

        before, after = put(at(number - 1), "before"), put(at(number), "after")
        key = [*PAGE, "landed_in"]
        gone = before.join(after, key, "left_anti").withColumn("gone", F.lit(True))
        return put(gone.unionByName(after.join(before, key, "left_anti").withColumn("gone", F.lit(False))), "changes")

    def _apply(self, changed: DataFrame, older: list[int], put) -> None:
        """Rewrite the partitions of earlier batches whose pages went or came back."""
        parents = join_to_one(self._parents(older), changed, [*PAGE, "landed_in"], "inner")
        parents = put(parents, "changed-parents")
        ids = put(parents.select(F.col("_projects").alias("project_id"), "batch"), "changed-ids")
        back = shred(parents.where(~F.col("gone")).drop("gone"))
        for table in TABLES:
            key = "id" if table == "projects" else "project_id"
            named = ids.withColumnRenamed("project_id", key)

            def change(rows: DataFrame, table=table, key=key, named=named) -> DataFrame:
                # Also what comes back goes first: a repeated micro-batch may have put it there.
                stay = rows.join(named.select(key), key, "left_anti")
                return stay.unionByName(join_to_one(back[table], named, [key], "inner"))

            self.store.rewrite(table, change, [f"{b:09d}" for b in older])

    def _finish(self, changed: DataFrame, number: int, name: str) -> None:
        parents = self._parents([number])
        # Ids of records that don't count now stay theirs.
        tops = parents.agg(*[
            F.max(F.col(f"_{t}") + (F.lit(0) if t in ("projects", "relevance_scores") else F.size(_ARRAYS[t]) - 1)).alias(t)
            for t in TABLES
        ]).first()
        own = changed.where(~F.col("gone") & (F.col("landed_in") == number)).select(*PAGE)
        visible = join_to_one(parents, own, PAGE, "inner")
        self.store.append(shred(visible), name, {t: tops[t] or 0 for t in TABLES})


_ARRAYS = {"files": "files", "keywords": "keywords", "person_role": "creators", "licenses": "licenses"}


def ingest(
    spark: SparkSession,
    landing_path: str,
    catalog_base: str,
    checkpoint: str,
    side: DataFrame | None = None,
    min_score: int = 1,
    max_files: int | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Bring the catalog up to all pages landed since the last call.

    Afterwards the catalog holds the records that one batch run over all landed pages, with its
    page cut-off, would store; ids of rows that stay don't change, and those of rows that go
    are not used again. The checkpoint remembers which files were read; a repeated micro-batch
    adds nothing twice. A micro-batch costs its own pages, the narrow facts of its sequences, and
    the partitions whose pages changed, in most cases none but its own.
    """

    def load(pages: DataFrame, batch_id: int) -> None:
        PageLedger(pages.sparkSession, catalog_base, side, min_score, fold_every).land(pages, batch_id)

    return (
        landing_stream(spark, landing_path, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def unique_record_stream(
    pages: DataFrame,
    side: DataFrame | None = None,
    min_score: int = 1,
    watermark: str | None = None,
) -> DataFrame:
    """Relevant records of a page stream, one per (source, record id).

    ``side`` is the table of file lists and details that has landed when the stream
    starts. Without a watermark the keys seen are kept for ever. With one, a key is forgotten
    once the watermark on ``fetched_at`` has passed it, which bounds the state. Which
    of the copies survives depends on their arrival; ``first_hits`` keeps the first of the run.
    """
    records = relevant_stream(pages, side, min_score)
    keys = ["source", "record_id"]
    if watermark:
        return records.withWatermark("fetched_at", watermark).dropDuplicatesWithinWatermark(keys)
    return records.dropDuplicates(keys)


def relevant_stream(pages: DataFrame, side: DataFrame | None = None, min_score: int = 1) -> DataFrame:
    """Scored, open-licensed, relevant records of a page stream."""
    return score(open_licensed(extract_all(pages, side))).where(F.col("relevance_score") >= min_score)
