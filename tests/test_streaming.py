"""Streams give what one batch over the same pages gives."""

import random

import pytest
from pyspark.sql import functions as F

from harvestlake.operators.dedup import dedup_records
from harvestlake.operators.extract import extract_all
from harvestlake.plans.collect import load_catalog, relevant_records
from harvestlake.refdata import REPOSITORIES, repositories, repository_names
from harvestlake.session import no_rows, stage
from harvestlake.sources.catalog import Catalog
from harvestlake.sources.landing import read_landing, write_landing
from harvestlake.streaming.first_hits import first_records, keep_first_hits, read_first_hits
from harvestlake.streaming.ingest import PageLedger, ingest, landing_stream, relevant_stream, unique_record_stream
from harvestlake.streaming.status import UPDATES, current_files, read_ledger, record_outcomes, status_log
from workload.payloads import landing_pages, side_documents


def natural(catalog):
    files = catalog.read("files")
    projects = catalog.read("projects")
    named = projects.join(files.withColumnRenamed("id", "file_id"), projects.id == files.project_id, "left")
    return sorted(
        tuple(r)
        for r in named.select(
            "download_repository_folder", "download_project_folder", "query_string",
            F.coalesce("file_name", F.lit("")),
        ).collect()
    )


def test_ingest_in_two_halves_equals_one_batch(spark, sf_dir, tmp_path):
    side = side_documents(spark, sf_dir)
    landing = str(tmp_path / "landing")
    stream, batch = (Catalog(spark, str(tmp_path / n)) for n in ("stream", "batch"))
    for half in ("page <= 4", "page > 4"):
        write_landing(landing_pages(spark, sf_dir).where(half), landing)
        ingest(spark, landing, stream.base, str(tmp_path / "cp"), side).awaitTermination()
    # A run without new pages adds nothing.
    before = stream.read("projects").count()
    ingest(spark, landing, stream.base, str(tmp_path / "cp"), side).awaitTermination()
    assert stream.read("projects").count() == before > 0

    load_catalog(batch, relevant_records(read_landing(spark, landing), side))
    assert natural(stream) == natural(batch)
    assert stream.read("files").select("id").distinct().count() == stream.read("files").count()


def test_unique_records_across_runs(spark, sf_dir, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for query in (0, 5000):
        pages = landing_pages(spark, sf_dir, "zenodo").withColumn(
            "query_idx", F.col("query_idx") + query
        )
        write_landing(pages, landing)
        (
            unique_record_stream(landing_stream(spark, landing))
            .select("source", "record_id")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    rows = spark.read.schema("source STRING, record_id STRING").parquet(out)
    expected = relevant_records(landing_pages(spark, sf_dir, "zenodo"), cut_off=False)
    assert sorted(rows.collect()) == sorted(expected.select("source", "record_id").collect())


def test_status_ledger(spark, tmp_path):
    incoming, book, cp = (str(tmp_path / n) for n in ("in", "ledger", "cp"))
    files = spark.createDataFrame([("a", "pending"), ("b", "pending")], "id STRING, status STRING")
    for rows in ([("a", "failed", 1), ("a", "success", 3)], [("a", "failed", 2), ("z", "failed", 9)]):
        spark.createDataFrame(rows, UPDATES).write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(UPDATES).parquet(incoming)
        record_outcomes(stream, book, cp).awaitTermination()
    now = current_files(files, read_ledger(spark, book))
    assert sorted(tuple(r) for r in now.collect()) == [("a", "success"), ("b", "pending")]


def planted(pages, rng):
    """Copies of pages in landing order: ends by total, failures, refetches, stale and equal copies."""
    day = F.expr("interval 1 day")
    few = pages.withColumn("page_size", F.lit(11))  # twice the real size: the total is reached half-way
    failed = few.withColumns({"failed": F.lit(True), "payload": F.lit(None).cast("string")})
    steps = [
        few.where("query_idx % 4 <> 1 or page <> 2"),
        failed.where("query_idx % 4 = 1 and page = 2"),
        few.where("query_idx % 8 = 1 and page = 2").withColumn("fetched_at", F.col("fetched_at") + day),
        failed.where("query_idx % 4 = 2 and page = 3").withColumn("fetched_at", F.col("fetched_at") + day),
        few.where("query_idx % 4 = 3 and page = 1").withColumns(
            {"payload": F.lit("{}"), "fetched_at": F.col("fetched_at") + day}),
        few.where("page = 4"),
    ]
    landed = []
    for step in steps:
        numbers = [r[0] for r in step.select("page").distinct().orderBy("page").collect()]
        rng.shuffle(numbers)
        landed += [step.where(F.col("page").isin(numbers[i::2])) for i in range(2)]
    return landed


def test_pages_in_any_order_give_the_batch_result(spark, sf_dir, tmp_path):
    """After micro-batches the catalog is what one run over the pages landed so far stores."""
    rng = random.Random(1)
    side = stage(side_documents(spark, sf_dir))
    small = planted(stage(landing_pages(spark, sf_dir).where("query_idx < 12")), rng)
    rng.shuffle(small)
    steps = [a.unionByName(b) for a, b in zip(small[::2], small[1::2], strict=True)]
    base = str(tmp_path / "catalog")
    landed, ids = None, {}
    for number, step in enumerate(steps):
        step = stage(step)
        PageLedger(spark, base, side, 1, fold_every=3).land(step, number)
        landed = step if landed is None else landed.unionByName(step)
        if number not in (2, len(steps) - 1):
            continue
        want = Catalog(spark, str(tmp_path / f"batch-{number}"))
        load_catalog(want, relevant_records(landed, side))
        got = Catalog(spark, base)
        assert natural(got) == natural(want), number
        for table, df in got.tables().items():
            n, distinct = df.agg(F.count("*"), F.count_distinct("id")).first()
            assert n == distinct == want.read(table).count(), table
    # A micro-batch that is delivered again changes nothing.
    before = natural(Catalog(spark, base))
    PageLedger(spark, base, side, 1, fold_every=3).land(steps[-1], len(steps) - 1)
    assert natural(Catalog(spark, base)) == before


def test_a_page_let_in_again_keeps_its_ids_and_others_their_files(spark, sf_dir, tmp_path):
    side = stage(side_documents(spark, sf_dir))
    pages = stage(landing_pages(spark, sf_dir, "zenodo"))
    ledger = PageLedger(spark, str(tmp_path / "catalog"), side, 1, fold_every=100)
    store = ledger.store
    ledger.land(pages.where("page > 3"), 0)
    ledger.land(pages.where("page < 3"), 1)
    first = {r["id"]: r["download_project_folder"] for r in store.read("projects").collect()}
    failed = pages.where("page = 3").withColumns({"failed": F.lit(True), "payload": F.lit(None).cast("string")})
    ledger.land(failed, 2)
    cut = store.read("projects")
    assert 0 < cut.count() < len(first) and {r["batch"] for r in store.rows("projects").collect()} == {"000000001"}
    untouched = {p.name for p in (tmp_path / "catalog" / "projects" / "batch=000000001").glob("part-*")}
    ledger.land(pages.where("page = 3").withColumn("fetched_at", F.col("fetched_at") + F.expr("interval 1 hour")), 3)
    again = {r["id"]: r["download_project_folder"] for r in store.read("projects").collect()}
    assert first.items() <= again.items(), "rows that come back have the ids they had"
    assert len(again) > len(first)
    assert {p.name for p in (tmp_path / "catalog" / "projects" / "batch=000000001").glob("part-*")} == untouched


def test_a_micro_batch_that_dies_is_repeated(spark, sf_dir, tmp_path, monkeypatch):
    side = stage(side_documents(spark, sf_dir))
    pages = stage(landing_pages(spark, sf_dir))
    failed = pages.where("page = 2").withColumns({"failed": F.lit(True), "payload": F.lit(None).cast("string")})
    later = pages.where("page = 2").withColumn("fetched_at", F.col("fetched_at") + F.expr("interval 1 hour"))
    ledger = PageLedger(spark, str(tmp_path / "catalog"), side, 1, fold_every=100)
    ledger.land(pages.where("page <> 2").unionByName(failed), 0)

    def dies(*_):
        raise OSError("the driver is gone")

    for method in ("_finish", "_apply"):
        monkeypatch.setattr(PageLedger, method, dies)
        with pytest.raises(OSError):
            ledger.land(later, 1)
        monkeypatch.undo()
    ledger.land(later, 1)
    want = Catalog(spark, str(tmp_path / "batch"))
    load_catalog(want, relevant_records(pages, side))
    assert natural(ledger.store) == natural(want)


def test_first_hits_after_shuffled_arrival(spark, sf_dir, tmp_path):
    """The place that counts and the rows at these places, over several runs of the stream."""
    pages = stage(landing_pages(spark, sf_dir).where("query_idx < 6"))
    copies = pages.withColumn("query_idx", F.col("query_idx") + 100)
    copies = copies.unionByName(pages.withColumn("query_idx", F.col("query_idx") + 50))
    side = stage(side_documents(spark, sf_dir))
    rng = random.Random(4)
    steps = [copies.where("page % 2 = 0"), pages.where("page % 3 = 0").unionByName(copies.where("page % 2 = 1")), pages.where("page % 3 <> 0")]
    rng.shuffle(steps)
    for watermark in (None, "1000 days"):
        base = tmp_path / str(watermark)
        landed = []
        for step in steps:
            write_landing(step, str(base / "landing"))
            landed.append(step)
            stream = relevant_stream(landing_stream(spark, str(base / "landing")), side)
            keep_first_hits(stream, str(base / "hits"), str(base / "cp"), watermark, fold_every=2).awaitTermination()
            if len(landed) == 1:
                continue
            everything = landed[0].unionByName(landed[1])
            everything = everything.unionByName(landed[2]) if len(landed) == 3 else everything
            records = stage(relevant_records(everything, side, cut_off=False))
            want = stage(dedup_records(records))
            place = ["source", "record_id", "query_idx", "repo_idx", "page", "pos"]
            hits = read_first_hits(spark, str(base / "hits"))
            assert sorted(hits.select(*place).collect()) == sorted(want.select(*place).collect())
        wide = [*place, "title", "query"]
        assert sorted(first_records(records, hits).select(*wide).collect()) == sorted(want.select(*wide).collect())


def test_a_folded_ledger_reads_the_same_files_however_many_batches(spark, tmp_path):
    """A thousand batches would leave as many folders as eighteen: those since the last snapshots."""
    rng = random.Random(7)
    log, last = status_log(spark, str(tmp_path / "ledger")), {}
    folders = []
    for batch in range(18):
        rows = [(f"f{rng.randrange(9)}", rng.choice(["failed", "success"]), batch * 3 + rng.randrange(6)) for _ in range(5)]
        for key, status, at in rows:
            last[key] = max(last.get(key, (-1, "")), (at, status))
        log.append(batch, spark.createDataFrame(rows, UPDATES))
        if batch and batch % 4 == 0:
            log.fold(batch - 1)
        if batch in (7, 17):
            assert {r["id"]: (r["updated_at"], r["status"]) for r in log.read().collect()} == last
        folders.append(len(list((tmp_path / "ledger").glob("*/*="))) + len(list((tmp_path / "ledger").glob("*/*=*"))))
    assert max(folders) <= 12 and folders[-1] <= max(folders[:10])
    assert {r["id"]: (r["updated_at"], r["status"]) for r in log.read(16).collect()}.keys() == last.keys()
    log.append(17, spark.createDataFrame(rows, UPDATES))
    assert {r["id"]: (r["updated_at"], r["status"]) for r in log.read().collect()} == last


def test_a_snapshot_that_dies_is_not_read(spark, tmp_path):
    log = status_log(spark, str(tmp_path / "ledger"))
    log.append(0, spark.createDataFrame([("a", "failed", 1)], UPDATES))
    half = tmp_path / "ledger" / "snapshot" / "upto=0"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"")
    assert [tuple(r) for r in log.read().collect()] == [("a", "failed", 1)]
    log.append(1, spark.createDataFrame([("a", "success", 2)], UPDATES))
    log.fold(1)
    assert [tuple(r) for r in log.read().collect()] == [("a", "success", 2)]


def test_a_micro_batch_is_read_once(spark, sf_dir, tmp_path):
    """A stream's micro-batch reads every column of every catalog whenever it is used."""
    side = stage(side_documents(spark, sf_dir))
    pages = stage(landing_pages(spark, sf_dir).where("query_idx < 4"))
    seen = spark.sparkContext.accumulator(0)

    def counted_rows(parts):
        for part in parts:
            seen.add(len(part))
            yield part

    base = str(tmp_path / "catalog")
    PageLedger(spark, base, side, 1, fold_every=3).land(pages.mapInPandas(counted_rows, pages.schema), 0)
    assert Catalog(spark, base).read("projects").count() > 0
    assert seen.value == pages.count()


def test_pages_are_made_of_one_scan(spark, sf_dir):
    plan = landing_pages(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan") == 1


def test_side_documents_of_few_hits_are_not_dealt_to_be_left_out(spark, sf_dir):
    """Hits of an increment get the documents that a whole run gives them."""
    pages = stage(landing_pages(spark, sf_dir).where("query_idx = 0 and page < 4"))
    side = stage(side_documents(spark, sf_dir))
    few, all_ = (extract_all(pages, side, few_hits=f) for f in (True, False))
    assert "LeftSemi" not in few._jdf.queryExecution().executedPlan().toString()
    assert few.count() > 0 and few.exceptAll(all_).isEmpty() and all_.exceptAll(few).isEmpty()


def test_small_tables_start_no_python_worker(spark):
    """Lookup tables and empty tables are part of many jobs of every micro-batch."""
    for table in (repositories(spark), repository_names(spark), no_rows(spark, "id BIGINT, batch STRING")):
        assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in repositories(spark).collect()) == sorted(REPOSITORIES)
    assert no_rows(spark, "id BIGINT, batch STRING").collect() == []
