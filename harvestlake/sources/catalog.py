"""The six catalog tables as Parquet partitioned by the batch that stored a row.

Layout: ``<base>/<table>/batch=<name>/`` for rows and ``<base>/batches/batch=<name>/`` for
one row per finished batch, with the highest id of each table. That row is written last, and
readers take the rows of finished batches only: a write that dies half-way is not seen, and
its repetition overwrites what it left. Changes rewrite the partitions they touch, by
Spark's dynamic partition overwrite, and leave the files of all others as they are.

One writer at a time: ids continue after the highest that finished batches have used.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from harvestlake.operators import ledger
from harvestlake.operators.integrity import with_broken_rules, with_repeated_scores
from harvestlake.operators.shred import table_columns, with_defaults
from harvestlake.schemas import NOT_NULL, TABLES
from harvestlake.session import delete_folder, folder_names, no_rows, staging

#: Ends the name of the partition with the rows that a batch's checks have turned down.
_REJECTED = ".rejected"
#: Folder of the report's partial counts, see ``sources.rollup``.
REPORT = "report"
_HIGHEST = ", ".join(f"{t} BIGINT" for t in TABLES)


class Catalog:
    """Reads and writes the catalog below one base folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _stored(self, name: str, schema: str) -> DataFrame:
        """All rows below a folder with their batch; none if the folder is missing."""
        path, schema = f"{self.base}/{name}", f"{schema}, batch STRING"
        if not folder_names(self.spark, path):
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(path)

    # ---- reading --------------------------------------------------------------

    def batches(self) -> DataFrame:
        """``batch`` and the highest id per table of every finished batch."""
        return self._stored("batches", _HIGHEST)

    def has(self, batch: str) -> bool:
        return batch in folder_names(self.spark, f"{self.base}/batches", "batch=")

    def rows(self, table: str) -> DataFrame:
        """The table's current rows and the batch that holds each."""
        stored = self._stored(table, TABLES[table])
        # A row per batch: small, so Spark broadcasts it and prunes unfinished partitions.
        return stored.join(self.batches().select("batch"), "batch", "left_semi").select(
            *table_columns(table), "batch"
        )

    def read(self, table: str) -> DataFrame:
        return self.rows(table).drop("batch")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in TABLES}

    def highest_ids(self) -> dict[str, Column]:
        """Highest id used per table: an aggregate of one row per batch; no table is read."""
        row = self.batches().agg(*[F.max(t).alias(t) for t in TABLES]).first()
        return {t: F.lit(row[t] or 0).cast("bigint") for t in TABLES}

    # ---- writing --------------------------------------------------------------

    def _write(self, df: DataFrame, table: str, batch: str) -> int:
        """Put a batch's rows in place of what its partition holds; their highest id."""
        seen = Observation()
        rows = with_defaults(df, table).observe(seen, F.max("id").alias("top"))
        rows.write.mode("overwrite").parquet(f"{self.base}/{table}/batch={batch}")
        return seen.get["top"] or 0

    def _finish(self, batch: str, highest: dict[str, int]) -> None:
        row = self.spark.range(1).select(*[F.lit(highest.get(t, 0)).cast("bigint").alias(t) for t in TABLES])
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/batches/batch={batch}")

    def append(self, tables: dict[str, DataFrame], batch: str | None = None, highest: dict[str, int] | None = None) -> None:
        """Add one batch; it counts when all its tables are written.

        A finished batch is not added again; an unfinished one is written over. ``highest``
        are ids that are taken besides those of the rows.
        """
        batch = batch or uuid.uuid4().hex
        if self.has(batch):
            return
        tops = {name: self._write(df, name, batch) for name, df in tables.items()}
        self._finish(batch, {t: max(tops.get(t, 0), (highest or {}).get(t, 0)) for t in TABLES})

    def append_checked(self, tables: dict[str, DataFrame], batch: str) -> dict[str, dict[str, int]]:
        """Add a batch whose rows keep the declared rules; the others are set apart.

        A row that breaks a rule goes to a partition of its own in the pass that writes the
        table; it isn't read with the table, but by ``rejected``. Projects are checked first: a
        child of a project that was turned down or never stored breaks its foreign key.
        Returns per table how many rows were stored and how many broke each rule, counted
        in the same pass. A finished batch is not added again and gives no counts.
        """
        counts: dict[str, dict[str, int]] = {}
        if self.has(batch):
            return counts
        tops = {}
        for table in sorted(tables, key=lambda t: t != "projects"):
            rows = with_defaults(tables[table], table)
            known = None
            if table != "projects":
                known = self.read("projects").select("id")
                if "projects" in tables:
                    path = f"{self.base}/projects/batch={batch}"
                    if folder_names(self.spark, path):
                        known = known.unionByName(self.spark.read.schema(TABLES["projects"]).parquet(path).select("id"))
            checked = with_broken_rules(rows, table, known)
            if table == "relevance_scores":
                checked = with_repeated_scores(checked, self.read(table))
            tops[table], counts[table] = self._write_checked(checked, table, batch)
        self._finish(batch, tops)
        return counts

    def _write_checked(self, checked: DataFrame, table: str, batch: str) -> tuple[int, dict[str, int]]:
        for name in (batch, batch + _REJECTED):  # what an unfinished write of the batch has left
            delete_folder(self.spark, f"{self.base}/{table}/batch={name}")
        passes = F.size("broken") == 0
        rules = [f"not null: {c}" for c in NOT_NULL[table]]
        rules += ["check: download_method"] if table == "projects" else ["foreign key: project_id", "unique: project_id"]
        seen = Observation()
        told = checked.observe(
            seen, F.max(F.when(passes, F.col("id"))).alias("top"), F.count_if(passes).alias("stored"),
            *[F.count_if(F.array_contains("broken", rule)).alias(f"r{i}") for i, rule in enumerate(rules)],
        )
        to = F.when(passes, F.lit(batch)).otherwise(F.lit(batch + _REJECTED))
        (
            told.withColumn("batch", to)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(f"{self.base}/{table}")
        )
        found = seen.get
        broken = {rule: found[f"r{i}"] for i, rule in enumerate(rules) if found[f"r{i}"]}
        return found["top"] or 0, {"stored": found["stored"], **broken}

    def rejected(self, table: str) -> DataFrame:
        """Rows that the checks of finished batches have turned down, with the rules they broke."""
        stored = self._stored(table, f"{TABLES[table]}, broken ARRAY<STRING>")
        mine = stored.where(F.col("batch").endswith(_REJECTED)).withColumn(
            "batch", F.expr(f"left(batch, length(batch) - {len(_REJECTED)})")
        )
        return mine.join(self.batches().select("batch"), "batch", "left_semi").select(*table_columns(table), "broken", "batch")

    def rewrite(
        self,
        table: str,
        change: Callable[[DataFrame], DataFrame],
        batches: list[str] | None = None,
        settle: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Put ``change(rows)`` in place of the rows of some batches (default: of all).

        ``change`` gets the table's columns and ``batch`` and must keep ``batch``. What it gives is
        dealt in ranges of (batch, project, id) once, written and only then put in place of what it was
        read from. ``settle`` is for changes that need the rows of one id side by side: it gets the dealt
        rows, sorted by these keys, with all columns of ``change``. Partitions of other batches keep their files.
        Each partition is replaced as a whole; repeating a rewrite that died completes it, if the change of
        changed rows is no other.
        """
        if batches is not None and not batches:
            return
        rows = self.rows(table)
        if batches is not None:
            rows = rows.where(F.col("batch").isin(batches))
        old = batches if batches is not None else [r["batch"] for r in self.batches().select("batch").collect()]
        paths = {batch: f"{self.base}/{table}/batch={batch}" for batch in old}
        files = {batch: set(folder_names(self.spark, path, "part-")) for batch, path in paths.items()}
        new = change(rows)
        for batch in old:  # they count what is about to change
            delete_folder(self.spark, f"{self.base}/{REPORT}/table_name={table}/batch={batch}")
        self._overwrite(table, new, settle)
        # A dynamic overwrite doesn't touch partitions that have no rows any more.
        for batch, path in paths.items():
            if files[batch] & set(folder_names(self.spark, path, "part-")):
                delete_folder(self.spark, path)

    def _overwrite(self, table: str, rows: DataFrame, settle: Callable[[DataFrame], DataFrame] | None = None) -> None:
        keys = ["batch", "repository_id" if table == "projects" else "project_id", "id"]
        # Ranges, so that a batch or project with very many rows is split.
        ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        (
            (settle(ranged) if settle else ranged)
            .select(*table_columns(table), "batch")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(f"{self.base}/{table}")
        )

    def compact(self, table: str, batches: list[str] | None = None) -> None:
        """Rewrite partitions in ranges of (project, id), or of (repository, id) for projects.

        Many small files of a batch become few, and lookups by key skip files and row groups.
        """
        self.rewrite(table, lambda rows: rows, batches)

    def _holding(self, table: str, key: str, keys: DataFrame) -> list[str]:
        """The batches that hold rows with one of the keys; only names come back."""
        held = self.rows(table).select(key, "batch").join(keys.select(key).distinct(), key, "left_semi")
        return sorted(r["batch"] for r in held.select("batch").distinct().collect())

    def apply_status(self, updates: DataFrame, order: str = "updated_at") -> None:
        """Store the last status per file; only partitions that hold changed files are rewritten.

        Only ids meet the changes in a join; a change then travels with the rows of its batch and
        project, so that whole rows are dealt once, for the files written.
        """
        keys = ["batch", "project_id", "id"]
        last = ledger.latest_status(updates, order=order)
        with staging(self.spark) as put:
            changes = put(self.rows("files").select(*keys).join(last, "id").select(*keys, "new_status"), "changes")
            touched = sorted(r["batch"] for r in changes.select("batch").distinct().collect())

            def change(rows: DataFrame) -> DataFrame:
                stored = rows.withColumn("stored", F.lit(True))
                return stored.unionByName(changes.withColumn("stored", F.lit(False)), allowMissingColumns=True)

            def settle(dealt: DataFrame) -> DataFrame:
                new = F.max("new_status").over(Window.partitionBy(*keys))
                return dealt.withColumn("status", F.coalesce(new, "status")).where("stored")

            self.rewrite("files", change, touched, settle)

    def upsert_scores(self, new: DataFrame, batch: str, order: str | None = None) -> None:
        """Insert scores or put them in place of the project's; ids as ``ledger.upsert_scores``.

        The new rows are a batch of their own; partitions that hold a replaced row are
        rewritten without it. A finished batch is not stored again; repeating an unfinished
        one gives the same rows.
        """
        if self.has(batch):
            return
        none = self.spark.createDataFrame([], TABLES["relevance_scores"])
        start = self.highest_ids()["relevance_scores"]
        incoming = ledger.upsert_scores(none, new, order, start=start)
        top = self._write(incoming, "relevance_scores", batch)
        self.rewrite(
            "relevance_scores",
            lambda rows: rows.join(new.select("project_id").distinct(), "project_id", "left_anti"),
            self._holding("relevance_scores", "project_id", new),
        )
        self._finish(batch, {"relevance_scores": top})

    def reset(self) -> None:
        """Empty all six tables; ids restart, and batches may be loaded again.

        The list of finished batches goes first, so no table is seen half empty.
        """
        for name in ("batches", REPORT, *TABLES):
            delete_folder(self.spark, f"{self.base}/{name}")

    # ---- SQL ------------------------------------------------------------------

    def sql(self, query: str, args: list | dict | None = None) -> DataFrame:
        return catalog_sql(self.spark, self.tables(), query, args)


def catalog_sql(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    query: str,
    args: list | dict | None = None,
) -> DataFrame:
    """Run SQL with ``?`` or named parameters over the given tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=args)
