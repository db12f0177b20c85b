"""A log of changes by micro-batch that one Spark job folds into a snapshot.

Layout: ``<path>/log/batch=<n>/`` per micro-batch and ``<path>/snapshot/upto=<n>/``: the
row that counts of each key over all batches up to n. A reader takes the newest finished
snapshot and the batches after it, so what it reads depends on the number of keys and on
how often the log is folded, not on the number of batches since the beginning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from harvestlake.operators.dedup import first_per_key
from harvestlake.session import delete_folder, folder_names, no_rows


class FoldedLog:
    """Per key the first row in ``order`` counts; the order must not depend on arrival."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], order: list[Column]):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order = keys, order
        self.columns = [part.split()[0] for part in schema.split(", ")]

    def _batches(self) -> list[int]:
        return sorted(int(n) for n in folder_names(self.spark, f"{self.path}/log", "batch=", finished=True))

    def _snapshots(self) -> list[int]:
        found = folder_names(self.spark, f"{self.path}/snapshot", "upto=", finished=True)
        return sorted(int(n) for n in found)

    def append(self, batch: int, rows: DataFrame) -> None:
        """Store what counts of one micro-batch; a repeated batch replaces itself."""
        best = first_per_key(rows.select(*self.columns), self.keys, self.order)
        best.write.mode("overwrite").parquet(f"{self.path}/log/batch={batch}")

    def _rows(self, upto: int | None = None) -> DataFrame:
        """Snapshot and tail together; ``upto`` leaves out later batches."""
        snapshots = [n for n in self._snapshots() if upto is None or n <= upto]
        since = snapshots[-1] if snapshots else -1
        tail = [b for b in self._batches() if b > since and (upto is None or b <= upto)]
        frames = [f"{self.path}/snapshot/upto={since}"] if snapshots else []
        frames += [f"{self.path}/log/batch={b}" for b in tail]
        if not frames:
            return no_rows(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*frames)

    def read(self, upto: int | None = None) -> DataFrame:
        """One row per key, the one that counts, over all batches or those up to one.

        ``upto`` must not lie before the newest snapshot but one.
        """
        return first_per_key(self._rows(upto), self.keys, self.order)

    def fold(self, upto: int) -> None:
        """Write the snapshot up to a finished batch; later batches may be written meanwhile.

        What the snapshot before this one has replaced is deleted, so a reader that has
        begun on it keeps its files until the next fold.
        """
        snapshots = self._snapshots()
        if snapshots and snapshots[-1] >= upto:
            return
        self.read(upto).write.mode("overwrite").parquet(f"{self.path}/snapshot/upto={upto}")
        for old in snapshots[:-1]:
            delete_folder(self.spark, f"{self.path}/snapshot/upto={old}")
        for batch in self._batches():
            if snapshots and batch <= snapshots[-1]:
                delete_folder(self.spark, f"{self.path}/log/batch={batch}")
