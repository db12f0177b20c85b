"""Status ledger as a stream of download outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harvestlake.operators.ledger import apply_status
from harvestlake.streaming.log import FoldedLog

UPDATES = "id STRING, status STRING, updated_at BIGINT"
#: Micro-batches between two snapshots of the ledger.
FOLD_EVERY = 100


def status_log(spark: SparkSession, ledger_path: str) -> FoldedLog:
    order = [F.desc_nulls_last("updated_at"), F.desc_nulls_last("status")]
    return FoldedLog(spark, ledger_path, UPDATES, ["id"], order)


def record_outcomes(
    updates: DataFrame, ledger_path: str, checkpoint: str, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Append the last status per file and micro-batch to the ledger.

    The ledger holds only changes: a micro-batch costs its own size, not the size of the
    file table. Each batch replaces itself on a retry. Every ``fold_every`` batches the ledger
    is folded into a snapshot of the last status per file, up to the batch before, which
    can't be repeated any more.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        log = status_log(batch.sparkSession, ledger_path)
        log.append(batch_id, batch)
        if batch_id and batch_id % fold_every == 0:
            log.fold(batch_id - 1)

    return (
        updates.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The last status per file that has one: the published state of the ledger."""
    return status_log(spark, ledger_path).read()


def current_files(files: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    """File table with the ledger applied."""
    return apply_status(files, ledger, key)
