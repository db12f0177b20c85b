"""Status and score changes as new table states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlake.operators.dedup import first_per_key
from harvestlake.operators.ids import with_dense_id


def latest_status(updates: DataFrame, key: str = "id", order: str = "updated_at") -> DataFrame:
    """Last status per file, of equally late ones the greatest in text order.

    The last row is picked before the exchange as well, so a file with very many updates
    reaches its task with one row per sender.
    """
    last = first_per_key(
        updates.select(key, order, "status"), [key], [F.desc_nulls_last(order), F.desc_nulls_last("status")]
    )
    return last.select(key, F.col("status").alias("new_status"))


def apply_status(
    files: DataFrame, updates: DataFrame, key: str = "id", order: str = "updated_at"
) -> DataFrame:
    """Files with their last status applied; updates of unknown files do nothing."""
    return files.join(latest_status(updates, key, order), key, "left").select(
        *[
            F.coalesce("new_status", "status").alias("status") if c == "status" else F.col(c)
            for c in files.columns
        ]
    )


def upsert_scores(
    current: DataFrame, new: DataFrame, order: str | None = None, number: bool = True, start: Column | None = None
) -> DataFrame:
    """Scores with ``new`` inserted or put in place of existing rows.

    If a project occurs more than once in ``new``, the highest ``order`` wins, then the
    highest score, then the greatest description. A replaced row gets a new id, after
    the highest one in use (or ``start``) and in ``order`` (a unique BIGINT).
    """
    incoming = first_per_key(new, ["project_id"], _latest_score(new, order))
    kept = current.join(incoming.select("project_id"), "project_id", "left_anti")
    if number:
        if start is None:
            start = F.coalesce(current.agg(F.max("id")).scalar(), F.lit(0))
        incoming = with_dense_id(incoming, order or "project_id", start=start)
    return kept.select(*current.columns).unionByName(incoming.select(*current.columns))


def _latest_score(new: DataFrame, order: str | None) -> list[Column]:
    by = [order] if order else []
    return [F.desc_nulls_last(c) for c in [*by, "relevance_score", "description"] if c in new.columns]


def update_scores(current: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """Scores of existing rows changed; description kept, unknown projects ignored.

    Of several scores for a project the highest ``order`` wins, then the highest score.
    """
    changed = first_per_key(new, ["project_id"], _latest_score(new, order)).select(
        "project_id", F.col("relevance_score").alias("_new")
    )
    return current.join(changed, "project_id", "left").select(
        *[
            F.coalesce("_new", "relevance_score").alias(c) if c == "relevance_score" else F.col(c)
            for c in current.columns
        ]
    )
