"""A whole collection run: landed pages to catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.operators.dedup import dedup_records
from harvestlake.operators.extract import extract_all, page_facts
from harvestlake.operators.pagination import counted_pages, effective_copies, stop_pages
from harvestlake.operators.records import open_licensed, score
from harvestlake.operators.shred import catalog_parents, shred
from harvestlake.session import stage, staging
from harvestlake.sources.catalog import Catalog


def relevant_records(
    landing: DataFrame,
    side: DataFrame | None = None,
    min_score: int = 1,
    max_pages: int | None = None,
    cut_off: bool = True,
    few_hits: bool = False,
) -> DataFrame:
    """Scored, open-licensed, relevant records of all counted pages.

    The page cut-off is worked out first, by a job that reads only ids and totals,
    and staged: a row per (repository, query). Spark then knows its size and need not
    exchange the payloads for it while it is small. The same holds for the pages that
    were landed more than once, of which one copy counts. Duplicates across queries
    are still present.
    """
    pages = landing
    if cut_off:
        facts = stage(page_facts(landing), "facts")
        stops = stage(stop_pages(facts), "stops")
        pages = counted_pages(effective_copies(landing, facts), stops, max_pages)
    found = open_licensed(extract_all(pages, side, few_hits=few_hits))
    return score(found).where(F.col("relevance_score") >= min_score)


def collect(
    landing: DataFrame,
    side: DataFrame | None = None,
    min_score: int = 1,
    max_pages: int | None = None,
    dedup: bool = True,
) -> DataFrame:
    """What a run over several queries returns: relevant records, first hit each."""
    return dedup_records(relevant_records(landing, side, min_score, max_pages), dedup)


def load_catalog(
    catalog: Catalog,
    records: DataFrame,
    batch: str | None = None,
    dedup: bool = False,
    staged: bool = True,
    stored: bool = False,
) -> None:
    """Shred scored records into the six tables and append them.

    Like the collection loop, every hit is stored by default, so a record found by
    k queries gives k project rows; ``dedup=True`` stores first hits only. The
    relevant records are staged once in the shared folder before they are numbered,
    so payloads are parsed once, and the numbered parents once more, so each of the
    six writes reads only the columns it needs; both are deleted at the end. Records that
    the caller reads from a table (``stored``) are not staged once more. A batch
    that the catalog already holds is not loaded again.
    """
    kept = dedup_records(records, dedup)
    if batch and catalog.has(batch):
        return
    start = catalog.highest_ids()
    if not staged:
        catalog.append(shred(catalog_parents(kept, start)), batch)
        return
    with staging(catalog.spark) as put:
        numbered = catalog_parents(kept if stored else put(kept, "records"), start)
        catalog.append(shred(put(numbered, "parents")), batch)
