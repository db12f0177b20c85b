"""Exact deduplication by Grace hashing.

Records are dealt by a hash of their text to buckets, the spill files of the method:
first Spark's shuffle files, further down tables in the shared folder. Each bucket is
read into an open-addressing table that compares complete texts. When the table has
taken as many bytes as it may, texts it doesn't hold yet go to the spill table of the
next level, which deals them anew with another hash; texts it holds are still merged.
A text is therefore either wholly in one table or wholly in the spill, and the recursion
ends when a level spills nothing. Each table takes at least one text, so it does end.

The fan-out of every level follows from the bytes it deals: so many buckets that tables are
half full on average. The first level takes all texts that fit such tables, a second what
chance or a wrong guess about copies left over; more texts mean more buckets, not more levels.

Before the first shuffle every task merges the copies inside each of its chunks, so a
text that a third of all rows repeat reaches its bucket once per chunk, not per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestlake.llm.common import free_name, row_tie, scratch_path, small_batches, stop_if_missing, text_of
from harvestlake.operators.joins import join_to_one

#: Bytes of text that one open-addressing table takes before it spills.
TABLE_BYTES = 64 << 20
#: Bytes of text in one chunk that a task merges before the first shuffle.
CHUNK_BYTES = 16 << 20
#: Bytes of text in one Arrow batch handed back to Spark.
BATCH_BYTES = 4 << 20


class OpenTable:
    """Open addressing with linear probing; keys are whole texts, values entry numbers."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.texts: list[str] = []
        self.bytes = 0

    def find(self, hash_: int, text: str) -> int:
        """The entry of ``text``, or -1."""
        mask = len(self.slots) - 1
        at = hash_ & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hash_ and self.texts[entry] == text:
                return entry
            at = (at + 1) & mask
        return -1

    def add(self, hash_: int, text: str) -> int:
        """Enter a text that ``find`` has not found."""
        if 2 * (len(self.texts) + 1) > len(self.slots):
            self._grow()
        self._place(hash_, len(self.texts))
        self.hashes.append(hash_)
        self.texts.append(text)
        self.bytes += len(text) + 64
        return len(self.texts) - 1

    def _place(self, hash_: int, entry: int) -> None:
        mask = len(self.slots) - 1
        at = hash_ & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        self.slots[at] = entry

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        for entry, hash_ in enumerate(self.hashes):
            self._place(hash_, entry)


def _batches(rows: Iterator[tuple], schema: pa.Schema, text_at: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at] or "") + 128
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


# A record is (text, hash, rank, tie, copies, *carried); the greatest (rank, tie) stays.
_TEXT, _HASH, _RANK, _TIE, _COPIES = range(5)


def _order(record: tuple):
    rank = record[_RANK]
    return (rank is not None, rank if rank is not None else 0, record[_TIE])


def _better(kept: tuple, other: tuple) -> tuple:
    """The record that stays of two with the same text, with the copies of both."""
    copies = kept[_COPIES] + other[_COPIES]
    best = other if _order(other) > _order(kept) else kept
    return (*best[:_COPIES], copies, *best[_COPIES + 1 :])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _merge_chunks(schema: pa.Schema, chunk_bytes: int):
    """Merge equal texts inside chunks of a task's rows."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        seen, kept = OpenTable(), []
        for record in _records(batches):
            entry = seen.find(record[_HASH], record[_TEXT])
            if entry >= 0:
                kept[entry] = _better(kept[entry], record)
                continue
            seen.add(record[_HASH], record[_TEXT])
            kept.append(record)
            if seen.bytes >= chunk_bytes:
                yield from kept
                seen, kept = OpenTable(), []
        yield from kept

    return lambda batches: _batches(merged(batches), schema, _TEXT)


def _resolve(schema: pa.Schema, table_bytes: int, keep_text: bool):
    """One bucket: merged records leave at the end, what doesn't fit leaves as it came."""

    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        seen, kept = OpenTable(), []
        for record in _records(batches):
            entry = seen.find(record[_HASH], record[_TEXT])
            if entry >= 0:
                kept[entry] = _better(kept[entry], record)
            elif not kept or seen.bytes + len(record[_TEXT]) <= table_bytes:
                seen.add(record[_HASH], record[_TEXT])
                kept.append(record if keep_text else (None, *record[1:]))
            else:
                yield (*record, True)
        for record in kept:
            yield (*record, False)

    return lambda batches: _batches(resolved(batches), schema, _TEXT)


def distinct_texts(
    docs: DataFrame,
    text: str,
    rank: str,
    carry: list[str],
    copies: str = "copies",
    table_bytes: int = TABLE_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per distinct text: the ``carry`` columns of the row that stays, and its copies.

    Of equal texts the row with the greatest ``rank`` stays (null ranks least; equal ranks:
    the greatest hash over the carried columns). Null text counts as empty and equals it.
    ``carry`` may contain ``text``. Rows that are equal in everything count as copies. An
    empty frame gives an empty frame. Texts that differ in one byte differ. The result is
    read from tables in the shared folder, one per level, which stay there with the texts that
    spilled until whoever owns the folder removes them.
    """
    stop_if_missing(docs, text, rank, *carry)
    spark = docs.sparkSession
    small_batches(spark)
    names = [f"c{i}" for i in range(len(carry))]
    others = [c for c in carry if c != text]
    records = docs.select(
        text_of(text).alias("text"),
        F.xxhash64(text_of(text)).alias("hash"),
        F.col(f"`{rank}`").cast("bigint").alias("rank"),
        (row_tie(docs.select(*others)) if others else F.lit(0).cast("bigint")).alias("tie"),
        F.lit(1).cast("bigint").alias("copies"),
        *[
            # The text itself travels once; here only whether it was null.
            (F.col(f"`{c}`").isNull() if c == text else F.col(f"`{c}`")).alias(n)
            for c, n in zip(carry, names, strict=True)
        ],
    )
    merged = records.mapInArrow(
        _merge_chunks(_arrow(records.schema), chunk_bytes), records.schema
    )
    fields = [*records.schema.fields, T.StructField("spilled", T.BooleanType())]
    out_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])

    done, level, pending = [], 0, merged
    size = docs.agg(F.sum(F.octet_length(text_of(text)))).first()[0] or 0
    while True:
        # Each level deals by a hash of its own: the bits of the levels above are alike in a bucket.
        bucket = F.xxhash64(F.col("hash"), F.lit(level))
        resolve = _resolve(_arrow(out_schema), table_bytes, text in carry)
        path = scratch_path(spark, f"exact-dedup-{level}")
        _dealt(pending, bucket, size, table_bytes).mapInArrow(resolve, out_schema).write.parquet(path)
        written = spark.read.schema(out_schema).parquet(path)
        done.append(written.where(~F.col("spilled")))
        spilled = written.where("spilled")
        size = spilled.agg(F.sum(F.octet_length("text") + 64)).first()[0]
        if size is None:
            break
        pending, level = spilled.drop("spilled"), level + 1

    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select(
        *[
            (F.when(~F.col(n), F.col("text")) if c == text else F.col(n)).alias(c)
            for c, n in zip(carry, names, strict=True)
        ],
        F.col("copies").alias(copies),
    )


def _dealt(rows: DataFrame, bucket, size: int, table_bytes: int) -> DataFrame:
    """``rows`` dealt to buckets whose tables are half full on average."""
    buckets = -(-2 * size // table_bytes)
    if buckets <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(bucket)  # as many as there are anyway; small ones are merged
    return rows.repartition(buckets, bucket)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """What becomes of each row: ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    One row per row of ``docs``. Equal texts (null as empty) form a group; the row with the
    greatest id stays, null ids being least. A row that is repeated with the same id is kept
    each time, for its id is the one that stays. Equality is decided on complete texts by
    ``distinct_texts``; the SHA-256 only names the group, so that rows can be told what became
    of them by a narrow join, in which a group of any size can be split.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        text_of(text).alias("text"),
    ).withColumn("text_sha256", F.sha2("text", 256))
    groups = distinct_texts(rows, "text", "doc_id", ["doc_id", "text_sha256"], "group_size", **options)
    groups = groups.withColumnRenamed("doc_id", "keep_id")
    return join_to_one(rows.drop("text"), groups, ["text_sha256"], "inner").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one whole row of each group of equal texts, that with the greatest id.

    All columns stay as they are, whatever their names. Of rows with the same text and id
    one stays, also where they repeat each other wholly.
    """
    copies = free_name(docs.columns, "copies")
    kept = distinct_texts(docs, text, id_column, docs.columns, copies, **options)
    return kept.drop(copies)
