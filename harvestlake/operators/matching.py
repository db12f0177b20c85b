"""Which search queries match which records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestlake.operators.grams import PLACE_SHIFT, PLACES, query_batches, text_batches
from harvestlake.operators.joins import ROW_BITS, join_to_one
from harvestlake.refdata import query_terms
from harvestlake.session import stage

#: n-grams of queries for each of which the bitmap has sixteen bits, so that it takes 8 MB at most.
MAX_SENT = (1 << 22) - 1


def match_queries(records: DataFrame, queries: list[str], *text_columns: str) -> DataFrame:
    """One row per (record, matching query): ``query_idx`` and ``query`` are added.

    A query matches when every one of its terms occurs in the joined text columns,
    ignoring case. The query list is configuration of fixed length, so it is
    compiled into one expression over the row: a linear scan of the texts without
    any join or exchange, and only matches are emitted.
    """
    haystack = F.lower(F.concat_ws("\n", *text_columns))
    found = []
    for index, query in enumerate(queries):
        terms = [F.contains(F.col("_text"), F.lit(t.lower())) for t in query_terms(query)]
        if terms:
            hit = F.struct(F.lit(index).alias("query_idx"), F.lit(query).alias("query"))
            found.append(F.when(reduce(lambda a, b: a & b, terms), hit))
    return (
        records.withColumn("_text", haystack)
        .withColumn("_found", F.array(*found))
        # Outer, as Spark would test the size of an inner one below, searching again.
        .withColumn("_hit", F.explode_outer(F.array_compact("_found")))
        .where(F.col("_hit").isNotNull())
        .select(*records.columns, "_hit.query_idx", "_hit.query")
    )


def terms_of(query: Column) -> Column:
    """``refdata.query_terms`` of a column, in lower case and each once."""
    parts = F.transform(
        F.split(query, '"'),
        lambda part, i: F.when(i % 2 == 1, F.array(part)).otherwise(F.split(part, r"(?U)\s+")),
    )
    return F.array_distinct(F.transform(F.filter(F.flatten(parts), lambda t: t != ""), F.lower))


def query_index(records: DataFrame, queries: DataFrame, text: Column) -> DataFrame:
    """Each query with its terms and the one n-gram it is filed under.

    That is the n-gram of its terms that occurs in the fewest texts, as a text without it can't
    match; where there is one only, no text is read. Which n-gram it is changes what moves, not
    the matches. ``near`` must stand where the n-gram does; ``open`` are the terms that this leaves
    to be looked for.
    """
    terms = queries.select(*queries.columns, terms_of(F.col("query")).alias("terms")).where(F.size("terms") > 0)
    # Queries may be made of whole texts: that is done once.
    terms = stage(terms, "queries")
    kind = terms.schema["query_idx"].dataType.simpleString()
    filed = stage(
        terms.select("query_idx", "terms").mapInArrow(
            query_batches, f"query_idx {kind}, kind INT, gram BIGINT, core BIGINT, near BINARY, open ARRAY<INT>, alone BOOLEAN"
        ),
        "query_grams",
    )
    chosen, several = filed.where("alone"), filed.where("not alone")
    if not several.isEmpty():
        chosen = chosen.drop("alone").unionByName(_rarest(several, records, text))
    places = F.transform("open", lambda i: F.get("terms", i)).alias("open")
    return terms.join(chosen, "query_idx").select(*queries.columns, "terms", "gram", "core", "kind", "near", places)


def _rarest(filed: DataFrame, records: DataFrame, text: Column) -> DataFrame:
    """Of several n-grams of a query the one that the fewest texts have; none if one of them is in no text."""
    found = text_grams(records, text, gram_kinds(filed), sent=gram_bitmap(filed))
    # One row per n-gram and task leaves for the exchange, however many texts hold it.
    counts = found.groupBy("gram").agg(F.count("*").alias("n_texts"))
    best = F.min(F.struct("n_texts", "gram", "kind", "core", "near", "open")).alias("best")
    missing = F.max(F.col("n_texts").isNull()).alias("missing")
    chosen = filed.join(counts, "gram", "left").groupBy("query_idx").agg(best, missing)
    # A query with an n-gram that no text has matches nothing.
    return chosen.where("not missing").select("query_idx", "best.kind", "best.gram", "best.core", "best.near", "best.open")


def gram_kinds(filed: DataFrame) -> list[int]:
    return sorted(r["kind"] for r in filed.select("kind").distinct().collect())


def gram_bitmap(filed: DataFrame) -> bytes:
    """A bitmap of n-grams and their cores, each with ``PLACES`` bits set: about one in two hundred others passes it.

    It is made in rows of ``ROW_BITS`` bits and at most 8 MB, however many n-grams there are; of over two million more pass.
    """
    bits = max(ROW_BITS, 1 << (16 * min(2 * filed.count(), MAX_SENT)).bit_length())
    places = [
        F.shiftrightunsigned(number, PLACE_SHIFT * i).bitwiseAND(F.lit(bits - 1).cast("bigint"))
        for number in ("gram", "core")
        for i in range(PLACES)
    ]
    place = filed.select(F.explode(F.array_distinct(F.array(*places))).alias("_place"))
    block, bit = (F.col("_place") / ROW_BITS).cast("int"), F.col("_place") % ROW_BITS
    # Dealt before they are put together: else each task would send bitmaps.
    dealt = place.select(block.alias("_block"), bit.alias("_bit")).repartition("_block")
    rows = dealt.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bitmap")).collect()
    bitmap = bytearray(bits // 8)
    for row in rows:
        at = row["_block"] * ROW_BITS // 8
        bitmap[at : at + ROW_BITS // 8] = row["_bitmap"]
    return bytes(bitmap)


def text_grams(
    records: DataFrame, text: Column, kinds: list[int], *columns: str, sent: bytes | None = None
) -> DataFrame:
    """One row per text and distinct n-gram of the given kinds, with the different surroundings it has in the text.

    Only n-grams that pass the bitmap ``sent`` leave their task.
    """
    own = records.select(*columns, text.cast("binary").alias("_text"))
    added = [T.StructField("gram", T.LongType()), T.StructField("around", T.ArrayType(T.BinaryType()))]
    if not kinds:
        return own.where("false").select(*columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    bitmap = records.sparkSession.sparkContext.broadcast(sent)
    return own.mapInArrow(text_batches(kinds, lambda: bitmap.value), T.StructType([*own.schema.fields[:-1], *added]))


def match_query_table(records: DataFrame, queries: DataFrame, key: str, *text_columns: str) -> DataFrame:
    """``match_queries`` for any number of queries: a table (query_idx, query).

    ``key`` is unique among the records, ``query_idx`` among the queries. Texts meet the queries
    filed under one of their n-grams, and most pairs that don't match are told by what stands around
    the n-gram, which goes with it. Only pairs of which this leaves terms open, and those of a key that
    repeats, meet the text again. Only pairs carry the query, and nothing the text. A
    bitmap of the n-grams of the index goes to the texts, so that all but few others are dropped where they arise. A
    text or n-gram with very many pairs can be split. Null texts count as empty, null or empty
    queries match nothing; records without a match drop out.
    """
    text = F.lower(F.concat_ws("\n", *text_columns))
    index = stage(query_index(records, queries, text), "query_index")
    found = text_grams(records, text, gram_kinds(index), key, sent=gram_bitmap(index))
    pairs = join_to_one(found, index.drop("kind", "core"), ["gram"], "inner").where(
        F.col("near").isNull() | F.exists("around", lambda part: F.contains(part, F.col("near")))
    )
    twice = records.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key, F.lit(True).alias("_twice"))
    known, columns = twice.isEmpty(), [*records.columns, "query_idx", "query"]
    if known and index.where(F.size("open") > 0).isEmpty():
        return join_to_one(pairs.select(key, "query_idx", "query"), records, [key], "inner").select(*columns)
    if not known:
        left = F.when(F.col("_twice"), F.col("terms")).otherwise(F.col("open"))
        pairs = join_to_one(pairs, twice, [key]).withColumn("open", left)
    pairs = stage(pairs.select(key, "query_idx", "query", "open"), "query_pairs")
    sure = join_to_one(pairs.where(F.size("open") == 0).drop("open"), records, [key], "inner")
    asked = (
        join_to_one(pairs.where(F.size("open") > 0), records.withColumn("_text", text), [key], "inner")
        .where(F.forall("open", lambda term: F.contains(F.col("_text"), term)))
    )
    return sure.select(*columns).unionByName(asked.select(*columns))
