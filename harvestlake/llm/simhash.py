"""SimHash fingerprints and all neighbours within a Hamming radius, in DataFrame operations.

Every term of a text (a pair of neighbouring words) votes with its weight, its length, on
the 64 bits of its hash: for a set bit, against it otherwise. The sign of the vote is the
bit of the fingerprint. Votes are counted 32 at a time: the bits j and j + 32 of a hash stand
in the two halves of one number, so 32 sums hold all 64.

Fingerprints that differ in at most r of 64 bits agree in at least b - r of b blocks. One
table for each choice of b - r blocks, keyed by those blocks put in front (permuted), brings
every such pair together in some table; nothing within the radius is missed.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestlake.llm.common import stage, stop_if_missing, text_of
from harvestlake.operators.joins import join_to_one

#: Bits j and j + 32 of a number.
_HALVES = (1 << 32) | 1
_LOW = (1 << 32) - 1
_WORDS = r"[\x20\x09-\x0D]+"


def terms_of(text: Column) -> Column:
    """Array of (a, b): neighbouring words; a text of one word has that word alone."""
    words = F.filter(F.split(F.lower(text), _WORDS), lambda w: w != "")
    n = F.size(words)
    pairs = F.arrays_zip(
        F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))).alias("a"),
        F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))).alias("b"),
    )
    alone = F.transform(words, lambda w: F.struct(w.alias("a"), F.lit(None).cast("string").alias("b")))
    return F.when(n == 1, alone).otherwise(pairs)


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text", fingerprint: str = "fingerprint") -> DataFrame:
    """``keys`` and the fingerprint (BIGINT) of each text; rows with equal keys count as one text.

    Case is ignored, ASCII white space parts words. A text without words, null included, has
    fingerprint 0; a bit whose votes tie is 0. Equal texts have equal fingerprints.
    """
    terms = texts.select(*keys, F.explode_outer(terms_of(text_of(text))).alias("t"))
    votes = terms.select(
        *keys,
        F.when(F.col("t").isNotNull(), F.xxhash64("t.a", "t.b")).alias("h"),
        (F.char_length("t.a") + F.coalesce(F.char_length("t.b"), F.lit(0))).cast("bigint").alias("w"),
    )
    sums = [
        F.sum(F.shiftright("h", j).bitwiseAND(F.lit(_HALVES)) * F.col("w")).alias(f"s{j}") for j in range(32)
    ]
    counted = votes.groupBy(*keys).agg(F.sum("w").alias("all"), *sums)

    def bit(ones: Column, j: int) -> Column:
        return F.when(2 * ones > F.col("all"), F.lit(1 << j if j < 63 else -(1 << 63))).otherwise(F.lit(0))

    low = [bit(F.col(f"s{j}").bitwiseAND(F.lit(_LOW)), j) for j in range(32)]
    high = [bit(F.shiftrightunsigned(f"s{j}", 32), j + 32) for j in range(32)]
    value = reduce(lambda a, b: a.bitwiseOR(b), [*low, *high])
    return counted.select(*keys, F.coalesce(value, F.lit(0)).cast("bigint").alias(fingerprint))


def as_hex(fingerprint: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _block_keys(fingerprint: Column, radius: int, blocks: int) -> Column:
    """Array of (table, key): the blocks of each choice in front, the others masked away."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    out = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(masks[i] for i in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(
            F.struct(F.lit(number).alias("table"), fingerprint.bitwiseAND(F.lit(signed)).alias("key"))
        )
    return F.array(*out)


def neighbours(
    queries: DataFrame, corpus: DataFrame, radius: int = 3, blocks: int = 6, fingerprint: str = "fingerprint"
) -> DataFrame:
    """``a``, ``b``, ``distance``: the fingerprints of ``corpus`` within ``radius`` of a query's.

    Both sides count each distinct fingerprint once, however many rows have it, so copies
    make no pairs; the pair of a fingerprint with itself is left out. ``queries`` may be any
    subset. A table's key may be shared by many fingerprints; the pairs of a key are those of
    its queries with its corpus, and adaptive execution splits a key with many rows.
    """
    if not 0 <= radius < blocks:
        raise ValueError("radius must be less than blocks")
    value = F.col(fingerprint)

    def table(frame: DataFrame, name: str) -> DataFrame:
        distinct = frame.select(value.alias(name)).where(F.col(name).isNotNull()).distinct()
        return distinct.select(name, F.explode(_block_keys(F.col(name), radius, blocks)).alias("k")).select(
            name, "k.table", "k.key"
        )

    pairs = table(corpus, "b").join(table(queries, "a"), ["table", "key"])
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return (
        pairs.where("a <> b")
        .select("a", "b", distance.cast("int").alias("distance"))
        .where(F.col("distance") <= radius)
        .distinct()
    )


def with_next(ids: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Each distinct id with the next larger one, ``next_id``; the last has the first.

    The ids are sorted in ranges; only the ends of the ranges, one row each, are looked at
    together. Null ids have no place and are left out.
    """
    distinct = ids.select(F.col(id_column).alias("id")).where(F.col("id").isNotNull()).distinct()
    # Written, so that the ranges read later are the ranges that were made.
    ranged = stage(
        distinct.repartitionByRange("id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id()),
        "id-ranges",
    )
    inside = ranged.withColumn("next_id", F.lead("id").over(Window.partitionBy("part").orderBy("id")))
    heads = ranged.groupBy("part").agg(F.min("id").alias("head"))
    whole = Window.partitionBy(F.lit(0)).orderBy("part")
    after = heads.select(
        "part",
        F.coalesce(F.lead("head").over(whole), F.min("head").over(Window.partitionBy(F.lit(0)))).alias("after"),
    )
    return join_to_one(inside, after, ["part"], "inner").select(
        F.col("id").alias(id_column), F.coalesce("next_id", "after").alias("next_id")
    )


def _both_fingerprints(rows: DataFrame) -> DataFrame:
    """Fingerprints of the texts and of the edited texts, whose new end is in ``start``."""
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    both = rows.select(
        "doc_id",
        "text_hash",
        "next_id",
        n.cast("bigint").alias("n_chars"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("edited"), F.col("text").alias("text")),
                F.struct(
                    F.lit(1).alias("edited"),
                    F.concat(
                        F.left("text", n - quarter), F.coalesce(F.left("start", quarter), F.lit(""))
                    ).alias("text"),
                ),
            )
        ).alias("v"),
    )
    both = both.select(
        "doc_id", "text_hash", "next_id", "n_chars", "v.edited", "v.text",
        F.when(F.col("v.edited") == 1, F.sha2("v.text", 256)).alias("sha"),
    )
    prints = fingerprints(both, ["doc_id", "text_hash", "next_id", "n_chars", "edited", "sha"])
    return prints.groupBy("doc_id", "text_hash", "next_id", "n_chars").agg(
        F.max(F.when(F.col("edited") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("edited") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
        F.max("sha").alias("edited_sha256"),
    )


def edited_likeness(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edited text has its last quarter of code points (rounded down) replaced by as many of
    the first of the next document's text, or by all it has. The next document is that with
    the next larger id; of rows that share an id, the text with the smallest hash stands for
    it. Null text is empty. Returns one row per row: ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint`` and ``edited_fingerprint`` (BIGINT), ``next_id``,
    ``near_edited`` and ``near_next``. A row without id has no next document: its edited text
    only loses the quarter, and ``near_next`` is null.
    """
    stop_if_missing(docs, id_column, text)
    # An alias without need would make the two exchanges of the texts differ, and cost one more.
    own = F.col(f"`{id_column}`")
    rows = docs.select(own if id_column == "doc_id" else own.alias("doc_id"), text_of(text).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    placed, lost = rows.where(F.col("doc_id").isNotNull()), rows.where(F.col("doc_id").isNull())
    known = stage(rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("times")), "id-texts")
    names = known.groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"))
    order = stage(with_next(names.select("doc_id")), "next-ids")

    # Who needs the start of a document, and how much of it.
    length = rows.select("doc_id", "text_hash", F.char_length("text").alias("n"))
    need = length.groupBy("doc_id").agg(F.max(F.floor(F.col("n") / 4)).alias("need"))
    wanted = join_to_one(order, need, ["doc_id"], "inner").select(
        F.col("doc_id").alias("asker"), F.col("next_id").alias("doc_id"), F.col("need").cast("int").alias("need")
    )
    heads = wanted.join(names.withColumnRenamed("text_hash", "head_hash"), "doc_id")
    # Joined by id alone, so that the texts are dealt once for this join and the next.
    starts = (
        placed.join(heads, "doc_id")
        # No equality of columns, which would become a second key and deal the texts again.
        .where(F.col("text_hash").bitwiseXOR(F.col("head_hash")) == 0)
        .select(F.col("asker").alias("doc_id"), F.col("doc_id").alias("next_id"), F.expr("left(text, need)").alias("start"))
        .groupBy("doc_id", "next_id")
        .agg(F.max("start").alias("start"))
    )
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    wide = _both_fingerprints(placed.join(starts, "doc_id", "left")).unionByName(
        _both_fingerprints(lost.withColumns({"next_id": F.lit(None).cast("bigint"), "start": F.lit("")}))
    )
    wide = stage(wide, "fingerprints")
    next_prints = wide.join(names, ["doc_id", "text_hash"], "left_semi").select(
        F.col("doc_id").alias("next_id"), F.col("fingerprint").alias("next_fingerprint")
    )
    found = join_to_one(wide, next_prints, ["next_id"])
    again = known.where("times > 1").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "times")
    found = found.join(
        again, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left"
    ).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("times", F.lit(1).cast("bigint")))))
    return found.select(
        "doc_id", "text_hash", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_id",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
