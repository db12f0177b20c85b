"""Joining many rows per key to one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_to_one(many: DataFrame, one: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join in which a key of ``many`` may hold a large part of all its rows.

    Adaptive execution splits such a key only where both inputs of the join come
    straight out of an exchange. ``one`` is often the result of an aggregation or
    another join on the same keys and then has none. The second key, a hash of the
    keys, gives it one: a further exchange of one narrow row per key, for which the
    large side can be split. A small ``one`` is still broadcast by Spark's own limit.
    """
    second = F.xxhash64(*[F.col(k).cast("string") for k in keys])
    left = many.withColumn("_second_key", second)
    right = one.withColumn("_second_key", second)
    return left.join(right, [*keys, "_second_key"], how).drop("_second_key")


#: Bits of a bitmap of keys, one message of bounded size however many keys there are, and of one of its rows.
MOST_BITS, ROW_BITS = 1 << 26, 1 << 15


def perhaps_in(rows: DataFrame, wanted: DataFrame, key: str, mark: str) -> DataFrame:
    """``rows`` with ``mark``: false only where ``key`` is not among the keys in ``wanted``.

    Sixteen bits or more per key go to the rows, of all keys 8 MB at most; so about one row in twenty
    is marked though its key isn't there, more where there are over four million keys. ``wanted`` is
    read twice. Nothing is exchanged but its keys.
    """
    bits = min(MOST_BITS, max(ROW_BITS, 1 << (16 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    block, bit = (place / ROW_BITS).cast("int"), (place % ROW_BITS).cast("bigint")
    # Dealt before they are put together: else each task would send bitmaps.
    dealt = wanted.select(block.alias("_block"), bit.alias("_bit")).repartition("_block")
    bitmap = dealt.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    byte = F.expr("substring(_bitmap, cast(_bit div 8 as int) + 1, 1)")
    found = F.conv(F.hex(byte), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(found, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    placed = rows.withColumns({"_block": block, "_bit": bit})
    return placed.join(F.broadcast(bitmap), "_block", "left").select(*rows.columns, hit.alias(mark))


def only_in(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in ``wanted``, of which most rows are not: those don't leave their task."""
    near = perhaps_in(rows, wanted, key, "_perhaps").where("_perhaps").drop("_perhaps")
    return near.join(wanted, key, "left_semi")
