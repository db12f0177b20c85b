"""Mixing sources to target weights: temperature, bisected exponent, budgeted block permutations.

With token shares p of the sources, the weights are p^a / sum(p^a). The exponent a is bisected
so that the mixture reaches a target entropy and no source is repeated beyond a limit. The
weights times the token budget are what each source owes. It pays in blocks: its documents
are dealt to blocks by a hash, every epoch has its own random order of blocks and, inside a
block, of documents. Whole epochs and whole blocks go out as they are; only the block in
which the budget ends is cut, between two documents.

Nothing depends on the number of sources or on the size of one: sources are rows of a table,
running totals go over the blocks of a source and over the documents of one block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestlake.llm.common import free_name, row_tie, stage, text_of
from harvestlake.operators.joins import join_to_one

#: Tokens that a block holds on average.
BLOCK_TOKENS = 1 << 20
#: Interior exponents that one pass over the source table tries: six halvings at once.
SPLITS = 63
PASSES = 8


def word_count(text: Column) -> Column:
    """Default token count: runs of characters other than ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _curve(sizes: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(exponent, entropy, largest repetition over smallest) of the mixtures, in one pass."""
    p, a = F.col("share"), F.col("exponent")
    tried = sizes.select("share", F.explode(F.array(*[F.lit(x) for x in exponents])).alias("exponent"))
    rows = tried.groupBy("exponent").agg(
        F.sum(F.pow(p, a)).alias("z"),
        F.sum(F.pow(p, a) * F.log(p)).alias("s"),
        F.max(p).alias("top"),
        F.min(p).alias("low"),
    )
    return [
        (r["exponent"], math.log(r["z"]) - r["exponent"] * r["s"] / r["z"], (r["top"] / r["low"]) ** (1 - r["exponent"]))
        for r in rows.orderBy("exponent").collect()  # as many rows as exponents
    ]


def find_exponent(sizes: DataFrame, entropy_share: float | None, max_repeats: float | None) -> float:
    """The least exponent in [0, 1] that meets both targets; 1 is the natural mixture.

    ``sizes`` has ``share``, the token share of each source, positive and summing to 1.
    ``entropy_share`` is a part of the largest possible entropy: the mixture is flattened
    until its entropy reaches it, and no further. ``max_repeats`` bounds how often the source
    with the greatest repetition is seen for each time of that with the least; it wins over
    the entropy. Entropy falls and repetition falls as the exponent grows, so both bounds are
    crossed once and can be bisected.
    """
    n = sizes.count()
    if n < 2:
        return 1.0
    goal = None if entropy_share is None else entropy_share * math.log(n)

    def flat_enough(entropy, repeats):
        return goal is not None and entropy < goal

    def too_flat(entropy, repeats):
        return max_repeats is not None and repeats > max_repeats

    def bisect(too_low) -> float:
        """The crossing from exponents that are ``too_low`` to those that are not."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            tried = [low + (high - low) * k / (SPLITS + 1) for k in range(1, SPLITS + 1)]
            for a, entropy, repeats in _curve(sizes, tried):
                if too_low(entropy, repeats):
                    low = a
                else:
                    high = a
                    break
        return high

    ends = {a: (h, r) for a, h, r in _curve(sizes, [0.0, 1.0])}
    # The flattest mixture allowed by the repetition limit.
    floor = bisect(too_flat) if too_flat(*ends[0.0]) else 0.0
    if goal is None:
        return floor
    if not flat_enough(*ends[1.0]):  # the natural mixture reaches the target
        return 1.0
    if flat_enough(*ends[0.0]):  # rounding only: no mixture is flatter than exponent 0
        return floor
    reached = bisect(lambda h, r: not flat_enough(h, r))
    return max(floor, reached)


def source_weights(
    sizes: DataFrame, entropy_share: float | None, max_repeats: float | None, budget: int | None
) -> DataFrame:
    """``source``, ``tokens``, ``weight``, ``owed`` (tokens the source owes the mixture).

    Without a ``budget`` the mixture is as large as it must be for every source to be seen
    once in full, so no document is left out; what grows are the repetitions.
    """
    totals = sizes.agg(F.sum("tokens").alias("all")).first()
    if not totals["all"]:
        return sizes.select("source", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("bigint").alias("owed"))
    shares = stage(
        sizes.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(totals["all"])), "shares"
    )
    a = find_exponent(shares, entropy_share, max_repeats)
    row = shares.agg(
        F.sum(F.pow("share", F.lit(a))).alias("z"), F.max(F.pow("share", F.lit(1 - a))).alias("top")
    ).first()
    weighted = shares.withColumn("weight", F.pow("share", F.lit(a)) / F.lit(row["z"]))
    if budget is None:
        # owed / tokens = (top share / share)^(1-a): 1 for the largest source, more for others
        owed = F.col("tokens") * F.lit(row["top"]) / F.pow("share", F.lit(1 - a))
    else:
        owed = F.col("weight") * F.lit(budget)
    return weighted.select("source", "tokens", "weight", F.round(owed).cast("bigint").alias("owed"))


def _numbered(facts: DataFrame, repeats: DataFrame) -> DataFrame:
    """``facts`` with a key of its own for each of several equal rows.

    The numbers are those of the rows of a written table, so they are the same in every scan;
    equal rows may take each other's. With keys of their own they are dealt to all blocks.
    """
    marked = join_to_one(facts, repeats, ["p_key"])
    single = marked.where(F.col("p_copies").isNull()).select(*facts.columns)
    several = marked.where(F.col("p_copies").isNotNull()).withColumn("p_copy", F.monotonically_increasing_id())
    several = stage(several.select(*facts.columns, "p_copy"), "mix-repeated")
    own = F.xxhash64("p_key", "p_copy")
    return single.unionByName(several.withColumn("p_key", own).drop("p_copy"))


def mix(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    id_column: str = "doc_id",
    tokens: Column | None = None,
    entropy_share: float | None = 0.9,
    max_repeats: float | None = 4.0,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """The mixture: rows of ``docs`` as often as they are due, with where they come.

    Adds ``mix``, a struct of epoch (from 0), block, block_rank (place of the block in its
    epoch), slot (place in the block) and tokens. Documents of a null source are a source of
    their own. A source pays whole epochs and then the documents whose tokens begin before
    its budget is spent, so it pays at least what it owes and less than one document more.
    Documents without tokens (null and empty texts) cost nothing and are in every whole epoch
    and in each full block; a source without any token is given once. Repeated rows count as
    documents of their own, each with a place of its own; which of them comes where isn't fixed.
    An empty frame gives an empty frame. The order depends on the rows and the seed only. By
    default a token is a run between white space; pass ``tokens`` for texts without spaces.
    """
    count = word_count(text_of(text)) if tokens is None else tokens.cast("bigint")
    src, key = F.col("p_source"), F.col("p_key")
    row = free_name(docs.columns, "row")
    place = free_name(docs.columns, "mix")
    facts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
        F.col(f"`{source}`").cast("string").alias("p_source"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), row_tie(docs)).alias("p_key"),
        count.alias("p_tokens"),
    )
    narrow = stage(facts.select("p_source", "p_key", "p_tokens"), "mix-facts")
    repeats = stage(narrow.groupBy("p_key").agg(F.count("*").alias("p_copies")).where("p_copies > 1"), "mix-repeats")
    if not repeats.isEmpty():
        facts = _numbered(facts, repeats)
        narrow = stage(facts.select("p_source", "p_key", "p_tokens"), "mix-facts")
    sizes = stage(
        narrow.groupBy(src.alias("source")).agg(F.sum("p_tokens").alias("tokens"), F.count("*").alias("n")), "mix-sizes"
    )
    weights = source_weights(sizes.select("source", "tokens"), entropy_share, max_repeats, budget)
    plan = stage(
        sizes.alias("s").join(weights.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left").select(
            F.col("s.source").alias("p_source"),
            F.greatest(F.lit(1), F.ceil(F.col("s.tokens") / F.lit(block_tokens))).cast("bigint").alias("blocks"),
            F.when(F.col("s.tokens") > 0, F.floor(F.col("owed") / F.col("s.tokens"))).otherwise(1).cast("bigint").alias("epochs"),
            F.when(F.col("s.tokens") > 0, F.col("owed") % F.col("s.tokens")).otherwise(0).cast("bigint").alias("rest"),
        ),
        "mix-plan",
    )

    def with_plan(frame: DataFrame, columns: list[str]) -> DataFrame:
        # A null source can't be joined on; it stands as a marked name.
        name = F.concat(F.when(src.isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(src, F.lit("")))
        one = plan.withColumn("p_name", name).select("p_name", *columns)
        return join_to_one(frame.withColumn("p_name", name), one, ["p_name"], "inner")

    block = F.pmod(F.xxhash64(key, F.lit("block")), F.col("blocks")).alias("block")
    dealt = with_plan(narrow, ["blocks", "epochs", "rest"]).select(
        "p_name", "p_key", "p_tokens", "epochs", "rest", block
    )
    # The last epoch: blocks in its order, as far as the rest of the budget goes.
    by_block = dealt.groupBy("p_name", "block", "epochs", "rest").agg(F.sum("p_tokens").alias("tokens"))
    order = Window.partitionBy("p_name").orderBy(F.xxhash64("p_name", "block", "epochs"), "block")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_block.withColumn("before", F.sum("tokens").over(order) - F.col("tokens"))
    last = stage(
        before.where("before < rest").select(
            "p_name", "block", (F.col("rest") - F.col("before")).alias("left"), "tokens",
        ),
        "mix-last",
    )
    inside = lambda epoch: F.xxhash64("p_key", epoch)
    # In the block where the budget ends, the documents up to this place are due.
    place_in = F.struct(inside(F.col("epochs")).alias("h"), F.col("p_key").alias("k"))
    run = Window.partitionBy("p_name", "block").orderBy(inside(F.col("epochs")), "p_key")
    run = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        join_to_one(dealt, last.where("left < tokens").drop("tokens"), ["p_name", "block"], "inner")
        .withColumn("spent", F.sum("p_tokens").over(run) - F.col("p_tokens"))
        .where("spent < left")
        .groupBy("p_name", "block")
        .agg(F.max(place_in).alias("upto"))
    )
    due = join_to_one(
        last.select("p_name", "block", (F.col("left") >= F.col("tokens")).alias("full")), cut, ["p_name", "block"]
    )
    due = stage(due, "mix-due")

    out = with_plan(facts, ["blocks", "epochs"]).withColumn("block", block)
    out = join_to_one(out, due, ["p_name", "block"])
    again = F.coalesce(F.col("full") | (place_in <= F.col("upto")), F.lit(False))
    out = out.withColumn("times", F.col("epochs") + F.when(again, 1).otherwise(0)).where("times > 0")
    out = out.select(
        row, "block", "p_tokens", "p_name", "p_key",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)).alias("epoch"),
    )
    return out.select(
        f"{row}.*",
        F.struct(
            F.col("epoch"),
            F.col("block"),
            F.xxhash64("p_name", "block", "epoch").alias("block_rank"),
            inside(F.col("epoch")).alias("slot"),
            F.col("p_tokens").alias("tokens"),
        ).alias(place),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture with the columns of ``docs`` only."""
    return mix(docs, **options).select(*[F.col(f"`{c}`") for c in docs.columns])
