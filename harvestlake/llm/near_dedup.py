"""Near-duplicates by MinHash with one permutation, optimal densification and star edges.

A document is the set of its word shingles. One hash of every shingle is dealt to as many
bins as the signature has places and the least hash of each bin kept; an empty bin borrows
from the first full bin in a random order of its own (optimal densification). Bands of the
signature make buckets. Documents with equal sets are one class; only classes are compared.

Candidates of a bucket are a star: one centre against the others. Links are confirmed on the
full sets. As a star may miss a link between two outer members, a second star follows around
another centre in those buckets whose members are not all in one component yet. In buckets
that even then are in several components, the members outside the largest component are a
query set that is compared with all members: pair by pair where the bucket is small, else in
blocks of bounded size, inside tasks that only give back the links. Afterwards any two
members of a bucket are in one component or have been compared, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestlake.llm.common import free_name, row_tie, small_batches, stage, stage_rows, text_of
from harvestlake.llm.components import components
from harvestlake.operators.joins import join_to_one, only_in, perhaps_in

BANDS = 40
ROWS = 6
#: Members of a bucket that are compared pair by pair; larger buckets go in blocks.
SMALL = 16
#: Rows of a block.
BLOCK = 128
# Stands for a missing id, before all others.
_NO_ID = -(1 << 63)

_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[1])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[2])
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, words: int, known: WordHashes) -> np.ndarray:
    """Distinct hashes of the word shingles, ascending.

    A-Z count as lower case and ASCII white space parts words. Fewer than ``words`` words are
    one shingle; no word, none.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), seed=len(tokens))], dtype=np.uint64)
    h = np.fromiter((known[t] for t in tokens), dtype=np.uint64, count=len(tokens))
    n = len(tokens) - words + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        mixed = _mix(mixed * np.uint64(_MIX[0]) + h[k : k + n] + np.uint64(k + 1))
    return np.unique(mixed)


class Signer:
    """Signatures of shingle sets: one permutation, densified, cut into bands."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        self.bands, self.rows = bands, rows
        k = bands * rows
        rng = np.random.default_rng(seed)
        #: The order in which an empty bin asks the bins, each bin an order of its own.
        self.orders = np.argsort(rng.random((k, k)), axis=1).astype(np.int32).T.copy()
        self.salt = rng.integers(1, 1 << 63, size=(bands, rows), dtype=np.uint64) | np.uint64(1)

    def bins(self, hashes: np.ndarray) -> np.ndarray:
        k = self.bands * self.rows
        h = _mix(hashes ^ np.uint64(_MIX[0]))
        bin_of = ((h >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        least = np.full(k, np.iinfo(np.uint64).max, dtype=np.uint64)
        np.minimum.at(least, bin_of.astype(np.int64), h)
        full = least != np.iinfo(np.uint64).max
        empty = np.flatnonzero(~full)
        for asked in self.orders:
            if not len(empty):
                break
            source = asked[empty]
            answered = full[source]
            least[empty[answered]] = least[source[answered]]
            empty = empty[~answered]
        return least

    def buckets(self, hashes: np.ndarray) -> np.ndarray:
        """One 64-bit bucket per band."""
        bins = self.bins(hashes).reshape(self.bands, self.rows)
        mixed = _mix(bins * self.salt)
        return _mix(mixed.sum(axis=1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64))


def _as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def describe(rows: DataFrame, words: int, bands: int, per_band: int) -> DataFrame:
    """``node``, ``n_shingles``, ``set_hash`` (names equal sets) and ``buckets`` of each text."""

    def described(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, signer = WordHashes(), Signer(bands, per_band)
        for frame in frames:
            sizes, names, buckets = [], [], []
            for text in frame["text"]:
                hashes = shingle_hashes(text, words, known)
                sizes.append(len(hashes))
                names.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                buckets.append(_as_long(signer.buckets(hashes)) if len(hashes) else None)
            yield pd.DataFrame(
                {"node": frame["node"], "n_shingles": sizes, "set_hash": names, "buckets": buckets}
            )

    return rows.select("node", "text").mapInPandas(
        described, "node long, n_shingles long, set_hash binary, buckets array<long>"
    )


def _sets_of(rows: DataFrame, words: int) -> DataFrame:
    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for frame in frames:
            yield pd.DataFrame(
                {
                    "node": frame["node"],
                    "shingles": [_as_long(np.sort(_as_long(shingle_hashes(t, words, known)))) for t in frame["text"]],
                }
            )

    return rows.select("node", "text").mapInPandas(sets, "node long, shingles array<long>")


def _overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets overlap enough: 100 * intersection >= percent * union."""
    one = pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("right")), "v")
    two = one.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("left")), "u")

    def confirmed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for a, b in zip(frame["left"], frame["right"], strict=True):
                small, large = min(len(a), len(b)), max(len(a), len(b))
                if 100 * small < percent * large:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield frame.loc[keep, ["u", "v"]]

    return two.select("u", "v", "left", "right").mapInPandas(confirmed, "u long, v long")


def _crowded(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one node."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    return join_to_one(members, sizes.select("bucket"), ["bucket"], "inner")


def _unfinished(members: DataFrame, component: DataFrame, rows: int) -> DataFrame:
    """Members of the buckets where a pair may still be a missed link.

    Adds ``component`` and ``open``: whether the member is outside its bucket's largest
    component and was no centre yet. ``members`` has ``rows`` rows. A bucket without open members is finished: of any two
    members in different components one has been compared with the other.
    """

    def labelled(rows: DataFrame) -> DataFrame:
        return join_to_one(rows, component, ["node"]).withColumn("component", F.coalesce("component", "node"))

    parts = labelled(members).groupBy("bucket", "component").agg(
        F.count("*").alias("members"), F.count(F.when(~F.col("done"), 1)).alias("fresh")
    )
    top = parts.groupBy("bucket").agg(
        F.max(F.struct("members", "component", "fresh")).alias("top"),
        F.sum("fresh").alias("fresh"),
        F.sum("members").alias("members"),
    )
    top = top.where(F.col("fresh") > F.col("top.fresh")).select(
        "bucket", "members", F.col("top.component").alias("largest"), (F.col("fresh") - F.col("top.fresh")).alias("n_open")
    )
    # Staged, so that Spark knows how few buckets are left; members of others then stay where they are.
    return labelled(join_to_one(members, stage_rows(top, rows, "open"), ["bucket"], "inner")).withColumn(
        "open", ~F.col("done") & (F.col("component") != F.col("largest"))
    )


def _block_links(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the open members of each bucket and its other members, in blocks.

    ``left`` has bucket, node, size, component, open, members and n_open. Open members are
    dealt to chunks and all members to blocks by hash, and each chunk meets each block once.
    """
    key = F.xxhash64("node", "bucket")
    chunks, blocks = F.ceil(F.col("n_open") / BLOCK), F.ceil(F.col("members") / BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    asked = left.where("open").select(
        "bucket", "node", "component", F.lit(True).alias("asks"),
        F.pmod(key, chunks).alias("chunk"), every(blocks).alias("block"),
    )
    asking = left.select(
        "bucket", "node", "component", F.lit(False).alias("asks"),
        every(chunks).alias("chunk"), F.pmod(key, blocks).alias("block"),
    )
    rows = asked.unionByName(asking.select(*asked.columns))
    rows = join_to_one(rows, sets, ["node"], "inner")

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        members = frame[~frame["asks"]]
        nodes, parts = members["node"].to_numpy(), members["component"].to_numpy()
        found: set[tuple[int, int]] = set()
        if len(nodes):
            each = [np.asarray(v) for v in members["shingles"]]
            sizes = np.array([len(v) for v in each])
            starts, values = np.cumsum(sizes) - sizes, np.concatenate(each)
            asks = frame[frame["asks"]]
            for node, part, own in zip(asks["node"], asks["component"], asks["shingles"], strict=True):
                own = np.asarray(own)
                at = np.minimum(np.searchsorted(own, values), len(own) - 1)
                both = np.add.reduceat((own[at] == values).astype(np.int64), starts)
                linked = (100 * both >= percent * (len(own) + sizes - both)) & (parts != part)
                found.update((min(node, n), max(node, n)) for n in nodes[linked])
        return pd.DataFrame(sorted(found), columns=["u", "v"], dtype="int64")

    return rows.groupBy("bucket", "chunk", "block").applyInPandas(links, "u long, v long").distinct()


class _Rounds:
    """Components of the classes as links are found."""

    def __init__(self, sets: DataFrame, percent: int, heads: DataFrame):
        self.sets, self.percent = sets, percent
        self.component = heads.select("node", F.col("node").alias("component")).limit(0)

    def star(self, members: DataFrame, centres: DataFrame, rows: int) -> DataFrame:
        """Compare the members of each bucket (``rows`` at most) with its centres; returns them with these done.

        ``centres`` has one array of (node, size, component) per bucket. Members of one
        component aren't compared, nor sets whose sizes alone rule a link out.
        """
        near = join_to_one(members, centres, ["bucket"])
        wanted = F.filter(
            "centres",
            lambda c: (c["component"] != F.col("component"))
            & (100 * F.least(c["size"], F.col("size")) >= self.percent * F.greatest(c["size"], F.col("size"))),
        )
        near = stage_rows(
            near.select(
                "bucket", "node", "size", wanted.alias("wanted"),
                (F.col("done") | F.coalesce(F.array_contains("centres.node", F.col("node")), F.lit(False))).alias("done"),
            ),
            rows,
            "members",
        )
        pairs = near.select("node", F.explode("wanted").alias("c"))
        pairs = pairs.select(
            F.least("node", "c.node").alias("u"), F.greatest("node", "c.node").alias("v")
        ).distinct()
        self.add(_overlaps(pairs, self.sets, self.percent))
        return near.drop("wanted")

    def add(self, links: DataFrame) -> None:
        links = stage(links, "links")
        if not links.isEmpty():
            stars = self.component.where("node <> component").toDF("u", "v")
            self.component = components(links.unionByName(stars))

    def run(self, members: DataFrame, rows: int) -> None:
        """Until every bucket of ``members`` (bucket, node, size; ``rows`` rows) is finished."""
        whole = F.struct("node", "size", "component")

        def star(frame: DataFrame, centres) -> DataFrame:
            return self.star(frame, frame.groupBy("bucket").agg(centres.alias("centres")), rows)

        members = members.withColumns({"done": F.lit(False), "component": F.col("node")})
        members = star(members, F.array(F.min_by(whole, F.col("node"))))
        left = stage(_unfinished(members, self.component, rows), "unfinished")
        if left.isEmpty():
            return
        # A second star, around a centre that differs from bucket to bucket.
        members = star(left, F.array(F.min_by(whole, F.xxhash64("node", "bucket"))))
        left = stage(_unfinished(members, self.component, rows), "unfinished")
        if left.isEmpty():
            return
        small = F.col("members") <= SMALL
        links = _block_links(left.where(~small), self.sets, self.percent)
        star(left.where(small), F.collect_list(F.when(F.col("open"), whole)))
        self.add(links)


def similar_classes(
    docs: DataFrame, words: int, percent: int, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``node``, ``n_shingles``, ``component`` of every row of ``docs`` (node BIGINT, text).

    ``component`` is the least node that links reach. Equal sets are linked (empty ones are
    not linked with anything). Nodes must be distinct.
    """
    small_batches(docs.sparkSession)
    facts = stage(describe(docs, words, bands, rows), "minhash")
    filled = facts.where("n_shingles > 0")
    # Only sets that repeat, of which Spark knows the size; most texts then stay where they are.
    classes = filled.groupBy("set_hash").agg(F.min("node").alias("class"), F.count("*").alias("members"))
    classes = stage_rows(classes.where("members > 1").select("set_hash", "class"), facts.count(), "repeated")
    member_of = join_to_one(filled, classes, ["set_hash"]).withColumn("class", F.coalesce("class", "node"))
    member_of = stage(member_of.drop("set_hash"), "classes")
    heads = member_of.where(F.col("node") == F.col("class"))
    buckets = _crowded(heads.select("node", F.explode("buckets").alias("bucket")))
    buckets = stage(buckets, "buckets")
    involved = stage(
        heads.select("node", F.col("n_shingles").alias("size")).join(
            buckets.select("node").distinct(), "node", "left_semi"
        ),
        "involved",
    )
    sets = stage(_sets_of(only_in(docs, involved.select("node"), "node"), words), "sets")
    rounds = _Rounds(sets, percent, heads)
    if not buckets.isEmpty():
        rounds.run(join_to_one(buckets, involved, ["node"], "inner"), buckets.count())

    by_class = rounds.component.select(F.col("node").alias("class"), "component")
    whole = join_to_one(member_of.select("node", "class"), by_class, ["class"], "left").select(
        "node", F.coalesce("component", "class").alias("component")
    )
    return join_to_one(
        facts.select("node", "n_shingles"), whole, ["node"], "left"
    ).select("node", "n_shingles", F.coalesce("component", "node").alias("component"))


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, **options
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for each row of ``docs``.

    Two rows are linked when 100 * intersection >= ``percent`` * union of their shingle sets;
    ``component_id`` is the smallest id that links reach, and the row with that id is kept.
    Null text is empty; a text without words has no shingle and is linked with nothing. Rows
    that repeat an id are linked by their texts like others and share the id. Rows without an
    id take part as if they had the smallest ids of all, and are reported with a null id.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("bigint"), F.lit(_NO_ID)).alias("node"),
        text_of(text).alias("text"),
    )
    out = similar_rows(rows, words, percent, **options)
    named = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return out.select(
        named("node").alias("doc_id"),
        "n_shingles",
        named("component").alias("component_id"),
        (F.col("node") == F.col("component")).alias("kept"),
    )


def similar_rows(rows: DataFrame, words: int, percent: int, **options) -> DataFrame:
    """``similar_classes`` for rows that may repeat a node: one node per distinct text and id.

    ``head`` marks the node that stands for its class, ``hash`` tells apart the texts of a
    repeated id (null where no id repeats).
    """
    repeats = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    if repeats.isEmpty():
        found = similar_classes(rows, words, percent, **options)
        return found.select("*", (F.col("node") == F.col("component")).alias("head"), F.lit(None).cast("bigint").alias("hash"))
    # Repeated ids: number the rows by id and text, keep the order of the ids, and go back.
    keyed = rows.withColumn("hash", F.xxhash64("text"))
    names = stage(
        keyed.select("node", "hash").distinct().orderBy("node", "hash").withColumn("at", F.monotonically_increasing_id()),
        "names",
    )
    texts = keyed.dropDuplicates(["node", "hash"]).join(names, ["node", "hash"]).select(F.col("at").alias("node"), "text")
    found = similar_classes(stage(texts, "texts"), words, percent, **options)
    ids = names.select(F.col("at").alias("node"), F.col("node").alias("id"), "hash")
    named = join_to_one(found, ids, ["node"], "inner").join(
        ids.select(F.col("node").alias("component"), F.col("id").alias("component_id")), "component"
    )
    by_text = named.select(
        F.col("id").alias("node"), "hash", "n_shingles", F.col("component_id").alias("component"),
        (F.col("node") == F.col("component")).alias("head"),
    )
    return keyed.select("node", "hash").join(by_text, ["node", "hash"]).select("node", "n_shingles", "component", "head", "hash")


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, **options
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that with the smallest id.

    The columns stay as they are. Where an id repeats with several texts, the row with the text
    that stands for the group stays; of rows alike in id and text, the one with the smallest
    hash over all columns. Texts without words are linked with nothing and all stay.
    """
    own = free_name(docs.columns, "kept_id")
    mark = free_name([*docs.columns, own], "kept_hash")
    node = F.coalesce(F.col(f"`{id_column}`").cast("bigint"), F.lit(_NO_ID))
    rows = docs.select(node.alias("node"), text_of(text).alias("text"))
    all_rows = stage(similar_rows(rows, words, percent, **options).distinct(), "heads")
    found = all_rows.where("head")
    ids = docs.withColumn(own, node)
    if found.where(F.col("hash").isNotNull()).isEmpty():
        # No id repeats. Most rows stay, and only those that a bitmap can't tell from the others are exchanged.
        gone = all_rows.where(~F.col("head")).select(F.col("node").alias(own))
        marked = perhaps_in(ids, gone, own, mark)
        asked = marked.where(mark).join(gone, own, "left_anti")
        return marked.where(~F.col(mark)).select(*docs.columns).unionByName(asked.select(*docs.columns))
    number = free_name([*docs.columns, own, mark], "number")
    kept = found.select(F.col("node").alias(own), F.col("hash").alias(mark), (F.col("n_shingles") > 0).alias(number))
    staying = ids.withColumn(mark, F.xxhash64(text_of(text))).join(kept, [own, mark])
    alike = Window.partitionBy(own, mark).orderBy(row_tie(docs))
    first = F.when(F.col(number), F.row_number().over(alike)).otherwise(1)
    return staying.withColumn(number, first).where(F.col(number) == 1).select(*docs.columns)
