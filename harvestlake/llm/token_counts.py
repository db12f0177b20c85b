"""Token counts: pieces are counted once per distinct pre-token and joined to frequencies.

A text falls into pre-tokens (the tokenizer's own normaliser and splitting rule) before the
merges run, and the merges never cross a pre-token. So the tokens of a text are the sum over
its distinct pre-tokens of frequency times number of pieces; no ids are made.

Most occurrences are of few pre-tokens. A vocabulary of bounded size, found by counting a
bounded sample of texts, is split into pieces once and sent along, and its share of each
text is summed on the spot. All other pre-tokens become rows of (text, pre-token, frequency)
that meet the piece counts of the distinct pre-tokens in a join. Which pre-tokens are in the
vocabulary changes what is moved, never the result.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.llm.common import sample_of_texts, small_batches, stage, text_of
from harvestlake.operators.joins import join_to_one

#: Texts whose pre-tokens are counted to choose the vocabulary that is sent along.
SAMPLE_TEXTS = 4000
#: Pre-tokens of that vocabulary, and the longest that it may hold; together its size bound.
VOCABULARY = 200_000
LONGEST = 48
#: Rows of one batch that goes back to Spark.
OUT_ROWS = 20_000


def odd_characters(pattern: str) -> str:
    """Ranges of code points that a class in ``pattern`` takes in one library's Unicode version only.

    Both versions agree on ASCII, which the texts' fast way relies on.
    """
    from tokenizers import Regex, pre_tokenizers

    odd: set[str] = set()
    names = sorted(set(regex.findall(r"\\[pP]\{\^?\w+\}|\\[swdSWD]", pattern)))
    for start in range(0, 0x110000, 0x4000):  # in parts, as each letter becomes a piece of its own
        part = "".join(chr(c) for c in range(start, start + 0x4000) if not 0xD800 <= c < 0xE000)
        for name in names:
            theirs = pre_tokenizers.Split(Regex(name), "removed", invert=True).pre_tokenize_str(part)
            odd ^= {c for piece, _ in theirs for c in piece} ^ set(regex.findall(name, part))
    codes = sorted(map(ord, odd))
    if codes and codes[0] < 128:
        raise ValueError("the pattern takes ASCII otherwise than the tokenizer")
    known = set(codes)
    first = [c for c in codes if c - 1 not in known]
    last = [c for c in codes if c + 1 not in known]
    return "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in zip(first, last, strict=True))


class PreTokens:
    """Normalising and splitting of one tokenizer, and the piece counts of its pre-tokens.

    Only tokenizers whose pre-tokens come from one splitting pattern are taken, as the
    byte-level ones; others are refused when the file is read.
    """

    def __init__(self, definition: str, odd: str | None = None):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        told = json.loads(definition)
        pattern = self._pattern(told["pre_tokenizer"])
        self.split = regex.compile(pattern)
        #: The tokenizer's own splitter, slower, for texts with characters that only one of the
        #: two Unicode versions knows.
        self.own_split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.odd = odd_characters(pattern) if odd is None else odd
        self.has_odd = re.compile(f"[{self.odd}]").search if self.odd else lambda text: None
        self.normalizer = self.tokenizer.normalizer
        #: Special strings count as one token wherever they stand in a text.
        self.special = [t["content"] for t in told.get("added_tokens", [])]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in told.get("added_tokens", [])):
            raise ValueError("added tokens with matching options are not supported")
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # A tokenizer that takes one pre-token as it is: nothing normalised or split again.
        # (The splitter's ByteLevel step stays, as it only renames bytes.)
        self.piecer = self._piecer(told)

    @staticmethod
    def _pattern(told: dict) -> str:
        steps = told["pretokenizers"] if told["type"] == "Sequence" else [told]
        split = [s for s in steps if s["type"] == "Split"]
        rest = [s for s in steps if s["type"] != "Split"]
        if len(split) != 1 or not split[0]["invert"] or split[0]["behavior"] != "Removed" or "Regex" not in split[0]["pattern"]:
            raise ValueError("the tokenizer must split by one pattern of what to keep")
        if any(s["type"] != "ByteLevel" or s["use_regex"] or s["add_prefix_space"] for s in rest):
            raise ValueError("only a plain byte-level step may follow the splitting")
        return split[0]["pattern"]["Regex"]

    @staticmethod
    def _piecer(told: dict):
        from tokenizers import Tokenizer

        plain = dict(told)
        steps = told["pre_tokenizer"].get("pretokenizers", [])
        plain["pre_tokenizer"] = next((s for s in steps if s["type"] == "ByteLevel"), None)
        plain["normalizer"] = None
        plain["added_tokens"] = []
        plain["post_processor"] = None
        return Tokenizer.from_str(json.dumps(plain))

    def count(self, text: str) -> tuple[int, Counter]:
        """Special tokens in the text, and the frequency of each pre-token."""
        parts, special = [text], 0
        if self.cut is not None and any(s in text for s in self.special):
            parts = self.cut.split(text)
            special = len(parts) - 1
        found: Counter = Counter()
        for part in parts:
            if part:
                found.update(self.pre_tokens(self.normalizer.normalize_str(part) if self.normalizer else part))
        return special, found

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii() and self.has_odd(text):
            return [piece for piece, _ in self.own_split.pre_tokenize_str(text)]
        return self.split.findall(text)

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.piecer.encode_batch_fast(pre_tokens, add_special_tokens=False)]


def _frequent(texts: DataFrame, definition: str, odd: str) -> dict[str, int]:
    """The most frequent pre-tokens of a bounded sample, with their piece counts."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, all_ = PreTokens(definition, odd), Counter()
        for frame in frames:
            for text in frame["text"]:
                all_.update(w for w in own.count(text)[1] if len(w) <= LONGEST)
        items = list(all_.items())
        yield pd.DataFrame({"pre": [w for w, _ in items], "n": [n for _, n in items]})

    sample = sample_of_texts(texts, "text", SAMPLE_TEXTS).mapInPandas(counted, "pre string, n long")
    top = sample.groupBy("pre").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pre").limit(VOCABULARY)
    words = [r["pre"] for r in top.select("pre").collect()]
    return dict(zip(words, PreTokens(definition, odd).pieces(words), strict=True))


def token_counts(
    docs: DataFrame, tokenizer_file: str, limit: int = 2048, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    One row per row of ``docs``; whole texts, null as empty, without begin, end or padding.
    Special strings inside a text count as the library counts them by default. Rows with the
    same id and text are counted together and given back as often as they came; null ids are
    ids like others here. An empty frame gives an empty frame.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = file.read()
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), text_of(text).alias("text"))
    rows = rows.select(
        "doc_id", "text", F.octet_length("text").cast("bigint").alias("n_bytes"), F.xxhash64("text").alias("text_hash")
    )
    odd = PreTokens(definition).odd
    shared = spark.sparkContext.broadcast((definition, _frequent(rows, definition, odd)))

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        definition, known = shared.value
        own = PreTokens(definition, odd)
        columns: tuple[list, ...] = ([], [], [], [], [], [])

        def batch() -> pd.DataFrame:
            frame = pd.DataFrame(dict(zip(("doc_id", "text_hash", "n_bytes", "here", "pre", "times"), columns, strict=True)))
            frame = frame.astype({"doc_id": "Int64", "n_bytes": "Int64", "here": "Int64", "times": "Int64"})
            for c in columns:
                c.clear()
            return frame

        def put(*values) -> None:
            for column, value in zip(columns, values, strict=True):
                column.append(value)

        for frame in frames:
            ids = [None if pd.isna(i) else int(i) for i in frame["doc_id"]]
            for id_, text, size, hash_ in zip(ids, frame["text"], frame["n_bytes"], frame["text_hash"], strict=True):
                here, found = own.count(text)
                rest = []
                for pre, times in found.items():
                    n = known.get(pre)
                    if n is None:
                        rest.append((pre, times))
                    else:
                        here += n * times
                put(id_, hash_, size, here, None, None)
                for pre, times in rest:
                    put(id_, hash_, None, None, pre, times)
                if len(columns[0]) >= OUT_ROWS:
                    yield batch()
        if columns[0]:
            yield batch()

    parts = stage(
        rows.mapInPandas(
            split, "doc_id long, text_hash long, n_bytes long, here long, pre string, times long"
        ),
        "pre-tokens",
    )
    rare = parts.where(F.col("pre").isNotNull())

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = PreTokens(definition, odd)
        for frame in frames:
            yield frame.assign(pieces=own.pieces(list(frame["pre"])))

    pieces = rare.select("pre").distinct().mapInPandas(counted, "pre string, pieces long")
    joined = join_to_one(rare.select("doc_id", "text_hash", "pre", "times"), pieces, ["pre"], "inner")
    sums = joined.select("doc_id", "text_hash", F.lit(None).cast("bigint").alias("n_bytes"), (F.col("times") * F.col("pieces")).alias("n"))
    whole = parts.where(F.col("pre").isNull()).select("doc_id", "text_hash", "n_bytes", F.col("here").alias("n"))
    # Rows alike in id and text are summed together: m of them give m times the tokens.
    total = sums.unionByName(whole).groupBy("doc_id", "text_hash").agg(
        F.sum("n").alias("n"), F.count("n_bytes").alias("m"), F.max("n_bytes").alias("n_bytes")
    )
    each = total.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))))
    tokens = F.expr("n div m")
    return each.select(
        "doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit")
    )
