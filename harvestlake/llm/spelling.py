"""Spelling variants of words by a reduced alphabet.

Letters are hashed to a few symbols. Two words that differ by one edit have reduced forms that
differ by one edit or not at all, so every word generates the one-edit neighbourhood of its
reduced form, the neighbourhoods are joined with the reduced vocabulary, and what meets is
verified on the original strings. A pair is met from one of its ends only: a deletion by the
longer word (the shorter one's insertion is the same meeting), a replacement by the word with
the lower symbol, an unchanged form by the lesser word; the others of the full neighbourhood
would give each pair a second time.

Reduced forms are compared by a polynomial hash modulo 2**64, which gives each edit of a word
in one step from the hash of the word; the verification makes a collision harmless. So a run of
letters of any length costs as many keys as it has edits, not as many texts. Short words travel
with their keys; long ones travel as numbers and are fetched for the candidates only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlake.llm.common import stage, stop_if_missing
from harvestlake.operators.joins import join_to_one

#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Code points of a word that travels with each of its keys.
SHORT = 64
#: Rows of keys in one batch handed back to Spark.
BATCH_KEYS = 1 << 16
#: Letters of words, A-Z lower-cased.
_LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_KEYS = "key LONG, same BOOLEAN, wid LONG, word STRING, n LONG"


def symbol_table(symbols: int) -> np.ndarray:
    """Symbol (from 1) of each code point below 256."""
    return ((np.arange(256, dtype=np.uint64) * np.uint64(2654435761)) >> np.uint64(7)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _BASE, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _marked(hashes: np.ndarray, length: int) -> np.ndarray:
    return (hashes ^ np.uint64(length * 0xD6E8FEB86659FD93 & _MASK)).view(np.int64)


def _reduced(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of words of one length, and the powers that weigh them."""
    codes = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    return symbol_table(symbols)[codes].reshape(len(words), -1), _powers(len(words[0]))


def own_keys(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """Keys of the reduced forms of words of one length."""
    reduced, powers = _reduced(words, symbols)
    return _marked((reduced * powers).sum(axis=1, dtype=np.uint64), len(words[0]))


def edit_keys(words: list[str], symbols: int = SYMBOLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of words, keys) of the deletions and upward replacements of words of one length."""
    reduced, powers = _reduced(words, symbols)
    length = len(words[0])
    terms = reduced * powers
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    whole = before[:, -1:].copy()
    # Deleting one of several equal neighbours gives one form; the last of them counts.
    last = np.ones(reduced.shape, dtype=bool)
    last[:, :-1] = reduced[:, :-1] != reduced[:, 1:]
    deleted = before - terms + (whole - before) * np.uint64(_BACK)
    yield np.nonzero(last)[0], _marked(deleted[last], length - 1)
    for symbol in range(2, symbols + 1):
        lower = reduced < np.uint64(symbol)
        replaced = whole + (np.uint64(symbol) - reduced) * powers
        yield np.nonzero(lower)[0], _marked(replaced[lower], length)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        yield places, [words[i] for i in places]


def _with_own_key(symbols: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros(batch.num_rows, dtype=np.int64)
            for places, words in _by_length(batch.column("word").to_pylist()):
                keys[places] = own_keys(words, symbols)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], [*batch.schema.names, "key"])

    return run


def _neighbourhood(symbols: int, short: int):
    """Rows of ``_KEYS``; ``same`` marks the unchanged form, ``word`` is null in long words."""
    names = [part.split()[0] for part in _KEYS.split(", ")]

    def told(batch: pa.RecordBatch, rows: np.ndarray, keys: np.ndarray, same: bool, short_: bool):
        for at in range(0, len(rows), BATCH_KEYS):
            part = pa.array(rows[at : at + BATCH_KEYS])
            word = batch.column("word").take(part) if short_ else pa.nulls(len(part), pa.string())
            columns = [
                pa.array(keys[at : at + BATCH_KEYS]), pa.array(np.full(len(part), same)),
                batch.column("wid").take(part), word, batch.column("n").take(part),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                rows, keys = [], []
                for places, words in _by_length(batch.column("word").to_pylist()):
                    short_ = len(words[0]) <= short
                    if not short_:  # a word at a time: its keys may be many
                        for place, word in zip(places, words, strict=True):
                            yield from told(batch, np.array([place]), own_keys([word], symbols), True, False)
                            for which, found in edit_keys([word], symbols):
                                yield from told(batch, np.full(len(which), place), found, False, False)
                        continue
                    yield from told(batch, places, own_keys(words, symbols), True, True)
                    for which, found in edit_keys(words, symbols):
                        rows.append(places[which])
                        keys.append(found)
                if rows:
                    yield from told(batch, np.concatenate(rows), np.concatenate(keys), False, True)

    return run


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = 7, min_count: int = 2) -> DataFrame:
    """``word``, ``n``: the runs of letters of all texts with planted misspellings, and how often.

    A run is lower-cased in A-Z only. Where 31 divides the crc32 of ``<id>:<run>``, the code point
    at that number modulo the run's length is deleted. Words are the results of ``min_length``
    code points or more that occur ``min_count`` times or more. Null texts have no words, a null
    id is written as nothing. The count is partial before the exchange, so a frequent word
    leaves each task as one row.
    """
    stop_if_missing(docs, id_column, text)
    # Deleting shortens, so shorter runs can't become words.
    pattern = f"[{_LETTERS}]{{{min_length},}}"
    lowered = F.translate(F.col(f"`{text}`").cast("string"), _UPPER, _LOWER)
    runs = docs.select(
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))).alias("run"),
    )
    at = F.pmod(F.col("hash"), F.char_length("run")).cast("int")
    shortened = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
    words = (
        runs.withColumn("hash", F.crc32(F.concat_ws(":", "id", "run")))
        .withColumn("at", at)
        .select(F.when(F.col("hash") % 31 == 0, shortened).otherwise(F.col("run")).alias("word"))
        .where(F.char_length("word") >= min_length)
    )
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def near_words(words: DataFrame, symbols: int = SYMBOLS, short: int = SHORT) -> DataFrame:
    """``word``, ``near``, ``near_n``: every pair of words one edit apart, in both directions.

    ``words`` has distinct ``word`` (letters below U+0100 only, not empty) and ``n``. An edit
    inserts, deletes or replaces one code point. The numbered words are a table in the shared
    folder. Of a pair at least one end generates the reduced form of the other, so none is lost.
    """
    numbered = words.select(F.monotonically_increasing_id().alias("wid"), "word", F.col("n").cast("bigint").alias("n"))
    table = stage(
        numbered.mapInArrow(_with_own_key(symbols), "wid LONG, word STRING, n LONG, key LONG"), "vocabulary"
    )
    keys = table.select("wid", "word", "n").mapInArrow(_neighbourhood(symbols, short), _KEYS)
    other = table.select("key", F.col("wid").alias("wid2"), F.col("word").alias("word2"), F.col("n").alias("n2"))
    once = ~F.col("same") | (F.col("wid") < F.col("wid2"))
    one_edit = F.levenshtein("word", "word2", 1) == 1

    # Both words are short: their letters are there, so only links leave the join.
    near = keys.where(F.col("word").isNotNull()).join(
        other.where(F.char_length("word2") <= short), "key"
    ).where(once & one_edit).select("word", "n", "word2", "n2")
    # A long word meets the others as a number; a pair's other end may be one code point shorter.
    far = keys.where(F.col("word").isNull()).drop("word", "n").join(
        other.where(F.char_length("word2") >= short), "key"
    ).where(once).drop("key", "same")
    far = join_to_one(far, table.select("wid", "word", "n"), ["wid"], "inner").where(one_edit)
    links = near.unionByName(far.select("word", "n", "word2", "n2"))
    links = stage(links, "links")
    return links.select("word", F.col("word2").alias("near"), F.col("n2").alias("near_n")).unionByName(
        links.select(F.col("word2").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last form that forms lead to, for words that have a ``form``.

    A form is more frequent than its word by a factor, so there are no circles and chains are
    as short as the logarithm of the greatest count; each round doubles the steps taken.
    """
    state = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("_ahead"))
        joined = join_to_one(state, ahead, ["root"])
        moved = stage(joined.select("word", F.coalesce("_ahead", "root").alias("root"), F.col("_ahead").isNotNull().alias("moved")), "roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def variant_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = 7, min_count: int = 2,
    factor: int = 10, symbols: int = SYMBOLS, short: int = SHORT,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of ``vocabulary``.

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that
    is ``factor`` times the word's n at least, else null; the root is where forms end, the word
    itself if it has none. Rows repeated with the same id count as often as they occur. Texts
    without long runs and empty tables give no words.
    """
    words = stage(vocabulary(docs, id_column, text, min_length, min_count), "words")
    best = near_words(words, symbols, short).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    facts = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        (-F.col("best.minus")).alias("best_n"), F.col("best.near").alias("best"),
    )
    rises = F.col("best_n") >= factor * F.col("n")
    facts = stage(facts.select(
        "word", "n", "n_near", F.when(rises, F.col("best")).alias("form"), F.when(rises, F.col("best_n")).alias("form_n"),
    ), "forms")
    ends = roots(facts.where(F.col("form").isNotNull()))
    return facts.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
