"""Repeated rows and ids, deep Grace levels, odd characters, byte tables."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from harvestlake.llm import exact_dedup, mixing, near_dedup, sentencepiece, token_counts, warc
from harvestlake.llm.queries import tokenizer_path

SCHEMA = "doc_id LONG, text STRING, source STRING"


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta".split()) + str(rng.randrange(60)) for _ in range(n))


def test_a_source_of_repeated_rows_pays_what_it_owes(spark):
    """6,000 equal rows and 100 others under a budget that isn't a multiple of an epoch."""
    rows = [(1, "one two three", "a")] * 6000 + [(i, "four five six", "b") for i in range(2, 102)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for budget in (3000, 40_000):
        out = mixing.mix(docs, budget=budget, entropy_share=0.0, max_repeats=None, block_tokens=500)
        paid = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum("mix.tokens").alias("n")).collect()}
        for source, tokens in (("a", 18_000), ("b", 300)):
            owed = round(budget * tokens / 18_300)
            assert owed <= paid[source] < owed + 3, (budget, source)
        blocks = out.where("source = 'a'").select("mix.block").distinct().count()
        assert blocks > 1, "equal rows are dealt to several blocks"


def test_some_repeated_rows_among_others(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, rng.randrange(1, 20)), rng.choice("abc")) for i in range(60)]
    rows += [rows[3]] * 4 + [rows[7]] * 2 + [(None, None, None)] * 3
    docs = spark.createDataFrame(rows, SCHEMA)
    got = Counter(map(tuple, mixing.mixed_documents(docs, entropy_share=0.0, max_repeats=None).collect()))
    assert got == Counter(rows), "the natural mixture gives each row once"


def test_one_row_of_each_group_when_ids_repeat(spark):
    rng = random.Random(2)
    a, b, c = (words(rng, 80) for _ in range(3))
    near_a, near_b = (t.rsplit(" ", 1)[0] + " other" for t in (a, b))

    def kept(rows):
        docs = spark.createDataFrame(rows, SCHEMA)
        return sorted(map(tuple, near_dedup.drop_near_copies(docs).collect()), key=str)

    assert kept([(1, a, "s"), (3, near_a, "s"), (3, b, "s")]) == [(1, a, "s"), (3, b, "s")]
    assert len(kept([(3, a, "s"), (3, near_a, "s"), (4, near_b, "s"), (4, c, "s")])) == 3
    assert len(kept([(None, a, "s"), (None, near_a, "s"), (None, a, "t")])) == 1
    assert kept([(5, a, "s"), (5, a, "t"), (6, a, "s")]) in ([(5, a, "s")], [(5, a, "t")])
    assert len(kept([(7, "", "s"), (7, "", "s"), (8, None, "s")])) == 3, "texts without words all stay"


@pytest.fixture
def levels(monkeypatch):
    made = []
    put = exact_dedup.scratch_path
    monkeypatch.setattr(exact_dedup, "scratch_path", lambda spark, name: made.append(name) or put(spark, name))
    return made


def test_more_texts_add_no_levels(spark, levels):
    """The fan-out grows with the bytes: levels and rewritten rows don't grow with the texts."""
    counts = []
    for n in (400, 800, 1600):
        rng = random.Random(n)
        docs = spark.createDataFrame([(i, words(rng, 120), "s") for i in range(n)] + [(n, None, "s")], SCHEMA)
        levels.clear()
        kept = exact_dedup.distinct_texts(docs, "text", "doc_id", ["doc_id", "text"], table_bytes=20_000)
        assert kept.count() == docs.select("text").distinct().count()
        counts.append(len(levels))
    assert counts[0] <= 3 and all(b <= a + 1 for a, b in zip(counts, counts[1:], strict=False)), counts


def test_a_text_larger_than_a_table(spark, levels):
    rng = random.Random(9)
    long_ = [words(rng, 5000) for _ in range(6)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(long_ * 3)], SCHEMA)
    kept = exact_dedup.distinct_texts(docs, "text", "doc_id", ["doc_id", "text"], table_bytes=1000)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(12, 18))


def test_random_characters_count_as_in_the_library(spark):
    """Characters of all of Unicode, many of them known to one library's tables only."""
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        library = Tokenizer.from_str(file.read())
    library.no_truncation()
    library.no_padding()
    rng = random.Random(12)
    known = "₏₝֋꭬\U00016ea9\U00018fd5\U0001266b🏠'’sſ 1é\n\t¹½中"

    def character():
        if rng.random() < 0.6:
            return rng.choice(known)
        code = rng.randrange(0x110000)
        return chr(code) if not 0xD800 <= code < 0xE000 and code else "x"

    texts = ["🏠₏", *("".join(character() for _ in range(rng.randrange(1, 9))) for _ in range(3000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, path).collect()}
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert got == want


def test_byte_table_agrees_with_the_decoder():
    """Round trips by bytes against the library's decoded text: byte pieces, markers, spaces."""
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        codec = sentencepiece.Codec(file.read(), 1)
    rng = random.Random(5)
    texts = ["", " ", "  two  spaces ", "▁marker ▁", "\U0001fae0 🏴‍☠️ \x01\x7f", "<0x41> <unk> </s>", " leading"]
    texts += ["".join(chr(rng.choice([32, 65, 233, 9601, 0x4E2D, rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(12)) for _ in range(500)]
    ids = list(codec.encode(texts))
    agreed = [codec.round_trip(t, i) for t, i in zip(texts, ids, strict=True)]
    assert agreed == [t == back for t, back in zip(texts, codec.decode(ids), strict=True)]
    assert any(agreed) and not all(agreed)
    broken = [codec.bytes.index(bytes([0xC3])), codec.bytes.index(bytes([0x28]))]
    assert not codec.round_trip("é", broken)


def test_records_are_read_by_as_many_tasks_as_their_bytes_ask_for(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", f"<p>{i}" * 50) for i in range(60)], "page_id LONG, url STRING, html STRING")
    monkeypatch.setattr(warc, "READ_BYTES", 2000)
    captures = warc.write_archives(pages, warc.scratch_path(spark, "archive"))
    size = captures.agg(F.sum("length")).first()[0]
    records = warc.read_records(captures)
    assert records.count() == 60
    tasks = records.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > math.ceil(size / 2000) / 3
