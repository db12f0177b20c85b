"""The training-data operators against brute force, and at their edges."""

from __future__ import annotations

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestlake.llm import (
    exact_dedup,
    licences,
    mixing,
    near_dedup,
    quality,
    sentencepiece,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from harvestlake.llm.components import components
from harvestlake.llm.queries import tokenizer_path

# Columns whose names the operators would like to use themselves.
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING, kept STRING, Copies INT, row INT, mix INT"


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, None, s, None, "own", None, 1, 2, 3) for i, t, s in rows], SCHEMA
    )


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(60)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and ids, copies and near copies."""
    rng = random.Random(4)
    base = words(rng, 60)
    near = base.rsplit(" ", 1)[0] + " changed"
    rows = [
        (1, base, "a"), (2, base, "a"), (3, near, "b"), (3, near, "b"), (4, words(rng, 50), None),
        (5, None, "b"), (6, "", "b"), (None, base, "a"), (None, None, None), (7, "one", "c"), (8, "ONE", "c"),
        (9, " \t\n", "c"), (10, words(rng, 30_000), "c"), (10, words(rng, 20), "c"), (11, "two words", "a"),
    ]
    return rows, frame(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, []).limit(0)


def bag(rows):
    return Counter(tuple(r) for r in rows)


# exact dedup


def test_open_table_compares_texts_not_hashes():
    table = exact_dedup.OpenTable(4)
    for i in range(50):
        assert table.find(7, f"t{i}") == -1
        assert table.add(7, f"t{i}") == i
    assert [table.find(7, f"t{i}") for i in range(50)] == list(range(50))
    assert table.find(7, "none") == -1


@pytest.mark.parametrize("limit", [1 << 26, 300])
def test_exact_groups(odd, limit):
    rows, df = odd
    got = bag(exact_dedup.exact_groups(df, table_bytes=limit, chunk_bytes=limit).collect())
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    want = Counter()
    for i, t, _ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        want[(i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert got == want


@pytest.mark.parametrize("limit", [1 << 26, 300])
def test_drop_exact_copies_keeps_whole_rows(odd, empty, limit):
    rows, df = odd
    out = exact_dedup.drop_exact_copies(df, table_bytes=limit, chunk_bytes=limit)
    assert out.columns == df.columns
    kept = {r["text"] or "": r["doc_id"] for r in out.collect()}
    assert out.count() == len(kept) == len({t or "" for _, t, _ in rows})
    assert kept[rows[0][1]] == 2 and kept[""] == 6
    assert exact_dedup.drop_exact_copies(empty).collect() == []


def test_exact_dedup_spills_and_recurses(spark):
    rows = [(i, f"text {i % 200} " + "x" * 100, "s") for i in range(2000)]
    df = frame(spark, rows).repartition(3)
    got = exact_dedup.exact_groups(df, table_bytes=2000, chunk_bytes=1000)
    assert bag(got.select("doc_id", "keep_id", "group_size").collect()) == Counter(
        (i, 1800 + i % 200, 10) for i in range(2000)
    )


# near dedup


def brute_components(rows, n, percent):
    """rows: distinct (id, text); least id reachable over sets with enough overlap."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[k : k + n]) for k in range(len(w) - n + 1)])
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_groups_of_families(spark, monkeypatch):
    """Chains, near copies of copies, and many documents that share a long passage only."""
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = random.Random(9)
    rows, passage = [], words(rng, 60)
    for family in range(4):
        own = words(rng, 120).split()
        for _ in range(25):
            text = list(own)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
            if rng.random() < 0.4:
                own = text
    for _ in range(60):
        rows.append((len(rows), passage + " " + words(rng, rng.randrange(5, 30))))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "a b"), (len(rows) + 3, "A  b")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    for n in (4, 5):
        want = brute_components(rows, n, 80)
        got = near_dedup.near_groups(df, words=n).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_groups_at_the_edges(odd, empty):
    rows, df = odd
    got = near_dedup.near_groups(df, words=4).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    # null ids come before all others, so the copies of the base text belong to them
    assert {r["component_id"] for i in (1, 2, 3) for r in by_id[i]} == {None}
    assert all(not r["kept"] for i in (1, 2, 3) for r in by_id[i])
    assert by_id[5][0]["component_id"] == 5 and by_id[6][0]["component_id"] == 6 and by_id[6][0]["kept"]
    assert by_id[8][0]["component_id"] == 7 and by_id[9][0]["n_shingles"] == 0
    assert len(by_id[10]) == 2
    assert near_dedup.near_groups(empty).collect() == []
    out = near_dedup.drop_near_copies(df)
    assert out.columns == df.columns
    assert {4, 5, 6, 7, 9, 10, 11} <= {r["doc_id"] for r in out.collect()}
    assert near_dedup.drop_near_copies(empty).collect() == []


def exchanged(df) -> int:
    """Rows that the joins of an executed plan have exchanged."""

    def walk(node):
        name = node.nodeName()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else []
        children = node.children()
        below += [children.apply(i) for i in range(children.size())]
        own = node.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
        return own + sum(walk(x) for x in below)

    return walk(df._jdf.queryExecution().executedPlan())


def test_dropping_near_copies_exchanges_few_rows(spark):
    rng = random.Random(9)
    texts = [words(rng, 30) for _ in range(2000)]
    df = frame(spark, [(i, t, "x") for i, t in enumerate([*texts, *texts[:40]])])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = near_dedup.drop_near_copies(df)
        assert sorted(r["doc_id"] for r in out.collect()) == list(range(2000))
        assert exchanged(out) < 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_densified_signatures_estimate_the_overlap():
    signer = near_dedup.Signer(40, 6)
    rng = np.random.default_rng(1)
    for size in (8, 60, 2000):
        base = rng.integers(1, 1 << 63, size, dtype=np.uint64)
        other = base.copy()
        other[: size // 8] = rng.integers(1, 1 << 63, size // 8, dtype=np.uint64)
        truth = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
        assert abs(np.mean(signer.bins(base) == signer.bins(other)) - truth) < 0.15


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u LONG, v LONG")).collect()}
    want = {}
    for a, b in edges:
        want.setdefault(a, a), want.setdefault(b, b)
    for _ in range(500):
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_few_links_take_few_tasks(spark):
    """However many shuffle partitions there are, a few links are not dealt to as many files."""
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        edges = [(i, i + 1) for i in range(0, 200, 2)] + [(i, i + 1) for i in range(0, 200, 2)] + [(7, 9), (9, 7), (3, 3)]
        found = components(spark.createDataFrame(edges, "u LONG, v LONG"))
        assert len(found.inputFiles()) == 1
        assert found.where("node in (6, 8, 9)").agg({"component": "max"}).first()[0] == 6
        assert found.count() == 200
    finally:
        spark.conf.set(merge, "true")


def test_ids_stay_packed_until_they_are_compared(spark):
    """Ids go from the encoder to Spark as numbers of four bytes, without lists of them between."""
    path = tokenizer_path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        codec = sentencepiece.Codec(file.read(), 1)
    texts = ["one word", "", " two  words", "one word again"]
    packed = list(codec.encode_packed(texts))
    assert all(ids.dtype == np.int32 for ids in packed)
    assert [ids.tolist() for ids in packed] == list(codec.encode(texts))
    df = spark.createDataFrame(list(enumerate([*texts, None, texts[0]])), "doc_id LONG, text STRING").repartition(3)
    rows = {r["doc_id"]: r for r in sentencepiece.encode_documents(df, path).collect()}
    assert [rows[i]["piece_ids"] for i in range(6)] == [*map(list, codec.encode(texts)), [], rows[0]["piece_ids"]]
    assert all(r["piece_facts"]["n_pieces"] == len(r["piece_ids"]) and r["piece_facts"]["parity"] for r in rows.values())
    none = sentencepiece.encode_documents(df, path, verify_every=1 << 40).collect()
    assert all(r["piece_facts"]["parity"] is None and r["piece_facts"]["round_trip"] for r in none)


# mixing


def mixed(df, **options):
    return mixing.mix(df.select("doc_id", "text", "source"), block_tokens=50, **options)


def test_mixture_meets_its_targets(spark):
    sizes = {"big": 400, "mid": 80, "low": 20, None: 40}
    rows = [(i, "w " * 5, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = frame(spark, rows)
    share = {s: n / 540 for s, n in sizes.items()}
    goal = 0.9 * math.log(4)

    def entropy(a):
        z = sum(p**a for p in share.values())
        return -sum(p**a / z * math.log(p**a / z) for p in share.values())

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(mid) > goal else (low, mid)
    table = spark.createDataFrame([(p,) for p in share.values()], "share DOUBLE")
    assert abs(mixing.find_exponent(table, 0.9, None) - low) < 1e-9
    # the repetition limit wins: (p_max / p_min)^(1-a) = 3
    limit = 1 - math.log(3) / math.log(20)
    assert abs(mixing.find_exponent(table, 0.999, 3.0) - limit) < 1e-9

    out = mixed(df, entropy_share=0.9, max_repeats=None).collect()
    times = Counter(r["doc_id"] for r in out)
    for s, n in sizes.items():
        own = [times[i] for i, _, x in rows if x == s]
        owed = n * (share["big"] / share[s]) ** (1 - low)
        assert min(own) >= 1 and max(own) - min(own) <= 1
        assert 0 <= sum(own) - owed < 2
    # whole epochs contain every document, and each epoch has its own order
    first = {r["doc_id"]: r["mix"]["slot"] for r in out if r["mix"]["epoch"] == 0}
    assert len(first) == len(rows)
    second = {r["doc_id"]: r["mix"]["slot"] for r in out if r["mix"]["epoch"] == 1}
    both = sorted(second)
    assert sorted(both, key=first.get) != sorted(both, key=second.get)
    assert bag(map(str, out)) == bag(map(str, mixed(df.repartition(5), entropy_share=0.9, max_repeats=None).collect()))


def test_mixture_of_a_token_budget(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 5 == 0]) for i in range(300)]
    out = mixed(frame(spark, rows), entropy_share=None, max_repeats=None, budget=500).collect()
    # exponent 0: both sources owe half
    for s in "ab":
        spent = sum(r["mix"]["tokens"] for r in out if r["source"] == s)
        assert 250 <= spent < 250 + 7


def test_mixture_at_the_edges(odd, empty):
    rows, df = odd
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    # without a budget no row is left out
    assert not bag(df.select("doc_id", "source").collect()) - bag(out.select("doc_id", "source").collect())
    assert mixing.mixed_documents(empty).collect() == []


# SentencePiece


def test_pieces_are_those_of_the_library(odd, empty):
    import sentencepiece as library

    path = tokenizer_path("piece_bpe_32k.model")
    own = library.SentencePieceProcessor(model_file=path)
    rows, df = odd
    extra = [(100, "  two  spaces▁ and▁▁", "x"), (101, "é 🤗 日本\n\n\tq", "x"), (102, "<s> </s> <unk> <0x41>", "x")]
    df = df.unionByName(frame(df.sparkSession, extra))
    out = sentencepiece.encode_documents(df, path).collect()
    assert len(out) == len(rows) + 3
    for r in out:
        assert r["piece_ids"] == own.encode(r["text"] or "")
        assert r["piece_facts"]["parity"] and r["piece_facts"]["n_pieces"] == len(r["piece_ids"])
        assert r["piece_facts"]["round_trip"] == ("▁" not in (r["text"] or ""))
    back = sentencepiece.decode_documents(sentencepiece.encode_documents(df, path, verify_every=1000), path)
    assert all(r["decoded"] == (r["text"] or "").replace("▁", " ") for r in back.select("text", "decoded").collect())
    assert sentencepiece.encode_documents(empty, path).collect() == []


def test_different_words_are_encoded_once(monkeypatch):
    import sentencepiece as library

    path = tokenizer_path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        codec = sentencepiece.Codec(file.read(), 1)
    own = library.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    odd = ["", " ", "a", "two  spaces", " led", "trailed ", "mar\u2581ked", "\u2581", "tab\tand\nline", "é 🤗 日本", "\x00 \u200b", "x" * 300]
    texts = [" ".join(rng.choices(["the", "interviewing", "ß🏠", "<s>", "-", "\n", "Ab1"], k=rng.randrange(1, 40))) for _ in range(200)]
    texts = rng.sample(texts + odd, k=len(texts) + len(odd))
    monkeypatch.setattr(sentencepiece, "WORD_BATCH_CHARS", 900)
    given, whole = [], codec._encode_whole
    monkeypatch.setattr(codec, "_encode_whole", lambda t: given.extend(t) or whole(t))
    want = want_of(own, texts)
    assert list(codec.encode(texts)) == want
    assert sum(map(len, given)) < sum(map(len, texts)) / 4
    monkeypatch.setattr(sentencepiece, "KNOWN_WORDS", 2)  # forgets at every batch
    assert list(codec.encode(texts)) == want and list(codec.encode(odd[:2])) == want_of(own, odd[:2])


def want_of(own, texts):
    return [own.encode_as_ids(t) for t in texts]


def test_unigram_model_is_rebuilt():
    """A unigram model written by hand: scores decide, unknown characters fall back to bytes."""

    def varint(n):
        out = b""
        while True:
            out, n = out + bytes([n & 127 | (128 if n > 127 else 0)]), n >> 7
            if not n:
                return out

    def field(number, kind, body):
        return varint(number << 3 | kind) + (varint(len(body)) + body if kind == 2 else body)

    def piece(text, score, kind):
        return field(1, 2, field(1, 2, text.encode()) + field(2, 5, np.float32(score).tobytes()) + field(3, 0, varint(kind)))

    pieces = [("<unk>", 0, 2), *[(f"<0x{b:02X}>", -20, 6) for b in range(256)]]
    pieces += [("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.0, 1), ("ab", -2.5, 1), ("▁ab", -2.6, 1), ("aba", -9.0, 1)]
    data = b"".join(piece(*p) for p in pieces)
    data += field(2, 2, field(3, 0, varint(1)) + field(35, 0, varint(1)))
    data += field(3, 2, field(1, 2, b"identity") + field(3, 0, varint(1)) + field(4, 0, varint(1)))
    codec = sentencepiece.Codec(data, 1)
    texts = ["ab aba", "  ab   b ", "", "aé", "b" * 50]
    ids = list(codec.encode(texts))
    assert all(codec.same_as_library(t, i) for t, i in zip(texts, ids, strict=True))
    assert codec.decode(ids)[0] == "ab aba"


# token counts


def test_token_counts_are_those_of_the_library(odd, empty, monkeypatch):
    from tokenizers import Tokenizer

    # hardly any pre-token is sent along, so nearly all go through the join
    monkeypatch.setattr(token_counts, "VOCABULARY", 3)
    path = tokenizer_path("word_bpe_49k.json")
    rows, df = odd
    extra = [(100, "Don't <|endoftext|>STOP<|startoftext|> İstanbul ǅ 12345 foo_bar  x", "x"), (101, "<|endoftext|>", "x")]
    got = token_counts.token_counts(df.unionByName(frame(df.sparkSession, extra)), path, limit=40).collect()
    own = Tokenizer.from_file(path)
    want = Counter()
    for i, t, _ in [*rows, *extra]:
        n = len(own.encode(t or "", add_special_tokens=False).ids)
        want[(i, len((t or "").encode()), n, n > 40)] += 1
    assert bag(got) == want
    assert token_counts.token_counts(empty, path).collect() == []


# quality and toxicity


def test_rules_compile_to_what_they_say(spark):
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.5)).astype(float)
    ensemble = quality.fit_rules(x, y, ["a", "b", "c"])
    assert 0 < len(ensemble.rules) < 60
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a DOUBLE, b DOUBLE, c DOUBLE")
    got = [r[0] for r in df.select(ensemble.column({n: F.col(n) for n in "abc"})).collect()]
    logit = ensemble.intercept + sum(w * quality.holds(r, x) for r, w in ensemble.rules)
    logit = logit + sum(w * np.clip(x[:, k], lo, hi) for k, w, lo, hi in ensemble.linear)
    assert np.allclose(got, 1 / (1 + np.exp(-logit)))
    assert np.mean((np.array(got) > 0.5) == (y == 1)) > 0.95


def test_non_negative_risk_finds_the_hidden_positives():
    rng = np.random.default_rng(3)
    truth = rng.random(3000) < 0.2
    x = (rng.random((3000, 6)) < np.where(truth[:, None], [0.9, 0.8, 0.5, 0.3, 0.5, 0.4], [0.02, 0.05, 0.5, 0.3, 0.5, 0.4])).astype(np.float32)
    known = truth & (rng.random(3000) < 0.3)
    w, b = toxicity.fit_pu(x[known], x, 0.2)
    assert np.mean(((x @ w + b) > 0) == truth) > 0.93


@pytest.mark.parametrize("name,column,fold_of,held", [("op8_toxicity", "toxic", 4, 2), ("op4_quality", "quality", 5, 0)])
def test_held_out_accuracy(spark, name, column, fold_of, held):
    import zlib

    from harvestlake.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % fold_of == held) for r in rows)
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in tested]) > 0.85


def test_classifiers_at_the_edges(odd, empty):
    rows, df = odd
    spark = df.sparkSession
    labels = spark.createDataFrame(
        [(i, i % 2, int(i == 7)) for i in range(12)] + [(None, 1, 1), (3, None, None)], "doc_id LONG, quality INT, toxic INT"
    )
    out = toxicity.drop_toxic(df, labels)
    assert out.columns == df.columns
    assert toxicity.drop_toxic(empty, labels).collect() == []
    assert toxicity.drop_toxic(df, labels.limit(0)).count() == len(rows)
    for known in (labels, labels.limit(0)):
        scored = quality.score_quality(df, quality.fit_quality(df, known), "quality_score")
        assert scored.columns == [*df.columns, "quality_score"]
        assert all(0 <= r["quality_score"] <= 1 for r in scored.collect())
    assert quality.score_quality(empty, quality.fit_quality(empty, labels), "s").collect() == []


def test_toxic_documents_go_and_clean_ones_stay(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(400):
        text = words(rng, 40)
        if i % 8 == 0:
            text += " you vilebeast " + words(rng, 5) + " grimfool"
        docs.append((i, text, "s"))
        if i // 8 % 2 == 0:
            labels.append((i, int(i % 8 == 0)))
    out = toxicity.drop_toxic(frame(spark, docs), spark.createDataFrame(labels, "doc_id LONG, toxic INT"))
    assert {r["doc_id"] for r in out.collect()} == {i for i in range(400) if i % 8}


# licences


def test_licence_paragraphs(spark, odd, empty):
    rng = random.Random(6)
    docs = [(i, words(rng, 40), "s") for i in range(50)]
    lines = {
        60: ("x\nReleased under the MIT License.\ny", "mit"),
        61: ("Licensed under the Apache License, Version 2.0.", "apache"),
        62: (words(rng, 30) + "\n\nThis work is licensed under the GNU General Public License, version 3.", "gpl"),
        63: ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        64: ("LICENSED UNDER CC BY 4.0.", "cc-by"),
        65: ("You need a driving license to rent a car.", None),
    }
    df = frame(spark, docs + [(i, t, "s") for i, (t, _) in lines.items()]).unionByName(odd[1])
    model = licences.fit_licences(df)
    out = licences.scan(df, model)
    assert out.columns == [*df.columns, "licences"] and out.count() == df.count()
    found = {r["doc_id"]: [p["family"] for p in r["licences"] if p["confirmed"]] for r in out.collect()}
    for i, (_, family) in lines.items():
        assert found[i] == ([family] if family else [])
    assert not any(found[i] for i, _, _ in docs)
    # the column says what the model says
    grams = licences.grams_of(lines[61][0])
    z = model.logits(grams) / model.temperature
    p = np.exp(z - z.max())
    got = next(r for r in out.where("doc_id = 61").collect())["licences"][0]
    assert abs(got["probability"] - (p / p.sum()).max()) < 1e-9
    assert licences.scan(empty, model).collect() == []


def confirmed(spark, texts):
    """Families that the scan confirms in each text."""
    rng = random.Random(7)
    docs = [(100 + i, words(rng, 40), "s") for i in range(50)]
    df = frame(spark, docs + [(i, t, "s") for i, t in enumerate(texts)])
    rows = licences.scan(df, licences.fit_licences(df)).where("doc_id < 100").collect()
    found = {r["doc_id"]: sorted(p["family"] for p in r["licences"] if p["confirmed"]) for r in rows}
    return [found[i] for i in range(len(texts))]


def test_licences_in_other_words(spark):
    lines = {
        "All rights reserved.": "proprietary",
        "© 2021 Acme. All rights reserved.": "proprietary",
        "Copyright (c) 1998-2003 Jo Doe, all rights reserved": "proprietary",
        "This file is licensed under the Apache License, Version 2.0.": "apache",
        "The whole project is released under the MIT license": "mit",
        "The tool is licensed under the GNU General Public License, version 3 or later.": "gpl",
        "It is licensed under the GNU Lesser General Public License, version 3.": "lgpl",
        "All of it is released under the BSD 2-Clause License.": "bsd",
        "The module is licensed under the Mozilla Public License, version 2.0": "mpl",
        "This article is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
        "Pictures are licensed under CC BY-NC 4.0": "cc-by-nc",
        "Text licensed under CC BY-SA 4.0, pictures too": "cc-by-sa",
        "The editor has waived all copyright and related rights to this work.": "public-domain",
        "Some rights reserved.": None,
        "All rights to the song were sold.": None,
    }
    assert confirmed(spark, list(lines)) == [[f] if f else [] for f in lines.values()]


def test_licences_over_lines_and_several_in_one(spark):
    gpl = """
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version."""
    lgpl = """
# This library is free software; you can redistribute it and/or
# modify it under the terms of the GNU Lesser General Public
# License as published by the Free Software Foundation; either
# version 2.1 of the License, or (at your option) any later version."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
    rng = random.Random(8)
    texts = {
        gpl: ["gpl"],
        lgpl: ["lgpl"],
        bsd: ["bsd"],
        words(rng, 200) + "\n" + bsd + "\n" + words(rng, 70) + gpl + "\n" + words(rng, 90): ["bsd", "gpl"],
        bsd.replace(" ", "\n"): ["bsd"],
        "Released under the MIT License. Pictures are licensed under CC BY 4.0.": ["cc-by", "mit"],
        "Licensed under either the Apache License, Version 2.0 or the MIT license.": ["apache", "mit"],
        "Licensed under the Apache License,\nVersion 2.0.\n" + words(rng, 40) + "\nAll rights reserved.": ["apache", "proprietary"],
    }
    assert confirmed(spark, list(texts)) == list(texts.values())


def test_licence_scan_is_native(odd):
    out = licences.scan(odd[1], licences.fit_licences())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


# SimHash


def test_fingerprints_vote(odd, empty):
    rows, df = odd
    got = {(r["doc_id"], r["text"]): r["fingerprint"] for r in simhash.fingerprints(df, ["doc_id", "text"]).collect()}
    spark = df.sparkSession
    for (_, text), value in got.items():
        terms = (text or "").lower().split()
        pairs = list(zip(terms, terms[1:], strict=False)) if len(terms) != 1 else [(terms[0], None)]
        if len(pairs) > 1000:
            continue
        votes = [0] * 64
        if pairs:
            table = spark.createDataFrame(pairs, "a STRING, b STRING").select("a", "b", F.xxhash64("a", "b").alias("h"))
            for r in table.collect():
                for j in range(64):
                    votes[j] += (len(r["a"]) + len(r["b"] or "")) * (1 if r["h"] >> j & 1 else -1)
        assert value & (1 << 64) - 1 == sum(1 << j for j in range(64) if votes[j] > 0)
    assert simhash.edited_likeness(empty).collect() == []


def test_edited_likeness(odd):
    rows, df = odd
    got = simhash.edited_likeness(df).collect()
    assert len(got) == len(rows)
    hashed = {(r["doc_id"], r["edited_sha256"]) for r in got}
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, set()).add(t or "")
    ids = sorted(i for i in texts if i is not None)
    for i, t, _ in rows:
        t = t or ""
        quarter = len(t) // 4
        after = ids[(ids.index(i) + 1) % len(ids)] if i is not None else None
        starts = {x[:quarter] for x in texts[after]} if after is not None else {""}
        edits = {(i, hashlib.sha256((t[: len(t) - quarter] + s).encode()).hexdigest()) for s in starts}
        assert edits & hashed
    assert {r["near_next"] is None for r in got if r["doc_id"] is None} == {True}


def test_neighbours_within_a_radius(spark):
    rng = random.Random(8)
    values = [rng.getrandbits(64) for _ in range(300)]
    for v in values[:100]:
        for _ in range(3):
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                v ^= 1 << bit
            values.append(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed + signed[:50] + [None]], "fingerprint LONG")
    asked = spark.createDataFrame([(v,) for v in signed[:120]], "fingerprint LONG")
    for radius in (0, 3):
        got = {tuple(r) for r in simhash.neighbours(asked, df, radius, 6).collect()}
        want = {
            (a, b, d) for a in set(signed[:120]) for b in set(signed)
            if a != b and (d := ((a ^ b) & (1 << 64) - 1).bit_count()) <= radius
        }
        assert got == want


# WARC


def test_archive_round_trip(spark):
    pages = [
        (1, "http://www.Example.com:80/a?x=1", "<p>é</p>"), (2, "https://example.com/b", "<p>é</p>"),
        (3, None, None), (4, "http://b.org/", ""), (5, "http://b.org/", "x" * 100_000), (5, "http://b.org/", "x" * 100_000),
        (None, "not a url at all\r\n", "y"), (None, "http://[bad", "<p>é</p>"), (6, "http://b.org/ü ü", "\r\n\r\nz"),
    ] + [(100 + i, "http://hot.org/", f"p{i % 5}") for i in range(60)]
    df = spark.createDataFrame(pages, "page_id LONG, url STRING, html STRING").withColumn("key", F.lit(1)).withColumn("file", F.lit("f"))
    got = bag(warc.archive_round_trip(df, block_lines=7).collect())
    first, want = {}, Counter()
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    for i, _, h in pages:
        data = (h or "").encode()
        own = first.get(h or "", i)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[(i, len(data), digest, "response" if own == i else "revisit", None if own == i else own)] += 1
    assert got == want
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_lookup_finds_what_is_there(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i % 50}.org/p{i % 400}", f"<b>{i}</b>") for i in range(2000)], "page_id LONG, url STRING, html STRING")
    captures = warc.write_archives(pages, f"{tmp_path}/a")
    shards = warc.build_index(captures, f"{tmp_path}/i", block_lines=16)
    asked = [warc.url_key(u) for u in ("http://h7.org/p7", "http://h7.org/none", "http://zzz.org/", "HTTPS://H0.org/p0")]
    found = warc.lookup(spark.createDataFrame([(k,) for k in asked], "key STRING"), shards)
    assert sorted(r["page_id"] for r in found.collect()) == sorted(i for i in range(2000) if i % 400 in (0, 7))
    records = warc.read_records(found).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in records} == {r["page_id"]: f"<b>{r['page_id']}</b>" for r in records}


def test_url_keys():
    assert warc.url_key("http://www.example.com/a?b=1") == "com,example,www)/a?b=1"
    assert warc.url_key("https://user@Example.com:8443") == "com,example:8443)/"
    assert warc.url_key(None) == ""
