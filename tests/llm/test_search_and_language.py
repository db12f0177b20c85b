"""Hard negatives, spelling variants and language labels against brute force, and at their edges."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestlake.llm import hard_negatives, language, spelling

VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, rank INT, anchor STRING"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "own") for i, v, label in rows], VECTORS)


def mined_by_hand(rows, n_positives=5, n_negatives=10):
    taken = []
    for number, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken.append((number, i, [math.floor(256 * float(np.float32(x))) for x in v], label))

    def first(found):
        return sorted(found, key=lambda s: (-s[0], s[1] is None, s[1] if s[1] is not None else 0))

    out = Counter()
    for number, anchor, a, label in taken:
        if anchor is None or anchor % 100:
            continue
        scored = [
            (sum(p * q for p, q in itertools.zip_longest(a, v, fillvalue=0)), i, own == label)
            for other, i, v, own in taken if other != number
        ]
        for score, positive, _ in first(s for s in scored if s[2])[:n_positives]:
            inside = first(s for s in scored if not s[2] and 30 * score <= 100 * s[0] <= 90 * score)
            for rank, (s, i, _) in enumerate(inside[:n_negatives], 1):
                out[anchor, positive, rank, i, score, s] += 1
    return out


def as_counter(df):
    return Counter(map(tuple, df.collect()))


def mined(spark, rows, **options):
    frame = hard_negatives.prepared(vector_frame(spark, rows))
    return as_counter(hard_negatives.mine(frame, frame.where("vec_id % 100 = 0"), **options))


@pytest.mark.parametrize("group_bytes", [1, 4 << 20])
def test_hard_negatives_against_brute_force(spark, group_bytes):
    """Ties, repeated rows and ids, nulls, odd values, unequal lengths; one cell and several."""
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(700):
        label = rng.randrange(4)
        v = [round(c + rng.gauss(0, 0.4), 1) for c in centres[label]]
        rows.append((i, v, label))
    rows += [rows[100], rows[200], rows[200], (300, rows[301][1], 2), (None, rows[5][1], 1), (None, rows[6][1], 0)]
    rows += [(800, None, 1), (900, [1.0, None], 1), (1000, [float("nan")] * 6, 1), (1100, [float("inf")] * 6, 0)]
    rows += [(1200, [1.0, 2.0], None), (1300, [1.0, -0.5], 1), (1301, [], 2), (1400, [], 2)]
    assert mined(spark, rows, group_bytes=group_bytes) == mined_by_hand(rows)


def test_hard_negatives_of_great_values_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1.0, -1.0]) * 2.0 ** rng.randrange(18, 22) for _ in range(8)], i % 2) for i in range(120)]
    assert mined(spark, rows) == mined_by_hand(rows)


def test_hard_negatives_of_empty_tables(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(1, [1.0], 1)]), "no anchor"
    assert not mined(spark, [(0, [1.0], 1), (100, [1.0], 2)]), "no positive"


def test_spanning_tree_bounds_skip_rows_and_lose_none():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8)) * 400
    x = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(1200, 8)) * 5)
    labels = np.repeat(np.arange(6), 200)
    anchors = np.arange(0, 1200, 40)
    work = hard_negatives.HardNegatives(8, 1.0, 5, 10, 30, 90)
    edges = hard_negatives.spanning_tree(x[anchors])
    assert sorted(e[0] for e in edges) == list(range(len(anchors))) and sum(e[1] < 0 for e in edges) == 1
    windows = [[int(x[a] @ x[a])] for a in anchors]
    scored = 0
    for j, known, exact in work.scores_along_tree(x, labels, x[anchors], labels[anchors], windows):
        scored += len(known)
        scores = x @ x[anchors[j]]
        top = windows[j][0]
        wanted = np.flatnonzero((labels != labels[anchors[j]]) & (30 * top <= 100 * scores) & (100 * scores <= 90 * top))
        assert set(wanted) <= set(known.tolist()) and (exact == scores[known]).all()
    assert scored < 0.5 * len(x) * len(anchors), "bounds spare most scores of clustered rows"


LETTERS = "abcdeéñüß×÷"


def words_by_hand(rows):
    import re

    count = Counter()
    for i, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


def is_near(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    if abs(len(u) - len(v)) != 1:
        return False
    u, v = sorted((u, v), key=len)
    return any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def groups_by_hand(words):
    out, forms = {}, {}
    for w, n in words.items():
        near = [v for v in words if is_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
        out[w] = [forms[w], None, n, len(near), words[forms[w]] if forms[w] else None]
    for w in out:
        root = w
        while forms[root]:
            root = forms[root]
        out[w][1] = root
    return {(w, *v) for w, v in out.items()}


def spelled(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(6, 11))) for _ in range(25)]
    rows = []
    for i in range(200):
        text = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.25)), len(base) - 1)]
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(LETTERS) + w[at:], w[:at] + rng.choice(LETTERS) + w[at + 1 :]])
            text.append(w if rng.random() < 0.9 else w.upper())
        rows.append((i, rng.choice([" ", "1", "–", "'"]).join(text)))
    long_ = "".join(rng.choice(LETTERS) for _ in range(3000))
    rows += [(500, long_ + " " + long_[:900] + "x" + long_[900:]), (501, long_), (502, long_[:900] + "x" + long_[900:])]
    rows += [(503, long_[:64] + " " + long_[:65] + " " + long_[:66]), (504, long_[:64] + " " + long_[:65] + " " + long_[:66])]
    rows += [(600, None), (601, ""), (602, "12 – 34 Ωμέγα"), (None, base[0] * 2), (None, base[0] * 2), rows[3], rows[3]]
    frame = spark.createDataFrame([(i, t, 1, 2, "own") for i, t in rows], "doc_id LONG, text STRING, n INT, word INT, root STRING")
    return rows, frame


@pytest.mark.parametrize("symbols, short", [(8, 64), (2, 8)])
def test_spelling_against_brute_force(spark, symbols, short):
    """All pairs of words by hand, with long runs, letters beyond ASCII, repeated rows and null ids."""
    rows, frame = spelled(spark)
    found = spelling.variant_groups(frame, symbols=symbols, short=short)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    words = words_by_hand(rows)
    expected = groups_by_hand(words)
    assert len(words) > 500 and sum(e[1] is not None for e in expected) > 20
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_forms_lead_to_the_last(spark):
    """A chain of misspellings of misspellings."""
    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk"]
    forms = spark.createDataFrame(list(itertools.pairwise(chain)), "word STRING, form STRING")
    assert sorted(map(tuple, spelling.roots(forms).collect())) == [(w, chain[-1]) for w in chain[:-1]]


def test_spelling_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert spelling.variant_groups(empty).count() == 0
    one = spark.createDataFrame([(1, "something once")], "doc_id LONG, text STRING")
    assert spelling.variant_groups(one).count() == 0, "no word occurs twice"


def best_value(scores, switch):
    value = scores[0].copy()
    for row in scores[1:]:
        value = np.maximum(value, value.max() - switch) + row
    return value.max()


def value_of(path, scores, switch):
    return scores[np.arange(len(path)), path].sum() - switch * np.count_nonzero(np.diff(path))


@pytest.mark.parametrize("block", [1, 4, 64])
def test_paths_are_the_best(block):
    """The value of each path against the plain recursion, texts of any length together."""
    rng = np.random.default_rng(1)
    texts = [-rng.integers(0, 9, size=(n, 3)).astype(float) for n in (0, 1, 3, 64, 65, 200, 5)]
    for switch in (0.0, 2.0, 15.0, 1e6):
        paths = language.best_path(texts, switch, block)
        for scores, path in zip(texts, paths, strict=True):
            assert len(path) == len(scores)
            if len(scores):
                assert value_of(path, scores, switch) == pytest.approx(best_value(scores, switch))


EN = "the quick brown fox jumps over the lazy dog while the other dogs were sleeping there with their friends"
DE = "der schnelle braune fuchs springt über den faulen hund und die anderen hunde schlafen dort mit freunden"
EL = "η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και τα άλλα σκυλιά κοιμούνται εκεί"


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(6)

    def some(text, n):
        return " ".join(rng.choice(text.split()) for _ in range(n))

    learned = [(i, some(t, 40), name) for i, (name, t) in enumerate([("en", EN), ("de", DE), ("el", EL)] * 30)]
    learned += [(None, "nothing", "xx"), (900, None, "yy"), (901, "no language", None), learned[0]]
    docs = spark.createDataFrame(
        [(i, t, lang, 5, "own") for i, t, lang in learned], "doc_id LONG, text STRING, lang STRING, language INT, score STRING"
    )
    return docs, language.fit_languages(docs)


def test_mixed_texts_are_cut_into_spans(spark, mixed):
    docs, model = mixed
    assert model.languages == ["de", "el", "en"]
    assert model.scripts == {"latin": [0, 2], "greek": [1]}
    texts = [
        EN + ". " + DE, EL + "! " + EN, EN, None, "", "12 ² ½ – ①", "шесть слов", EN + " " + " ".join([DE] * 3000), "日本語", "x" * 100_000,
    ]
    rows = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id LONG, text STRING, scores STRING")
    told = {r["doc_id"]: r["language"] for r in language.label_documents(rows, model).collect()}
    spans = [(s["lang"], texts[0][s["begin"] : s["end"]]) for s in told[0]["spans"]]
    assert spans == [("en", EN), ("de", DE)]
    assert [(s["lang"], texts[1][s["begin"] : s["end"]]) for s in told[1]["spans"]] == [("el", EL), ("en", EN)]
    assert told[2]["lang"] == "en" and told[2]["score"] == 1.0 and len(told[2]["spans"]) == 1
    for i in (3, 4, 5):
        assert tuple(told[i]) == ("und", 0.0, [])
    assert told[6]["score"] == told[8]["score"] == 0.0 and told[6]["lang"] in model.languages
    assert told[7]["lang"] == "de" and [s["lang"] for s in told[7]["spans"]] == ["en", "de"]
    assert 0.0 <= told[9]["score"] <= 1.0 and told[9]["lang"] in model.languages


def test_word_scores_by_hand(spark, mixed):
    """Counts, likelihoods and candidates of one word from the texts themselves."""
    import re

    docs, model = mixed
    counts = {lang: Counter() for lang in model.languages}
    for row in docs.where("doc_id is not null and text is not null and lang is not null").distinct().collect():
        for word, n in Counter(re.findall(r"\w+", row["text"].lower())).items():
            for size in language.SIZES:
                marked = f"<{word}>"
                for at in range(len(marked) - size + 1):
                    counts[row["lang"]][marked[at : at + size]] += min(n, 3)
    every = set().union(*counts.values())
    logs = dict.fromkeys(model.languages, 0.0)
    for size in language.SIZES:
        grams = {g for g in every if len(g) == size}
        for lang, own in counts.items():
            total = sum(own[g] + 0.5 for g in grams)
            for at in range(len("<there>") - size + 1):
                gram = "<there>"[at : at + size]
                if gram in grams:
                    logs[lang] += math.log((own[gram] + 0.5) / total) / (len(language.SIZES) + 1)
    best = max(logs["en"], logs["de"])
    expected = [max(logs["de"] - best, -language.MOST), -language.MOST, max(logs["en"] - best, -language.MOST)]
    scores, known = model.score_words(["There", "шесть"])
    assert scores[0].tolist() == pytest.approx(expected) and known.tolist() == [True, False]
    assert scores[1].tolist() == [0.0, 0.0, 0.0]


def test_no_language_is_learned_from_nothing(spark, mixed):
    docs, _ = mixed
    for nothing in (docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        model = language.fit_languages(nothing)
        told = language.label_documents(docs, model).select("language.*")
        assert {(r["lang"], r["score"], len(r["spans"])) for r in told.collect()} == {("und", 0.0, 0)}


def test_held_out_rows_teach_nothing(spark, mixed):
    docs, _ = mixed
    without = language.fit_languages(docs, F.col("doc_id") % 3 == 2)
    assert without.languages == ["de", "en"] and "greek" not in without.scripts


def test_languages_of_held_out_documents(spark):
    """Accuracy on documents that were not learned from."""
    from harvestlake.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    told = QUERIES["op13_language"](spark, sf_dir).where("held_out")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    n, right = told.join(docs, "doc_id").agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 300 and right >= 0.99 * n
