"""Tables bucketed by project, the report from partial counts, and the index of a query table."""

import random
import re
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harvestlake.operators import reports as rep
from harvestlake.operators import worklist as wl
from harvestlake.operators.grams import FIRST_AROUND, Slice, grams_of_texts, slices
from harvestlake.operators.joins import only_in, perhaps_in
from harvestlake.operators.matching import (
    gram_kinds, match_queries, match_query_table, query_index, terms_of, text_grams,
)
from harvestlake.refdata import all_queries, query_terms
from harvestlake.sources.bucketed import BUCKET_BYTES, BucketedTables, buckets_for
from harvestlake.sources.catalog import Catalog
from harvestlake.sources.rollup import refresh, report, uncounted
from workload.projections import catalog, view


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def executed(df) -> str:
    rows = df.collect()
    assert rows
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def store(spark, sf_dir, tmp_path_factory):
    tables = BucketedTables(spark, str(tmp_path_factory.mktemp("bucketed")), f"t{uuid.uuid4().hex}", 4)
    for name in ("files", "projects"):
        tables.save(name, view(spark, sf_dir, name))
    yield tables
    for name in ("files", "projects"):
        tables.drop(name)


def test_bucketed_tables_join_in_place(store, no_broadcast):
    plan = executed(rep.files_with_projects(store.read("files"), store.read("projects")))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # Only the order of the listing moves rows.
    assert re.findall(r"Exchange (\w+)", plan) == ["rangepartitioning"]


def test_bucketed_work_list_has_no_exchange(store, no_broadcast, spark, sf_dir):
    choice = wl.selection("retry_failed")
    plan = wl.plan_all(store.read("files"), store.read("projects"), choice, colocated=True)
    assert "Exchange" not in executed(plan)
    plain = wl.plan_all(view(spark, sf_dir, "files"), view(spark, sf_dir, "projects"), choice)
    assert sorted(r["id"] for r in plan.collect()) == sorted(r["id"] for r in plain.collect())


def test_a_table_is_replaced_and_dropped(spark, tmp_path):
    tables = BucketedTables(spark, str(tmp_path), f"t{uuid.uuid4().hex}", 2)
    rows = spark.createDataFrame([(1, 7), (2, None), (3, 7)], "id INT, project_id BIGINT")
    tables.save("files", rows)
    tables.save("files", rows.where("id > 1"))
    assert sorted(r["id"] for r in tables.read("files").collect()) == [2, 3]
    tables.save("files", rows.where("false"))
    assert tables.read("files").collect() == []
    tables.drop("files")
    assert not (tmp_path / "files").exists()


def test_bucket_count():
    assert [buckets_for(n) for n in (0, 1, BUCKET_BYTES, BUCKET_BYTES + 1, 5 * BUCKET_BYTES)] == [1, 1, 1, 2, 8]
    with pytest.raises(ValueError):
        BucketedTables(None, "x", "y", 0)


def test_buckets_grow_with_the_table():
    # Rows of a bucket are sorted unpacked by one task: 2.8 GB of files, some 216 million rows, need over a hundred.
    assert buckets_for(2_800_000_000) >= 128
    assert 2_800_000_000 / buckets_for(2_800_000_000) <= 32 * 1024 * 1024


# ---- partial counts ---------------------------------------------------------------


def as_map(df):
    return {(r["metric"], r["key"]): r["value"] for r in df.collect()}


def small_catalog(spark, sf_dir):
    tables = catalog(spark, sf_dir)
    tables["projects"] = tables["projects"].withColumn("repository_url", F.lit("x"))
    tables["files"] = tables["files"].withColumn("id", F.xxhash64("id"))
    tables["keywords"] = tables["keywords"].withColumn("id", F.xxhash64("id"))
    return tables


def test_report_follows_appends_and_changes(spark, sf_dir, tmp_path):
    store = Catalog(spark, str(tmp_path))
    tables = small_catalog(spark, sf_dir)
    assert as_map(report(store)) == as_map(rep.stats(store.tables()))
    for batch in range(3):
        own = {t: df.where(F.col("id" if t == "projects" else "project_id") % 3 == batch) for t, df in tables.items()}
        store.append(own, str(batch))
        counted = refresh(store)
        assert all(names == [str(batch)] for names in counted.values()) and len(counted) == 6
    assert refresh(store) == {}
    assert as_map(report(store)) == as_map(rep.stats(store.tables()))

    one = store.rows("files").where("batch = '1'").select("id").limit(5)
    store.apply_status(one.select("id", F.lit("failed").alias("status"), F.lit(1).alias("updated_at")))
    # Only the rewritten partition is counted again.
    assert uncounted(store) == {"files": ["1"]}
    assert as_map(report(store)) == as_map(rep.stats(store.tables()))

    new = spark.createDataFrame([(3, 99, "new"), (10**12, 50, "new")], "project_id BIGINT, relevance_score INT, description STRING")
    store.upsert_scores(new, "scores")
    assert as_map(report(store)) == as_map(rep.stats(store.tables()))
    assert as_map(report(store))[("relevance_score", "max")] == 99
    store.reset()
    assert as_map(report(store)) == as_map(rep.stats(store.tables()))


def test_an_unfinished_batch_does_not_count(spark, sf_dir, tmp_path, monkeypatch):
    store = Catalog(spark, str(tmp_path))
    files = {"files": small_catalog(spark, sf_dir)["files"]}
    monkeypatch.setattr(store, "_finish", lambda *a: (_ for _ in ()).throw(RuntimeError("dies")))
    with pytest.raises(RuntimeError):
        store.append(files, "a")
    assert as_map(report(store))[("rows", "files")] == 0
    monkeypatch.undo()
    store.append(files, "a")
    assert as_map(report(store))[("rows", "files")] == files["files"].count()


# ---- a table of queries -----------------------------------------------------------

TEXTS = [
    (1, "Interview transcripts, focus group"), (2, "of"), (3, "a🏠b of the city"), (4, ""), (5, None),
    (6, "line one\nline two"), (7, "INTERVIEW Focus Group transcripts"), (8, "of of of"), (9, "xy"),
]
QUERIES = [
    "interview", '"focus group" interview', "of", "x", '"one\nline"', "🏠", "a🏠b", "nothing-here", "", '""',
    "of the", 'city "a🏠', "Of  of", " of the", "y", "tran script",
]
#: Terms of several words, with characters outside the basic plane at either side of white space.
LONG_TEXTS = [
    (1, "a🏠b of the city"), (2, "x🏠🏠 b🏠c 🏠🏠🏠 d"), (3, "abc  def\nghi jkl"), (4, "xabc def ghijk"), (5, "the abc defg hij"),
    (6, "🏠abc def ghi🏠"),
]
LONG_QUERIES = [
    '"a🏠b of the"', '"🏠b of the city"', '"🏠🏠 b🏠c 🏠🏠"', '"b🏠c 🏠🏠🏠 d"', '"abc  def\nghi"', '"abc def ghi"', '"bc def gh" abc',
    '"e abc defg"', '" of the c"', '"🏠abc def ghi🏠"',
]


def matches(df):
    return sorted((r["doc_id"], r["query_idx"], r["query"]) for r in df.collect())


def test_query_table_finds_what_the_compiled_queries_find(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id INT, text STRING")
    table = spark.createDataFrame([*enumerate(QUERIES), (99, None)], "query_idx INT, query STRING")
    want = matches(match_queries(docs, QUERIES, "text"))
    assert matches(match_query_table(docs, table, "doc_id", "text")) == want
    assert {q for _, q, _ in want} >= {0, 1, 2, 3, 4, 5, 6, 10, 11, 12}


def test_query_table_with_long_terms(spark):
    docs = spark.createDataFrame(LONG_TEXTS, "doc_id INT, text STRING")
    table = spark.createDataFrame(list(enumerate(LONG_QUERIES)), "query_idx INT, query STRING")
    got = matches(match_query_table(docs, table, "doc_id", "text"))
    assert got == matches(match_queries(docs, LONG_QUERIES, "text")) and {q for _, q, _ in got} == set(range(10))


def test_query_table_without_broadcast(spark, sf_dir, no_broadcast):
    docs = view(spark, sf_dir, "documents", "doc_id", "text")
    queries = all_queries() + ["the", "der die", "worthless", "in", "ing tion"]
    table = spark.createDataFrame(list(enumerate(queries)), "query_idx INT, query STRING")
    want = matches(match_queries(docs, queries, "text"))
    got = match_query_table(docs, table, "doc_id", "text")
    assert want and matches(got) == want
    assert "BroadcastNestedLoopJoin" not in executed(got) and "CartesianProduct" not in executed(got)


def test_query_table_with_nothing_in_it(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id INT, text STRING")
    table = spark.createDataFrame([(1, "of")], "query_idx INT, query STRING")
    assert match_query_table(docs.where("false"), table, "doc_id", "text").collect() == []
    assert match_query_table(docs, table.where("false"), "doc_id", "text").collect() == []


def test_queries_alike_behind_white_space_are_told_apart(spark):
    """A first word that tells the queries apart keeps texts from meeting the queries of all others."""
    n = 60
    docs = spark.createDataFrame([(i, f"a word{i}x common wording here") for i in range(n)], "doc_id INT, text STRING")
    asked = [f'"word{i}x common wording" here' for i in range(n)]
    table = spark.createDataFrame(list(enumerate(asked)), "query_idx INT, query STRING")
    index = query_index(docs, table, F.col("text")).cache()
    pairs = text_grams(docs, F.col("text"), gram_kinds(index), "doc_id").join(index, "gram").count()
    assert pairs < 12 * n  # n-grams share the last figure of the number; were they all one, n * n
    assert [(d, q) for d, q, _ in matches(match_query_table(docs, table, "doc_id", "text"))] == [(i, i) for i in range(n)]


def test_query_table_beyond_what_is_sent(spark, sf_dir, monkeypatch):
    docs = view(spark, sf_dir, "documents", "doc_id", "text")
    queries = all_queries() + ["the", "der die", "in", '"a b c d"', '"or more of the"']
    table = spark.createDataFrame(list(enumerate(queries)), "query_idx INT, query STRING")
    want = matches(match_queries(docs, queries, "text"))
    monkeypatch.setattr("harvestlake.operators.matching.MAX_SENT", 0)
    assert want and matches(match_query_table(docs, table, "doc_id", "text")) == want


def test_phrases_are_told_without_the_texts(spark, sf_dir, no_broadcast):
    """Texts are read once to find n-grams; what stands around these tells the rest, no text is exchanged."""
    docs = view(spark, sf_dir, "documents", "doc_id", "text")
    phrases = [r[0] for r in docs.select(F.regexp_extract("text", "[a-z]{3,} [a-z]+ [a-z]{3,}", 0)).distinct().collect() if r[0]]
    queries = [f'"{p}" {p.split()[1]}' for p in phrases[:60]]
    table = spark.createDataFrame(list(enumerate(queries)), "query_idx INT, query STRING")
    got = match_query_table(docs, table, "doc_id", "text")
    assert len(phrases) >= 60 and matches(got) == matches(match_queries(docs, queries, "text"))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", executed(got.select("doc_id", "query")))
    assert len(scans) > 1 and sum("text:" in columns for columns in scans) == 1


def test_query_table_over_random_texts(spark):
    """Terms cut out of texts: short and long words, every kind of white space, keys that repeat or are null."""
    pick = random.Random(4)
    words = ["ab", "the", "that", "theab", "é", "a🏠b", "x" * 40, "abcdefghij", "a" * 33 + "b", ""]
    texts = ["".join(pick.choice(words) + pick.choice(" \t\n ") for _ in range(pick.randrange(40))) for _ in range(60)]
    terms = []
    for text in texts * 3:
        at = pick.randrange(len(text) + 1)
        terms.append(text[at : at + pick.choice([1, 4, 9, 20, 60, 120])])
    queries = [f'"{t}" {pick.choice(terms).split(" ")[0]}' if i % 2 else f'"{t}"' for i, t in enumerate(terms)]
    table = spark.createDataFrame(list(enumerate(queries)), "query_idx INT, query STRING")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id INT, text STRING")
    want = matches(match_queries(docs, queries, "text"))
    assert len(want) > 200 and matches(match_query_table(docs, table, "doc_id", "text")) == want
    again = docs.withColumn("doc_id", F.expr("if(doc_id % 9 = 0, null, doc_id % 50)"))
    want = {tuple(r) for r in match_queries(again, queries, "text").collect() if r["doc_id"] is not None}
    assert want == {tuple(r) for r in match_query_table(again, table, "doc_id", "text").collect()}


def test_surroundings_of_one_number_are_told_apart(monkeypatch):
    """Were all n-grams of one number, none that differs would be lost."""
    text = "one two three four\n one two three  one  two xtwo thre"
    part = next(slices(pa.array([text, None, text])))[1]
    kinds = [FIRST_AROUND]
    want = [grams_of_texts(part, kinds, None)[i] for i in (0, 2)]
    monkeypatch.setattr(Slice, "hash", lambda self, start, end, seed: np.zeros(len(start), np.uint64))
    index, _, around = grams_of_texts(part, kinds, None)
    assert index.tolist() == [0, 2] and len(set(want[0].tolist())) == 2
    assert {bytes(b) for bs in around.to_pylist() for b in bs} == {bytes(b) for bs in want[1].to_pylist() for b in bs}


def test_rows_with_a_wanted_key(spark, no_broadcast):
    rows = spark.createDataFrame([(i % 50_000 if i % 7 else None, f"t{i}") for i in range(100_000)], "k BIGINT, t STRING")
    wanted = rows.select("k").where("k % 40 = 3").distinct()
    want = rows.join(wanted, "k", "left_semi")
    got = only_in(rows, wanted, "k")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 1000
    marked = perhaps_in(rows, wanted, "k", "m").where("m").count()
    assert got.count() <= marked < got.count() + 0.15 * rows.count()
    assert only_in(rows, wanted.where("false"), "k").isEmpty() and only_in(rows.where("false"), wanted, "k").isEmpty()


def test_terms_of_a_column(spark):
    for query in [q for q in QUERIES if q]:
        got = spark.createDataFrame([(query,)], "q STRING").select(terms_of(F.col("q"))).first()[0]
        assert got == list(dict.fromkeys(t.lower() for t in query_terms(query)))
