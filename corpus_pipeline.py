"""A corpus from raw documents: toxicity, exact and near copies, source mixing, encoding.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before
has kept. Nulls, empty texts and repeated rows are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harvestlake.llm.common import scratch_path, table
from harvestlake.llm.exact_dedup import drop_exact_copies
from harvestlake.llm.mixing import mixed_documents
from harvestlake.llm.near_dedup import drop_near_copies
from harvestlake.llm.queries import tokenizer_path
from harvestlake.llm.sentencepiece import encode_documents
from harvestlake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that a classifier trained on the confirmed toxic ones rejects."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts, that with the greatest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, that with the smallest id."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents of small sources; each document is given at least once."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each document of the mixture, with the round trip and parity checks."""
    coded = encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))
    return coded.select("doc_id", "source", "piece_ids", "piece_facts.*")


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("minhash near-dedup", near_dedup),
    ("source mixing", mixing),
    ("sentencepiece encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "corpus")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier, the exponent search and the tokenizer aren't SQL; tests use brute force.
ORACLE_SQL = None
