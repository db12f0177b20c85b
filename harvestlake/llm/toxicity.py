"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the positives; every other text is merely unlabelled, so a
missing or a wrong "clean" label teaches nothing false. With class prior p, the risk of a
classifier g is  p R+(positives) + max(0, R-(unlabelled) - p R-(positives)):  the share of
toxic texts among the unlabelled is taken out, and the part that stands for clean texts
may not fall below zero, which would mean that the classifier learns the sample by heart.

A text is the set of its words and word beginnings, so a few insults count alike in a
short and in a very long text. Candidate features are counted in Spark over a bounded
sample, the classifier is fitted in numpy on the driver, and texts are scored in tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlake.llm.common import free_name, sample_of_ids, small_batches, stage, text_of

#: Bounds of the sample that the classifier is fitted on; scoring has no bound.
MAX_POSITIVE = 3000
MAX_UNLABELLED = 6000
#: Features that the classifier may use.
MAX_FEATURES = 512
#: A feature must occur in so many positive texts, and in such a share of them.
MIN_POSITIVE = 4
MIN_SHARE = 0.02
#: How many times more frequent among the positives than among the unlabelled it must be.
MIN_LIFT = 2.5
PREFIXES = (4, 5, 6, 7)

_WORD = re.compile(r"\w+")


def features_of(word: str) -> Iterator[str]:
    """The word itself and its beginnings, marked by a hyphen."""
    yield word
    for n in PREFIXES:
        if len(word) > n:
            yield word[:n] + "-"


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass
class ToxicityModel:
    """Which features count, and how much; ``score`` is between 0 and 1."""

    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -50.0

    def active(self, text: str | None, known: dict[str, tuple[int, ...]]) -> list[int]:
        """Numbers of the features in the text; ``known`` keeps what words have given so far."""
        if len(known) > 500_000:
            known.clear()
        found: set[int] = set()
        for word in words_of(text or ""):
            numbers = known.get(word)
            if numbers is None:
                numbers = tuple(n for f in features_of(word) if (n := self.features.get(f)) is not None)
                known[word] = numbers
            found.update(numbers)
        return sorted(found)

    def score_texts(self, texts: pd.Series, known: dict) -> pd.Series:
        logits = [self.bias + self.weights[self.active(t, known)].sum() for t in texts]
        return pd.Series(1.0 / (1.0 + np.exp(-np.clip(logits, -60.0, 60.0))), dtype="float64")

    def column(self, spark: SparkSession, text):
        """The score of a text column. The model is of bounded size and sent once per executor."""
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known: dict = {}
            for texts in batches:
                yield shared.value.score_texts(texts, known)

        return score(text)


def _sample(docs: DataFrame, labels: DataFrame, trains) -> DataFrame:
    """(text, positive): the bounded sample, chosen by a hash of the ids."""
    pool = docs.where(trains)
    # The ids are chosen first, so that the texts are read where they are and not moved.
    confirmed = sample_of_ids(labels.where((F.col("toxic") == 1) & trains), "doc_id", MAX_POSITIVE)
    others = sample_of_ids(pool, "doc_id", MAX_UNLABELLED)
    positives = pool.join(confirmed, "doc_id", "left_semi").limit(2 * MAX_POSITIVE)
    unlabelled = pool.join(others, "doc_id", "left_semi").limit(2 * MAX_UNLABELLED)
    # A text copied many times would pass its own words off as signs of toxicity.
    return (
        positives.select("text", F.lit(1).alias("positive"))
        .unionByName(unlabelled.select("text", F.lit(0).alias("positive")))
        .dropDuplicates(["text", "positive"])
    )


def _count_features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for frame in frames:
        for text, positive in zip(frame["text"], frame["positive"], strict=True):
            counts[positive].update({f for w in words_of(text) for f in features_of(w)})
    for positive, counter in enumerate(counts):
        items = list(counter.items())
        for at in range(0, len(items), 50_000):
            part = items[at : at + 50_000]
            yield pd.DataFrame(
                {"feature": [f for f, _ in part], "positive": positive, "n": [n for _, n in part]}
            )


def fit_pu(
    x_p: np.ndarray, x_u: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05,
    decay: float = 1e-4, slack: float = 0.02,
) -> tuple[np.ndarray, float]:
    """Weights and bias of least non-negative positive-unlabelled risk, logistic loss (Adam).

    Where the part of the risk that stands for clean texts has fallen below ``-slack``, the
    step climbs back on that part alone.
    """
    theta = np.zeros(x_p.shape[1] + 1, dtype=np.float32)
    theta[-1] = np.log(prior / (1.0 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def gradient(x, slope):
        return np.append(x.T @ slope / len(slope), slope.mean())

    for step in range(1, steps + 1):
        z_p, z_u = x_p @ theta[:-1] + theta[-1], x_u @ theta[:-1] + theta[-1]
        s_p, s_u = 1.0 / (1.0 + np.exp(-z_p)), 1.0 / (1.0 + np.exp(-z_u))
        clean_risk = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        clean = gradient(x_u, s_u) - prior * gradient(x_p, s_p)
        g = -clean if clean_risk < -slack else prior * gradient(x_p, s_p - 1.0) + clean
        g = g + decay * np.append(theta[:-1], 0.0)
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, held_out=None) -> ToxicityModel:
    """Train on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Rows whose id makes ``held_out`` (a column of ``doc_id``) true, or whose id is null,
    take no part. The sample has at most ``MAX_POSITIVE`` confirmed toxic texts and
    ``MAX_UNLABELLED`` others, the smallest by a hash of the row; the class prior comes from
    all labels. Without any confirmed toxic text the model scores every text 0.
    """
    trains = F.col("doc_id").isNotNull()
    if held_out is not None:
        trains = trains & ~held_out
    docs = docs.select(F.col("doc_id"), text_of().alias("text"))
    known = labels.where(trains & F.col("toxic").isNotNull())
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return ToxicityModel()
    prior = min(max(prior, 1e-4), 0.9)
    small_batches(docs.sparkSession)
    sample = stage(_sample(docs, labels, trains), "toxicity-sample")
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return ToxicityModel()

    both = {True: F.col("positive") == 1, False: F.col("positive") == 0}
    counted = (
        sample.mapInPandas(_count_features, "feature string, positive int, n long")
        .groupBy("feature")
        .agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias("np"[k] + "_") for k, c in both.items()])
    )
    # Toxic texts hide among the unlabelled, so no lift can exceed one over the prior.
    share_p = F.col("p_") / sizes[1]
    share_u = F.greatest(F.col("n_") / sizes[0], F.lit(prior) * share_p)
    counted = counted.where(
        (F.col("p_") >= max(MIN_POSITIVE, MIN_SHARE * sizes[1])) & (share_p >= MIN_LIFT * share_u)
    ).withColumn("gain", share_p * F.log(share_p / share_u))
    best = counted.orderBy(F.desc("gain"), "feature").limit(MAX_FEATURES).select("feature").collect()
    if not best:
        return ToxicityModel()
    model = ToxicityModel({r["feature"]: i for i, r in enumerate(best)}, np.zeros(len(best)), 0.0)

    @F.pandas_udf("array<int>")
    def active(texts: pd.Series) -> pd.Series:
        known: dict = {}
        return pd.Series([model.active(t, known) for t in texts])

    rows = sample.select("positive", active("text").alias("active")).collect()
    x = np.zeros((len(rows), len(best)), dtype=np.float32)
    for i, row in enumerate(rows):
        x[i, row["active"]] = 1.0
    positive = np.array([r["positive"] for r in rows]) == 1
    model.weights, model.bias = fit_pu(x[positive], x[~positive], prior)
    return model


def score_documents(docs: DataFrame, model: ToxicityModel, score: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; null and empty texts are scored as empty."""
    small_batches(docs.sparkSession)
    return docs.withColumn(score, model.column(docs.sparkSession, text_of()))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those scored ``threshold`` or more; the columns stay as they are."""
    model = fit_toxicity(docs, labels)
    score = free_name(docs.columns, "score")
    return score_documents(docs, model, score).where(F.col(score) < threshold).drop(score)
