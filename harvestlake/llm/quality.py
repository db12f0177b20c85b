"""Quality by a sparse rule ensemble.

Statistics of a text are Spark columns. Boosted regression trees over them are fitted to a
bounded sample of labelled rows; every path from a root to a node is a conjunctive rule. A
lasso logistic regression over the rules (and the statistics themselves, clipped and scaled)
keeps few of them, and what it keeps is compiled into one Spark column expression, so that
scoring is a projection without Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlake.llm.common import free_name, sample_of_ids, stage, text_of

#: Bound of the labelled sample that the ensemble is fitted on; scoring has no bound.
MAX_ROWS = 20_000
TREES = 40
DEPTH = 3
#: Share of the sample that each tree sees.
SUBSAMPLE = 0.5
#: Thresholds tried per statistic.
CUTS = 32


def statistics(text: Column) -> dict[str, Column]:
    """Facts of a whole text by name, each one a double; empty texts give zeros."""
    n = F.greatest(F.char_length(text), F.lit(1)).cast("double")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))) / n

    return {
        "log_chars": F.log1p(F.char_length(text).cast("double")),
        "word_length": F.char_length(text) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / F.sqrt(n_words),
        "distinct_share": F.size(F.array_distinct(words)) / n_words,
        "line_words": n_words / n_lines,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "symbols": share(r"[^\p{L}\p{N}\s.,;:!?'\"()-]+"),
        "stops": share(r"[.,;:]+"),
        "shouts": share("[!?]+"),
        "digits": share(r"\p{N}+"),
        "capitals": share(r"\p{Lu}+"),
        "letters": share(r"\p{L}+"),
        "spaces": share(r"\s+"),
        "marks": share("[|<>{}\\[\\]=_#*&%$@^~\\\\/]+"),
        "repeats": (F.size(words) - F.size(F.array_distinct(words))) / n_words,
    }


@dataclass(frozen=True)
class Condition:
    """``statistic <= cut`` where ``below``, else ``statistic > cut``."""

    statistic: int
    below: bool
    cut: float


@dataclass
class RuleEnsemble:
    """Intercept, weighted rules and weighted statistics; the score is a probability."""

    names: list[str]
    intercept: float = 0.0
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)
    #: statistic, weight, lower and upper clip
    linear: list[tuple[int, float, float, float]] = field(default_factory=list)

    def column(self, columns: dict[str, Column]) -> Column:
        """The score as one column expression over the statistics."""
        logit = F.lit(float(self.intercept))
        for conditions, weight in self.rules:
            test = F.lit(True)
            for c in conditions:
                value = columns[self.names[c.statistic]]
                test = test & ((value <= c.cut) if c.below else (value > c.cut))
            logit = logit + F.when(test, float(weight)).otherwise(0.0)
        for number, weight, low, high in self.linear:
            value = columns[self.names[number]]
            logit = logit + float(weight) * F.least(F.greatest(value, F.lit(low)), F.lit(high))
        return 1.0 / (1.0 + F.exp(-logit))


def _tree_rules(x: np.ndarray, residual: np.ndarray, hessian: np.ndarray, cuts, rate: float):
    """Grow one regression tree; its paths as rules and its prediction on ``x``."""
    rules: list[tuple[Condition, ...]] = []
    prediction = np.zeros(len(x))

    def best_split(rows: np.ndarray):
        best = (1e-6, None)
        g, h = residual[rows].sum(), hessian[rows].sum()
        for s, own in enumerate(cuts):
            # Sums up to each threshold by one histogram per statistic.
            at = np.searchsorted(own, x[rows, s], side="left")
            gs = np.bincount(at, residual[rows], len(own) + 1).cumsum()[:-1]
            hs = np.bincount(at, hessian[rows], len(own) + 1).cumsum()[:-1]
            ns = np.bincount(at, minlength=len(own) + 1).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < 8) | (len(rows) - ns < 8)] = -np.inf
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (gain[k], (s, own[k]))
        return best[1]

    def grow(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        if path:
            rules.append(path)
        split = best_split(rows) if len(path) < DEPTH and len(rows) >= 20 else None
        if split is None:
            prediction[rows] = rate * residual[rows].sum() / (hessian[rows].sum() + 1)
            return
        s, cut = split
        left = x[rows, s] <= cut
        grow(rows[left], (*path, Condition(s, True, float(cut))))
        grow(rows[~left], (*path, Condition(s, False, float(cut))))

    return rules, prediction, grow


def extract_rules(x: np.ndarray, y: np.ndarray, seed: int = 5) -> list[tuple[Condition, ...]]:
    """Distinct rules of boosted trees (logistic loss)."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, s], np.linspace(0.02, 0.98, CUTS))) for s in range(x.shape[1])]
    logit = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    found: dict[tuple[Condition, ...], None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        rules, prediction, grow = _tree_rules(x, y - p, p * (1 - p), cuts, 0.2)
        rows = np.flatnonzero(rng.random(len(y)) < SUBSAMPLE)
        grow(rows, ())
        found.update(dict.fromkeys(rules))
        logit[rows] += prediction[rows]
    return list(found)


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    test = np.ones(len(x), dtype=bool)
    for c in rule:
        test &= (x[:, c.statistic] <= c.cut) if c.below else (x[:, c.statistic] > c.cut)
    return test


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 500) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient; the intercept isn't penalised."""
    n = len(y)
    step = 4.0 / (np.linalg.norm(z, 2) ** 2 / n + 1.0)
    w = look = np.zeros(z.shape[1])
    b = b_look = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    t = 1.0
    for _ in range(steps):
        slope = 1 / (1 + np.exp(-(z @ look + b_look))) - y
        moved = look - step * (z.T @ slope) / n
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0.0)
        new_b = b_look - step * slope.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, b_look = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return w, b


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = 0.002) -> RuleEnsemble:
    """The sparse ensemble for statistics ``x`` and labels ``y`` (0 or 1)."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return RuleEnsemble(names, float(np.log(share / (1 - share))))
    rules = extract_rules(x, y)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    clipped = np.clip(x, low, high)
    spread = clipped.std(axis=0)
    useful = np.flatnonzero(spread > 1e-9)
    # A statistic counts like a typical rule: 0.4 is the deviation of a rule of medium support.
    linear = 0.4 * (clipped[:, useful] - clipped[:, useful].mean(axis=0)) / spread[useful]
    fired = np.column_stack([holds(r, x) for r in rules]).astype(float) if rules else np.zeros((len(y), 0))
    w, b = lasso_logistic(np.hstack([fired, linear]), y, penalty)
    ensemble = RuleEnsemble(names)
    ensemble.rules = [(r, v) for r, v in zip(rules, w, strict=False) if abs(v) > 1e-6]
    for k, v in zip(useful, w[len(rules) :], strict=True):
        if abs(v) > 1e-6:
            scale = 0.4 * v / spread[k]
            ensemble.linear.append((int(k), float(scale), float(low[k]), float(high[k])))
            b -= scale * clipped[:, k].mean()
    ensemble.intercept = float(b)
    return ensemble


def fit_quality(docs: DataFrame, labels: DataFrame, held_out: Column | None = None) -> RuleEnsemble:
    """Train on ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Rows whose id makes ``held_out`` true or is null, and rows without label, take no part.
    The labels of at most ``MAX_ROWS`` ids are used, the smallest by a hash of the id; only
    their statistics reach the driver. Without labels every text scores one half.
    """
    trains = F.col("doc_id").isNotNull() & F.col("quality").isNotNull()
    if held_out is not None:
        trains = trains & ~held_out
    known = labels.where(trains).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    # The ids are chosen first, so that the texts are read where they are and not moved.
    ids = sample_of_ids(known, "doc_id", MAX_ROWS)
    sample_labels = stage(known.join(ids, "doc_id", "left_semi"), "sample-labels")
    rows = docs.select("doc_id", text_of().alias("text")).join(sample_labels, "doc_id").limit(2 * MAX_ROWS)
    columns = statistics(F.col("text"))
    sample = rows.select("quality", *[c.alias(n) for n, c in columns.items()]).toPandas()
    x = sample[list(columns)].to_numpy(dtype=float)
    return fit_rules(x, sample["quality"].to_numpy(dtype=float), list(columns))


def score_quality(docs: DataFrame, ensemble: RuleEnsemble, score: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the score of each whole text; null texts are scored as empty."""
    facts = free_name([*docs.columns, score], "facts")
    columns = statistics(text_of(text))
    # One struct, so that each statistic is computed once and not in every rule.
    rows = docs.withColumn(facts, F.struct(*[c.alias(n) for n, c in columns.items()]))
    value = ensemble.column({n: F.col(f"{facts}.{n}") for n in columns})
    return rows.withColumn(score, value).drop(facts)
