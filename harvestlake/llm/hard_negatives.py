"""Hard-negative mining with bounds along a spanning tree of the anchors.

For an anchor and one of its positives a hard negative is a row of another label whose score
lies in a window below the positive's score. The anchors of a block are joined by a minimum
spanning tree. The root is scored against all rows; from a parent p to its child c

    |score(c, x) - score(p, x)| = |(c - p) . x| <= distance(c, p) * norm(x),

so what is known at the parent bounds the child's scores, and only the rows whose bounds meet
one of the child's windows are scored again. A row that isn't scored hands its bounds on,
widened by the edge. The bounds only save work: a row that could be in a window is scored.

Rows and anchors are dealt to cells of bounded size (so many rows, so many anchors), each row
to one row group and each anchor to one anchor group, whatever its label or id; a cell is one
cogroup. Cells hand back the best few per anchor, which windows put together.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestlake.llm.common import stage, stop_if_missing
from harvestlake.operators.joins import join_to_one

#: Bytes of components (8 each) in the rows, and in the anchors, of one cell.
GROUP_BYTES = 4 << 20
#: Anchors joined by one spanning tree.
TREE_ANCHORS = 512
#: Sums of products below this bound are exact in doubles, a hundred times as great ones too.
_EXACT = float(1 << 45)

_TOP = "anchor LONG, vec_id LONG, score LONG, own BOOLEAN"
_HARD = "anchor LONG, place INT, vec_id LONG, score LONG"


def prepared(rows: DataFrame, relabel: Column | None = None) -> DataFrame:
    """``vec_id``, ``label``, ``vector`` of the rows that take part.

    Rows with a null label, a null vector, or a null, NaN or infinite component are left out.
    ``relabel`` is the label that counts (null: the row's own).
    """
    stop_if_missing(rows, "vec_id", "embedding", "label")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.coalesce(relabel if relabel is not None else F.col("label"), F.col("label")).cast("bigint").alias("label"),
        F.col("embedding").alias("vector"),
    )


def whole_components(vectors: pa.ChunkedArray, width: int, scale: float) -> np.ndarray:
    """``floor(scale * x)`` per component; shorter vectors end in zeros."""
    lists = vectors.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = np.diff(lists.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = values
    return out


def products(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``x`` with the rows of ``a``, exact whole numbers."""
    if not x.size or not a.size:
        return np.zeros((len(x), len(a)))
    if np.abs(x).max() * np.abs(a).max() * x.shape[1] < _EXACT:
        return x @ a.T
    whole = np.vectorize(int, otypes=[object])
    return whole(x) @ whole(a).T


def spanning_tree(a: np.ndarray) -> list[tuple[int, int, float]]:
    """Minimum spanning tree by Prim's rule: (anchor, parent or -1, distance), parents first."""
    n = len(a)
    norms = np.einsum("ij,ij->i", a, a)
    nearest, parent = np.full(n, np.inf), np.full(n, -1)
    todo = np.ones(n, dtype=bool)
    edges, at = [], 0
    for _ in range(n):
        edges.append((at, int(parent[at]), 0.0 if parent[at] < 0 else float(np.sqrt(nearest[at]))))
        todo[at] = False
        squares = np.maximum(norms + norms[at] - 2 * (a @ a[at]), 0.0)
        closer = todo & (squares < nearest)
        nearest[closer], parent[closer] = squares[closer], at
        if not todo.any():
            break
        at = int(np.where(todo, nearest, np.inf).argmin()) if np.isfinite(nearest[todo]).any() else int(todo.argmax())
    # Distances from the differences themselves: the squares above cancel for near anchors.
    return [(c, p, float(np.linalg.norm(a[c] - a[p])) if p >= 0 else 0.0) for c, p, _ in edges]


def _first(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n``: greatest score, then smallest id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:n], dtype=np.int64)
    if len(scores) > 4 * n:
        # Everything that ties with the n-th stays in.
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:n]]


class HardNegatives:
    """The numpy work inside one cell."""

    def __init__(self, width: int, scale: float, n_positives: int, n_negatives: int, low: int, high: int):
        self.width, self.scale = width, scale
        self.n_positives, self.n_negatives = n_positives, n_negatives
        self.low, self.high = low, high

    def _side(self, table: pa.Table, *columns: str):
        vectors = whole_components(table.column("vector"), self.width, self.scale)
        out = [table.column(c).combine_chunks() for c in columns]
        return vectors, *[o.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False) for o in out]

    def _ids(self, table: pa.Table, places: list[np.ndarray]) -> pa.Array:
        column = table.column("vec_id").combine_chunks()
        return column.take(pa.array(np.concatenate(places) if places else [], pa.int64()))

    def positives(self, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """Per anchor the first rows of its label, one more than asked: the anchor may be among them."""
        x, ids, labels = self._side(rows, "vec_id", "label")
        a, a_ids, a_labels, numbers = self._side(anchors, "vec_id", "label", "anchor")
        whose, places, scores, own = [], [], [], []
        for label in np.unique(a_labels):
            here, there = np.flatnonzero(labels == label), np.flatnonzero(a_labels == label)
            if not len(here):
                continue
            for at in range(0, len(there), TREE_ANCHORS):
                block = there[at : at + TREE_ANCHORS]
                found = products(x[here], a[block])
                for k, j in enumerate(block):
                    best = _first(found[:, k], ids[here], self.n_positives + 1)
                    rows_ = here[best]
                    whose.append(np.full(len(best), numbers[j]))
                    places.append(rows_)
                    scores.extend(int(s) for s in found[best, k])
                    own.append((ids[rows_] == a_ids[j]) & (x[rows_] == a[j]).all(axis=1))
        return pa.table(
            {
                "anchor": pa.array(np.concatenate(whose) if whose else [], pa.int64()),
                "vec_id": self._ids(rows, places),
                "score": pa.array(scores, pa.int64()),
                "own": pa.array(np.concatenate(own) if own else [], pa.bool_()),
            }
        )

    def negatives(self, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """Per anchor and positive the first rows of other labels inside the window."""
        x, ids, labels = self._side(rows, "vec_id", "label")
        a, a_labels, numbers = self._side(anchors, "label", "anchor")
        windows = anchors.column("windows").to_pylist()
        whose, order, places, scores = [], [], [], []
        similar = np.lexsort((numbers, a_labels))
        for at in range(0, len(similar), TREE_ANCHORS):
            block = similar[at : at + TREE_ANCHORS]
            for j, known, exact in self.scores_along_tree(x, labels, a[block], a_labels[block], [windows[k] for k in block]):
                for place, positive in enumerate(windows[block[j]]):
                    inside = (self.low * positive <= 100 * exact) & (100 * exact <= self.high * positive)
                    here = known[inside]
                    best = _first(exact[inside], ids[here], self.n_negatives)
                    whose.append(np.full(len(best), numbers[block[j]]))
                    order.append(np.full(len(best), place))
                    places.append(here[best])
                    scores.extend(int(s) for s in exact[inside][best])
        return pa.table(
            {
                "anchor": pa.array(np.concatenate(whose) if whose else [], pa.int64()),
                "place": pa.array(np.concatenate(order) if order else [], pa.int32()),
                "vec_id": self._ids(rows, places),
                "score": pa.array(scores, pa.int64()),
            }
        )

    def scores_along_tree(self, x, labels, a, a_labels, windows):
        """Yield (anchor, rows scored, their scores); all rows that may lie in a window are scored.

        ``centre`` and ``reach`` bound a row's score at an anchor: centre - reach to centre + reach.
        """
        norms = np.linalg.norm(x, axis=1)
        edges = spanning_tree(a)
        children = np.bincount([p for _, p, _ in edges if p >= 0], minlength=len(a))
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for j, parent, distance in edges:
            if parent < 0:
                scored = np.arange(len(x))
                centre, reach = np.zeros(len(x)), np.zeros(len(x))
            else:
                centre, reach = bounds[parent]
                children[parent] -= 1
                if not children[parent]:
                    del bounds[parent]
                # A little more than the bound itself, so that rounding can't lose a row.
                reach = reach + (1 + 1e-9) * distance * norms + 1e-6 * (1 + np.abs(centre) * 1e-9)
                meets = np.zeros(len(x), dtype=bool)
                for positive in windows[j]:
                    if positive >= 0:  # else the window is empty
                        meets |= (100 * (centre + reach) >= self.low * positive) & (
                            100 * (centre - reach) <= self.high * positive
                        )
                scored = np.flatnonzero(meets & (labels != a_labels[j]))
            few = 2 * len(scored) < len(x)
            exact = products(x[scored], a[j : j + 1])[:, 0] if few else products(x, a[j : j + 1])[scored, 0]
            if children[j]:
                centre, reach = centre.copy(), reach.copy()
                centre[scored], reach[scored] = exact.astype(np.float64), 0.0
                bounds[j] = (centre, reach)
            other = labels[scored] != a_labels[j]
            yield j, scored[other], exact[other]


def _cells(rows: DataFrame, anchors: DataFrame, work, schema: str, n_groups: int, n_chunks: int) -> DataFrame:
    """Bring every row group together with every anchor group, each pair in a cogroup of its own."""
    chunk = F.pmod(F.xxhash64("anchor"), F.lit(n_chunks)).cast("int")
    # The number of the row in its scan, not its id: repeated ids and rows spread like others.
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_groups)).cast("int")
    left = rows.withColumn("group", group).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    right = anchors.withColumn("chunk", chunk).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    dealt = [df.repartition(n_groups * n_chunks, "group", "chunk") for df in (left, right)]


    def cell(rows_: pa.Table, anchors_: pa.Table) -> pa.Table:  # two arguments, which a bound method hides
        return work(rows_, anchors_)

    return dealt[0].groupBy("group", "chunk").cogroup(dealt[1].groupBy("group", "chunk")).applyInArrow(cell, schema)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Hard negatives of every anchor and positive; both frames as ``prepared`` returns them.

    Each component counts as floor(scale * x), a score is the whole inner product with the
    anchor, greater scores come first, then smaller ids (null ids last). Positives are the
    anchor's first ``n_positives`` other rows of its label; negatives the first ``n_negatives``
    rows of other labels with  low * positive <= 100 * negative <= high * positive.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``. Anchors without positives, or without a row in a window, give no rows,
    and so do negative positive scores, whose windows are empty. An anchor that is repeated
    counts each time, and its repeats are positives of each other. Vectors of unequal length are
    compared as if the shorter ended in zeros. Scores beyond 64 bits are an error. Empty frames
    give an empty result. Anchors, their windows and the cells' best are tables in the shared folder.
    """
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    anchors = stage(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    about = anchors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = max(facts["width"] or 1, about["width"] or 1, 1)
    per_cell = max(256, group_bytes // (8 * width))
    n_groups, n_chunks = (max(1, math.ceil(n / per_cell)) for n in (facts["n"], about["n"]))
    work = HardNegatives(width, scale, n_positives, n_negatives, low, high)

    top = _cells(rows, anchors, work.positives, _TOP, n_groups, n_chunks)
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.desc("own")]
    by_anchor = Window.partitionBy("anchor").orderBy(*order)
    best = top.withColumn("n", F.row_number().over(by_anchor)).where(F.col("n") <= n_positives + 1)
    # The anchor itself goes: one of the rows that equal it, no matter which.
    seen = F.sum(F.col("own").cast("int")).over(by_anchor.rowsBetween(Window.unboundedPreceding, 0))
    best = best.withColumn("selves", seen).where(~(F.col("own") & (F.col("selves") == 1)))
    best = best.withColumn("place", (F.col("n") - F.least("selves", F.lit(1)) - 1).cast("int"))
    positives = stage(best.where(F.col("place") < n_positives).select("anchor", "place", "vec_id", "score"), "positives")

    ranked = F.sort_array(F.collect_list(F.struct("place", "score")))
    windows = positives.groupBy("anchor").agg(F.transform(ranked, lambda p: p["score"]).alias("windows"))
    asking = stage(anchors.join(windows, "anchor"), "windows")
    hard = _cells(rows, asking, work.negatives, _HARD, n_groups, n_chunks)
    by_window = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    hard = hard.withColumn("rank", F.row_number().over(by_window)).where(F.col("rank") <= n_negatives)
    told = hard.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    told = join_to_one(told, positives.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["anchor", "place"], "inner")
    named = join_to_one(told, anchors.select("anchor", F.col("vec_id").alias("anchor_id")), ["anchor"], "inner")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
