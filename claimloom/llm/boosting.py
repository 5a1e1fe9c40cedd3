"""Gradient-boosted trees on binned features: counted by DataFrame operations, grown from the counts, applied as SQL.

Training rows are counted by their binned features in one aggregation (weight and sum of labels). The caller gives a bounded sample,
so the cells are at most as many as its rows; they are collected, and the trees are grown from sums of gradients by (node,
feature, bin) on the driver, without a job for each level. A tree is a nested CASE over the features, so all rows are scored
inside the query's own expressions, without a model file or any Python.

Defined cases: without rows the model is 0.5 everywhere; with one label only it is next to that label; rows whose features or label
are null count as a cell of their own bin, -1, or not at all; repeated rows weigh as often as they come; ties between splits go to
the first feature and the smallest bin; an extra column is ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Node:
    """A leaf if ``feature`` is None; else rows with feature <= bin go left."""

    value: float = 0.0
    feature: str | None = None
    bin: int = 0
    left: Node | None = None
    right: Node | None = None

    def sql(self, of: str) -> str:
        if self.feature is None:
            return f"{self.value!r}D"
        return f"case when {of}{self.feature} <= {self.bin} then {self.left.sql(of)} else {self.right.sql(of)} end"

    def depth(self) -> int:
        return 0 if self.feature is None else 1 + max(self.left.depth(), self.right.depth())


@dataclass
class Trees:
    start: float = 0.0
    trees: list[Node] = field(default_factory=list)

    def margin(self, of: str = "") -> str:
        return " + ".join([f"{self.start!r}D", *(f"({t.sql(of)})" for t in self.trees)])

    def probability(self, of: str = "") -> str:
        """SQL for the probability of label 1; ``of`` is put before each feature's name."""
        return f"(1D / (1D + exp(-({self.margin(of)}))))"


def fit(rows: DataFrame, features: list[str], label: str, trees: int = 24, depth: int = 3, rate: float = 0.4, l2: float = 1.0, least: float = 1e-3, weight: str = "1D") -> Trees:
    """Fit on ``rows``, a bounded sample whose ``features`` are small integers and whose ``label`` (SQL) is 0 or 1."""
    binned = [F.coalesce(F.col(name).cast("int"), F.lit(-1)).alias(name) for name in features]
    labelled = rows.select(*binned, F.expr(weight).alias("__w"), F.expr(label).alias("__y")).where("__y is not null")
    cells = sorted(labelled.groupBy(*features).agg(F.sum("__w").alias("__w"), F.sum(F.col("__y") * F.col("__w")).alias("__y")).collect())
    return grown(np.array([r[:-2] for r in cells], dtype=np.int64).reshape(len(cells), len(features)), np.array([r[-2] for r in cells]), np.array([r[-1] for r in cells]), features, trees, depth, rate, l2, least)


def grown(x: np.ndarray, w: np.ndarray, y: np.ndarray, features: list[str], trees: int, depth: int, rate: float, l2: float, least: float) -> Trees:
    """Trees over cells ``x`` (a row of bins each) of weight ``w`` that hold labels summing up to ``y``."""
    total = w.sum()
    if not len(x) or not total:
        return Trees()
    share = min(1 - 1e-4, max(1e-4, y.sum() / total))
    model = Trees(log(share / (1 - share)))
    if not 0 < y.sum() < total:
        return model
    margin = np.full(len(x), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - w * p, w * p * (1 - p)
        root = _node(x, g, h, np.arange(len(x)), features, depth, rate, l2, least, margin)
        if root.feature is None:
            break
        model.trees.append(root)
    return model


def _node(x, g, h, rows, features, depth, rate, l2, least, margin) -> Node:
    """The subtree of ``rows``; leaves add their value to ``margin``."""
    split = _best_split(x[rows], g[rows], h[rows], l2) if depth else None
    if split is None or split[0] <= least:
        value = float(rate * g[rows].sum() / (h[rows].sum() + l2))
        margin[rows] += value
        return Node(value)
    _, f, at = split
    left = x[rows, f] <= at
    below = [_node(x, g, h, part, features, depth - 1, rate, l2, least, margin) for part in (rows[left], rows[~left])]
    return Node(feature=features[f], bin=at, left=below[0], right=below[1])


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best split of a node's rows, the first of equals."""
    all_g, all_h, best = g.sum(), h.sum(), None
    for f in range(x.shape[1]):
        bins, of = np.unique(x[:, f], return_inverse=True)
        if len(bins) < 2:
            continue
        left_g, left_h = (np.cumsum(np.bincount(of, v))[:-1] for v in (g, h))
        gain = left_g**2 / (left_h + l2) + (all_g - left_g) ** 2 / (all_h - left_h + l2) - all_g**2 / (all_h + l2)
        k = int(gain.argmax())
        if best is None or gain[k] > best[0] + 1e-12:
            best = (float(gain[k]), f, int(bins[k]))
    return best
