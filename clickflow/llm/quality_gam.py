"""Quality classifier: a generalised additive model with pairwise terms.

Features are cut into quantile bins. Boosting cycles over the features; each
step fits a shallow tree to the current gradients of one feature's bins and
adds it to that feature's lookup table. Then the pairs whose two-way residual
structure gains most get tables of their own the same way. A document's score
is the sum of one table entry per feature and pair, through the logistic.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.features import (QUALITY, collect_sample, feature_rows, keep_rows,
                                    quality_features, sample_ids)
from clickflow.llm.sqltext import held_out

SAMPLE_ROWS = 20_000   # labelled documents the model is fitted on, at most
BINS = 64
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 60            # passes over all features
PAIR_ROUNDS = 30
LEAVES = 3             # of a step's tree
RATE = 0.15
RIDGE = 5.0            # added to the hessian of a leaf
THRESHOLD = 0.3


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _cuts(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))


def _split_tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf value of each bin: the best tree of so many leaves grown greedily
    on the bins' gradient and hessian sums."""
    edges = [(0, len(g))]
    gs, hs = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, -1
        at = np.arange(lo + 1, hi)
        gl, hl = gs[at] - gs[lo], hs[at] - hs[lo]
        gt, ht = gs[hi] - gs[lo], hs[hi] - hs[lo]
        gain = (gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE))
        i = int(np.argmax(gain))
        return float(gain[i]), int(at[i])

    while len(edges) < leaves:
        (gain, cut), e = max(((best(*e), e) for e in edges), key=lambda t: t[0][0])
        if gain <= 1e-9:
            break
        edges.remove(e)
        edges += [(e[0], cut), (cut, e[1])]
    out = np.zeros(len(g))
    for lo, hi in edges:
        out[lo:hi] = (gs[hi] - gs[lo]) / (hs[hi] - hs[lo] + RIDGE)
    return out


def _cross_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values on a two-way grid: one cut on each axis, the best four
    quadrants."""
    def corner(a: np.ndarray) -> np.ndarray:
        return np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0)))[1:-1, 1:-1]

    if min(g.shape) < 2:
        return np.zeros_like(g)
    gl, hl = corner(g), corner(h)
    gr, hr = g.sum(1).cumsum()[:-1, None] - gl, h.sum(1).cumsum()[:-1, None] - hl
    gd, hd = g.sum(0).cumsum()[None, :-1] - gl, h.sum(0).cumsum()[None, :-1] - hl
    go, ho = g.sum() - gl - gr - gd, h.sum() - hl - hr - hd
    gain = sum(a ** 2 / (b + RIDGE) for a, b in ((gl, hl), (gr, hr), (gd, hd), (go, ho)))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(g)
    for a, b, rows, cols in ((gl, hl, slice(0, i + 1), slice(0, j + 1)),
                             (gr, hr, slice(0, i + 1), slice(j + 1, None)),
                             (gd, hd, slice(i + 1, None), slice(0, j + 1)),
                             (go, ho, slice(i + 1, None), slice(j + 1, None))):
        out[rows, cols] = a[i, j] / (b[i, j] + RIDGE)
    return out


@dataclass
class Gam:
    """Intercept, one (cuts, table) per feature, and one (i, j, cuts_i,
    cuts_j, table) per pair."""
    intercept: float
    mains: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row of ``x``."""
        z = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(self.mains):
            z += table[np.searchsorted(cuts, x[:, j], side="left")]
        for i, j, ci, cj, table in self.pairs:
            z += table[np.searchsorted(ci, x[:, i], side="left"),
                       np.searchsorted(cj, x[:, j], side="left")]
        return sigmoid(z)


def fit_gam(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit on feature rows and 0/1 labels. Without rows the score is 1/2
    everywhere; with one class it is near that class everywhere."""
    p = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
    model = Gam(float(np.log(p / (1 - p))))
    if not len(y):
        return model
    z = np.full(len(y), model.intercept)
    cuts = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            q = sigmoid(z)
            n = len(tables[j])
            step = RATE * _split_tree(np.bincount(b, y - q, n), np.bincount(b, q * (1 - q), n))
            tables[j] += step
            z += step[b]
    model.mains = list(zip(cuts, tables))
    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cb = [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(coarse)]
    shape = [len(c) + 1 for c in coarse]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        q = sigmoid(z)
        at, n = cb[i] * shape[j] + cb[j], shape[i] * shape[j]
        return (np.bincount(at, y - q, n).reshape(shape[i], shape[j]),
                np.bincount(at, q * (1 - q), n).reshape(shape[i], shape[j]))

    def worth(i: int, j: int) -> float:
        g, h = grids(i, j)
        return float((g * _cross_tree(g, h)).sum())

    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda ij: (-worth(*ij), ij))[:PAIRS]
    pair_tables = {ij: np.zeros((shape[ij[0]], shape[ij[1]])) for ij in ranked}
    for _ in range(PAIR_ROUNDS):
        for i, j in ranked:
            step = RATE * _cross_tree(*grids(i, j))
            pair_tables[i, j] += step
            z += step[cb[i], cb[j]]
    model.pairs = [(i, j, coarse[i], coarse[j], t) for (i, j), t in pair_tables.items()]
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> Gam:
    """Model from ``labels`` (doc_id, quality) of documents outside the held-out
    fold. The sample's ids, at most ``max_rows``, are broadcast."""
    ids = sample_ids(labels, "quality", max_rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = feature_rows(picked, quality_features, ["doc_id", "y"])
    return fit_gam(*collect_sample(rows, max_rows, len(QUALITY)))


def score_documents(docs: DataFrame, model: Gam) -> DataFrame:
    """doc_id and score per row of ``docs``: every whole text, also empty and
    NULL ones; repeated rows give one each."""

    def extract(texts: list[bytes]) -> np.ndarray:
        return model.score(quality_features(texts))[:, None]

    rows = feature_rows(docs, extract, ["doc_id"])
    return rows.select("doc_id", F.col("x")[0].alias("score"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted per row of ``docs``."""
    s = score_documents(docs, fit_quality(docs, labels))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored below ``threshold``; same columns."""
    model = fit_quality(docs, labels)
    return keep_rows(docs, lambda texts: model.score(quality_features(texts)) >= threshold)
