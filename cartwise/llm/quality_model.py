"""Quality classifier (operator 2): generalised additive model with pairwise interactions.

Features of a text are DataFrame expressions.  Each has quantile bins, and the
model is a sum of lookup tables: one per feature, and one per chosen pair of
features.  Tables are learnt by cyclic boosting: round after round, every
feature in turn gets a shallow tree (at most two cuts over its bins) fitted to
the current gradient and added, shrunk, to its table; then the pairs with the
largest gain on what is left get trees with one cut on either side.  A score
is the logistic of the summed bin entries, looked up for whole batches.

The fit uses at most ``max_rows`` labelled rows, picked by a hash of the id; the
features, bins and scores of all rows come from Spark, and the driver holds the
sampled feature rows only.

Results for odd input: NULL and empty texts have all-zero features and get a
score like any other; labels may repeat (a document with several counts once
each) or be NULL (ignored); without labels of both kinds every score is the
share of label 1 (0.5 without labels); a NULL id is scored, never learnt from;
an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, full_text, id_long, id_remainder, id_text, written

FOLDS, HELD = 3, 1


def text_features(text: Column) -> dict[str, Column]:
    n_chars = F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(text, SPACES), lambda x: x != "")
    lines = F.split(text, "\n")

    def share(chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))) / n_chars

    return {
        "w": words, "l": lines,
        "log_chars": F.log1p(F.length(text)),
        "symbols": share("#*$%&|<>@~^_=+\\{}[]"),
        "marks": share("!?"),
        "stops": share(".,;:"),
        "digits": share("0123456789"),
        "blanks": share(" \t\n\r"),
        "upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))) / n_chars,
    }


DERIVED = {
    "distinct": lambda: F.size(F.array_distinct("w")) / F.greatest(F.size("w"), F.lit(1)),
    "word_chars": lambda: F.col("chars") / F.greatest(F.size("w"), F.lit(1)),
    "line_words": lambda: F.log1p(F.size("w") / F.greatest(F.size("l"), F.lit(1))),
    "dup_lines": lambda: 1 - F.size(F.array_distinct("l")) / F.greatest(F.size("l"), F.lit(1)),
    "log_words": lambda: F.log1p(F.size("w")),
}
DIRECT = ["log_chars", "symbols", "marks", "stops", "digits", "blanks", "upper"]
FEATURES = DIRECT + list(DERIVED)


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and the FEATURES (double) of every row."""
    text = full_text(docs)
    cols = text_features(text)
    chars = F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).alias("chars")
    wide = docs.select("doc_id", chars, *[c.alias(k) for k, c in cols.items()])
    return wide.select("doc_id", *[F.col(c).cast("double") for c in DIRECT],
                       *[f().cast("double").alias(k) for k, f in DERIVED.items()])


def best_cut(g: np.ndarray, h: np.ndarray, reg: float) -> tuple[float, int]:
    """Gain and place of the best single cut over ordered bins (0: none)."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + reg) + gr**2 / (hr + reg) - g.sum() ** 2 / (h.sum() + reg)
    if not len(gain) or gain.max() <= 1e-12:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, reg: float) -> np.ndarray:
    """Leaf value per bin of a tree with up to two cuts."""
    _, c = best_cut(g, h, reg)
    cuts = {0, c, len(g)}
    if c:
        a, ca = best_cut(g[:c], h[:c], reg)
        b, cb = best_cut(g[c:], h[c:], reg)
        if max(a, b) > 0:
            cuts.add(ca if a >= b else c + cb)
    out = np.zeros(len(g))
    edges = sorted(cuts)
    for lo, hi in zip(edges, edges[1:]):
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + reg)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, reg: float) -> tuple[float, np.ndarray]:
    """Best cut on one side, then one on the other in each half: gain and values."""
    best = (0.0, np.zeros_like(g))
    for axis in (0, 1):
        _, c = best_cut(g.sum(1 - axis), h.sum(1 - axis), reg)
        gg, hh = (g, h) if axis == 0 else (g.T, h.T)
        out, gain = np.zeros_like(gg), 0.0
        for part in ([slice(0, c), slice(c, len(gg))] if c else [slice(0, len(gg))]):
            gs, hs = gg[part].sum(0), hh[part].sum(0)
            _, d = best_cut(gs, hs, reg)
            for side in ([slice(0, d), slice(d, len(gs))] if d else [slice(0, len(gs))]):
                a, b = gs[side].sum(), hs[side].sum() + reg
                out[part, side] = -a / b
                gain += a * a / b
        if gain > best[0]:
            best = (gain, out if axis == 0 else out.T)
    return best


class AdditiveModel:
    """Bin edges, one table per feature, one per pair, and the intercept."""

    def __init__(self, edges, intercept):
        self.edges, self.intercept = edges, intercept
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)]

    def margin(self, bins) -> np.ndarray:
        z = np.full(len(bins[0]), self.intercept)
        for b, t in zip(bins, self.tables):
            z += t[b]
        for (i, j), t in self.pairs.items():
            z += t[bins[i], bins[j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(x)), -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, max_bins: int = 32, rounds: int = 120, pair_rounds: int = 30,
        n_pairs: int = 6, rate: float = 0.15, reg: float = 1.0) -> AdditiveModel:
    """Cyclic boosting of the single tables, then of the best pairs."""
    rates = np.linspace(0, 1, max_bins + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, i], rates)) if len(x) else np.zeros(0) for i in range(x.shape[1])]
    p = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model = AdditiveModel(edges, float(np.log(p / (1 - p))))
    if len(set(y.tolist())) < 2:
        return model
    bins = model.bins(x)
    z = model.margin(bins)

    def slope():
        q = 1 / (1 + np.exp(-z))
        return q - y, np.maximum(q * (1 - q), 1e-9)

    for _ in range(rounds):
        for b, t in zip(bins, model.tables):
            g, h = slope()
            step = rate * shallow_tree(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)), reg)
            t += step
            z += step[b]

    def grid(i, j):
        shape = len(model.tables[i]), len(model.tables[j])
        flat = bins[i] * shape[1] + bins[j]
        g, h = slope()
        return [np.bincount(flat, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)]

    gains = {(i, j): pair_tree(*grid(i, j), reg)[0] for i, j in combinations(range(x.shape[1]), 2)}
    for i, j in sorted(gains, key=lambda k: (-gains[k], k))[:n_pairs]:
        model.pairs[i, j] = np.zeros((len(model.tables[i]), len(model.tables[j])))
    for _ in range(pair_rounds):
        for (i, j), t in model.pairs.items():
            step = rate * pair_tree(*grid(i, j), reg)[1]
            t += step
            z += step[bins[i], bins[j]]
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = 20000) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    rows = written(featured(docs), "features")
    known = labels.filter("quality IS NOT NULL").select("doc_id", "quality")
    train = rows.filter(id_remainder(F.col("doc_id"), FOLDS) != HELD).join(known, "doc_id")
    train = train.withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    n = train.count()
    if n > max_rows:
        train = train.filter(F.col("_h") < int((1 << 30) * max_rows / n))
    sample = train.orderBy("_h", "doc_id", "quality").toPandas()
    model = fit(sample[FEATURES].to_numpy(float).reshape(-1, len(FEATURES)), sample["quality"].to_numpy(float))

    def score_rows(batches):
        for pdf in batches:
            s = model.score(pdf[FEATURES].to_numpy(float).reshape(-1, len(FEATURES)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": s})

    out = id_long(id_text(rows.select("doc_id", *FEATURES)).mapInPandas(score_rows, "doc_id string, score double"))
    return out.select("doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
