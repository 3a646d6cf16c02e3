"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic gradient boosting of shallow trees, one feature at a time, leaves one
lookup table for each feature; the pairs with the largest remaining gain get a
two-dimensional table each.  A score is the logistic of the sum of table
entries, so scoring is binning plus vectorised additions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import words
from cirrus.llm.sampling import held_out, labelled_sample

MAX_TRAIN_ROWS = 20_000  # bound of the fitted sample
THRESHOLD = 0.3
FEATURES = (
    "log_words", "word_length", "upper", "digit", "punct", "symbol", "pipe", "gap", "distinct_words",
    "adjacent_repeats", "repeated_lines", "words_per_line", "bang_words", "bare_words",
)


@dataclass
class Gam:
    """Bin edges by feature, tables by feature, and (i, j, table) for pairs.

    ``pair_edges`` are the coarser edges that the pair tables use."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``; NaN counts as 0."""
        x = np.nan_to_num(x)
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        coarse = {f: np.searchsorted(self.pair_edges[f], x[:, f], side="right") for i, j, _ in self.pairs for f in (i, j)}
        for i, j, table in self.pairs:
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h, l2):
    return g * g / (h + l2)


def _cut(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, int]:
    """Best gain and place of one cut over ordered bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(gl, hl, l2) + _gain(g.sum() - gl, h.sum() - hl, l2) - _gain(g.sum(), h.sum(), l2)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, l2: float, leaves: int = 3) -> np.ndarray:
    """Values by bin of a shallow tree, grown by the best cut each time."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_cut(g[a:b], h[a:b], l2), a, b) for a, b in parts]
        gain, k, a, b = max(cuts)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + l2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Best pair of cuts (one for each feature) over a grid: gain and values."""
    best, values = 0.0, np.zeros_like(g)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    whole = _gain(cg[-1, -1], ch[-1, -1], l2)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            quarter = []
            for c in (cg, ch):
                a, b, d, t = c[i, j], c[i, -1], c[-1, j], c[-1, -1]
                quarter.append(np.array([a, b - a, d - a, t - b - d + a]))
            gain = float(_gain(*quarter, l2).sum() - whole)
            if gain > best:
                v = quarter[0] / (quarter[1] + l2)
                values = np.empty_like(g)
                values[: i + 1, : j + 1], values[: i + 1, j + 1 :] = v[0], v[1]
                values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = v[2], v[3]
                best = gain
    return best, values


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 32, n_pairs: int = 6,
    pair_rounds: int = 25, pair_bins: int = 8, l2: float = 2.0,
) -> Gam:
    """Fit on rows ``x`` and labels ``y`` (0 or 1).

    No rows: every score is 0.5.  One label only: the smoothed share of it.
    """
    if len(y) == 0:
        return Gam()
    x = np.nan_to_num(x)
    rate_1 = (y.sum() + 1) / (len(y) + 2)
    model = Gam(base=float(np.log(rate_1 / (1 - rate_1))))
    if y.min() == y.max():
        return model
    n, k = x.shape
    model.edges = [_edges(x[:, f], bins) for f in range(k)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    total = np.full(n, model.base)

    def moments():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(k):
            g, h = moments()
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(binned[f], g, size), np.bincount(binned[f], h, size), l2)
            model.tables[f] += step
            total += step[binned[f]]

    model.pair_edges = [_edges(x[:, f], pair_bins) for f in range(k)]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]

    def grid(i, j):
        a, b = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
        at = coarse[i] * b + coarse[j]
        g, h = moments()
        return np.bincount(at, g, a * b).reshape(a, b), np.bincount(at, h, a * b).reshape(a, b)

    ranked = sorted(((-_quadrants(*grid(i, j), l2)[0], i, j) for i in range(k) for j in range(i)))[:n_pairs]
    model.pairs = [(i, j, np.zeros((len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1))) for _, i, j in ranked]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * _quadrants(*grid(i, j), l2)[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def feature_columns(text: Column) -> dict[str, Column]:
    """Features of a whole text, by name, for use after the word and line
    arrays ``__w`` and ``__l`` exist (see :func:`with_features`)."""
    t, w, lines = text, F.col("__w"), F.col("__l")
    left = lambda keep: F.length(F.regexp_replace(t, f"[^{keep}]+", ""))
    chars = F.greatest(F.length(t), F.lit(1))
    n = F.greatest(F.size(w), F.lit(1))
    return {
        "log_words": F.log1p(F.size(w).cast("double")),
        "word_length": F.length(t) / n,
        "upper": left(r"\p{Lu}") / chars,
        "digit": left(r"0-9") / chars,
        "punct": left(r"\p{Punct}") / chars,
        "symbol": left(r"#*$%&<>") / chars,
        "pipe": left(r"|") / chars,
        "gap": left(r"\x20\x09-\x0D") / chars,
        "distinct_words": F.size(F.array_distinct(w)) / n,
        "adjacent_repeats": F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))) / n,
        "repeated_lines": (F.size(lines) - F.size(F.array_distinct(lines))) / F.greatest(F.size(lines), F.lit(1)),
        "words_per_line": n / F.greatest(F.size(lines), F.lit(1)),
        "bang_words": F.size(F.filter(w, lambda x: x.endswith("!"))) / n,
        "bare_words": F.size(F.filter(w, lambda x: F.length(x) == 1)) / n,
    }


def with_features(docs: DataFrame, to: str = "__x") -> DataFrame:
    """``docs`` plus an array of the features of ``text`` (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.withColumn("__w", words(F.col("text"))).withColumn(
        "__l", F.filter(F.split(text, "\n"), lambda x: F.length(x) > 0)
    )
    made = feature_columns(text)
    return d.withColumn(to, F.array(*[made[f].cast("double") for f in FEATURES])).drop("__w", "__l")


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> Gam:
    """Fit on at most ``max_rows`` labelled documents outside the held-out fold."""
    rows = with_features(labelled_sample(docs, labels, [target], max_rows)).select("doc_id", "__x", target)
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).toPandas()
    x = np.array(got["__x"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    return fit(x, got[target].to_numpy(dtype=float))


def score(docs: DataFrame, model: Gam, to: str = "score") -> DataFrame:
    """``docs`` plus the score (0 to 1) of every whole text.

    Empty and null texts are scored like any other; an existing column ``to``
    is replaced."""

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        rows = np.array(x.tolist(), dtype=float).reshape(len(x), len(FEATURES))
        return pd.Series(model.score(rows))

    # Marked as not deterministic so that a filter on the score stays above it:
    # pushed below, it would take the word array into the features' lambdas,
    # to be split anew for every word.
    return with_features(docs).withColumn(to, scored.asNondeterministic()("__x")).drop("__x")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.3) of every document.

    Labels of held-out ids are never read; ids, sources and languages are
    never features.  Without labels every score is 0.5.
    """
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
