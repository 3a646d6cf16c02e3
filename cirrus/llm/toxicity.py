"""Toxicity by a classifier chain.

Categories are predicted in a fixed order.  Each has a logistic model over
words and word beginnings; the models after the first also take the
probabilities of the categories before them.  Those inputs are out-of-fold
predictions while training, so that a later model sees them as noisy as they
will be.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import cut, id_text, words
from cirrus.llm.sampling import held_out, labelled_sample

MAX_TRAIN_ROWS = 20_000  # bound of the fitted sample
MAX_FEATURES = 3_000  # for each category
LEAST_Z = 5.0  # standard errors that a feature's shares must differ by
FOLDS = 3
THRESHOLD = 0.4
PREFIXES = (4, 5, 6)  # lengths of the word beginnings that are features
TRIM = ".,;:!?#*$%&|()[]\"'"
CATEGORIES = ("quality", "toxic")  # the label columns, in chain order


@dataclass
class Linear:
    """Weights by feature, then by earlier category; and a constant."""

    weights: np.ndarray
    chained: np.ndarray
    bias: float

    def predict(self, rows: np.ndarray, cols: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        z = np.bincount(rows, self.weights[cols], n) + before @ self.chained + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 0.001, 0.999)
    return np.log(p / (1 - p)) / 4


def fit_linear(
    rows: np.ndarray, cols: np.ndarray, before: np.ndarray, y: np.ndarray, k: int, steps: int = 150, l2: float = 1e-4
) -> Linear:
    """Logistic regression on present features (row, column) by Adam.

    Both classes weigh the same.  One class only: a constant."""
    n = len(y)
    model = Linear(np.zeros(k), np.zeros(before.shape[1]), 0.0)
    share = (y.sum() + 1) / (n + 2)
    if n == 0 or y.min() == y.max():
        model.bias = float(np.log(share / (1 - share))) if n else 0.0
        return model
    weigh = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, n - y.sum()))
    at = np.zeros(k + before.shape[1] + 1)
    m, v = np.zeros_like(at), np.zeros_like(at)
    for t in range(1, steps + 1):
        model = Linear(at[:k], at[k:-1], float(at[-1]))
        err = weigh * (model.predict(rows, cols, n, before) - y)
        g = np.concatenate([np.bincount(cols, err[rows], k) + l2 * at[:k], before.T @ err + l2 * at[k:-1], [err.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        at = at - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Linear(at[:k], at[k:-1], float(at[-1]))


@dataclass
class Chain:
    features: dict[str, int]
    models: list[Linear]

    def predict(self, texts: Sequence[str]) -> np.ndarray:
        """Probability of every category, in order, for each text."""
        n = len(texts)
        rows, cols = self.present(texts)
        out = np.zeros((n, 0))
        for model in self.models:
            out = np.column_stack([out, model.predict(rows, cols, n, _logit(out))])
        return out

    def present(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        rows, cols, known = [], [], self.features
        for i, t in enumerate(texts):
            found = set()
            for raw in set(t.lower().split()):
                w = raw.strip(TRIM)
                for f in (w, *[f"{w[:k]}-" for k in PREFIXES if len(w) > k]):
                    j = known.get(f)
                    if j is not None:
                        found.add(j)
            cols.extend(sorted(found))
            rows.extend([i] * len(found))
        return np.array(rows, dtype=np.int64), np.array(cols, dtype=np.int64)


def _feature_array(text: Column) -> Column:
    """Distinct features of a text: words, and word beginnings marked by a hyphen."""
    w = F.array_distinct(F.transform(words(F.lower(text)), lambda x: F.trim(x, F.lit(TRIM))))
    starts = [F.transform(F.filter(w, lambda x, k=k: F.length(x) > k), lambda x, k=k: F.concat(F.substring(x, 1, k), F.lit("-"))) for k in PREFIXES]
    return F.array_distinct(F.concat(w, *starts))


def choose_features(sample: DataFrame, categories: Sequence[str], most: int = MAX_FEATURES) -> list[str]:
    """The features whose share of documents differs most between the labels of
    a category, in standard errors (``LEAST_Z`` at least, so that chance finds
    among a million words stay out); at most ``most`` for each category."""
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    n = totals["n"]
    if not n:
        return []
    counted = sample.select(F.explode(_feature_array(F.col("text"))).alias("f"), *categories).groupBy("f")
    counted = cut(counted.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories]).where("n >= 5"))
    chosen: set[str] = set()
    for c in categories:
        pos = totals[c] or 0
        if 0 < pos < n:
            a, b, p = F.col(c) / pos, (F.col("n") - F.col(c)) / (n - pos), F.col("n") / n
            z = F.abs(a - b) / F.sqrt(p * (1 - p) * (1 / pos + 1 / (n - pos)) + 1e-12)
            top = counted.where((F.col("f") != "") & (z >= LEAST_Z)).orderBy(F.desc(z), "f").limit(most).select("f")
            chosen |= {r["f"] for r in top.collect()}
    return sorted(chosen)


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = CATEGORIES, max_rows: int = MAX_TRAIN_ROWS) -> Chain:
    """Fit the chain on at most ``max_rows`` labelled documents outside the
    held-out fold.  Without labels every probability is 0.5."""
    sample = cut(labelled_sample(docs, labels, list(categories), max_rows))
    chain = Chain({f: i for i, f in enumerate(choose_features(sample, categories))}, [])

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, cols = chain.present(b["text"])
            ends = np.searchsorted(rows, np.arange(1, len(b)))
            yield b.drop(columns="text").assign(found=[x.tolist() for x in np.split(cols, ends)])

    kind = sample.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} int' for c in categories)}, found array<long>"
    got = sample.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(max_rows)
    got = got.select("doc_id", *categories, "text").mapInPandas(present, schema).toPandas()
    n, k = len(got), len(chain.features)
    sizes = np.array([len(x) for x in got["found"]], dtype=np.int64)
    rows = np.repeat(np.arange(n), sizes)
    cols = np.concatenate([np.asarray(x, dtype=np.int64) for x in got["found"]]) if sizes.sum() else np.zeros(0, dtype=np.int64)
    part = np.arange(n) % FOLDS
    before = np.zeros((n, 0))
    for c in categories:
        y = got[c].to_numpy(dtype=float)
        chain.models.append(fit_linear(rows, cols, before, y, k))
        if c == categories[-1]:
            break
        unseen = np.zeros(n)
        for f in range(FOLDS):
            fitted, asked = part != f, part == f
            new = np.cumsum(fitted) - 1
            use = fitted[rows]
            m = fit_linear(new[rows[use]], cols[use], before[fitted], y[fitted], k)
            unseen[asked] = m.predict(rows, cols, n, before)[asked]
        before = np.column_stack([before, _logit(unseen)])
    return chain


def toxicity_scores(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """doc_id, held_out, the probability of each category (p_<name>), score (that
    of the last category) and predicted (score >= 0.4) of every whole text.

    A null text counts as empty; empty texts get the models' constants.
    """
    chain = train(docs, labels, categories)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = chain.predict(b["text"])
            yield pd.DataFrame({"doc_id": b["doc_id"], **{f"p_{c}": p[:, i] for i, c in enumerate(categories)}})

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select(id_text(), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        score, f"doc_id string, {', '.join(f'p_{c} double' for c in categories)}"
    )
    scored = scored.withColumn("doc_id", F.col("doc_id").cast(kind))
    last = F.col(f"p_{categories[-1]}")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), *[f"p_{c}" for c in categories],
        last.alias("score"), (last >= THRESHOLD).cast("int").alias("predicted"),
    )
