"""Language identification by string kernels.

A text's features are the n-grams (n = 1 to 3) of its lower-case letters that
it has at least once, any other character counting as a blank.  The kernel of
two texts is the number of n-grams they share over the geometric mean of their
numbers (blended spectrum, presence).  A bounded sample of landmark texts gives
Nystroem features of that kernel, and kernel ridge regression, one language
against the rest, is solved in them.  Scoring a batch of texts is a product of
its presence matrix with one matrix of weights by n-gram and language, into
which the landmarks' kernel columns and the regression are folded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirrus.llm.common import cut, cut_wide
from cirrus.llm.sampling import fold

ORDERS = 3  # longest n-gram
LANDMARKS = 320  # texts, spread evenly over the languages, at least one each
FIT_TEXTS = 6_000  # texts the regression is fitted on, likewise
RIDGE = 1e-3
SHARPNESS = 8.0  # of the softmax that turns decisions into a score
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2

_CHUNK = 1 << 20  # characters handled at once
_CELLS = 1 << 23  # cells of a presence matrix
_NONE = 0x1FFFFF  # no character: more than any code point
_TABLE = 1 << 24  # entries of a direct n-gram table at most


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, FOLDS) == HELD_OUT


_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether a code point is a letter; built once in each worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _runs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Characters of the texts in pieces of about ``_CHUNK``: code points (0
    for anything but letters), the text each belongs to, and whether an n-gram
    starts there.  Every text has a blank before and two after it; a longer one
    continues in the next piece, which repeats its last two characters."""
    letter = _is_letter()
    parts, rows, size = [], [], 0

    def flush():
        points = np.concatenate(parts)
        row = np.repeat(np.array(rows), [len(p) for p in parts])
        starts = np.ones(len(points), bool)
        ends = np.cumsum([len(p) for p in parts])
        for k in (1, 2):
            starts[np.maximum(ends - k, 0)] = False
        return np.where(letter[points], points, 0), row, starts

    for i, t in enumerate(texts):
        if not t:
            continue
        points = np.frombuffer(f" {t.lower()}  ".encode("utf-32-le", "surrogatepass"), np.uint32)
        for a in range(0, max(1, len(points) - 2), _CHUNK):
            piece = points[a : a + _CHUNK + 2]
            parts.append(piece)
            rows.append(i)
            size += len(piece)
            if size >= _CHUNK:
                yield flush()
                parts, rows, size = [], [], 0
    if parts:
        yield flush()


def _packed(points: np.ndarray) -> list[np.ndarray]:
    """N-grams that start at each character, by n, three code points in 63 bits.

    Blanks alone are no n-gram (-1)."""
    p = points.astype(np.int64)
    after = [p, np.concatenate((p[1:], np.zeros(1, np.int64))), np.concatenate((p[2:], np.zeros(2, np.int64)))]
    out, some = [], np.zeros(len(p), bool)
    for n in range(1, ORDERS + 1):
        some |= after[n - 1] > 0
        code = np.zeros(len(p), np.int64)
        for j in range(ORDERS):
            code = (code << 21) | (after[j] if j < n else _NONE)
        out.append(np.where(some, code, -1))
    return out


@dataclass
class Model:
    """``grams`` (sorted packed n-grams), ``weights`` (n-gram by language) and
    ``languages``; without languages every text is unknown."""

    languages: list[str] = field(default_factory=list)
    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    def decisions(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """One decision a text and language, and which texts have letters."""
        finder = Finder(self.grams)
        out = np.zeros((len(texts), len(self.languages)), np.float32)
        lettered = np.zeros(len(texts), bool)
        for rows, present, some in finder.presence(texts):
            lettered[rows] = some
            if self.languages:
                norm = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
                out[rows] = present @ self.weights / norm
        return out, lettered


class Finder:
    """Places of n-grams among ``grams``: by a table over the letters that
    occur in them, or by binary search where that table would be too large."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        parts = np.stack([(grams >> (21 * (ORDERS - 1 - j))) & _NONE for j in range(ORDERS)]) if len(grams) else np.zeros((ORDERS, 0), np.int64)
        letters = np.unique(parts[(parts != _NONE) & (parts != 0)])
        self.size = len(letters) + 2  # 0 blank, last: any other letter
        self.tables = None
        if self.size**ORDERS <= _TABLE:
            self.small = np.full(0x110000, self.size - 1, np.int32)
            self.small[letters] = np.arange(1, len(letters) + 1)
            self.small[0] = 0
            self.tables = []
            for n in range(1, ORDERS + 1):
                mine = (parts[n - 1] != _NONE) if n == ORDERS else (parts[n - 1] != _NONE) & (parts[n] == _NONE)
                table = np.full(self.size**n, -1, np.int32)
                at = np.zeros(int(mine.sum()), np.int64)
                for j in range(n):
                    at = at * self.size + self.small[parts[j][mine]]
                table[at] = np.flatnonzero(mine)
                self.tables.append(table)

    def places(self, points: np.ndarray) -> list[np.ndarray]:
        if self.tables is None:
            out = []
            for code in _packed(points):
                k = np.minimum(np.searchsorted(self.grams, code), len(self.grams) - 1)
                out.append(np.where(self.grams[k] == code, k, -1).astype(np.int32))
            return out
        letter = self.small[points]
        out, at = [], np.zeros(len(points), np.int32)
        for n in range(ORDERS):
            after = np.zeros(len(points), np.int32)
            after[: len(points) - n] = letter[n:]
            at = at * np.int32(self.size) + after
            out.append(self.tables[n][at])
        return out

    def presence(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For some texts at a time: their rows, presence matrix (text by
        n-gram, 0 or 1) and whether each has a letter."""
        width = max(1, len(self.grams))
        step = max(1, _CELLS // width)
        for a in range(0, len(texts), step):
            some = texts[a : a + step]
            x = np.zeros((len(some), width), np.float32)
            lettered = np.zeros(len(some), bool)
            for points, row, starts in _runs(some):
                lettered[row[points > 0]] = True
                if len(self.grams):
                    base = row * width
                    for place in self.places(points):
                        good = starts & (place >= 0)
                        x.reshape(-1)[base[good] + place[good]] = 1
            yield np.arange(a, a + len(some)), x, lettered


def _distinct_grams(text: str | None) -> np.ndarray:
    out = [np.zeros(0, np.int64)]
    for points, _, starts in _runs([text]):
        out.append(np.unique(np.concatenate([c[starts] for c in _packed(points)])))
    got = np.unique(np.concatenate(out))
    return got[got >= 0]


def sample(docs: DataFrame, landmarks: int = LANDMARKS, fit_texts: int = FIT_TEXTS) -> DataFrame:
    """lang, text and landmark of the texts that are learnt from: up to an even
    share of ``fit_texts`` of each language, chosen by a hash of the id.

    Held-out documents and null languages are never taken; of rows that repeat
    in id and language the least text counts.  Only ids and languages are ranked;
    texts that are not chosen are dropped in the scan."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = cut(known.groupBy(F.col("lang").alias("__l")).agg(F.count(F.lit(1)).alias("__n")))
    n_langs = max(1, counts.count())
    share, marks = max(1, fit_texts // n_langs), max(1, landmarks // n_langs)
    # Three times the share lies below the threshold, so ranking has few rows.
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    below = known.select("lang", "doc_id").join(F.broadcast(counts), F.col("lang") == F.col("__l"))
    below = below.where(draw <= (3.0 * share + 100) / F.col("__n")).select("lang", "doc_id").distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = below.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= share)
    chosen = cut(chosen.select(F.col("lang").alias("__l"), F.col("doc_id").alias("__id"), "__r"))
    same = (F.col("lang") == F.col("__l")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), same)  # at most ``fit_texts`` ids
    one = texts.groupBy("lang", "doc_id", "__r").agg(F.min("text").alias("text"))
    return cut_wide(one.select("lang", "text", (F.col("__r") <= marks).alias("landmark")))


def train(docs: DataFrame, landmarks: int = LANDMARKS, fit_texts: int = FIT_TEXTS) -> Model:
    """Model from the texts and languages outside the held-out fold.

    The driver gets the landmarks' n-grams and one row of ``landmarks`` kernel
    values for each fitted text, never a text."""
    chosen = sample(docs, landmarks, fit_texts)

    def grams(batches):
        for b in batches:
            got = [_distinct_grams(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(got, pa.list_(pa.int64()))], names=["lang", "grams"])

    marked = chosen.where("landmark").select("lang", "text").mapInArrow(grams, "lang string, grams array<long>")
    marks = sorted((r["lang"], tuple(r["grams"])) for r in marked.collect() if r["grams"])
    if not marks:
        return Model()
    vocabulary, n = np.unique(np.concatenate([np.array(g) for _, g in marks]), return_counts=True)
    # An n-gram of one landmark tells two texts apart only by chance.
    vocabulary = vocabulary[n > 1] if (n > 1).any() else vocabulary
    columns = np.zeros((len(vocabulary), len(marks)), np.float32)
    for j, (_, g) in enumerate(marks):
        k = np.minimum(np.searchsorted(vocabulary, g), len(vocabulary) - 1)
        columns[k[vocabulary[k] == np.array(g)], j] = 1
    columns /= np.sqrt(np.maximum(columns.sum(axis=0), 1))

    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, columns))  # bounded by the landmarks

    def kernels(batches):
        grams_of, marks_of = shared.value
        finder = Finder(grams_of)
        for b in batches:
            for rows, x, some in finder.presence(b.column("text").to_pylist()):
                k = x @ marks_of / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
                langs = b.column("lang").take(pa.array(rows[some]))
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(list(k[some].astype(np.float32)), pa.list_(pa.float32()))], names=["lang", "k"]
                )

    rows = chosen.select("lang", "text").mapInArrow(kernels, "lang string, k array<float>").collect()
    # Sorted, so that sums do not depend on the order in which tasks end.
    rows = sorted((r["lang"], tuple(r["k"])) for r in rows)
    languages = sorted({lang for lang, _ in rows})
    k_nm = np.array([k for _, k in rows], dtype=np.float64)
    index = {lang: j for j, lang in enumerate(languages)}
    y = np.zeros((len(rows), len(languages)))
    y[np.arange(len(rows)), [index[lang] for lang, _ in rows]] = 1
    return Model(languages, vocabulary, (columns @ _regress(k_nm, columns, y)).astype(np.float32))


def _regress(k_nm: np.ndarray, columns: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights by landmark and language: ridge regression in Nystroem features.

    Targets are 1 for the language and minus its share elsewhere, each language
    weighing the same; there is no constant term, so that the languages' order
    does not depend on a text's length."""
    k_mm = columns.astype(np.float64).T @ columns
    values, vectors = np.linalg.eigh(k_mm)
    good = values > values.max() * 1e-6
    to_features = vectors[:, good] / np.sqrt(values[good])
    phi = k_nm @ to_features
    weight = (y / y.sum(axis=0)).sum(axis=1, keepdims=True) / y.shape[1]
    target = y - (weight * y).sum(axis=0)
    gram = phi.T @ (weight * phi) + RIDGE * np.eye(phi.shape[1])
    return to_features @ np.linalg.solve(gram, phi.T @ (weight * target))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus lang_pred and score for every whole text.

    Columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts):
        import pandas as pd

        m = shared.value
        f, lettered = m.decisions(texts.tolist())
        if not m.languages:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0})
        e = np.exp(SHARPNESS * (f - f.max(axis=1, keepdims=True)).astype(np.float64))
        best = f.argmax(axis=1)
        score = np.where(lettered, e[np.arange(len(f)), best] / e.sum(axis=1), 0.0)
        return pd.DataFrame({"lang_pred": np.where(lettered, np.array(m.languages, object)[best], UNKNOWN), "score": score})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.withColumn("__g", guess.asNondeterministic()("text"))
    return out.select(*kept, F.col("__g.lang_pred").alias("lang_pred"), F.col("__g.score").alias("score"))


def languages_of(docs: DataFrame, landmarks: int = LANDMARKS, fit_texts: int = FIT_TEXTS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text if there is nothing to learn from.  A null id counts as the empty text
    and is learnt from.  Repeated rows get the same result; an empty table gives
    no rows.  Columns other than doc_id, text and lang are left alone.
    """
    model = train(docs.select("doc_id", "text", "lang"), landmarks, fit_texts)
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
