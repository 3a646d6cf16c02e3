"""Cross-entropy difference between a target and a background language model.

Both models are interpolated character n-gram models over one vocabulary:
every code point of all documents, and the edge of a text.  The score of a
text is its mean loss a token under the target model less that under the
background model; the lower, the more like the target.

Counts cover every document and every code point.  Counts, probabilities and
losses are tables that grow with the corpus.  Texts meet the losses in two
ways that together cover every token: a table of ``2 ** SLOT_BITS`` slots, each
holding the most frequent of the n-grams that hash to it, goes to all workers
(28 MB, whatever the corpus size); occurrences of all other n-grams are summed
up by document and joined to the stored losses.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import cut, cut_wide, id_text, sized
from cirrus.llm.sampling import held_out

ORDER = 4  # the symbols before a token, at most three, fill one long
SLOT_BITS = 20
_BITS = 21  # of a symbol: code point + 1, or 0 for the edge of a text
_PIECE = 1 << 21  # code points held at once; longer texts are read in pieces


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def pieces(texts: list[str], before: int, size: int = _PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(symbols, place, owner) of about ``size`` code points at a time.

    ``symbols[place]`` are tokens, ``owner`` the number of their text;
    ``before`` symbols stand before each run of tokens: the edge, or what
    precedes in the text."""
    held: list[tuple[int, str, str]] = []
    full = 0
    for i, t in enumerate(texts):
        for a in range(0, len(t), size):
            held.append((i, t[max(0, a - before) : a], t[a : a + size]))
            full += len(held[-1][2])
            if full >= size:
                yield _joined(held, before)
                held, full = [], 0
    if held:
        yield _joined(held, before)


def _joined(held: list[tuple[int, str, str]], before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for _, _, t in held])
    run = np.repeat(np.arange(len(held)), lengths)
    place = np.arange(lengths.sum()) + before * (run + 1)
    symbols = np.zeros(lengths.sum() + before * len(held), dtype=np.int64)
    symbols[place] = _codes("".join(t for _, _, t in held)).astype(np.int64) + 1
    starts = np.cumsum(lengths + before) - lengths
    for s, (_, left, _) in zip(starts, held):
        if left:
            symbols[s - len(left) : s] = _codes(left).astype(np.int64) + 1
    return symbols, place, np.array([i for i, _, _ in held])[run]


def grams(symbols: np.ndarray, place: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each place: the packed symbols before it, and its symbol."""
    ctx = np.zeros(len(place), dtype=np.int64)
    for k in range(order - 1, 0, -1):
        ctx = ctx << _BITS | symbols[place - k]
    return ctx, symbols[place]


def tally(symbols: np.ndarray, place: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ctx, next, n) of the n-grams that end at the places, each once or, where
    a piece has too many different symbols for one number, once for each half."""
    seen = np.zeros(1 << _BITS, dtype=bool)
    for k in range(order):
        seen[symbols[place - k]] = True
    names = np.flatnonzero(seen)
    base = len(names)
    if base**order >= 1 << 63:
        half = len(place) // 2
        yield from tally(symbols, place[:half], order)
        yield from tally(symbols, place[half:], order)
        return
    number = np.zeros(1 << _BITS, dtype=np.int64)
    number[names] = np.arange(base)
    dense = number[symbols]
    key = np.zeros(len(place), dtype=np.int64)
    for k in range(order - 1, -1, -1):
        key = key * base + dense[place - k]
    key, n = np.unique(key, return_counts=True)
    ctx = np.zeros(len(key), dtype=np.int64)
    for k in range(order - 1, 0, -1):
        ctx = ctx << _BITS | names[key // base**k % base]
    yield ctx, names[key % base], n


def slots(ctx: np.ndarray, following: np.ndarray, bits: int) -> np.ndarray:
    """The slot of each n-gram."""
    x = ctx.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + following.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """ctx, next, background, target: counts over all rows of ``docs`` (text, is_target)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for wanted, part in b.groupby("is_target"):
                for symbols, place, _ in pieces(part["text"].tolist(), order - 1):
                    for ctx, following, n in tally(symbols, place, order):
                        yield pd.DataFrame({"ctx": ctx, "next": following, "background": n, "target": n * int(wanted)})

    counted = docs.mapInPandas(count, "ctx long, next int, background long, target long")
    return _summed(counted)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("ctx", "next").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


def _last(ctx: str, symbols: int) -> Column:
    """The last so many symbols of a packed run."""
    return F.col(ctx).bitwiseAND(F.lit((1 << _BITS * symbols) - 1).cast("long"))


def losses(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """ctx, next, n, target_loss and background_loss of every n-gram of
    :func:`gram_counts` (already cut).

    Witten-Bell: with k different followers of a context (1 if it has none),
    p = (count + k * p of the shorter n-gram) / (count of the context + k), down
    to the uniform model over all code points that occur."""
    low = None
    for n in range(1, order + 1):
        here = counts if n == order else cut(_summed(counts.withColumn("ctx", _last("ctx", n - 1))))
        if n == 1:
            floor = 1.0 / max(1, here.count())
        models = ("background", "target")
        seen = here.groupBy("ctx").agg(
            *[F.sum(m).alias(f"seen_{m}") for m in models],
            *[F.greatest(F.count(F.when(F.col(m) > 0, 1)), F.lit(1)).alias(f"kinds_{m}") for m in models],
        )
        rows = here.join(sized(cut(seen.withColumnRenamed("ctx", "__c")), 56), F.col("ctx") == F.col("__c"))
        if low is None:
            rows = rows.withColumns({f"low_{m}": F.lit(floor) for m in models})
        else:
            lower = low.select(
                F.col("ctx").alias("__l"), F.col("next").alias("__n"), *[F.col(f"p_{m}").alias(f"low_{m}") for m in models]
            )
            rows = rows.join(sized(lower, 48), (_last("ctx", n - 2) == F.col("__l")) & (F.col("next") == F.col("__n")))
        p = {
            m: (F.col(m) + F.col(f"kinds_{m}") * F.col(f"low_{m}")) / (F.col(f"seen_{m}") + F.col(f"kinds_{m}"))
            for m in models
        }
        low = rows.select("ctx", "next", F.col("background").alias("n"), *[p[m].alias(f"p_{m}") for m in models])
        low = cut(low) if n < order else low
    return low.select("ctx", "next", "n", *[(-F.log(f"p_{m}")).alias(f"{m}_loss") for m in ("target", "background")])


def frequent(table: DataFrame, bits: int = SLOT_BITS) -> pd.DataFrame:
    """The most frequent n-gram of each slot with its losses: at most ``2 ** bits`` rows."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["slot"] = slots(b["ctx"].to_numpy(), b["next"].to_numpy(), bits)
            yield b

    placed = table.mapInPandas(place, "ctx long, next int, n long, target_loss double, background_loss double, slot long")
    best = F.max(F.struct("n", "ctx", "next", "target_loss", "background_loss")).alias("best")
    return placed.groupBy("slot").agg(best).select("slot", "best.*").drop("n").toArrow().to_pandas()


def lm_scores(docs: DataFrame, labels: DataFrame, order: int = ORDER, bits: int = SLOT_BITS) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score of every document.

    Tokens are code points.  The target is made of the documents labelled
    quality 1 (outside the held-out fold), the background of all documents.
    Null text counts as empty; an empty text has n_tokens 0, null losses and
    score.  Without labels the target model is uniform.  Repeated rows each
    count and are answered alike; a null id is answered like any other.
    """
    if not 1 < order <= 4:
        raise ValueError("order must be 2, 3 or 4")
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    good = cut(good.select(F.col("doc_id").alias("__id")).distinct())
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    flagged = texts.join(sized(good, 40), F.col("doc_id") == F.col("__id"), "left").select(
        "text", F.col("__id").isNotNull().alias("is_target")
    )
    table = cut(losses(cut(gram_counts(flagged, order)), order))
    top = frequent(table, bits)  # at most 2 ** bits rows
    at = top["slot"].to_numpy()
    held = {"ctx": np.full(1 << bits, -1, dtype=np.int64), "next": np.zeros(1 << bits, dtype=np.int32)}
    held |= {c: np.zeros(1 << bits) for c in ("target_loss", "background_loss")}
    for c in held:
        held[c][at] = top[c].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for b in batches:
            sums = np.zeros((2, len(b)))
            rest: list[list[np.ndarray]] = [[], [], [], []]
            for symbols, place, owner in pieces(b["text"].tolist(), order - 1):
                ctx, following = grams(symbols, place, order)
                slot = slots(ctx, following, bits)
                hit = (known["ctx"][slot] == ctx) & (known["next"][slot] == following)
                for k, c in enumerate(("target_loss", "background_loss")):
                    sums[k] += np.bincount(owner[hit], known[c][slot[hit]], len(b))
                for part, x in zip(rest, (owner, ctx, following, np.ones(len(hit), dtype=np.int64))):
                    part.append(x[~hit])
            r = pd.DataFrame(dict(zip(("owner", "ctx", "next", "times"), (np.concatenate(x or [np.zeros(0, np.int64)]) for x in rest))))
            r = r.groupby(["owner", "ctx", "next"], as_index=False).sum()
            ends = np.searchsorted(r["owner"], np.arange(len(b) + 1))
            out = {"doc_id": b["doc_id"], "n_tokens": [len(t) for t in b["text"]]}
            out |= {"target_sum": sums[0], "background_sum": sums[1]}
            out |= {f"r_{c}": [r[c].to_numpy()[i:j] for i, j in zip(ends, ends[1:])] for c in ("ctx", "next", "times")}
            yield pd.DataFrame(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts.select(id_text(), "text").mapInPandas(
        score,
        "doc_id string, n_tokens long, target_sum double, background_sum double,"
        "r_ctx array<long>, r_next array<int>, r_times array<long>",
    )
    scored = cut_wide(scored.withColumn("__row", F.monotonically_increasing_id()))
    rest = scored.where(F.size("r_ctx") > 0).select(
        "__row", F.explode(F.arrays_zip("r_ctx", "r_next", "r_times")).alias("g")
    )
    rest = rest.select("__row", F.col("g.r_ctx").alias("ctx"), F.col("g.r_next").alias("next"), F.col("g.r_times").alias("times"))
    more = rest.join(table, ["ctx", "next"]).groupBy("__row").agg(
        *[F.sum(F.col("times") * F.col(f"{m}_loss")).alias(f"more_{m}") for m in ("target", "background")]
    )
    out = scored.drop("r_ctx", "r_next", "r_times").join(more, "__row", "left")

    def mean(m: str) -> Column:
        total = F.col(f"{m}_sum") + F.coalesce(f"more_{m}", F.lit(0.0))
        return F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias(f"{m}_loss")

    out = out.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_tokens", mean("target"), mean("background"))
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))
